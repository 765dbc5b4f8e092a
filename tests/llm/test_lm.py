"""Language-model scores against plain counting; the softmax is a distribution and learns."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skygrain.llm import common, lm, queries

SF = "/root/testdata/sf0.001"


def _tokens(text):
    return [*(text or "").encode().lower().split(), b"</s>"]


def _base(rows):
    """(key, text, train) rows to (n_tokens, n_known, N, base)."""
    counts = Counter(w for _, t, train in rows if train for w in _tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for key, text, _ in rows:
        words = _tokens(text)
        out.append((key, len(words), sum(w in counts for w in words), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)))
    return out


def _compare(found, rows, key="doc_id"):
    got = sorted(((r[key], r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=str)
    for g, e in zip(got, sorted(_base(rows), key=str), strict=True):
        assert g[:4] == e[:4] and g[4] == pytest.approx(e[4], rel=1e-9, abs=1e-9)


def test_query(spark):
    docs = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = queries.op9_lm_scoring(spark, SF).collect()
    _compare(found, docs)
    train = {d: t for d, _, t in docs}
    assert all(r.held_out != train[r.doc_id] for r in found)
    # the model predicts held-out text better than the unigram base
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


@pytest.mark.parametrize("block", [16 << 20, 50])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_CHARS", block)
    rows = [(1, "A b a B c", True), (2, None, True), (3, "", False), (4, "a z É é", False), (None, "a", True), (4, "a z É é", False), (5, "b\x0bc\td", True), (6, "w " * 30_000, False)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, train boolean, c string")
    _compare(lm.score(docs, docs["train"]).collect(), rows)
    _compare(lm.score(docs, docs["train"] & docs["doc_id"].isNull() & docs["doc_id"].isNotNull()).collect(), [(k, t, False) for k, t, _ in rows])
    assert lm.score(docs.limit(0), docs["train"]).count() == 0


def test_histories_start_anew_with_each_document():
    classes, starts = np.array([5, 6, 7, 0, 0, 8, 0]), np.array([0, 4, 5])
    s = lm.START
    expected = [(s, s), (s, 5), (5, 6), (6, 7), (s, s), (s, s), (s, 8)]
    assert lm.histories(classes, starts).tolist() == [a * (lm.CLASSES + 1) + b for a, b in expected]


def test_softmax_adds_up_and_learns(spark):
    pick = np.random.default_rng(1)
    weights = pick.normal(size=(lm.BUCKETS, lm.CLASSES))
    assert np.allclose(np.exp(lm.log_softmax(weights, np.arange(0, 4000, 7))).sum(axis=1), 1)
    # "a" follows "b" and nothing else does
    text = "a b " * 400
    docs = spark.createDataFrame([(k, text) for k in range(5)], "doc_id long, text string")
    rows = lm.score(docs, docs["doc_id"] < 4).collect()
    assert all(r.score > 0.2 * r.base_score for r in rows)


def test_words_of_a_history_are_told_apart(spark):
    """What follows a word depends on that very word, however many others share its class."""
    pick = np.random.default_rng(2)
    left, right = ["l%d" % k for k in range(300)], ["r%d" % k for k in range(300)]
    line = lambda: " ".join(w for k in range(200) for w in ((str(pick.choice(left)), "yes") if pick.random() < 0.5 else (str(pick.choice(right)), "no")))
    rows = [(k, line()) for k in range(120)]
    rows += [(1000, "l7 yes r9 no " * 50), (1001, "l7 no r9 yes " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm.score(docs, docs["doc_id"] < 120).collect()}
    # 100 times the right word: more than 0.15 decimal digits each
    assert found[1000] > found[1001] + 15


def test_expected_counts_equal_a_plain_model(spark):
    pick = np.random.default_rng(5)
    texts = [" ".join("w%d" % w for w in pick.integers(0, 9, 30)) for _ in range(8)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("cast(text as binary) as text").repartition(3)
    weights = pick.normal(size=(lm.BUCKETS, lm.CLASSES)).astype(np.float32)
    frequent, known = [b"w1", b"w2"], lm._Classes([b"w1", b"w2"])
    seen, expected = np.zeros((lm.BUCKETS, lm.CLASSES)), np.zeros((lm.BUCKETS, lm.CLASSES))
    for t in texts:
        two = one = lm.WORDS - 1
        for w in lm.tokens(t.encode()):
            word, cls = divmod(known[w], lm.CLASSES)
            at = lm.features(np.array([two * lm.WORDS + one]), lm.WORDS)[0]
            logits = weights[at].sum(axis=0, dtype=float)
            for b in at:
                seen[b, cls] += 1
                expected[b] += np.exp(logits) / np.exp(logits).sum()
            two, one = one, word
    assert (lm._observed(docs, frequent) == seen).all()
    assert np.allclose(lm._expected(docs, frequent, weights), expected, rtol=1e-4, atol=1e-4)


def test_expected_counts_equal_a_plain_softmax(spark):
    """The sums over all tokens, added up bucket by bucket as doubles, equal those of one token after another."""
    texts = ["a b c a b", "", "b " * 700, "x y z", "é a\tb"]
    weights = np.random.default_rng(2).normal(size=(lm.BUCKETS, lm.CLASSES)).astype(np.float32)
    plain = np.zeros((lm.BUCKETS, lm.CLASSES))
    batch = pa.record_batch([pa.array([t.encode() for t in texts], pa.binary())], ["text"])
    for at, _ in lm._tokens([batch], [b"a", b"b"]):
        for row in at:
            chance = np.exp(lm._logits(weights, row[None]))[0].astype(float)
            for b in row:
                plain[b] += chance
    docs = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    assert np.allclose(lm._expected(docs, [b"a", b"b"], weights), plain, rtol=1e-6, atol=1e-9)


def test_sums_take_bounded_memory():
    """What is gathered at a time is bounded, however long the runs; running sums of all rows were as large as the rows."""
    rows, cuts = np.ones((200, 64)), np.array([0, 3, 5, 400_000])
    tracemalloc.start()
    out = common.weighted_sums(np.ones(400_000), np.arange(400_000) % 200, rows, cuts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(out[:, 0], np.diff(cuts)) and peak < 40e6
