"""Leaks of benchmark passages: exact copies, paraphrases, recall of the candidate search, odd rows."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from skygrain.llm import decontaminate as d
from skygrain.llm import common, queries
from skygrain.llm.common import text_slices

SF = "/root/testdata/sf0.01"


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(new[-1], row[k + 1]))
        row = new
    return row[-1]


def test_common_is_the_longest_common_subsequence():
    pick = random.Random(1)
    for _ in range(200):
        item = [b"%d" % pick.randrange(8) for _ in range(pick.randrange(1, 40))]
        region = [b"%d" % pick.randrange(9) for _ in range(pick.randrange(60))]
        bits = d.common(d.Passage(0, item, 0).positions, len(item), region)
        assert bits.bit_count() == _lcs(item, region)
        for k in range(1, len(item)):  # bits of a beginning are its own length
            assert (bits & (1 << k) - 1).bit_count() == _lcs(item[:k], region)


@pytest.fixture(scope="module")
def space(spark):
    return d.learn(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))


def test_query_finds_every_copy_and_nothing_else(spark, space):
    docs = [(r.doc_id, b" " + b" ".join(d.words(r.text.encode())) + b" ") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, b" " + b" ".join(d.words(r.text.encode())) + b" ") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    copies = {(k, i) for k, t in docs for i, b in items if b in t}
    found = queries.op7_decontamination(spark, SF).collect()
    assert copies and {(r.doc_id, r.item_id) for r in found} == copies
    assert all(r.common == 1 for r in found)


def test_candidates_lose_nothing(spark, space, monkeypatch):
    """Every leak that the check of all windows finds is a candidate, paraphrases of a third of the words included."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 150").collect()]
    pick = random.Random(2)
    planted = []
    for item, text in items:
        for rate in (0, 0.1, 0.2, 0.3):
            parts = [pick.choice(["other", "words", "zuq%d" % pick.randrange(99)]) if pick.random() < rate else w for w in text.split()]
            host = pick.choice(docs).split()[:300]
            at = pick.randrange(len(host) + 1)
            planted.append(" ".join([*host[:at], *parts, *host[at:]]))
    passages = [p for i, t in items for p in d.passages_of(i, t.encode())]
    found = [{x["item_id"] for x in d.Searcher(space, passages).leaks(t.encode())} for t in planted]
    monkeypatch.setattr(d, "COSINE", -2.0)
    every = [{x["item_id"] for x in d.Searcher(space, passages).leaks(t.encode())} for t in planted]
    total = sum(map(len, every))
    assert total > len(items) * 2
    assert sum(len(a & b) for a, b in zip(found, every)) / total > 0.98


def test_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa. lambda mu nu xi omicron"
    items = spark.createDataFrame([(1, item), (2, None), (None, item), (3, ""), (4, "too short"), (5, item.upper() + " pi rho"), (1, item), (6, item + " x" * 500)], "item_id long, text string")
    space = d.learn(spark.read.parquet(f"{SF}/documents.parquet"), items)
    texts = [None, "", "!!", item, "x " * 3000 + item.replace(" ", "\n") + " y" * 3000, "alpha beta gamma", item, "other words " * 40_000]
    docs = spark.createDataFrame([(k if k != 6 else None, t, "x", k) for k, t in enumerate(texts)] + [(3, item, "x", 3)], "doc_id long, text string, leaks string, item_id int")
    kept = d.clean(docs, items, space)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 5, 7]
    found = d.find(docs, items, space).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found if r.item_id == 1) == [("3", 1), ("3", 1), ("4", 1), ("None", 1)]
    assert not {r.item_id for r in found} & {2, 3, 4, None}
    assert d.clean(docs.limit(0), items).count() == 0 and d.clean(docs, items.limit(0)).count() == docs.count()


def test_items_in_several_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(20)) + " tail " + " ".join(f"w{(k + 1) % 30}x{j}" for j in range(20))) for k in range(30)], "doc_id long, text string")
    space = d.learn(spark.read.parquet(f"{SF}/documents.parquet"), items)
    monkeypatch.setattr(d, "ITEM_BLOCK", 7)
    assert sorted((r.doc_id, r.item_id) for r in d.find(docs, items, space).collect()) == sorted((k, i) for k in range(30) for i in (k, (k + 1) % 30))


def test_svd_finds_the_leading_directions():
    pick = np.random.default_rng(3)
    texts = [b" ".join(b"t%dw%d" % (topic, w) for w in pick.permutation(32)) for topic in pick.integers(0, 10, 80)]
    cells = d._cells(texts, [1.0] * len(texts), np.ones(d.BUCKETS))
    matrix = np.zeros((len(texts), d.BUCKETS))
    matrix[cells[0], cells[1]] = cells[2]
    assert np.allclose(np.linalg.norm(matrix, axis=1), 1)
    basis = pick.normal(size=(d.BUCKETS, 4))
    assert np.allclose(d._project(cells, basis), matrix @ basis)
    assert np.allclose(d._back(cells, matrix @ basis), matrix.T @ (matrix @ basis))


@pytest.mark.parametrize("low,high", [(8, 14), (15, 64), (65, 150)])
def test_copies_are_found_whatever_the_space(low, high):
    """In a space of zeros nothing is near; whole copies, and those that keep most words, are found by their runs."""
    pick = random.Random(low)
    word = lambda: "w%d" % int(400 * pick.random() ** 2)
    items = [[word() for _ in range(pick.randint(low, high))] for _ in range(1500)]
    passages = [p for k, i in enumerate(items) for p in d.passages_of(k, " ".join(i).encode())]
    searcher = d.Searcher(d.Space(np.zeros((d.BUCKETS, d.RANK), np.float32)), passages)
    for k in range(0, 1500, 10):
        host = [word() for _ in range(pick.randrange(200))]
        at = pick.randrange(len(host) + 1)
        assert k in {x["item_id"] for x in searcher.leaks(" ".join([*host[:at], *items[k], *host[at:]]).encode())}
        changed = ["zuq" if n % 8 == 7 else w for n, w in enumerate(items[k])]
        assert k in {x["item_id"] for x in searcher.leaks(" ".join([*host[:at], *changed, *host[at:]]).encode())}
    assert searcher.leaks(b"") == [] and searcher.leaks(b"two words") == []


def test_short_items_are_found_by_their_sequence():
    searcher = d.Searcher(d.Space(np.zeros((d.BUCKETS, d.RANK), np.float32)), [p for k, t in enumerate(["Who wrote it?", "one", "a b c d e f g"]) for p in d.passages_of(k, t.encode())])
    found = lambda text: [x["item_id"] for x in searcher.leaks(text)]
    assert found(b"who, wrote it") == [0] and found(b"x a b c d e f g y a b one") == [1, 2]
    assert found(b"who it wrote a b c d e f") == [] and found(b"") == [] and found(b"wrote it") == []


def test_a_long_items_answer_counts_for_each_passage():
    question, answer = ["q%d" % k for k in range(110)], ["a%d" % k for k in range(20)]
    item = (" ".join(question) + ". " + " ".join(answer)).encode()
    passages = d.passages_of(7, item)
    assert len(passages) > 1
    searcher = d.Searcher(d.Space(np.zeros((d.BUCKETS, d.RANK), np.float32)), passages)
    # seven words of ten stay in the question
    some = " ".join("zuq" if k % 10 in (3, 6, 8) and k < 43 else w for k, w in enumerate(question[:43]))
    assert not searcher.leaks(some.encode())
    template = " ".join("zuq" if k % 10 in (3, 6, 8) else w for k, w in enumerate(question))
    assert not searcher.leaks((template + " other answer here").encode())
    assert [x["item_id"] for x in searcher.leaks((template + ". " + " ".join(answer)).encode())] == [7]
    assert [x["item_id"] for x in searcher.leaks(item)] == [7]


def test_space_is_fitted_on_every_document(spark):
    """A few documents with words of their own among 4,000 others: their directions are in the space, and equal a plain SVD's."""
    pick = random.Random(8)
    common_words = ["c%d" % k for k in range(60)]
    texts = [" ".join(pick.choices(common_words, k=40)) for _ in range(4000)]
    rare = [" ".join("r%dx%d" % (k, j) for j in range(32)) for k in range(3)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + rare * 4)], "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, texts[0])], "item_id long, text string")
    space = d.learn(docs, items)
    assert all(np.linalg.norm(space.of(t.encode().split())) > 0.99 for t in rare)
    own = [d.buckets(t.encode().split()) for t in rare]
    # nothing else has their words, so all three, and each for itself, are directions
    found = np.stack([space.vectors[ids].sum(axis=0) / np.linalg.norm(space.vectors[ids].sum(axis=0)) for ids in own])
    assert np.allclose(found @ found.T, np.eye(3), atol=0.1)


def test_products_equal_the_whole_matrix(spark):
    pick = np.random.default_rng(4)
    texts = [" ".join("w%d" % w for w in pick.integers(0, 300, pick.integers(0, 90))) for _ in range(500)] + [None, "", "a a a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    numbered, idf = d._numbered(docs, "text"), pick.random(d.BUCKETS) + 0.5
    frequency, rows = d.document_frequencies(numbered)
    sets = [set(d.buckets(d.words((t or "").encode())).tolist()) for t in texts]
    assert rows == len(texts) and all(frequency[b] == sum(b in s for s in sets) for b in range(0, d.BUCKETS, 97))
    cells = d._cells([(t or "").encode() for t in texts], [1.0] * len(texts), idf)
    matrix = np.zeros((cells[0].max() + 1, d.BUCKETS))
    matrix[cells[0], cells[1]] = cells[2]
    basis = pick.normal(size=(d.BUCKETS, 3))
    assert np.allclose(d._product(numbered, basis, idf), matrix.T @ (matrix @ basis), rtol=1e-3, atol=1e-3)


def _batches(texts):
    numbers = [d.buckets(d.words(t)).astype(np.uint16).tobytes() for t in texts]
    return [pa.record_batch([pa.array(numbers[k:k + 7], pa.binary())], ["ids"]) for k in range(0, len(texts), 7)]


def test_products_in_pieces_equal_the_whole_matrix(monkeypatch):
    """Texts longer than a piece, runs longer than what is gathered, repeated words at the cuts."""
    pick = np.random.default_rng(6)
    texts = [b" ".join(b"w%d" % w for w in pick.integers(0, high, size)) for high, size in [(2, 700), (300, 500), (5, 33), (9, 64), (300, 10), (3, 0), (1, 90)] * 4]
    idf, basis = pick.random(d.BUCKETS) + 0.5, pick.normal(size=(d.BUCKETS, 3))
    cells = d._cells(texts, [1.0] * len(texts), idf)
    matrix = np.zeros((cells[0].max() + 1, d.BUCKETS))
    matrix[cells[0], cells[1]] = cells[2]
    monkeypatch.setattr(d, "PIECE_WORDS", 64)
    monkeypatch.setattr(common, "GATHER", 16)
    total = np.zeros(basis.shape)
    for ids, sizes in d._pieces(_batches(texts)):
        assert len(ids) <= 64 == d.PIECE_WORDS and sizes.sum() == len(ids)
        part = d._matrix(ids, sizes, idf)
        d._add_back(total, part, d._project(part, basis))
    assert np.allclose(total, matrix.T @ (matrix @ basis))


def test_long_texts_take_bounded_memory():
    """The search and the products of many long texts hold the vectors of a part of their words only."""
    pick = random.Random(9)
    texts = [" ".join("w%d" % pick.randrange(3000) for _ in range(20_000)).encode() for _ in range(30)]
    searcher = d.Searcher(d.Space(np.ones((d.BUCKETS, d.RANK), np.float32)), d.passages_of(1, b" ".join(b"q%d" % k for k in range(30))))
    batch = d.Batch(texts)
    tracemalloc.start()
    next(searcher.candidates(batch), None)
    search = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    total, basis = np.zeros((d.BUCKETS, d.RANK)), np.ones((d.BUCKETS, d.RANK))
    for ids, sizes in d._pieces(_batches(texts)):
        part = d._matrix(ids, sizes, np.ones(d.BUCKETS))
        d._add_back(total, part, d._project(part, basis))
    product = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert search < 120e6 and product < 150e6, (search, product)


def test_slices_are_bounded_by_text():
    texts = ["a" * 50, None, "b" * 300, "", "c" * 60, "d" * 30, "e" * 20]
    batch = pa.record_batch([pa.array(texts), pa.array(range(7))], ["text", "k"])
    found = [b.column(1).to_pylist() for b in text_slices([batch], 0, 100)]
    assert [k for f in found for k in f] == list(range(7)) and [0, 1] in found
    assert all(len(f) == 1 or sum(len(texts[k] or "") for k in f) <= 100 for f in found)


def test_search_by_written_numbers_equals_search_by_text(spark, space):
    """Without a space the search goes by the numbers that the fit has written; columns and rows stay as they are."""
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    one, two = d.annotate(docs, items), d.annotate(docs, items, space)
    assert one.columns == two.columns == [*docs.columns, "leaks"]
    found = [sorted((r.doc_id, r.text, [x.item_id for x in r.leaks]) for r in rows.collect()) for rows in (one, two)]
    assert found[0] == found[1] and any(x[2] for x in found[0])


def test_fit_makes_few_matrices_whatever_the_files(spark):
    """A matrix for each of a thousand small files would be 8 GB."""
    numbered = d._numbered(spark.createDataFrame([("some words",)] * 300, "text string").repartition(100), "text")
    tasks = d._dealt(numbered).rdd.getNumPartitions()
    assert tasks <= spark.sparkContext.defaultParallelism and d._dealt(numbered).count() == 300
    assert d.document_frequencies(d._dealt(numbered.limit(0)))[1] == 0
