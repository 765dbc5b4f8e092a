"""Language and quality classifiers: held-out accuracy, gradients, codes, odd rows."""

import zlib

import numpy as np
import pytest

from skygrain.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_codebook_keeps_languages_apart():
    assert langid.codebook(0).shape == (0, 0) and langid.codebook(1).shape == (1, 0)
    for n in (2, 3, 4, 6, 9, 40):
        book = langid.codebook(n)
        apart = [(book[i] != book[j]).sum() for i in range(n) for j in range(i)]
        assert set(np.unique(book)) == {-1, 1} and min(apart) >= max(1, book.shape[1] // 4)
        assert (np.abs(book.sum(axis=0)) < n).all()


def test_ngrams_do_not_depend_on_the_batch():
    texts = ["Der Hund, 12", "", None, "a" * 5, "été ça", "12 !?", "x y"]
    together, letters = langid.ngram_counts(texts)
    assert letters.tolist() == [7, 0, 0, 5, 5, 0, 2]
    for k, t in enumerate(texts):
        alone, _ = langid.ngram_counts([t])
        assert (alone[0] == together[k]).all()
    assert langid.ngram_counts(["ab " * 900_000])[1][0] == 1_800_000


@pytest.fixture(scope="module")
def languages(spark):
    return queries.op1_language_id(spark, SF).collect()


def test_language_query(spark, languages):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in languages) == sorted(truth)
    held = [r for r in languages if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 for r in languages)
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.98
    assert np.mean([r.ambiguous for r in languages]) < 0.02


def test_language_odd_rows(spark):
    rows = [(1, "der hund und die katze " * 9, "de", 1.0), (2, "the dog and the cat " * 9, "en", 2.0), (3, None, "en", None),
            (4, "", "de", 1.0), (None, "123 !?", None, 1.0), (2, "the dog and the cat " * 9, "en", 2.0), (6, "und " * 100_000, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    found = langid.identify(docs, langid.learn(docs))
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]
    got = sorted((str(r.doc_id), r.lang_pred, r.score > 0, r.ambiguous) for r in found.collect())
    assert got == [("1", "de", True, False), ("2", "en", True, False), ("2", "en", True, False), ("3", "und", False, True),
                   ("4", "und", False, True), ("6", "de", True, False), ("None", "und", False, True)]
    for few in (docs.limit(0), docs.filter("lang is null")):
        assert {r.lang_pred for r in langid.identify(docs, langid.learn(few)).collect()} == {"und"}
    one = langid.identify(docs, langid.learn(docs.filter("lang = 'de'"))).collect()
    assert {r.lang_pred for r in one} == {"de", "und"}
    assert langid.identify(docs.limit(0), langid.learn(docs)).count() == 0


def test_close_languages_are_flagged(spark):
    same = [(k, "la casa de la que en", "pt" if k % 2 else "gl") for k in range(40)] + [(99, "the and of with", "en")]
    docs = spark.createDataFrame(same, "doc_id long, text string, lang string")
    found = langid.identify(docs, langid.learn(docs)).collect()
    assert all(r.ambiguous for r in found if r.doc_id < 40) and not any(r.ambiguous for r in found if r.doc_id == 99)


def test_quality_query(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op5_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_attention_gradient_is_exact():
    pick = np.random.default_rng(1)
    params = {k: pick.normal(0, 0.3, p.shape) for k, p in quality.fresh_parameters().items()}
    x, starts = pick.normal(size=(9, quality.FEATURES)), np.array([0, 4, 5])
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss(p):
        s = quality.Forward(p, x, starts).score
        penalty = sum(5e-6 * (p[k] ** 2).sum() for k in ("e", "v", "u", "c"))
        return -(weight * (label * np.log(s) + (1 - label) * np.log(1 - s))).sum() / weight.sum() + penalty

    found = quality.Forward(params, x, starts)
    assert np.allclose(np.add.reduceat(found.attention, starts), 1)
    gradient = found.gradient(label, weight)
    for name, p in params.items():
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 5)]:
            up, down = {k: v.copy() for k, v in params.items()}, {k: v.copy() for k, v in params.items()}
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - gradient[name][at]) < 1e-6


def test_passages():
    assert quality.passages(b"").shape == (1, quality.FEATURES) and not quality.passages(b" \n").any()
    assert len(quality.passages(b"w " * 64)) == 1 and len(quality.passages(b" w" * 65)) == 2
    assert quality.passages(b"a b a b")[0, -4] == 0.5 and quality.passages(b"a a b")[0, -3] == np.float32(1 / 3)
    assert len(quality.passages(b"x" * 500_000)) == 1


def test_quality_odd_rows(spark):
    rows = [(1, "Good text here. " * 50, "x"), (2, "JUNK!! " * 50, "x"), (3, None, "x"), (4, "", "x"), (None, "Good.", None), (2, "JUNK!! " * 50, "x")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string, label string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (77, 1)], "doc_id long, quality int")
    found = quality.score(docs, quality.learn(docs, labels))
    assert found.columns == ["doc_id", "text", "label", "score"] and dict(found.dtypes)["score"] == "double"
    got = {r.text: r.score for r in found.collect()}
    assert found.count() == 6 and got["Good text here. " * 50] > got["JUNK!! " * 50] and got[None] == got[""]
    assert {r.score for r in quality.score(docs, quality.learn(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.learn(docs, labels)).count() == 0


def _labelled(n, copies, pick):
    """``copies`` texts of each of ``n`` made-up languages, each with its own syllables."""
    out = []
    for k in range(n):
        syllables = ["".join(pick.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(6)]
        out += [(len(out) + i, " ".join("".join(pick.choice(syllables, 2)) for _ in range(40)), f"l{k:03d}") for i in range(copies)]
    return out


def test_decoding_equals_brute_force(spark):
    pick = np.random.default_rng(3)
    rows = _labelled(9, 12, pick)
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [t for _, t, _ in rows[::5]] + ["abc", "x"]
    names, scores, flags = model.predict(texts)
    margins = model.margins(langid.ngram_counts(texts)[0])
    for m, name, score, flag in zip(margins, names, scores, flags):
        # loss-weighted decoding: every bit costs log(1 + exp(-code * margin)) by its weight for the language
        cost = [sum(np.log1p(np.exp(-b * c)) * w for b, c, w in zip(m, word, weight)) * len(m) for word, weight in zip(model.code, model.weights)]
        chance = np.exp(min(cost) - np.array(cost)) / np.exp(min(cost) - np.array(cost)).sum()
        first, second = np.sort(chance)[::-1][:2]
        assert name == model.languages[int(np.argmin(cost))] and score == pytest.approx(first, rel=1e-4)
        assert bool(flag) == (first - second < langid.AMBIGUOUS) or abs(first - second - langid.AMBIGUOUS) < 1e-4


def test_every_label_is_learned_and_copies_do_not_fill_the_sample(spark, monkeypatch):
    """600 languages, one of which is a single text a third of all rows repeat."""
    rows = _labelled(600, 3, np.random.default_rng(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hot = spark.createDataFrame([rows[0]] * 900, docs.schema)
    written = {}
    monkeypatch.setattr(langid, "durable", lambda df, label: written.setdefault(label, df.cache()))
    model = langid.learn(docs.union(hot))
    assert len(model.languages) == 600 and written["language-sample"].count() <= 1800
    got = langid.identify(docs, model).collect()
    assert len({r.lang_pred for r in got}) > 570 and np.mean([r.lang_pred == r.lang for r in got]) > 0.9


def test_rows_outside_the_sample_are_learned(spark, monkeypatch):
    """Half of a language's texts have words of their own, and the sample holds none of them."""
    pick = np.random.default_rng(6)
    monkeypatch.setattr(langid, "SAMPLE", 30)
    monkeypatch.setattr(langid, "share", lambda key, part: key[0].rlike("^(ka|mo)"))
    made = lambda start, syllables: start + " " + " ".join("".join(pick.choice(syllables, 2)) for _ in range(30))
    rows = [(made("ka", ["ka", "lu"]), "a") for _ in range(40)] + [(made("mo", ["mo", "se"]), "b") for _ in range(40)]
    unseen = [made("zi", ["zi", "xo"]) for _ in range(1200)]
    rows += [(t, "b") for t in unseen]
    docs = spark.createDataFrame(rows + rows[:3] * 5, "text string, lang string").repartition(3)
    alone = langid.learn(docs.filter("not text like 'zi%'").limit(0).union(docs.filter("text rlike '^(ka|mo)'")))
    model = langid.learn(docs)
    chance = lambda m: np.mean([s if n == "b" else 1 - s for n, s in zip(*m.predict(unseen[:50])[:2])])
    assert chance(model) > chance(alone) + 0.05 and model.predict(["ka lu kalu lulu", "mo se mose"])[0] == ["a", "b"]


def test_copies_weigh_as_one_text(spark):
    rows = [("one two", "a")] * 9 + [("three", "a"), ("four", "b")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    keys = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 1.0)], "lang string, label int, part double")
    found = langid._weighed(docs, keys).groupBy("text").agg({"weight": "sum"}).collect()
    assert {r[0]: pytest.approx(r[1]) for r in found} == {"one two": 0.5, "three": 0.5, "four": 1.0}


def test_quality_learns_from_labels_outside_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 40)
    monkeypatch.setattr(quality, "share", lambda key, rate: key[0] < 80)
    texts = {"Good text here. ": 1, "JUNK!! ": 0, "12 34 567 ": 0}
    rows = [(k, ["Good text here. ", "JUNK!! "][k % 2] * 30) for k in range(80)] + [(k, "12 34 567 " * 30) for k in range(80, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(text like 'Good%' as int) as quality")
    test = spark.createDataFrame([(t * 30,) for t in texts], "text string")
    got = {r.text[:4]: r.score for r in quality.score(test, quality.learn(docs.repartition(3), labels)).collect()}
    few = {r.text[:4]: r.score for r in quality.score(test, quality.learn(docs.filter("doc_id < 80"), labels.filter("doc_id < 80"))).collect()}
    assert got["12 3"] < 0.1 and got["12 3"] < few["12 3"] and got["Good"] > 0.5
