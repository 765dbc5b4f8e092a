"""The pipeline's stages, each against brute force on its own input, and odd rows through all of them."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from skygrain.llm import decontaminate as d
from test_simhash import _print, _roots

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in cp.STAGES[:-1]:
        found = cp.durable(stage(spark, docs, SF), "test")
        assert found.columns == docs.columns
        out.append((docs.collect(), found.collect()))
        docs = found
    return out


def test_stages_keep_clean_documents(spark, steps):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = steps[0]
    assert len(after) >= 0.99 * len(before)
    before, after = steps[1]
    kept = {r.doc_id for r in after}
    good = [r.doc_id for r in before if quality.get(r.doc_id) == 1]
    bad = [r.doc_id for r in before if quality.get(r.doc_id) == 0]
    assert sum(k in kept for k in good) >= 0.95 * len(good) and sum(k in kept for k in bad) <= 0.3 * len(bad)


def test_one_of_each_group_stays(steps):
    before, after = steps[2]
    roots = _roots([_print(r.text) for r in before], [r.doc_id for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(roots))


def test_leaks_go(spark, steps):
    before, after = steps[3]
    items = [b" " + b" ".join(d.words(r.text.encode())) + b" " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before if any(i in b" " + b" ".join(d.words(r.text.encode())) + b" " for i in items)}
    assert leaks and {r.doc_id for r in after} == {r.doc_id for r in before} - leaks


def test_run_encodes_what_is_left(spark, steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = cp.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in steps[-1][1]}
    assert {r.doc_id: (r.n_tokens, r.ids) for r in rows} == {k: (len(e.ids), e.ids) for k, e in ((k, library.encode(t, add_special_tokens=False)) for k, t in texts.items())}


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    good = docs.first().text
    odd = spark.createDataFrame([(None, good + " more words at the end here", None, None, None), (900_001, None, "en", "s", 0), (900_002, "", None, None, 0),
                                 (900_003, "12 !?", "fr", None, None), (0, docs.filter("doc_id = 0").first().text, "en", None, None), (900_004, good + " of the" * 40_000, "en", None, 1)], docs.schema)
    rows = docs.limit(60).union(odd).selectExpr("*", "'x' as label", "1 as leaks", "2 as fingerprint", "3 as component_id", "4 as score")
    for _, stage in cp.STAGES[:-1]:
        found = cp.durable(stage(spark, rows, SF), "test")
        assert found.columns == rows.columns
        rows = found
    ids = [r.doc_id for r in cp.STAGES[-1][1](spark, rows, SF).collect()]
    assert ids and not {900_001, 900_002, 900_003} & set(ids) and ids.count(0) <= 1
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0
