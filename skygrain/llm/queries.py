"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain.llm import bond, bpe, chat, decontaminate, kdtree, langid, lm, quality, ranking, records, sigtree, simhash, warc
from skygrain.llm.common import fold, table
from skygrain.session import scratch_root

VOCABULARY = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.learn(docs.filter(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chat.transcripts(table(spark, sf_dir, "conversations"))
    return chat.parse(lines, chat.learn(lines.filter(fold(F.col("conv_id"), 5) != 0)))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{scratch_root(spark)}/warc-{spark.sql('select uuid()').first()[0]}"
    found = warc.read(spark, warc.write(table(spark, sf_dir, "pages"), root))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality.learn(docs, labels.filter(~held_out))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{scratch_root(spark)}/records-{spark.sql('select uuid()').first()[0]}"
    written = records.write(table(spark, sf_dir, "documents"), root, public_tokenizers.path(VOCABULARY))
    return records.digests(spark, written).withColumnRenamed("key", "doc_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    return lm.score(docs, ~held_out).withColumn("held_out", held_out)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", kdtree.quantised(F.col("embedding")).alias("vector"))
    return kdtree.top_k(rows, rows.filter("vec_id % 50 = 0"), 5)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), kdtree.quantised(F.col("embedding")).alias("vector"))
    return bond.mine(rows, F.expr("vec_id % 100 = 0"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.near_sets(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_chat": op3_chat,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_token_records": op6_token_records,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_top_k": op10_top_k,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES: dict[str, str] = {
    "op10_top_k": """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and list_count(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
asked as (select * from vectors where vec_id % 50 = 0 qualify row_number() over (partition by vec_id order by v) = 1),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
  from asked q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op11_hard_negatives": """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and list_count(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
anchors as (
  select * from vectors where vec_id % 100 = 0 qualify row_number() over (partition by vec_id order by label, v) = 1),
scored as (
  select a.vec_id as anchor_id, r.vec_id as vec_id, a.label = r.label as same,
    cast(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) as bigint) as score
  from anchors a join vectors r on a.vec_id <> r.vec_id and len(a.v) = len(r.v)),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score,
    cast(row_number() over (partition by anchor_id order by score desc, vec_id) as int) as positive_rank
  from scored where same qualify positive_rank <= 5),
windows as (
  select p.anchor_id, p.positive_id, p.positive_rank, p.positive_score, n.vec_id as negative_id, n.score as negative_score
  from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
    and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_rank order by negative_score desc, negative_id) as int) as rank,
  negative_id, positive_score, negative_score, positive_rank
from windows qualify rank <= 10""",
    "op12_ngram_jaccard": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as grams
  from words),
sized as (select doc_id, coalesce(len(grams), 0) as n, grams from sets),
flat as (select doc_id, n, unnest(grams) as gram from sized),
both as (
  select a.doc_id as a, b.doc_id as b, a.n as x, b.n as y, count(*) as c
  from flat a join flat b on a.gram = b.gram and a.doc_id < b.doc_id and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n group by all),
pairs as (select a, b from both where 100 * c >= 90 * (x + y - c)),
links as (select a, b from pairs union select b, a from pairs),
reached(node, other) as (
  select doc_id, doc_id from sized union select r.node, l.b from reached r join links l on r.other = l.a)
select s.doc_id, cast(s.n as bigint) as n_shingles, cast(min(r.other) as bigint) as component_id
from sized s join reached r on r.node = s.doc_id group by s.doc_id, s.n""",
    "op13_ranked_search": r"""
with lowered as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term, row_id
  from (select *, row_number() over () as row_id from documents)),
postings as (select row_id, doc_id, term, count(*) as tf from lowered group by all),
lengths as (select row_id, cast(sum(tf) as bigint) as n from postings group by all),
totals as (select count(*) as documents, cast(sum(n) as bigint) as terms from lengths),
norms as (select row_id, 100 - 25 + ((25 * n * documents) // terms) as m from lengths, totals),
weights as (
  select term, cast(floor(1000 * ln((2.0::double * documents + 2) / (2.0::double * count(*) + 1))) as bigint) as w
  from postings, totals group by term, documents),
wanted as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select item_id, min(text) as text from benchmark where item_id is not null group by item_id)),
asked as (select item_id, term, count(*) as q from wanted group by all),
scored as (
  select item_id, row_id, doc_id, cast(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from asked join postings using (term) join weights using (term) join norms using (row_id)
  where doc_id is not null group by all)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
from scored where score > 0 qualify rank <= 20""",
}
