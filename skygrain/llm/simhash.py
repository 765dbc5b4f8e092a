"""SimHash fingerprints and groups of near copies, found by pigeonring filtering.

A fingerprint of 64 bits is four segments of 16 on a ring. If two fingerprints
differ in at most 3 bits, then from some segment on, every chain of l
consecutive segments differs in at most floor(3 l / 4) bits: 0, 1, 2, 3. So some
segment is equal and the next differs in one bit at most, that is, one of its halves
is equal too. Fingerprints meet under these 24 bits, eight times each, and
a pair must pass the chain of its segment before its Hamming distance counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.llm.common import bounds, grouped, slices
from skygrain.llm.components import components
from skygrain.session import durable

WORDS, SEED, BITS = 3, 42, 64
DISTANCE, SEGMENTS = 3, 4
# Fingerprints of a bucket that meet in one task; larger buckets are cut into parts that meet in pairs.
BUCKET = 2048


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority of the bits of all shingles' hashes; 0 without a word."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined, width = b" ".join(tokens), min(words, len(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:len(tokens) - width + 1].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``key`` and ``fp`` (the 64 bits as a signed long) of every row's whole text; a null text has no words."""
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), F.lit("").alias("_mark"))
    return _prints(rows, words).select(F.col("_key").alias(key), "fp")


def _prints(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """``_key, _mark`` and ``fp`` of every row of ``_key, _text, _mark``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            found = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["_key", "_mark", "fp"])

    return rows.select("_key", "_mark", F.coalesce("_text", F.lit("")).cast("binary").alias("_text")).mapInArrow(run, "_key long, _mark string, fp long")


def _chain(first: np.ndarray, second: np.ndarray, segment: np.ndarray | int) -> np.ndarray:
    """Pairs whose chain from ``segment`` on stays within its budgets, the last of which is the Hamming distance."""
    turn = np.asarray(16 * segment, np.uint64)
    differ = first ^ second
    differ = (differ >> turn) | (differ << ((np.uint64(64) - turn) & np.uint64(63)))
    passed = np.ones(differ.shape, bool)
    for length in range(1, SEGMENTS + 1):
        left = np.flatnonzero(passed)
        mask = np.uint64((1 << 16 * length) - 1)
        passed[left] = np.bitwise_count(differ[left] & mask) <= DISTANCE * length // SEGMENTS
    return passed


def _forest(fps: np.ndarray, segment: int) -> Iterator[tuple[int, int]]:
    """Links that join all of one bucket's fingerprints that can be reached from each other, one fewer than each such set has.

    A fingerprint is compared only with those that are not reached yet.
    """
    left = np.arange(len(fps))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = _chain(fps[left], fps[node], segment)
            for other in left[near].tolist():
                yield node, other
                queue.append(other)
            left = left[~near]


# Buckets up to this size compare all their pairs at once.
_SMALL = 24


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in grouped(batches, ["bucket", "part"]):
        keys = np.stack([table.column(k).to_numpy() for k in ("bucket", "part")], axis=1)
        nodes, fps = table.column("node").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
        ends = bounds(keys)
        sizes = np.diff(ends)
        segment = keys[:, 0] >> 25
        group = np.repeat(np.arange(len(sizes)), sizes)
        few = np.repeat(sizes <= _SMALL, sizes)
        pairs = []
        for step in range(1, min(_SMALL, int(sizes.max()))):
            at = np.flatnonzero(few[:-step] & (group[:-step] == group[step:]))
            if not len(at):
                break
            at = at[_chain(fps[at], fps[at + step], segment[at])]
            pairs.append(np.stack([nodes[at], nodes[at + step]], axis=1))
        for g in np.flatnonzero(sizes > _SMALL):
            a, b = ends[g], ends[g + 1]
            forest = list(_forest(fps[a:b], int(segment[a])))
            if forest:
                pairs.append(nodes[a:b][np.array(forest)])
        if pairs:
            found = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def links(points: DataFrame, bucket_size: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect exactly the nodes that fingerprints at most 3 bits apart connect.

    ``points``: ``node, fp``, each fingerprint once. Within a bucket the links are
    all pairs or a spanning forest. A bucket over ``bucket_size`` is cut into parts by a
    hash of the fingerprint, and every two parts meet in a group of their own.
    """
    keys = []
    for segment in range(SEGMENTS):
        following = (segment + 1) % SEGMENTS
        for half in range(2):
            # segment | half | the equal segment | the equal half of the next one
            keys.append(f"{(segment << 1 | half) << 24}L | (shiftrightunsigned(fp, {16 * segment}) & 65535L) << 8"
                        f" | (shiftrightunsigned(fp, {16 * following + 8 * half}) & 255L)")
    spread = points.selectExpr("node", "fp", f"explode(array({', '.join(keys)})) as bucket")
    full = durable(spread.groupBy("bucket").count().filter(F.col("count") > bucket_size)
                   .select("bucket", F.ceil(F.col("count") / bucket_size).cast("int").alias("parts")), "full")
    if full.isEmpty():
        parted = spread.withColumn("part", F.lit(0))
    else:
        cut = spread.join(full, "bucket", "left").withColumn("own", F.expr("pmod(xxhash64(fp), coalesce(parts, 1))").cast("int"))
        pair = "transform(sequence(0, coalesce(parts, 1) - 1), p -> least(p, own) * coalesce(parts, 1) + greatest(p, own))"
        parted = cut.select("node", "fp", "bucket", F.explode(F.expr(pair)).alias("part"))
    return (parted.select("node", "fp", "bucket", "part").repartition("bucket", "part").sortWithinPartitions("bucket", "part", "node")
            .mapInArrow(_links, "a long, b long"))


def _grouped(prints: DataFrame) -> DataFrame:
    """``fp, root`` of every fingerprint: the component that links of 3 or fewer bits make."""
    points = durable(prints.select("fp").distinct(), "classes")
    found = components(links(points.select(F.col("fp").alias("node"), "fp")))
    return durable(points.join(found, points["fp"] == found["node"], "left").select("fp", F.coalesce("component", "fp").alias("root")), "rooted")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Rows are linked at 3 or fewer differing bits; ``component_id`` is the smallest
    key that can be reached, the own one included. Texts without words
    have the fingerprint zero and are linked like any others; so are null texts. A null key
    links too but is never the smallest; a component of null keys has a null id. Repeated rows and
    rows that share a key stay, each with the component of its own text. Other columns are not read;
    an empty table gives an empty one.
    """
    prints = durable(fingerprints(docs, key, text, words).select(F.col(key).alias("key"), "fp"), "fingerprints")
    rooted = _grouped(prints)
    ids = durable(prints.groupBy("fp").agg(F.min("key").alias("least")).join(rooted, "fp").groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = durable(rooted.join(ids, "root").select("fp", "component_id"), "named")
    return (prints.join(named, "fp")
            .select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row of each group of near copies; all columns as they were.

    It is the row with the smallest key, a null key being the largest; of rows that share this key, but not the text, the one
    whose text has the least MD5. Of rows equal in key and text one stays. Groups are of texts: rows that share
    a key belong together only if their texts do, so the last copy of a text goes only where a near copy of it stays.
    """
    mark = F.md5(F.coalesce(F.concat(F.lit("t"), F.col(text)), F.lit("")).cast("binary"))
    marked = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), mark.alias("_mark"))
    prints = durable(_prints(marked, words), "fingerprints")
    rooted = _grouped(prints)
    first = F.min(F.struct(F.col("_key").isNull().alias("missing"), "_key", "_mark")).alias("f")
    kept = durable(prints.join(rooted, "fp").groupBy("root").agg(first).select("f._key", "f._mark"), "kept")
    copies = prints.groupBy("_key", "_mark").agg(F.count("*").alias("n")).filter("n > 1")
    found = docs.withColumns({"_key": F.col(key).cast("long"), "_mark": mark})

    def among(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        same = F.col("_key").eqNullSafe(F.col("_other_key")) & (F.col("_mark") == F.col("_other_mark"))
        return rows.join(some.select(F.col("_key").alias("_other_key"), F.col("_mark").alias("_other_mark")), same, how)

    repeated = durable(among(copies.select("_key", "_mark"), kept, "left_semi"), "repeated")
    out = among(found, kept, "left_semi")
    if not repeated.isEmpty():
        # rows equal in key and text: partial aggregation leaves one a task before anything is moved
        again = among(out, repeated, "left_semi").groupBy("_key", "_mark").agg(F.first(F.struct(*docs.columns)).alias("r")).select("r.*")
        return among(out, repeated, "left_anti").select(*docs.columns).union(again)
    return out.select(*docs.columns)
