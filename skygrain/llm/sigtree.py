"""Groups of documents whose shingle sets are alike by Jaccard similarity, by signature trees.

A signature tree has sets as leaves; every node holds the OR of the bitmaps below it, the range of their sizes and the largest
number of elements that a bitmap hides by collisions. Two nodes are met from the roots down: what they have in common at most
follows from the bits that both hold, and if that is too little for their smallest sizes, no pair below them
is looked at. Leaves that pass are compared as sets.

Sets that can be alike come together by an exact rule. Sets of neighbouring sizes deal their elements to ``d + 2`` cells by
hash, where ``d`` is the greatest number of elements in which two similar sets of these sizes can differ. At least two
cells are then equal, so every pair shares the key of a cell's whole content (of two cells, where cells have
few elements). Each set's home is the largest group it shares a key with. Homes are cut into chunks of bounded size, each a
tree that meets itself; what it joins is represented by one set in the next round, until a home is one chunk.
After that only groups with sets that are not joined yet are left. There all sets but those of the
largest component visit the chunks of the others, once for each chunk, and the visitors' tree meets the chunk's.

Links that would join what is joined already are not looked for: the components are exact, the list of pairs is not given.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.llm.common import bounds, grouped, ragged, slices
from skygrain.llm.components import components
from skygrain.session import durable, small_side

WORDS, SEED = 3, 42
# Similarity as a fraction of whole numbers, so that every comparison is exact.
ALIKE, OF = 90, 100
# Sets and shingles of a chunk, visitors that meet it at a time, children of a node, and bits of a bitmap for each element.
CHUNK_SETS, CHUNK_SHINGLES, VISITORS, FANOUT, BITS = 512, 1 << 18, 1024, 8, 8
# A cell with fewer elements than this is no key by itself.
LEAST = 3
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_WORK = 1 << 20


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles in order; a text of fewer words is one shingle, one without a word none."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined, width = b" ".join(tokens), min(words, len(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:len(tokens) - width + 1].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64))


class Sizes:
    """Ranges of set sizes, each half again as large as the one before, and the cells that sets of a range are dealt to."""

    def __init__(self, alike: int = ALIKE, of: int = OF):
        self.alike, self.of, self.first = alike, of, [1]
        while self.first[-1] < 1 << 40:
            self.first.append(max(self.first[-1] + 1, self.first[-1] * 3 // 2))

    def differ(self, size: int, other: int) -> int:
        """Most elements that are in only one of two similar sets of at most these sizes."""
        return (size + other) * (self.of - self.alike) // (self.of + self.alike)

    def ranges(self, size: int) -> Iterator[tuple[int, int]]:
        """The size's own range, and the ranges above it that a similar larger set can be in; with their number of cells.

        A similar set is at most ``of / alike`` times as large, and the pair meets in the larger one's range.
        """
        k = int(np.searchsorted(self.first, size, "right")) - 1
        while self.first[k] <= size * self.of // self.alike:
            differ = self.differ(self.first[k + 1] - 1, self.first[k + 1] - 1)
            if differ:
                yield k, differ + 2
            k += 1


def keys(grams: np.ndarray, sizes: Sizes) -> np.ndarray:
    """What a set shares with every similar but unequal set: at least one of these keys."""
    out = []
    for which, cells in sizes.ranges(len(grams)) if len(grams) else ():
        cell = (grams % np.uint64(cells)).astype(np.int64)
        count = np.bincount(cell, minlength=cells)
        content = np.zeros(cells, np.uint64)
        np.add.at(content, cell, (grams ^ (grams >> np.uint64(29))) * _ODD[0])
        content = (content ^ (np.arange(cells, dtype=np.uint64) * _ODD[1]) ^ (content >> np.uint64(31))) * _ODD[0] ^ np.uint64(which * int(_ODD[2]) % (1 << 64))
        out.append(content[count >= LEAST])
        small = content[count < LEAST]
        if len(small) > 1:
            a, b = np.triu_indices(len(small), 1)
            out.append((small[a] * _ODD[1]) ^ (small[b] + _ODD[2]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Tree:
    """Sets in an order that brings alike ones together, and levels of nodes above them, the leaves first."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        heads = np.array([np.resize(s[:4], 4) for s in sets], np.uint64).reshape(-1, 4)
        self.order = np.lexsort(heads.T[::-1])
        self.sets = [sets[i] for i in self.order]
        size = np.array([len(s) for s in self.sets], np.int64)
        row = np.repeat(np.arange(len(sets)), size)
        bit = (np.concatenate(self.sets) & np.uint64(bits - 1)).astype(np.int64)
        marks = np.zeros((len(sets), bits), bool)
        marks[row, bit] = True
        bitmap = np.packbits(marks, axis=1).view(np.uint64)
        hidden = size - np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmap, size, size, hidden)]
        while len(self.levels[-1][1]) > 1:
            bitmap, low, high, hidden = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bitmap, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(hidden, at)))

    def level(self, k: int) -> tuple:
        return self.levels[min(k, len(self.levels) - 1)]


def _passes(one: tuple, two: tuple, i: np.ndarray, j: np.ndarray, alike: int, of: int) -> np.ndarray:
    """Pairs of nodes below which a similar pair is possible."""
    (bits, low, high, hidden), (bits2, low2, high2, hidden2) = one, two
    good = (of * high[i] >= alike * low2[j]) & (of * high2[j] >= alike * low[i])
    at = np.flatnonzero(good)
    step = max(1, _WORK // bits.shape[1])
    for a in range(0, len(at), step):
        some = at[a:a + step]
        p, q = i[some], j[some]
        both = np.bitwise_count(bits[p] & bits2[q]).sum(axis=1, dtype=np.int64) + np.minimum(hidden[p], hidden2[q])
        both = np.minimum(both, np.minimum(high[p], high2[q]))
        good[some] = (alike + of) * both >= alike * (low[p] + low2[q])
    return good


def meet(one: Tree, two: Tree, alike: int = ALIKE, of: int = OF) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves (positions in each tree's order) that the bitmaps do not rule out; of a tree with itself each once."""
    own = one is two
    i = j = np.zeros(1, np.int64)
    for k in range(max(len(one.levels), len(two.levels)) - 1, -1, -1):
        good = _passes(one.level(k), two.level(k), i, j, alike, of)
        i, j = i[good], j[good]
        if k:
            down = [np.arange(FANOUT), np.zeros(1, np.int64)]
            steps, steps2 = down[k >= len(one.levels)], down[k >= len(two.levels)]
            scale, scale2 = (FANOUT if len(s) > 1 else 1 for s in (steps, steps2))
            i, j = (np.broadcast_arrays((scale * i)[:, None, None] + steps[:, None], (scale2 * j)[:, None, None] + steps2))
            i, j = i.ravel(), j.ravel()
            keep = (i < len(one.level(k - 1)[1])) & (j < len(two.level(k - 1)[1]))
            i, j = i[keep], j[keep]
        if own:
            keep = i <= j if k else i < j
            i, j = i[keep], j[keep]
    return i, j


def alike_sets(a: np.ndarray, b: np.ndarray, alike: int = ALIKE, of: int = OF) -> bool:
    both = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return of * both >= alike * (len(a) + len(b) - both)


def joins(sets: list[np.ndarray], components_: list[int], visitors: list[np.ndarray] | None = None, visiting: list[int] | None = None,
          alike: int = ALIKE, of: int = OF) -> Iterator[tuple[int, int]]:
    """Similar pairs (of ``sets`` and ``visitors``, or within ``sets``) that join all that similar pairs join.

    Sets of one component are joined already.
    """
    longest = max(map(len, [*sets, *(visitors or [])]))
    bits = max(64, 1 << (BITS * longest - 1).bit_length())
    one = Tree(sets, bits)
    two = one if visitors is None else Tree(visitors, bits)
    first = np.array(components_)[one.order]
    second = first if visitors is None else np.array(visiting)[two.order]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = up = root.get(up, up)
            x = up
        return x

    i, j = meet(one, two, alike, of)
    some = np.lexsort((j, i))
    for p, q in zip(i[some].tolist(), j[some].tolist()):
        a, b = find(int(first[p])), find(int(second[q]))
        if a != b and alike_sets(one.sets[p], two.sets[q], alike, of):
            root[a] = b
            yield int(one.order[p]), int(two.order[q])


def _prints(docs: DataFrame, key: str, text: str, words: int, alike: int, of: int) -> DataFrame:
    """``key, digest`` (of the set), ``size`` and ``keys`` of every row."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(alike, of)
        for batch in slices(batches):
            sets = [shingles(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                                              ragged([keys(s, sizes).view(np.int64) for s in sets], pa.int64())], ["key", "digest", "size", "keys"])

    return rows.mapInArrow(run, "key long, digest binary, size long, keys array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``node, grams`` of each of ``nodes`` (``node, digest, least``), from the rows that have its smallest key."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    wanted = nodes.filter("least is not null").select(F.col("least").alias("key")).distinct()
    # classes of rows without a key are found among all rows without one
    some = rows.join(small_side(wanted), "key", "left_semi").select("key", "text").union(rows.filter("key is null"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = {xxhash.xxh128_digest(s.tobytes()): s for s in (shingles(t, words) for t in batch.column(1).to_pylist())}
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.binary()), pa.array([s.tobytes() for s in sets.values()], pa.binary())], ["digest", "grams"])

    found = durable(some.mapInArrow(run, "digest binary, grams binary").join(small_side(nodes.select("node", "digest")), "digest").select("node", "grams"), "found")
    if found.groupBy("node").count().filter("count > 1").isEmpty():
        return found
    return durable(found.groupBy("node").agg(F.first("grams").alias("grams")), "sets")  # rows that repeat key and text


def _stars(ids: list[int], pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Every id that ``pairs`` (of positions) join to a smaller one, and the smallest it is joined to."""
    group = list(range(len(ids)))

    def find(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        if ids[i] > ids[j]:
            i, j = j, i
        group[j] = i  # the smallest id of a group is its root
    return [(ids[i], ids[find(i)]) for i in range(len(ids)) if group[i] != i]


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _meetings(rows: DataFrame, alike: int, of: int) -> DataFrame:
    """Of every chunk the components ``a`` that are joined to a smaller one, ``b``; if it has visitors, links ``a, b`` of its sets
    (``visits`` 0) with them (1).

    ``rows``: ``home, part, block, visits, node, component, grams``; within a chunk without visitors components are unique.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["home", "part", "block"]):
            key = np.stack([table.column(k).to_numpy() for k in ("home", "part", "block")], axis=1)
            nodes, visits, component = (table.column(k).to_numpy() for k in ("node", "visits", "component"))
            ends, grams = bounds(key).tolist(), table.column("grams")
            for a, b in zip(ends, ends[1:]):
                if b - a < 2:
                    continue
                sets = [np.frombuffer(g, np.uint64) for g in grams.slice(a, b - a).to_pylist()]
                own, names = int(np.count_nonzero(visits[a:b] == 0)), component[a:b].tolist()
                if own == b - a:
                    found = _stars(names, joins(sets, names, alike=alike, of=of))
                elif own:
                    found = [(nodes[a + i], nodes[a + own + j]) for i, j in joins(sets[:own], names[:own], sets[own:], names[own:], alike, of)]
                if own and found:
                    yield _pairs(found)

    dealt = rows.select("home", "part", "block", "visits", "node", "component", "grams").repartition("home", "part", "block").sortWithinPartitions("home", "part", "block", "visits", "node")
    return dealt.mapInArrow(run, "a long, b long")


def _parted(rows: DataFrame) -> DataFrame:
    """``rows`` (``node, size, home``) with the ``part`` of its home that each is in, and the number of ``parts``."""
    count = rows.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / CHUNK_SETS), F.ceil(F.sum("size") / CHUNK_SHINGLES)).cast("int").alias("parts"))
    return rows.join(count, "home").withColumn("part", F.expr("cast(pmod(xxhash64(node), parts) as int)"))


def _links(nodes: DataFrame, shared: DataFrame, sets: DataFrame, alike: int, of: int) -> DataFrame:
    """Links that join all nodes that similar pairs join. ``shared``: ``bucket, node, size, n`` (the bucket's number of nodes)."""
    homes = durable(shared.groupBy("node", "size").agg(F.max(F.struct("n", "bucket")).alias("h")).select("node", "size", F.col("h.bucket").alias("home")), "homes")
    chunks = durable(_parted(homes), "chunks")
    plain = (F.lit(0).alias("block"), F.lit(0).alias("visits"))
    # every set is in one chunk, so what a chunk joins is all there is to join before the visits
    found = _meetings(sets.join(small_side(chunks), "node").select("home", "part", *plain, "node", F.col("node").alias("component"), "grams"), alike, of)
    named = durable(homes.select("node").join(found, F.col("node") == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("component")), "components")
    cut, before = chunks.select("home", "node", "size", "parts"), None
    while True:
        # one set for each component of a home that has several chunks
        many = cut.filter("parts > 1").join(named, "node").groupBy("home", "component").agg(F.min(F.struct("node", "size")).alias("s"))
        cut = durable(_parted(many.select("home", "component", "s.node", "s.size")), "again")
        seen = cut.count()
        if not seen or (before is not None and 2 * seen > before):
            break  # what is not joined by now meets as visitors
        found = durable(_meetings(sets.join(small_side(cut), "node").select("home", "part", *plain, "node", "component", "grams"), alike, of), "joined")
        named = durable(named.join(found, F.col("component") == F.col("a"), "left").select("node", F.coalesce("b", "component").alias("component")), "components")
        cut, before = cut.select("home", "node", "size", "parts"), seen

    weights = named.groupBy("component").agg(F.count("*").alias("weight"))
    placed = durable(chunks.select("node", "home", "part").join(named, "node").join(weights, "component"), "placed")
    open_ = shared.join(placed.select("node", "component"), "node").groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    # buckets of the same members have the same meetings: one of them is enough
    members = shared.join(open_, "bucket").groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("u"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("v"))
    once = members.groupBy("n", "u", "v").agg(F.min("bucket").alias("bucket")).select("bucket")
    mixed = durable(shared.join(once, "bucket").select("bucket", "node", "size").join(placed, "node"), "mixed")
    lead = mixed.groupBy("bucket").agg(F.max(F.struct("weight", "component")).alias("lead"))
    mixed = durable(mixed.join(lead, "bucket").withColumn("leads", F.col("component") == F.col("lead.component")).drop("lead", "weight"), "led")
    hosts = mixed.groupBy("bucket", F.col("home").alias("h"), F.col("part").alias("p")).agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.min("size").alias("low"), F.max("size").alias("high"), F.max("leads").alias("leading"))
    guests = mixed.filter("not leads").drop("leads")
    # of two sets that do not lead one visits the other: that of the later chunk
    visits = guests.join(hosts, "bucket").filter(
        f"(leading or struct(h, p) < struct(home, part)) and not (home = h and part = p) and not (x = component and y = component)"
        f" and {of} * size >= {alike} * low and {of} * high >= {alike} * size")
    visits = durable(visits.select("h", "p", "node", "component", "size").distinct(), "visits")
    blocks = durable(visits.groupBy("h", "p").agg(F.greatest(F.ceil(F.count("*") / VISITORS), F.ceil(F.sum("size") / (2 * CHUNK_SHINGLES))).cast("int").alias("blocks")), "blocks")
    guests = sets.join(small_side(visits.join(blocks, ["h", "p"])), "node").select(
        F.col("h").alias("home"), F.col("p").alias("part"), F.expr("cast(pmod(xxhash64(node, 5), blocks) as int)").alias("block"), F.lit(1).alias("visits"), "node", "component", "grams")
    hosts = sets.join(small_side(placed.join(blocks, (F.col("home") == F.col("h")) & (F.col("part") == F.col("p")))), "node").select(
        "home", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("visits"), "node", "component", "grams")
    return named.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(durable(_meetings(hosts.union(guests), alike, of), "links"))


def near_sets(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, alike: int = ALIKE, of: int = OF) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row: the smallest key that links reach, the own one included.

    Rows are linked whose sets of shingles have a Jaccard similarity of ``alike / of`` or more. Rows without a word (empty, blank, null)
    have an empty set and are linked with nothing. A null key links but is never the smallest; a component of null
    keys has a null id. Rows that repeat a key or a text stay, each with the component of its own text; other columns are
    not read; an empty table gives an empty one. Shingles are compared by 64-bit hashes, sets for equality by 128-bit ones.
    """
    prints = durable(_prints(docs, key, text, words, alike, of).withColumn("row", F.monotonically_increasing_id()), "prints")
    classes = durable(prints.filter("size > 0").groupBy("digest").agg(F.min("key").alias("least"), F.min("row").alias("node"), F.max("size").alias("size"), F.count("*").alias("copies")), "classes")
    # of equal sets the first row deals its keys
    several = classes.filter("copies > 1").select("digest", "node")
    copies = durable(prints.select("digest", "row").join(small_side(several), "digest").filter("row <> node").select("row"), "copies")
    spread = prints.filter("size > 0").join(small_side(copies), "row", "left_anti").select(F.col("row").alias("node"), F.explode("keys").alias("bucket"))
    # counted and joined in one exchange, which both sides read; neither holds a bucket's rows at once
    spread = spread.repartition("bucket")
    full = spread.groupBy("bucket").agg(F.count("node").alias("n")).filter("n > 1")
    met = durable(spread.join(full.hint("merge"), "bucket"), "met")
    nodes = durable(classes.join(met.select("node").distinct(), "node", "left_semi"), "nodes")
    shared = durable(met.join(nodes.select("node", "size"), "node"), "shared")
    sets = _sets(docs, nodes, key, text, words)
    found = components(_links(nodes, shared, sets, alike, of)).withColumnRenamed("node", "n")
    rooted = durable(classes.join(found, F.col("node") == F.col("n"), "left").select("digest", "least", F.coalesce("component", "node").alias("root")), "rooted")
    ids = durable(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = durable(rooted.join(ids, "root").select(F.col("digest").alias("d"), "component_id"), "named")
    # an empty set is alone
    return (prints.join(named, F.col("digest") == F.col("d"), "left")
            .select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id")))
