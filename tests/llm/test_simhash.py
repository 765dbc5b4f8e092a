"""Fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from skygrain.llm import queries, simhash
from skygrain.llm.components import components

SF = "/root/testdata/sf0.001"


def _print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            root[find(i)] = find(int(j))
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(prints))]


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    prints = [_print(t) for _, t in docs]
    roots = _roots(prints, [d for d, _ in docs])
    rows = {r.doc_id: r for r in queries.op2_simhash_near_dedup(spark, SF).collect()}
    assert {d: (f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, roots)} == {d: (r.fingerprint, r.component_id) for d, r in rows.items()}


def test_odd_rows(spark):
    texts = [None, "", " \n", "A", "a", "a b", "A b c", "x " * 5000, None, "É a b c", "é a b c"]
    rows = [(k if k != 8 else None, t, k) for k, t in enumerate(texts)] + [(5, "a b", 0), (3, "other words are here", 1)]
    found = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    prints = [_print(t) for _, t, _ in rows]
    expected = _roots(prints, [k for k, _, _ in rows])
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=key) == sorted(
        ((k, f"{p:016x}", c) for (k, _, _), p, c in zip(rows, prints, expected)), key=key)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp int"))
    assert kept.columns == ["doc_id", "text", "fp"]
    groups = {}  # two groups may have the same smallest id
    for (k, _, _), g in zip(rows, _roots(prints, range(len(rows)))):
        groups.setdefault(g, []).append(k)
    least = [min(k for k in keys if k is not None) for keys in groups.values() if set(keys) != {None}]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(least)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_copies(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_one_row_stays_and_no_text_is_lost(spark):
    """Rows that share or lack a key: groups are of texts, the survivor is a row."""
    a, b, c = ("the quick brown fox jumps over it all day", "another text of quite other words than that one", "a third one nobody else has copied so far")
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "y"), (9, b, "y"), (None, a, "z"), (None, c, "n"), (None, c, "n"), (None, None, "n"), (8, c + " 1", "s"), (8, c + " 1", "s"), (8, c + " 1", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string").selectExpr("*", "1 as root", "2 as _n")
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(frame).collect()]
    prints = {t: _print(t) for t in (a, b, c, c + " 1")}
    near = bin(prints[c] ^ prints[c + " 1"]).count("1") <= 3
    expected = [(3, a), (5, b), (8, c + " 1"), (None, None)] + ([] if near else [(None, c)])
    assert sorted(kept, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("bucket", [2048, 30])
def test_links_connect_as_brute_force(spark, bucket):
    pick = random.Random(3)
    points = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = pick.getrandbits(64)
        for _ in range(60):
            value = centre
            for b in pick.sample(range(64), pick.randrange(9)):
                value ^= 1 << b
            points.add(value)
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(s, s) for s in signed], "node long, fp long")
    pairs = simhash.links(frame, bucket)
    for r in pairs.collect():
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 3
    found = {r.node: r.component for r in components(pairs).collect()}
    expected = _roots(points, signed)
    assert {s: found.get(s, s) for s in signed} == dict(zip(signed, expected))


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5), (2000, 2001), (2001, 2000), (2000, 2001)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)} | {2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
