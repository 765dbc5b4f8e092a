"""Ranked search by dense tiles against brute force."""

import math
import random
import re

import numpy as np
import pytest

from skygrain.llm import queries, ranking

SF = "/root/testdata/sf0.001"


def _terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def _brute(docs, items, k=20):
    """docs, items: (id, text). The rows that ``search`` gives."""
    bags = [(i, _terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out, texts = [], {}
    for i, t in items:
        if i is not None and t is not None:
            texts[i] = min(texts.get(i, t), t)
    for item, text in texts.items():
        scored = []
        for i, b in bags:
            m = 75 + (25 * len(b) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b.count(t)) // (1000 * b.count(t) + 12 * m)) for t in _terms(text) if t in df and t in b)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def _found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = _brute(docs, items)
    assert len(expected) == 20 * len(items) and _found(queries.op13_ranked_search(spark, SF)) == expected


@pytest.mark.parametrize("tile, block, width, slab", [(3, 2, 1, 2), (40, 256, 5, 7), (2048, 256, 4096, 512)])
def test_tiles_ties_and_odd_rows(spark, monkeypatch, tile, block, width, slab):
    for name, value in (("TILE_DOCUMENTS", tile), ("BLOCK_ITEMS", block), ("SLAB", slab)):
        monkeypatch.setattr(ranking, name, value)
    monkeypatch.setattr(ranking._cuts, "__defaults__", (width,))
    pick = random.Random(3)
    words = ["ant", "Bee", "cäse", "DOG", "eel", "fox1", "gnü", "hen", "Ä", "ä"]
    docs = [(i, " ".join(pick.choices(words, k=pick.randrange(1, 30)))) for i in range(60)]
    docs += [(100 + i, "ant, bee; hen!") for i in range(30)]                       # ties for a third of the rows
    docs += [(7, "ant bee hen"), (7, "ant bee hen"), (None, "ant ant"), (300, None), (301, ""), (302, " .,! "), (303, "fox1 " * 3000), (304, "x" * 50_000)]
    items = [(1, "ant BEE ant"), (2, "zebra"), (3, None), (4, ""), (5, "Ä cäse GNÜ"), (6, "fox1 " * 40), (6, "hen"), (None, "ant"), (8, "x" * 50_000), (9, "hen-ant_dog")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "'n' as n", "2 as tile", "3 as item_id")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as block")
    for k in (5, 20):
        assert _found(ranking.search(frame, asked, k)) == _brute(docs, items, k)
    assert ranking.search(frame.limit(0), asked, 5).count() == 0 and ranking.search(frame, asked.limit(0), 5).count() == 0


def test_sums_stay_exact():
    """Column tiles end before a float sum could be inexact, and one heavy column is multiplied as integers."""
    heavy = (1 << 53) // ranking._MOST
    for weights in ([heavy // 2] * 3, [5 * heavy, 1, 2], [1] * 10):
        cuts = ranking._cuts(np.array(weights), 4)
        assert cuts[0] == 0 and cuts[-1] == len(weights)
        assert all(b - a == 1 or (b - a <= 4 and sum(weights[a:b]) * ranking._MOST < 1 << 53) for a, b in zip(cuts, cuts[1:]))
    weights = np.array([5 * heavy, heavy // 2, heavy // 2, heavy // 2 + 1, 3])
    impacts = np.array([ranking._MOST - 1, ranking._MOST - 3, ranking._MOST, ranking._MOST - 7, 999_983])
    terms = np.arange(5) * 11 - 20
    found = ranking.scores((np.zeros(5, int), terms, impacts), 1, (np.zeros(5, int), terms, weights), 1)
    assert int(found[0, 0]) == sum(int(w) * int(i) for w, i in zip(weights, impacts))
