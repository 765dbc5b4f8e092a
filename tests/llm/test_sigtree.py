"""Groups by Jaccard similarity with signature trees against brute force."""

import random

import numpy as np
import pytest

from skygrain.llm import queries, sigtree

SF = "/root/testdata/sf0.001"


def _set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def _brute(rows, alike=90, of=100):
    """rows: (id, text). Id, size and smallest id of the component of every row."""
    sets, root = [_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * of >= alike * max(len(a), len(b)) and of * len(a & b) >= alike * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((key, len(s), least.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def _changed(pick, text, rate):
    words = text.split()
    for at in pick.sample(range(len(words)), max(1, int(len(words) * rate))):
        words[at] = "zuq%d" % pick.randrange(10_000)
    return " ".join(words)


def _found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _found(queries.op12_ngram_jaccard(spark, SF)) == _brute(rows)


@pytest.mark.parametrize("chunk, visitors", [(512, 1024), (8, 3)])
def test_groups_as_brute_force(spark, monkeypatch, chunk, visitors):
    """A hot group of near copies, some linked only through others; chunks of a few sets go through rounds and visits."""
    monkeypatch.setattr(sigtree, "CHUNK_SETS", chunk)
    monkeypatch.setattr(sigtree, "VISITORS", visitors)
    pick = random.Random(6)
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(120).collect()]
    base = next(t for t in rows if 200 < len(t.split()) < 400)
    chain = [base]
    for _ in range(25):
        chain.append(_changed(pick, chain[-1], 0.015))
    rows += chain + [_changed(pick, base, rate) for rate in [0.01] * 40 + [0.02] * 40 + [0.04] * 20] + [_changed(pick, pick.choice(rows[:120]), 0.01) for _ in range(60)]
    rows += [" ".join(f"w{pick.randrange(12)}" for _ in range(pick.randrange(1, 15))) for _ in range(60)] + [base] * 30
    pairs = list(enumerate(rows))
    found = _found(sigtree.near_sets(spark.createDataFrame(pairs, "doc_id long, text string")))
    expected = _brute(pairs)
    assert found == expected and len({c for _, _, c in expected}) < len(rows) - 100


def test_every_similar_pair_shares_a_key():
    pick = np.random.default_rng(5)
    for alike in (90, 80):
        sizes = sigtree.Sizes(alike, 100)
        tried = 0
        for n in [*range(8, 60), *pick.integers(60, 3000, 60)]:
            for _ in range(6):
                a = np.unique(pick.integers(0, 1 << 63, n, dtype=np.uint64))
                drop = int(pick.integers(0, len(a) // 10 + 2))
                b = np.union1d(pick.choice(a, max(1, len(a) - drop), replace=False), pick.integers(0, 1 << 63, int(pick.integers(0, drop + 1)), dtype=np.uint64))
                if sigtree.alike_sets(a, b, alike) and not np.array_equal(a, b):
                    tried += 1
                    assert np.intersect1d(sigtree.keys(a, sizes), sigtree.keys(b, sizes)).size
        assert tried > 150


def test_trees_lose_no_pair_and_prune():
    pick = np.random.default_rng(2)
    groups = [np.unique(pick.integers(0, 1 << 63, 120, dtype=np.uint64)) for _ in range(12)]
    sets = [np.union1d(pick.choice(g, len(g) - int(pick.integers(0, 9)), replace=False), pick.integers(0, 1 << 63, 3, dtype=np.uint64)) for g in groups for _ in range(15)]
    near = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sigtree.alike_sets(sets[i], sets[j])}
    tree = sigtree.Tree(sets, 1024)
    i, j = sigtree.meet(tree, tree)
    met = {tuple(sorted((int(tree.order[a]), int(tree.order[b])))) for a, b in zip(i, j)}
    assert near and near <= met and len(met) < len(sets) ** 2 / 8
    one, two = sigtree.Tree(sets[:70], 1024), sigtree.Tree(sets[70:75], 1024)
    i, j = sigtree.meet(one, two)
    assert {(a, b) for a, b in near if a < 70 <= b < 75} <= {(int(one.order[a]), 70 + int(two.order[b])) for a, b in zip(i, j)}
    joined = list(sigtree.joins(sets, list(range(len(sets)))))
    assert {tuple(sorted(p)) for p in joined} <= near and len(joined) < len(sets)


def test_odd_rows(spark):
    texts = [None, "", " \n", "A", "a", "a b", "A b c", "x " * 5000, None, "É a b c", "é a b c", "X\tx x x x x", "x " * 4000, " ".join(map(str, range(30_000)))]
    texts.append(texts[-1] + " more")
    rows = [(k if k != 8 else None, t) for k, t in enumerate(texts)] + [(5, "a b"), (3, "other words are here"), (None, "only null keys"), (None, "only null keys"), (5, "a B")]
    rows += [(None, " ".join(map(str, range(100)))), (None, " ".join(map(str, range(1, 100)))), (None, " ".join(map(str, range(100))))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "'h' as home", "2 as n_shingles", "3 as size")
    assert _found(sigtree.near_sets(frame)) == _brute(rows)
    assert sigtree.near_sets(frame.limit(0)).count() == 0
