"""Benchmark decontamination by latent semantic retrieval, then longest common subsequences and answers.

Words are hashed to buckets whose inverse document frequencies come from all documents. A
randomised SVD of TF-IDF passages, of all documents and of the whole benchmark, gives
a space of few dimensions; its products are sums over the partitions. Every document is cut into blocks of 16
words whose latent vectors are sums over their words; windows of blocks meet all benchmark passages by
cosine. Passages also meet documents by their runs of three words, whatever the space holds: it
gets crowded as the benchmark grows. A candidate is a leak if the longest common subsequence of words holds nearly all of
the passage, or, for a paraphrase, most of it together with nearly all of its answer, the last sentence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.llm.common import GATHER, cuts_of, rows_for, slices, text_slices, weighted_sums
from skygrain.llm.training import totals
from skygrain.session import durable

BUCKETS, RANK = 1 << 14, 64
# What a passage of the benchmark counts in the basis, a passage of a document being 1.
ITEM_WEIGHT = 8.0
BLOCK_WORDS = 16
# Blocks of a window for passages up to and above this length; longer items are cut into passages.
SHORT_WORDS, PASSAGE_WORDS = 40, 64
SHORT_BLOCKS, LONG_BLOCKS = 2, 4
COSINE = 0.55
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
# Words of a run, and the share of a passage's runs that make a stretch of a document a candidate; one run is enough for short ones.
RUN, RUN_SHARE = 3, 0.1
# Bits of a place in the table that tells most of a document's runs from all of the passages'.
_RUN_BITS = 22
# Items with fewer words are leaks only where all their words stand in order, side by side.
LEAST_WORDS = 8
# Items that meet the documents in one pass.
ITEM_BLOCK = 4096
# Cosines that are computed at a time.
_WORK = 1 << 18
# Words whose cells are in memory at a time, a multiple of those of a passage.
PIECE_WORDS = 1 << 17
# Words a task of the fit goes over at least, where there are more tasks than cores: each gives a matrix of the size of the basis.
TASK_WORDS = 1 << 23
# Bytes of text that meet the items at a time.
SLICE_BYTES = 1 << 18

_WORD = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
# Column of the numbers of a text's words.
NUMBERS = "_bucket_numbers"
LEAK = "struct<item_id:bigint,cosine:double,common:double,answer:double>"


def words(text: bytes) -> list[bytes]:
    """Words in lower case without ASCII marks."""
    return text.translate(_WORD).split()


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word) % BUCKETS
        return found


_buckets = _Buckets()


def buckets(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_buckets.__getitem__, found), np.int64, len(found))


def fresh(ids: np.ndarray) -> np.ndarray:
    """Places whose word is not that before: a word repeated over and over would hide what stands beside it."""
    return np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))


def runs(ids: np.ndarray) -> np.ndarray:
    """One number for each run of ``RUN`` neighbouring words, from their buckets."""
    out = np.zeros(max(0, len(ids) - RUN + 1), np.int64)
    for k in range(RUN):
        out = out * BUCKETS + ids[k:len(ids) - RUN + 1 + k]
    return out


def _places(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _RUN_BITS)).astype(np.int64)


def answer_start(text: bytes) -> int:
    """Word at which the last sentence begins; the last third of a text of one sentence."""
    total, start, at = len(words(text)), 0, 0
    for sentence in text.replace(b"?", b".").replace(b"!", b".").replace(b"\n", b".").split(b"."):
        count = len(words(sentence))
        if count:
            start = at
        at += count
    return start or total - -(-total // 3)


def common(positions: dict[bytes, int], size: int, region: list[bytes]) -> int:
    """Bits of the passage's words that a longest common subsequence with ``region`` holds."""
    full = (1 << size) - 1
    row = full
    for word in region:
        mask = positions.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return full & ~row


@dataclass(frozen=True)
class Passage:
    item_id: int
    words: list[bytes]
    answer: int  # word at which the answer begins
    # of a passage of a longer item: the item's answer, and the words from its beginning to the passage's and from the passage's end to its end
    whole: tuple[bytes, ...] = ()
    before: int = 0
    after: int = 0

    @property
    def positions(self) -> dict[bytes, int]:
        found: dict[bytes, int] = {}
        for k, w in enumerate(self.words):
            found[w] = found.get(w, 0) | 1 << k
        return found


def passages_of(item_id: int, text: bytes) -> list[Passage]:
    """An item as passages of at most ``PASSAGE_WORDS``, of nearly equal length."""
    found = words(text)
    if not found:
        return []
    parts = -(-len(found) // PASSAGE_WORDS)
    cuts = [len(found) * k // parts for k in range(parts + 1)]
    answer = answer_start(text)
    if parts == 1:
        return [Passage(item_id, found, answer)]
    return [Passage(item_id, found[a:b], 0, tuple(found[answer:]), max(0, a - answer), len(found) - b) for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Space:
    """Weighted latent vector of every bucket."""

    vectors: np.ndarray

    def of(self, found: list[bytes]) -> np.ndarray:
        ids = buckets(found)
        vector = self.vectors[ids[fresh(ids)]].sum(axis=0)
        return vector / max(float(np.linalg.norm(vector)), 1e-12)


def _cells(texts: list[bytes], weights: list[float], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the TF-IDF matrix of all passages of 32 words, rows of the stated length."""
    found = [buckets(words(text)) for text in texts]
    sizes = np.array([len(f) for f in found], np.int64)
    row, column, value = _matrix(np.concatenate([*found, np.empty(0, np.int64)]), sizes, idf)
    passages = -(-np.array([len(fresh(f)) if len(f) else 0 for f in found], np.int64) // (BLOCK_WORDS * SHORT_BLOCKS))
    return row, column, value * np.repeat(np.array(weights, float), passages)[row]


def _matrix(ids: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the TF-IDF matrix of texts of so many words, whose buckets follow one another; rows of length 1."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (text[1:] != text[:-1])
    ids, text = ids[new], text[new]
    if not len(ids):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    kept = np.bincount(text, minlength=len(sizes))
    passages = -(-kept // (BLOCK_WORDS * SHORT_BLOCKS))
    within = np.arange(len(ids)) - np.repeat(np.cumsum(kept) - kept, kept)
    row = np.repeat(np.cumsum(passages) - passages, kept) + within // (BLOCK_WORDS * SHORT_BLOCKS)
    cells, count = np.unique(row * BUCKETS + ids, return_counts=True)
    row, column = cells // BUCKETS, cells % BUCKETS
    value = count * idf[column]
    norm = np.sqrt(np.bincount(row, weights=value * value))
    return row, column, value / np.maximum(norm, 1e-12)[row]


def _project(cells: tuple[np.ndarray, np.ndarray, np.ndarray], basis: np.ndarray) -> np.ndarray:
    """The matrix times ``basis``; its rows are those of the passages."""
    row, column, value = cells
    return weighted_sums(value, column, basis, cuts_of(row))


def _add_back(out: np.ndarray, cells: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray) -> None:
    """Add the transposed matrix times ``rows`` to ``out``."""
    row, column, value = cells
    order = np.argsort(column.astype(np.uint16), kind="stable")  # 16-bit numbers are sorted by radix
    column, number = column[order], np.cumsum(np.concatenate([[0], row[1:] != row[:-1]]))
    cuts = cuts_of(column)
    out[column[cuts[:-1]]] += weighted_sums(value[order], number[order], rows, cuts)


def _back(cells: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The transposed matrix times ``rows``."""
    out = np.zeros((BUCKETS, rows.shape[1]))
    _add_back(out, cells, rows)
    return out


def _with_numbers(rows: DataFrame, text: str) -> DataFrame:
    """All columns and ``NUMBERS``, the buckets of the text's words as 16-bit numbers; written, so that texts are cut into words once."""
    at = rows.columns.index(text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [buckets(words(t or b"")).astype(np.uint16).tobytes() for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, NUMBERS])

    return durable(rows.mapInArrow(run, f"{kinds}, {NUMBERS} binary"), "bucket-numbers")


def _numbered(rows: DataFrame, text: str) -> DataFrame:
    """``ids`` of every text, the buckets of its words as 16-bit numbers; written, so that texts are cut into words once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([buckets(words(t)).astype(np.uint16).tobytes() for t in batch.column(0).to_pylist()], pa.binary())], ["ids"])

    return durable(rows.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).mapInArrow(run, "ids binary"), "bucket-numbers")


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words of some texts one after another, and the texts' numbers of words; about ``PIECE_WORDS`` at a time.

    A longer text comes in several parts, without words that repeat the one before and cut between its passages.
    """
    ids: list[np.ndarray] = []
    total = 0
    for batch in batches:
        for text in batch.column(0):
            found = np.frombuffer(text.as_buffer(), np.uint16)
            if len(found) > PIECE_WORDS:
                found = found[fresh(found)]
            for low in range(0, len(found), PIECE_WORDS):
                part = found[low:low + PIECE_WORDS]
                if ids and total + len(part) > PIECE_WORDS:
                    yield np.concatenate(ids).astype(np.int64), np.array(list(map(len, ids)), np.int64)
                    ids, total = [], 0
                ids.append(part)
                total += len(part)
    if ids:
        yield np.concatenate(ids).astype(np.int64), np.array(list(map(len, ids)), np.int64)


def _dealt(numbered: DataFrame) -> DataFrame:
    """The numbers in tasks that are worth a matrix each, whatever the files they lie in."""
    size = numbered.agg(F.sum(F.octet_length(numbered.columns[0]).cast("long"))).first()[0]
    return numbered.coalesce(max(numbered.sparkSession.sparkContext.defaultParallelism, rows_for(size, 2 * TASK_WORDS)))


def document_frequencies(numbered: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold a word of each bucket, over all documents, and their number."""
    def count(batches: Iterable[pa.RecordBatch]) -> tuple[int, np.ndarray]:
        total, rows = np.zeros(BUCKETS), 0
        for batch in batches:
            for text in batch.column(0):
                total[np.unique(np.frombuffer(text.as_buffer(), np.uint16))] += 1
            rows += batch.num_rows
        return rows, total

    rows, total = totals(numbered, count, BUCKETS)
    return total, int(rows)


def _product(numbered: DataFrame, basis: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The transposed TF-IDF matrix of all passages times that matrix times ``basis``."""
    def count(batches: Iterable[pa.RecordBatch]) -> tuple[int, np.ndarray]:
        total, pieces = np.zeros(basis.shape), 0
        for ids, sizes in _pieces(batches):
            cells = _matrix(ids, sizes, idf)
            _add_back(total, cells, _project(cells, basis))
            pieces += 1
        return pieces, total.ravel()

    return totals(numbered, count, basis.size)[1].reshape(basis.shape)


def learn(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> Space:
    """The latent space of all documents and the whole benchmark; without either it is one of zeros, in which nothing is near.

    Two passes over the words' numbers make the basis. The strength of its directions in the documents comes from what the second pass has
    found (Nystroem), so that no third is needed; that in the benchmark is worked out again.
    """
    return _fit(_numbered(docs, text), _numbered(items, item_text))


def _fit(ours: DataFrame, theirs: DataFrame) -> Space:
    """The space of ``learn`` from the numbers of the words of the documents and of the items."""
    ours, theirs = _dealt(ours), _dealt(theirs)
    frequency, count = document_frequencies(ours)
    idf = np.log((count + 1) / (frequency + 1)) + 0.1
    basis = np.random.default_rng(5).normal(size=(BUCKETS, RANK))
    for _ in range(2):
        before, found = basis, _product(ours, basis, idf)
        basis = np.linalg.qr(found + ITEM_WEIGHT ** 2 * _product(theirs, basis, idf))[0]
    reached = basis.T @ found
    strength = reached @ np.linalg.pinv(before.T @ found, rcond=1e-9) @ reached.T + basis.T @ _product(theirs, basis, idf)
    values, turn = np.linalg.eigh((strength + strength.T) / 2)
    # directions of frequent words are strong and would hide the others
    scale = np.where(values > 1e-9 * max(float(values.max()), 1e-300), np.maximum(values, 1e-300) ** -0.25, 0)
    return Space((idf[:, None] * (basis @ (turn * scale))).astype(np.float32))


class Searcher:
    """Finds the passages of one block of items in documents."""

    def __init__(self, space: Space, passages: list[Passage]):
        self.space, self.vectors = space, np.concatenate([space.vectors, np.zeros((1, space.vectors.shape[1]), space.vectors.dtype)])
        self.short: dict[bytes, list[Passage]] = {}
        for p in passages:
            if len(p.words) < LEAST_WORDS:
                self.short.setdefault(p.words[0], []).append(p)
        self.begins = np.zeros(BUCKETS, bool)
        self.begins[buckets(list(self.short))] = True
        passages = [p for p in passages if len(p.words) >= LEAST_WORDS]
        self.groups = []
        for blocks, some in ((SHORT_BLOCKS, [p for p in passages if len(p.words) <= SHORT_WORDS]), (LONG_BLOCKS, [p for p in passages if len(p.words) > SHORT_WORDS])):
            if some:
                self.groups.append((blocks, some, np.stack([space.of(p.words) for p in some]).astype(np.float32)))
        self.positions = {id(p): p.positions for p in passages}
        self.counts = {id(p): {w: mask.bit_count() for w, mask in self.positions[id(p)].items()} for p in passages}
        self.distinct = {key: frozenset(counts) for key, counts in self.counts.items()}
        self.passages = passages
        # runs in order, and for each the passages that have it
        found = [np.unique(runs(buckets(p.words))) for p in passages]
        self.needed = np.array([max(1, int(np.ceil(RUN_SHARE * len(f)))) for f in found], np.int64)
        owner, every = np.repeat(np.arange(len(found)), [len(f) for f in found]), np.concatenate([*found, np.empty(0, np.int64)])
        order = np.argsort(every, kind="stable")
        self.runs, starts = np.unique(every[order], return_index=True)
        self.owners, self.owner_ends = owner[order], np.concatenate([starts, [len(every)]])
        self.known = np.zeros(1 << _RUN_BITS, bool)
        self.known[_places(self.runs)] = True

    def candidates(self, batch: "Batch") -> Iterator[tuple[int, Passage, int, int, float]]:
        """Texts, passages, and the first and last word of a window that is near."""
        if not len(batch.place) or not self.groups:
            return
        at, text, begin = batch.place, batch.text[batch.place], batch.starts
        # blocks of BLOCK_WORDS fresh words of a text
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        number = np.arange(len(at)) - np.repeat(first, np.diff([*first, len(at)]))
        starts = np.flatnonzero(number % BLOCK_WORDS == 0)
        owner, end = text[starts], np.repeat([*first[1:], len(at)], np.diff([*np.searchsorted(starts, first), len(starts)]))
        # a short block is filled up with a bucket of no weight
        cells = np.full((len(starts), BLOCK_WORDS), BUCKETS)
        cells[np.cumsum(number % BLOCK_WORDS == 0) - 1, number % BLOCK_WORDS] = batch.ids[at]
        sums_ = np.empty((len(cells), self.vectors.shape[1]), self.vectors.dtype)
        step = GATHER // BLOCK_WORDS
        for low in range(0, len(cells), step):
            self.vectors[cells[low:low + step]].sum(axis=1, out=sums_[low:low + step])
        for blocks, some, matrix in self.groups:
            window = sums_.copy()
            for k in range(1, blocks):
                same = np.flatnonzero(owner[k:] == owner[:-k])
                window[same] += sums_[same + k]
            norm = np.sqrt(np.einsum("ij,ij->i", window, window))
            step = max(1, _WORK // len(some))
            for low in range(0, len(window), step):
                near = window[low:low + step] @ matrix.T
                for w, p in np.argwhere(near >= COSINE * np.maximum(norm[low:low + step], 1e-12)[:, None]).tolist():
                    block = low + w
                    last = min(int(end[block]), int(starts[block]) + blocks * BLOCK_WORDS) - 1
                    i = int(owner[block])
                    yield i, some[p], int(at[starts[block]] - begin[i]), int(at[last] - begin[i]) + 1, float(near[w, p] / norm[block])

    def verbatim(self, batch: "Batch") -> Iterator[tuple[int, Passage, int, int, None]]:
        """Texts, passages, and the first and last word of a stretch no longer than the passage that has enough of its runs.

        A stretch begins at the first run that the one before has left, so a whole copy always lies within a passage's length of one.
        """
        if len(batch.ids) < RUN or not len(self.runs):
            return
        keys = runs(batch.ids)
        # runs do not reach from one text into the next
        at = np.flatnonzero(self.known[_places(keys)] & (batch.text[:len(keys)] == batch.text[RUN - 1:]))
        index = np.minimum(np.searchsorted(self.runs, keys[at]), len(self.runs) - 1)
        same = self.runs[index] == keys[at]
        at, index = at[same], index[same]
        text = batch.text[at]
        cuts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]])) if len(at) else [0]
        for a, b in zip(cuts, cuts[1:]):
            i = int(text[a])
            for passage, first, last in self._stretches(at[a:b] - batch.starts[i], index[a:b]):
                yield i, passage, first, last, None

    def _stretches(self, at: np.ndarray, index: np.ndarray) -> Iterator[tuple[Passage, int, int]]:
        """Stretches of one text from the places of its known runs."""
        sizes = self.owner_ends[index + 1] - self.owner_ends[index]
        first = np.repeat(self.owner_ends[index] - np.cumsum(sizes) + sizes, sizes)
        owner, place = self.owners[first + np.arange(len(first))], np.repeat(at, sizes)
        kept = (np.bincount(owner, minlength=len(self.needed)) >= self.needed)[owner]
        order = np.argsort(owner[kept], kind="stable")
        owner, place = owner[kept][order], place[kept][order]
        cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else [0]
        for a, b in zip(cuts, cuts[1:]):
            passage, needed, places = self.passages[owner[a]], self.needed[owner[a]], place[a:b]
            k = 0
            while k < len(places):
                end = int(np.searchsorted(places, places[k] + len(passage.words), "right"))
                if end - k >= needed:
                    yield passage, int(places[k]), int(places[end - 1]) + RUN
                k = end

    def leaks(self, text: bytes) -> list[dict]:
        return self.leaks_of([text])[0]

    def leaks_of(self, texts: list[bytes], numbers: list[bytes] | None = None) -> list[list[dict]]:
        """Items that each text holds, each once, with the best of its passages; ``numbers`` are the texts' own, if they are known."""
        batch = Batch(texts, numbers)
        best: list[dict[int, tuple]] = [{} for _ in texts]
        if self.short:
            for at in np.flatnonzero(self.begins[batch.ids]).tolist():
                i = int(batch.text[at])
                found, here = batch.words[i], at - int(batch.starts[i])
                for p in self.short.get(found[here], ()):
                    if found[here:here + len(p.words)] == p.words:
                        best[i][p.item_id] = (1.0, 1.0, 1.0)
        for i, passage, first, last, cosine in chain(self.candidates(batch), self.verbatim(batch)):
            found, size, key = batch.words[i], len(passage.words), id(passage)
            region = found[max(0, first - size):last + size]
            # words of the passage that stand anywhere in the region: no common subsequence is longer
            if sum(map(self.counts[key].__getitem__, self.distinct[key].intersection(region))) < PARAPHRASE * size:
                continue
            bits = common(self.positions[key], size, region)
            share_, answer = bits.bit_count() / size, (bits >> passage.answer).bit_count() / (size - passage.answer)
            if passage.whole and share_ >= PARAPHRASE:
                # the answer of a longer item stands as far from the passage as in the item
                near = found[max(0, first - size - passage.before):last + size + passage.after]
                answer = common(Passage(0, list(passage.whole), 0).positions, len(passage.whole), near).bit_count() / len(passage.whole)
            if share_ >= COPY or share_ >= PARAPHRASE and answer >= ANSWER:
                if cosine is None:
                    cosine = float(self.space.of(passage.words) @ self.space.of(found[first:last]))
                best[i][passage.item_id] = max(best[i].get(passage.item_id, (0, 0, 0)), (share_, answer, cosine))
        return [[{"item_id": i, "cosine": c, "common": s, "answer": a} for i, (s, a, c) in sorted(one.items())] for one in best]


class _Cut(dict):
    """Words of the text of each number, cut when they are asked for."""

    def __init__(self, texts: list[bytes]):
        super().__init__()
        self.texts = texts

    def __missing__(self, i: int) -> list[bytes]:
        self[i] = found = words(self.texts[i])
        return found


class Batch:
    """Words of some texts one after another: their buckets, the text of each and the fresh ones' places."""

    def __init__(self, texts: list[bytes], numbers: list[bytes] | None = None):
        self.words = _Cut(texts)
        if numbers is None:
            found = [self.words[i] for i in range(len(texts))]
            sizes = np.fromiter(map(len, found), np.int64, len(texts))
            self.ids = np.fromiter(map(_buckets.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
        else:
            sizes = np.fromiter(map(len, numbers), np.int64, len(texts)) // 2
            self.ids = np.frombuffer(b"".join(numbers), np.uint16).astype(np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.text = np.repeat(np.arange(len(texts)), sizes)
        new = np.ones(len(self.ids), bool)
        new[1:] = (self.ids[1:] != self.ids[:-1]) | (self.text[1:] != self.text[:-1])
        self.place = np.flatnonzero(new)


def annotate(docs: DataFrame, items: DataFrame, space: Space | None = None, text: str = "text", item_key: str = "item_id", item_text: str = "text", name: str = "leaks") -> DataFrame:
    """All columns of ``docs`` and the benchmark items that its whole text holds, an array that is empty for clean rows.

    Null and empty texts are clean. Items without an id or a word are not searched, those of fewer than 8 words by their exact sequence; items that
    repeat an id are passages of one item. A column of that name is replaced; rows are kept as they are, repeats included.
    Items come to the tasks in blocks of about 4096, one pass over the documents for each block. Without a space the documents are
    written once with the numbers of their words: the space is fitted on these, and the search reads them.
    """
    docs = docs.drop(name)
    at, columns, numbered = docs.columns.index(text), docs.columns, space is None
    if numbered:
        docs = _with_numbers(docs, text)
        space = _fit(docs.select(NUMBERS), _numbered(items, item_text))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    wanted = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text")).dropna()
    blocks = rows_for(wanted.count(), ITEM_BLOCK)
    leak = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("common", pa.float64()), ("answer", pa.float64())]))
    for block in range(blocks):
        rows = wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        passages = [p for r in rows for p in passages_of(r.item_id, bytes(r.text))]
        shared = docs.sparkSession.sparkContext.broadcast((space, passages))

        def run(batches: Iterable[pa.RecordBatch], shared=shared, last=block > 0) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(*shared.value)
            for batch in text_slices(batches, at, SLICE_BYTES):
                numbers = batch.column(NUMBERS).to_pylist() if numbered else None
                found = searcher.leaks_of([t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()], numbers)
                if last:
                    found = [[*before, *new] for before, new in zip(batch.column(name).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays([*(batch.columns[:-1] if last else batch.columns), pa.array(found, leak)],
                                                 [*(batch.schema.names[:-1] if last else batch.schema.names), name])

        docs = docs.mapInArrow(run, f"{kinds}, `{name}` array<{LEAK}>")
    return docs.select(*[F.col(f"`{c}`") for c in columns], name)


def find(docs: DataFrame, items: DataFrame, space: Space | None = None, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """``key, item_id, cosine, common, answer`` of every leak: a row for each document and item."""
    found = annotate(docs.select(key, text), items, space, text, item_key).select(key, F.explode("leaks").alias("leak"))
    return found.select(key, "leak.item_id", F.round("leak.cosine", 4).alias("cosine"), F.round("leak.common", 6).alias("common"), F.round("leak.answer", 6).alias("answer"))


def clean(docs: DataFrame, items: DataFrame, space: Space | None = None, text: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark item, with the columns they had."""
    return annotate(docs, items, space, text, name="_leaks").filter(F.size("_leaks") == 0).drop("_leaks")
