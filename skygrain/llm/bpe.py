"""Byte-pair encoding by a segment tree over the ranks of neighbouring pairs, and decoding.

A piece of text is a row of symbols. Leaf i of the tree holds the rank of the
pair (symbol i, next symbol) together with i, or nothing if the pair does not
merge; a node holds the smaller of its children. So the root is the leftmost
pair of lowest rank. A merge changes three leaves, each in logarithmic time, and
a piece is done when the root is empty. Short pieces of many texts have their trees
side by side in one array, and every step merges in all trees that are not done;
a long piece has its own tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.llm.chunks import CACHE_ENTRIES, PATTERN, Vocabulary, Words, encode_column, packed, parts, written
from skygrain.llm.common import ragged, slices

_NONE = 1 << 62
_POSITION_BITS = 32
_POSITION = (1 << _POSITION_BITS) - 1
# Pieces of fewer bytes share an array of trees, if there are so many of a size.
SHORT_BYTES = 64
LEAST_SHARED = 64
# New parts that are split and merged at a time.
LEARN_PARTS = 16_384


class Codec:
    """Text to ids and back, as the vocabulary's own library does."""

    def __init__(self, content: str):
        self.vocabulary = Vocabulary(content)
        ids = self.vocabulary.ids
        self.byte_ids = [0] * 256
        for i in ids.values():
            if len(self.vocabulary.bytes[i]) == 1:
                self.byte_ids[self.vocabulary.bytes[i][0]] = i
        self.ranks = {ids[a] << 20 | ids[b]: rank for rank, (a, b) in reversed(list(enumerate(self.vocabulary.merges)))}
        self.merged = [ids[a + b] for a, b in self.vocabulary.merges]
        self.nothing = len(self.vocabulary.bytes)  # stands beside the first and the last symbol; merges with none
        first = {pair: rank for rank, pair in reversed(list(enumerate(self.vocabulary.merges)))}
        pairs = sorted((ids[a] << 32 | ids[b], rank) for (a, b), rank in first.items())
        self.pairs, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs))
        self.merged_ids, self.symbols = np.array(self.merged, np.int64), np.array(self.byte_ids, np.int64)
        self.decimal = [str(i).encode() for i in range(self.nothing)]
        self.pattern = regex.compile(PATTERN)
        self.pieces: dict[str, bytes] = {}
        self.words = Words(lambda part: self._join([self.pattern.findall(part)])[0])

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of one piece, given the ids of its bytes."""
        count, find, merged = len(symbols), self.ranks.get, self.merged
        if count == 1:
            return symbols
        size = 1 << (count - 2).bit_length()
        tree = [_NONE] * (2 * size)
        for i in range(count - 1):
            rank = find(symbols[i] << 20 | symbols[i + 1])
            if rank is not None:
                tree[size + i] = rank << _POSITION_BITS | i
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        while (best := tree[1]) != _NONE:
            left = best & _POSITION
            right = after[left]
            symbols[left], symbols[right] = merged[best >> _POSITION_BITS], -1
            after[left] = follow = after[right]
            changes = []
            if follow < count:
                before[follow] = left
                changes.append((right, _NONE))
                rank = find(symbols[left] << 20 | symbols[follow])
                changes.append((left, _NONE if rank is None else rank << _POSITION_BITS | left))
            else:
                changes.append((left, _NONE))
            if (previous := before[left]) >= 0:
                rank = find(symbols[previous] << 20 | symbols[left])
                changes.append((previous, _NONE if rank is None else rank << _POSITION_BITS | previous))
            for leaf, key in changes:
                node = size + leaf
                if tree[node] != key:
                    tree[node] = key
                    while node > 1:
                        other = tree[node ^ 1]
                        if other < key:
                            key = other
                        node >>= 1
                        if tree[node] == key:
                            break
                        tree[node] = key
        return [s for s in symbols if s >= 0]

    def _keys(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Leaves of pairs of symbols at the given positions."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at] << _POSITION_BITS | position, _NONE)

    def _merge_short(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Packed ids of pieces of less than ``size`` bytes, a power of two: leaf p is for the pair of the symbols p and the next, from 1."""
        count, width = len(pieces), size + 1
        lengths = np.fromiter(map(len, pieces), np.int64, count)
        columns = np.arange(width)
        inside = (columns > 0) & (columns <= lengths[:, None])
        symbols = np.full((count, width), self.nothing)
        symbols[inside] = self.symbols[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.tile(columns + 1, (count, 1)).ravel(), np.tile(columns - 1, (count, 1)).ravel()
        tree = np.full((count, 2 * size), _NONE)
        tree[:, size:] = self._keys(symbols[:, :-1], symbols[:, 1:], columns[:-1])
        level = size
        while level > 1:
            level //= 2
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        symbols, tree = symbols.ravel(), tree.ravel()
        rows = np.flatnonzero(tree[1::2 * size] != _NONE)
        while len(rows):
            row, root = rows * width, rows * (2 * size)
            best = tree[root + 1]
            left, joined = best & _POSITION, self.merged_ids[best >> _POSITION_BITS]
            right = after[row + left]
            follow, previous = after[row + right], before[row + left]
            symbols[row + left], symbols[row + right] = joined, -1
            after[row + left], before[row + follow] = follow, left
            keys = self._keys(np.concatenate([joined, symbols[row + previous]]), np.concatenate([symbols[row + follow], joined]),
                              np.concatenate([left, previous]))
            roots, nodes = np.tile(root, 3), np.concatenate([left, previous, right]) + size
            tree[roots + nodes] = np.concatenate([keys, np.full(len(rows), _NONE)])
            for _ in range(size.bit_length() - 1):
                nodes >>= 1
                below = roots + 2 * nodes
                tree[roots + nodes] = np.minimum(tree[below], tree[below + 1])
            rows = rows[tree[root + 1] != _NONE]
        symbols = symbols.reshape(count, width)
        kept = inside & (symbols >= 0)
        raw, ends = symbols[kept].astype("<i4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces."""
        content, found = [p.encode() for p in pieces], [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, data in enumerate(content):
            if len(data) < SHORT_BYTES:
                classes.setdefault(1 << len(data).bit_length(), []).append(i)
            else:
                found[i] = self._merge_one(data)
        for size, members in classes.items():
            some = [content[i] for i in members]
            shared = self._merge_short(some, size) if len(some) >= LEAST_SHARED else map(self._merge_one, some)
            for i, ids in zip(members, shared):
                found[i] = ids
        return found

    def _merge_one(self, data: bytes) -> bytes:
        return packed(self.merge([self.byte_ids[b] for b in data]))

    def _split(self, part: str) -> list[str]:
        """Pieces of a part; a word of plain letters is one, and a mark after it another."""
        if part.isascii():
            if part.isalpha():
                return [" " + part]
            if part[:-1].isalpha() and part[-1] in ".,":
                return [" " + part[:-1], part[-1]]
        return self.pattern.findall(written(part))

    def _join(self, split: list[list[str]]) -> list[bytes]:
        """Packed ids of texts that are split into pieces."""
        known = self.pieces
        if len(known) >= CACHE_ENTRIES // 2:
            known.clear()
        new = [p for p in set().union(*split) if p not in known]
        known.update(zip(new, self.merge_all(new)))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def _learn(self, found: set[str]) -> None:
        """Put new parts into the dictionary, thousands at a time."""
        words = self.words
        new = [p for p in found if p not in words]
        words.update((p, words.old[p]) for p in new if p in words.old)
        new = [p for p in new if p not in words]
        for at in range(0, len(new), LEARN_PARTS):
            some = new[at:at + LEARN_PARTS]
            words.make_room()
            words.update(zip(some, self._join([self._split(p) for p in some])))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        plans = [[(special, section, parts(section)) for special, section in self.vocabulary.sections(t)] for t in texts]
        self._learn(set().union(*(cut for plan in plans for _, _, cut in plan if cut)))
        out = []
        for plan in plans:
            ids = []
            for special, section, cut in plan:
                if special is not None:
                    ids.append(np.array([special], "<i4"))
                ids.append(np.frombuffer(self._join([self.pattern.findall(section)])[0], "<i4") if cut is None else self.words.ids(cut))
            out.append(np.concatenate(ids))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of a string column without nulls."""
        return encode_column(texts, self.vocabulary.added, self._learn, self.words.__getitem__, self.encode_all)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_codecs: dict[int, Codec] = {}


def _codec(content: str) -> Codec:
    """One codec for each vocabulary and Python worker."""
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def _content(df: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids array<int>`` of every row's whole text.

    A null text has the ids of an empty one, none. Null and repeated keys pass
    through, one row each; other columns are not read. Rows do not depend on each
    other, so an empty table gives an empty one and no key is special.
    ``vocabulary``: path of a tokenizer file on the driver, 1.5 MB, broadcast.
    """
    content = _content(docs, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in slices(batches):
            ids = codec.encode_column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ragged(ids, pa.int32())], ["key", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text that ``ids`` stand for; null ids give an empty text.

    Bytes that are not UTF-8 become U+FFFD. A column already named ``text`` is replaced.
    """
    content = _content(rows, vocabulary)
    kept = [c for c in rows.columns if c != text]
    rows = rows.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in slices(batches):
            column = batch.column(at)
            starts, flat_ids = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            texts = [codec.decode(flat_ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, `{text}` string")


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256`` of every row's whole text.

    Encodes and decodes like ``encode`` and ``decode``, with the same rules for odd rows, but only the digests leave the task.
    """
    content = _content(docs, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in slices(batches):
            found = codec.encode_column(batch.column(1))
            decimal = [hashlib.sha256(b",".join(map(codec.decimal.__getitem__, ids.tolist()))).hexdigest() for ids in found]
            decoded = [hashlib.sha256(codec.decode(ids).encode()).hexdigest() for ids in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, found), pa.int64()), pa.array(decimal), pa.array(decoded)],
                                             ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)


def id_list(ids: str = "ids") -> F.Column:
    """Decimal ids joined by commas."""
    return F.expr(f"replace(substr(cast({ids} as string), 2, length(cast({ids} as string)) - 2), ', ', ',')")
