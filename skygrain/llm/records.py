"""Length-delimited binary records of token ids, with an offset index for shuffled reads.

File format: a folder ``records`` of shards, each a row of frames
    8 bytes   length of the data, little-endian
    4 bytes   masked checksum of the length
    n bytes   data: 8 bytes key (signed), 1 byte null flag, 1 byte width (2 or 4), then the ids, little-endian
    4 bytes   masked checksum of the data
    1 byte    line feed
The checksum is zlib's CRC-32 (not CRC-32C), masked by rotating it right by 15
bits and adding a constant, so that data that hold checksums stay safe. Ids take two bytes each where all
of them fit. Shards are in key order, and so are the frames of a shard. The
folder ``index`` is a Parquet table with a row for each frame: its shard,
offset, length, key, the number of ids, and the ids before it.

Shards are written by Spark's own writer, so a lost executor leaves no half
shard behind; the line feed is that writer's row end.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skygrain.llm.chunks import BARE, CACHE_ENTRIES, LINE, Vocabulary, Words, byte_letters, encode_column, packed, parts
from skygrain.llm.common import ragged, rows_for, slices

#: Fixed value: the constant that masks a checksum.
MASK_DELTA = 0xA282EAD8
END_ID = 0
# Characters of text a shard holds, about.
SHARD_CHARS = 16 << 20

INDEX = "key long, shard string, offset long, bytes long, n_tokens long, start long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray) -> bytes:
    """One record without its line feed."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    data = struct.pack("<qBB", key or 0, key is None, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(data))
    return length + struct.pack("<I", masked(length)) + data + struct.pack("<I", masked(data))


def unframe(content: bytes, offset: int) -> tuple[int | None, np.ndarray, int]:
    """Key and ids of the record at ``offset``, and the offset after it; ValueError if it is damaged."""
    head = content[offset:offset + 12]
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError(f"damaged length at byte {offset}")
    end = offset + 12 + struct.unpack("<Q", head[:8])[0]
    data = content[offset + 12:end]
    if len(content) < end + 5 or masked(data) != struct.unpack("<I", content[end:end + 4])[0]:
        raise ValueError(f"damaged data at byte {offset}")
    key, null, width = struct.unpack_from("<qBB", data)
    return None if null else key, np.frombuffer(data, f"<u{width}", offset=10).astype(np.uint32), end + 5


# A part of the commonest shape: what stands before it, a word of letters on which all
# versions of Unicode agree, and marks, which are a piece of their own.
_PLAIN = re.compile(r"([\0\n]?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]{0,8})")


class LibraryEncoder:
    """The tokenizers library's ids; parts seen before are taken from a dictionary.

    A new part that is a word, with marks after it or not, goes to the library's model as the
    pieces its pattern would make of it. Anything else goes through the whole library.
    """

    def __init__(self, content: str):
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        vocabulary = Vocabulary(content)
        self.sections, self.added = vocabulary.sections, vocabulary.added
        self.letters = {b: letter for letter, b in byte_letters().items()}
        self.words = Words(lambda text: packed(self._ids(text)), 2 * CACHE_ENTRIES)
        self.marks: dict[str, bytes] = {"": b""}
        self.heads = {"": b"", BARE: b"", LINE: packed(self._ids(LINE))}

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _piece(self, piece: str, space: str = "") -> bytes:
        """Packed ids of one piece of the pattern, with the letter of the space before it."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return array("i", [token.id for token in self.model.tokenize(space + piece)]).tobytes()

    def _learn(self, found: set[str]) -> None:
        """Put new parts into the dictionary."""
        known, old, marks = self.words, self.words.old, self.marks
        new = [p for p in found if p not in known]
        known.update((p, old[p]) for p in new if p in old)
        for part in new:
            shape = None if part in known else _PLAIN.fullmatch(part)
            if not shape:
                continue  # known, or looked up on its own when it is met
            head, word, mark = shape.groups()
            # the word without its marks is known more often
            ids = known.get(word) if mark and not head else None
            if ids is None:
                ids = self._piece(word, "" if head else self.letters[32])
            if mark not in marks:
                if len(marks) >= CACHE_ENTRIES // 10:
                    marks.clear()
                    marks[""] = b""
                marks[mark] = self._piece(mark)
            known.make_room()
            if mark and not head:
                known[word] = ids
            known[part] = self.heads[head] + ids + marks[mark]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plans = [[(added, section, parts(section)) for added, section in self.sections(t)] for t in texts]
        self._learn(set().union(*(cut for plan in plans for _, _, cut in plan if cut)))
        out = []
        for plan in plans:
            ids = []
            for added, section, cut in plan:
                if added is not None:
                    ids.append(np.array([added]))
                ids.append(np.array(self._ids(section), "<i4") if cut is None else self.words.ids(cut))
            out.append(np.concatenate(ids).astype(np.uint32))
        return out


    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of a string column without nulls."""
        return [ids.astype(np.uint32) for ids in encode_column(texts, self.added, self._learn, self.words.__getitem__, self.encode)]


_encoders: dict[int, LibraryEncoder] = {}


def _encoder(content: str) -> LibraryEncoder:
    key = hash(content)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = LibraryEncoder(content)
    return _encoders[key]


@dataclass(frozen=True)
class Records:
    """A written set of records."""

    root: str

    def shards(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{self.root}/records")

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(INDEX).parquet(f"{self.root}/index")


def write(docs: DataFrame, root: str, vocabulary: str, key: str = "doc_id", text: str = "text") -> Records:
    """Encode every whole text, append the end id, write records and index under ``root``.

    A null text is an empty one and has the end id only. Null keys come first;
    rows of one key, repeats included, are one record each, in any order among
    them. An empty table gives an empty index. Other columns are not read.
    ``key``: an integer column.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.length("text").cast("long"))).first()[0]

    def frames(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in slices(batches):
            ids = encoder.encode_column(batch.column(1))
            data = [frame(k, np.append(i, np.uint32(END_ID))) for k, i in zip(batch.column(0).to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["frame"])

    shards = rows_for(total, SHARD_CHARS)
    (rows.repartitionByRange(shards, F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())
     .mapInArrow(frames, "frame binary")
     .select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(f"{root}/records"))
    written = Records(root)
    _write_index(spark, written)
    return written


def _shard(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of whole shards; ``start`` counts from the beginning of the shard."""
    for batch in slices(batches, 1):
        content, rows, at, start = batch.column(1)[0].as_py(), [], 0, 0
        shard = _shard(batch.column(0)[0].as_py())
        while at < len(content):
            key, ids, after = unframe(content, at)
            rows.append((key, shard, at, after - at, len(ids), start))
            at, start = after, start + len(ids)
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["key", "shard", "offset", "bytes", "n_tokens", "start"])


def _write_index(spark: SparkSession, written: Records) -> None:
    """Index of the shards: one scan, then the ids before each shard are added.

    The totals are one number for each shard and go through the driver: a
    million shards of 16 MB are 16 MB of totals.
    """
    local = f"{written.root}/scan"
    written.shards(spark).select("path", "content").mapInArrow(_scan, INDEX).write.parquet(local)
    scan = spark.read.schema(INDEX).parquet(local)
    totals = sorted((r.shard, r.n) for r in scan.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, rows = 0, []
    for shard, n in totals:
        rows.append((shard, before))
        before += n
    base = spark.createDataFrame(rows, "shard string, base long")
    (scan.join(F.broadcast(base), "shard")
     .select("key", "shard", "offset", "bytes", "n_tokens", (F.col("base") + F.col("start")).alias("start"))
     .write.parquet(f"{written.root}/index"))


_READ = "key long, ids array<int>, start long"


def _batch(found: list[tuple[int | None, np.ndarray, int]]) -> pa.RecordBatch:
    keys, ids, starts = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ragged([i.astype(np.int32) for i in ids], pa.int32()), pa.array(starts, pa.int64())],
                                      ["key", "ids", "start"])


def _based(spark: SparkSession, records: Records) -> DataFrame:
    """``content, base`` of each shard: its bytes and the ids before it."""
    base = records.index(spark).groupBy("shard").agg(F.min("start").alias("base"))
    shards = records.shards(spark).select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    return shards.join(F.broadcast(base), "shard").select("content", "base")


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, int]]:
    for batch in slices(batches, 1):
        yield batch.column(0)[0].as_py(), batch.column(1)[0].as_py()


def _frames(content: bytes, start: int) -> Iterator[tuple[int | None, np.ndarray, int]]:
    """Key, ids and ids before it of every record of a shard."""
    at = 0
    while at < len(content):
        key, ids, at = unframe(content, at)
        yield key, ids, start
        start += len(ids)


def read(spark: SparkSession, records: Records) -> DataFrame:
    """``key, ids, start`` of all records. Shards are read where they lie; the ids before each, one number, are broadcast.

    Damaged records raise ValueError.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content, start in _shards(batches):
            frames = _frames(content, start)
            while found := list(islice(frames, 256)):
                yield _batch(found)

    return _based(spark, records).mapInArrow(run, _READ)


def pick(spark: SparkSession, records: Records, chosen: DataFrame) -> DataFrame:
    """``key, ids, start`` of the records that ``chosen``, rows of the index, names: read at their offsets.

    The offsets of a shard travel as one row beside its content. Damaged records raise ValueError.
    """
    wanted = chosen.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("offset", "start"))).alias("wanted"))
    shards = records.shards(spark).select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            content, wanted = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            for at in range(0, len(wanted), 256):
                yield _batch([(*unframe(content, w["offset"])[:2], w["start"]) for w in wanted[at:at + 256]])

    return shards.join(wanted, "shard").select("content", "wanted").mapInArrow(run, _READ)


def shuffled(spark: SparkSession, records: Records, seed: int) -> DataFrame:
    """All records with a column ``position`` that orders them at random, the same for the same seed."""
    return read(spark, records).withColumn("position", F.xxhash64(F.lit(seed), "start"))


def digests(spark: SparkSession, records: Records) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` (over little-endian unsigned 32-bit ids) of all records, as ``read`` reads them; only the digests leave the task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content, start in _shards(batches):
            found = [(key, first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for key, ids, first in _frames(content, start)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["key", "start", "n_tokens", "ids_crc32"])

    return _based(spark, records).mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")
