"""WARC archives: writing pages as segmented records, and reading them back by reassembly.

A page is an HTTP response with a chunked body. A long response is cut into
segments: the first record and continuation records that name its id, with numbers from 1; the last
carries the total length. Reading groups continuations by that id, orders them by
number, verifies numbers and total length, joins the blocks and undoes the chunk framing. Pages whose
payload another page has too are revisit records, which hold no payload.

Archives are gzipped text files of Spark's own writer, whose row end is the two line ends after
a record, so a lost executor leaves no half archive behind. Segments of 32 KB and 8192 records a file
bound what one task holds: 256 MB at the very most, a few dozen in practice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain.llm.common import slices
from skygrain.session import durable

SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS = 32 << 10, 8 << 10, 8192
LEAST_BYTES = 0

#: Names and line ends of the format.
VERSION, END = b"WARC/1.1", b"\r\n"


class Damaged(ValueError):
    """A record that can't be put together."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        chunk = payload[at:at + size]
        parts += [b"%x" % len(chunk), END, chunk, END]
    return b"".join([*parts, b"0", END, END])


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        line = body.find(END, at)
        if line < 0:
            raise Damaged("chunk without a size")
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError as error:
            raise Damaged("chunk size is no number") from error
        at = line + 2
        if size == 0:
            break
        if size < 0 or body[at + size:at + size + 2] != END:
            raise Damaged("chunk ends too early or too late")
        parts.append(body[at:at + size])
        at += size + 2
    if not body.endswith(END + END) and body[at:] != END:
        raise Damaged("body goes on after its last chunk")
    return b"".join(parts)


def payload_of(response: bytes) -> bytes:
    """Payload of an HTTP response, chunked or not."""
    head, found, body = response.partition(END + END)
    if not found:
        raise Damaged("response without an end of its head")
    fields = _fields(head.split(END)[1:])
    return unchunked(body) if fields.get("transfer-encoding") == "chunked" else body


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines)
    return {name.decode("utf-8", "replace").strip().lower(): value.decode("utf-8", "replace").strip() for name, _, value in pairs}


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return VERSION + END + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def records_of(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """Records of one page: a revisit, a response, or a response with its continuations."""
    uri = None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")
    own = f"<urn:uuid:{uuid.uuid4()}>"
    common = [("WARC-Target-URI", uri), ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To-Page-ID", refers_to),
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *common], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common], block)
        return
    cuts = range(0, len(block), segment)
    for number, at in enumerate(cuts, 1):
        total = len(block) if number == len(cuts) else None
        if number == 1:
            yield _record([("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Segment-Number", 1), *common], block[:segment])
        else:
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Segment-Origin-ID", own),
                           ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total)], block[at:at + segment])


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head fields and block of every record."""
    at = 0
    while at < len(archive):
        stop = archive.find(END + END, at)
        if stop < 0 or not archive.startswith(b"WARC/", at):
            raise Damaged(f"no record at byte {at}")
        fields = _fields(archive[at:stop].split(END)[1:])
        try:
            end = stop + 4 + int(fields["content-length"])
        except (KeyError, ValueError) as error:
            raise Damaged(f"record without a length at byte {at}") from error
        if end > len(archive):
            raise Damaged(f"record cut off at byte {at}")
        yield fields, archive[stop + 4:end]
        at = end + 4 if archive.startswith(END + END, end) else end


def reassembled(segments: list[tuple[int, bytes]], total: int | None) -> bytes:
    """The block of a segmented record; Damaged if a segment is missing or the length is wrong."""
    segments = sorted(segments, key=lambda s: s[0])
    if [number for number, _ in segments] != list(range(1, len(segments) + 1)):
        raise Damaged("segments are missing or repeated")
    block = b"".join(part for _, part in segments)
    if total != len(block):
        raise Damaged("segments have another length than the last one says")
    return block


def write(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_BYTES) -> str:
    """Archives of all pages under ``root``.

    The payload is the html in UTF-8, empty for null. Of pages with equal payloads of ``least`` bytes or more,
    that with the largest key is the response and the others refer to it. Rows that repeat the
    largest key are responses too; a page without a key is always a response. Pages are moved once, by payload digest;
    a digest with very many pages is split by the join, as both of its sides come straight from storage.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    keep = durable(rows.groupBy("sha").agg(F.max("page_id").alias("target")), "payloads")
    refers = F.when((F.octet_length("payload") >= least) & (F.col("page_id") < F.col("target")), F.col("target"))
    rows = rows.join(keep, "sha").select("page_id", "url", "payload", refers.alias("refers_to"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [r for row in zip(*(c.to_pylist() for c in batch.columns)) for r in records_of(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    (rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(root))
    return root


_SEGMENTS = "origin string, number int, total long, type string, page_id long, refers_to long, stated string, block binary, payload_bytes long, payload_digest string"
_KINDS = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string()]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of whole archives; those of one segment are decoded at once."""
    for batch in slices(batches, 1):
        rows = []
        for fields, block in parse(gzip.decompress(batch.column(0)[0].as_py())):
            kind, number = fields.get("warc-type"), _number(fields.get("warc-segment-number"))
            if kind not in ("response", "revisit", "continuation"):
                continue
            origin = fields.get("warc-segment-origin-id") or fields.get("warc-record-id")
            size = found = None
            if number is None and kind == "response":
                try:
                    payload = payload_of(block)
                    size, found = len(payload), digest(payload)
                except Damaged:
                    pass
            rows.append((origin, number, _number(fields.get("warc-segment-total-length")), None if kind == "continuation" else kind,
                         _number(fields.get("warc-page-id")), _number(fields.get("warc-refers-to-page-id")),
                         fields.get("warc-payload-digest"), block if number is not None else None, size, found))
            if len(rows) >= 512:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names)


def _assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decodes the segmented records among whole records; the others pass."""
    for batch in slices(batches):
        sizes, digests = batch.column("payload_bytes").to_pylist(), batch.column("payload_digest").to_pylist()
        for k, (parts, total) in enumerate(zip(batch.column("parts").to_pylist(), batch.column("total").to_pylist())):
            if parts:
                try:
                    payload = payload_of(reassembled([(p["number"], p["block"]) for p in parts], total))
                    sizes[k], digests[k] = len(payload), digest(payload)
                except Damaged:
                    pass
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("type"), batch.column("refers_to"), batch.column("stated"),
                                          pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                         ["page_id", "record_type", "refers_to", "stated", "payload_bytes", "payload_digest"])


def read(spark: SparkSession, root: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` of every page in the archives.

    Size and digest are those of the whole payload: of a response, as put together; of a revisit, of the
    response it refers to. A response with missing segments, a wrong total length, broken framing or
    another digest than it states has ``intact`` false and, unless only the digest differs, null size and digest; so
    have its revisits. Records of other types are skipped. An archive that is no sequence of records fails.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(root).select("content")
    parts = F.collect_list(F.when(F.col("block").isNotNull(), F.struct("number", "block"))).alias("parts")
    single = ["type", "page_id", "refers_to", "stated", "total", "payload_bytes", "payload_digest"]
    whole = files.mapInArrow(_read, _SEGMENTS).groupBy("origin").agg(*[F.max(c).alias(c) for c in single], parts)
    records = durable(whole.mapInArrow(_assemble, "page_id long, record_type string, refers_to long, stated string, payload_bytes long, payload_digest string"), "warc-records")
    intact = F.coalesce(F.concat(F.lit("sha1:"), "payload_digest") == F.col("stated"), F.lit(False))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    responses = records.filter("record_type = 'response' or record_type is null").withColumn("intact", intact)
    targets = (responses.filter("intact").select(F.col("page_id").alias("refers_to"), "stated", "payload_bytes", "payload_digest").distinct())
    targets = durable(targets, "warc-targets")
    revisits = (records.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
                .join(targets, ["refers_to", "stated"], "left").withColumn("intact", F.col("payload_digest").isNotNull()))
    return responses.select(*columns).unionByName(revisits.select(*columns))
