"""WARC archives: written in segments, read back by segment reassembly.

Writing. Each page is an HTTP response whose body is framed in chunks. Of pages with equal payloads of at least
``REVISIT_BYTES`` bytes, the one with the smallest id is a response, the others are revisit records that refer to it;
shorter payloads are all responses. A block longer than ``SEGMENT_BYTES`` is cut into segments: the response holds the
first, continuation records hold the rest with the origin's record id, their segment numbers and, in the last one, the
total length. Spark's text writer makes the files (gzip, one record per value, closed by two line ends), so that they
are committed like any other job's output and lie in a shared folder.

Reading. Each file is parsed by the records' own content lengths. Segments are grouped by the origin's record id,
ordered by number and joined; a missing number or a total length that differs raises an error. Then the chunk framing
is decoded, sizes and all, and the payload is digested. Segments bound what a file holds; a group holds one page.

A null html is an empty payload. Record ids come from page ids; null and repeated ids get a row number besides, and all
rows of the smallest id are responses. Equal payloads that have null ids only are all responses. An empty table gives an empty result. Only the id, url and html columns of the input are read.
"""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspar.llm.storage import materialize, small_batches
from feldspar.plans.storage import ensure_checkpoint_dir

REVISIT_BYTES = 100
SEGMENT_BYTES, CHUNK_BYTES = 32_768, 4096
#: Records of a file; with the segments' length they bound what a reading task holds.
FILE_RECORDS = 2048
END = b"\r\n"
#: Names and forms of the format's fields.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _whole_characters(octets: bytes, size: int) -> list[bytes]:
    """Parts of about ``size`` bytes that do not cut a character."""
    out, at = [], 0
    while at < len(octets):
        end = min(at + size, len(octets))
        while end < len(octets) and octets[end] & 0xC0 == 0x80:
            end += 1
        out.append(octets[at:end])
        at = end
    return out or [b""]


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing: sizes in hexadecimal, a chunk of size 0 at the end."""
    parts = [p for p in _whole_characters(payload, CHUNK_BYTES) if p]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailing fields are passed over, bad framing raises ValueError."""
    out, at = [], 0
    while True:
        end = body.index(END, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != END:
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def _record(kind: str, record_id: str, block: bytes, fields: list[tuple[str, str]]) -> bytes:
    """A record without the two line ends that close it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), *fields, ("Content-Length", str(len(block)))]
    return VERSION + END + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + END + block


def records(record_id: str, url: str, payload: bytes, digest: str, refers: str | None) -> list[bytes]:
    """The records of one page."""
    url = re.sub(r"\s", "%20", url)
    fields = [("WARC-Target-URI", url)] if url else []
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers is not None:
        return [_record("revisit", record_id, head, [*fields, ("WARC-Refers-To", f"<{refers}>"), ("WARC-Profile", IDENTICAL), ("Content-Type", "application/http; msgtype=response")])]
    segments = _whole_characters(head + chunked(payload), SEGMENT_BYTES)
    fields.append(("Content-Type", "application/http; msgtype=response"))
    if len(segments) == 1:
        return [_record("response", record_id, segments[0], fields)]
    out = [_record("response", record_id, segments[0], [*fields, ("WARC-Segment-Number", "1")])]
    for i, s in enumerate(segments[1:], 2):
        more = [("WARC-Segment-Number", str(i)), ("WARC-Segment-Origin-ID", f"<{record_id}>")]
        if i == len(segments):
            more.append(("WARC-Segment-Total-Length", str(sum(map(len, segments)))))
        out.append(_record("continuation", f"{record_id}-c{i}", s, more))
    return out


def parse(octets: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(octets):
        if octets.startswith(END, at):
            at += 2
            continue
        end = octets.index(END + END, at)
        lines = octets[at:end].split(END)
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        fields = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
        size = int(fields["content-length"])
        block = octets[end + 4 : end + 4 + size]
        if len(block) != size or octets[end + 4 + size : end + 8 + size] != END + END:
            raise ValueError("a record is shorter or longer than its content length")
        yield fields, block
        at = end + 8 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response, its transfer framing decoded."""
    head, _, body = block.partition(END + END)
    framed = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(END))
    return unchunked(body) if framed else body


def joined(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """One block of (number, total length, block) segments in any order."""
    segments = sorted(segments, key=lambda s: s[0])
    block = b"".join(s[2] for s in segments)
    if [s[0] for s in segments] != list(range(1, len(segments) + 1)) or segments[-1][1] is None:
        raise ValueError("a segment is missing or there twice")
    if segments[-1][1] != len(block):
        raise ValueError("the segments' total length differs from what the last one says")
    return block


def page_name(i: int | None) -> str:
    return f"urn:page:{'' if i is None else i}"


def page_of(name: str) -> int | None:
    """The page's id in a record id."""
    i = name.strip("<>").split(":")[2].split("-c")[0]
    return int(i) if i else None


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write all pages as WARC files into ``folder``."""
    rows = pages.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    small_batches(pages.sparkSession)
    rows = rows.withColumn("digest", F.sha2("html", 256))
    small = rows.select("id", "digest", F.octet_length("html").alias("size"))
    first = small.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    again = small.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").select(F.col("id").alias("other"), F.lit(True).alias("again"))
    told = rows.join(_hinted(first.select(F.col("digest").alias("of"), "first")), F.col("digest") == F.col("of"), "left")
    told = told.join(_hinted(again), F.col("id").eqNullSafe(F.col("other")), "left").withColumn("row", F.when(F.col("again"), F.monotonically_increasing_id()))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    told = told.select("id", "row", "url", "digest", F.when(~revisit, F.col("html")).alias("html"), F.when(revisit, F.col("first")).alias("refers"))

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(i, 256).to_pylist():
                    name = page_name(r["id"]) + ("" if r["row"] is None else f":{r['row']}")
                    out += records(name, r["url"], (r["html"] or "").encode(), r["digest"], None if r["html"] is not None else page_name(r["refers"]))
                yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in out], pa.string())], ["value"])

    told.mapInArrow(form, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def _hinted(table: DataFrame, most: int = 100_000) -> DataFrame:
    """A narrow table, written and counted: broadcast if it is small, else left to a shuffled join."""
    table = materialize(table)
    return F.broadcast(table) if table.count() <= most else table


SCHEMA = "record_id string, page_id bigint, record_type string, refers_to bigint, digest string, number int, total bigint, block binary"


def _parsed(spark: SparkSession, folder: str, segmented: bool) -> DataFrame:
    """The records of all files in ``folder`` that are, or are not, parts of a segmented one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            for i in range(batch.num_rows):
                out = []
                for fields, block in parse(gzip.decompress(batch.column(0)[i].as_py())):
                    number = fields.get("warc-segment-number")
                    if (number is not None) != segmented:
                        continue
                    name = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                    kind = fields["warc-type"]
                    if not segmented:
                        block = payload_of(block) if kind == "response" else None
                    total = fields.get("warc-segment-total-length")
                    refers = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
                    out.append((name, page_of(name), kind, refers, fields.get("warc-payload-digest", ":").split(":")[1], number and int(number), total and int(total), block))
                    if len(out) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(run, SCHEMA)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, digest, payload) of every page in ``folder``; revisits have no payload."""

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                page, digest, parts = (batch.column(c)[i].as_py() for c in range(3))
                payload = payload_of(joined([(p["number"], p["total"], p["block"]) for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([digest], pa.string()), pa.array([payload], pa.binary())], ["page_id", "digest", "payload"])

    parts = _parsed(spark, folder, True).groupBy("record_id").agg(F.first("page_id").alias("page_id"), F.max("digest").alias("digest"), F.collect_list(F.struct("number", "total", "block")).alias("parts"))
    long = parts.select("page_id", "digest", "parts").mapInArrow(reassemble, "page_id bigint, digest string, payload binary")
    long = long.select("page_id", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "digest", "payload")
    whole = _parsed(spark, folder, False).select("page_id", "record_type", "refers_to", "digest", F.col("block").alias("payload"))
    return whole.union(long)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), revisits with what their response holds.

    A payload whose digest differs from the one its record states raises an error, as does a revisit without response.
    """
    told = records.withColumns({"size": F.octet_length("payload").cast("long"), "found": F.sha2("payload", 256)})
    wrong = F.raise_error(F.concat(F.lit("wrong payload digest of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast("string")
    told = told.withColumn("found", F.when(F.col("found").isNull() | (F.col("found") == F.col("digest")), F.col("found")).otherwise(wrong))
    told = materialize(told.select("page_id", "record_type", "refers_to", "digest", "size", "found"))
    own = told.where("record_type = 'response'").select("page_id", F.col("size").alias("payload_bytes"), F.col("found").alias("payload_digest"), "record_type", "refers_to")
    held = told.where("record_type = 'response'").select(F.col("page_id").alias("of"), F.col("found").alias("payload_digest"), F.col("size").alias("payload_bytes")).distinct()
    revisits = told.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "digest")
    revisits = revisits.join(held, (F.col("refers_to") == F.col("of")) & (F.col("digest") == F.col("payload_digest")), "left")
    missing = F.raise_error(F.lit("a revisit refers to no response")).cast("long")
    size = F.coalesce("payload_bytes", missing)
    return own.union(revisits.select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (into a new folder beside the checkpoints unless one is named) and read them back."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4()}"
    write(pages, folder, key, url, html)
    out = resolved(read(spark, folder))
    return out.select(F.col("page_id").alias(key), *[c for c in out.columns if c != "page_id"])
