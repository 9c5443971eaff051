"""WARC archives of web pages: written as segmented records, read back and reassembled.

A page becomes one record: `response` with its payload, or `revisit` of the page that first had the same
payload. The HTTP body is framed in chunks. A long block is split: the first segment is the record itself,
the others are `continuation` records with the origin's identifier and their number, the last of them with
the total length. Reading finds records anywhere in the files, groups continuations by origin, orders them by
number, verifies lengths and digests, and undoes the chunk framing.

Spark's text source writes and reads the files, so that any file system of the cluster serves, a lost task
leaves no half archive, and a large archive is read in splits. Records are split at the version line. The
writer ends a chunk wherever a body would show its mark, so that it never stands inside a record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.session import materialize, new_folder

VERSION = b"WARC/1.1\r\n"
#: What a chunk or a header never shows whole: a line end may follow it anywhere.
_MARK = b"WARC/1.1"

RECORDS = ("record_id string, type string, page_id bigint, refers_to bigint, digest string, origin string, "
           "segment int, total bigint, whole boolean, block binary")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, content: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{content}')}>"


def chunked(body: bytes, size: int) -> bytes:
    """Chunked transfer framing; a chunk ends within each version mark of the body."""
    out = []
    start = 0
    while start < len(body):
        end = min(start + size, len(body))
        at = body.find(_MARK, start, end + len(_MARK))
        if at >= 0:
            end = min(end, at + len(_MARK) // 2)
        out.append(b"%x\r\n%b\r\n" % (end - start, body[start:end]))
        start = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The body of a chunked message; raises ValueError where the framing is broken."""
    out = []
    at = 0
    while True:
        line = data.index(b"\r\n", at)
        size = int(data[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = line + 2 + size
        if data[at : at + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(data[line + 2 : at])
        at += 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))]]
    return VERSION + "".join(lines).encode() + b"\r\n" + block


def _header_text(value: str | None) -> str:
    return "".join(c for c in value or "" if c not in "\r\n").replace("WARC/1.1", "WARC/1%2E1")


def records_of(
    page_id: int | None, url: str | None, payload: bytes, sha256: str, refers_to: int | None, revisit: bool,
    date: str, segment_bytes: int, chunk_bytes: int,
) -> list[bytes]:
    own = record_id(page_id, sha256)
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", date),
        ("WARC-Target-URI", _header_text(url)), ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        fields.append(("WARC-Page-ID", page_id))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(refers_to, sha256))]
        if refers_to is not None:
            fields.append(("WARC-Refers-To-Page-ID", refers_to))
        head = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n"
        return [_record(fields, head.encode())]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block += chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record(fields, block)]
    out = [_record([*fields, ("WARC-Segment-Number", 1)], block[:segment_bytes])]
    starts = range(segment_bytes, len(block), segment_bytes)
    for number, start in enumerate(starts, 2):
        segment = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, f"{sha256}:{number}")),
                   ("WARC-Date", date), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number)]
        if start + segment_bytes >= len(block):
            segment.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_record(segment, block[start : start + segment_bytes]))
    return out


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    segment_bytes: int = 64 * 1024, chunk_bytes: int = 16 * 1024,
) -> None:
    """Writes a record for each row of `pages` (page_id, url, html) to WARC files in `folder`.

    The payload is the html in UTF-8; null is empty. Of pages with equal payloads of at least `least_bytes`
    the one with the smallest page_id (null after all others) is written as response and the rest as
    revisits of it; pages with smaller payloads are all responses. Other columns are not read.
    """
    named = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", _payload().alias("html"))
    keyed = named.withColumn("sha256", F.sha2("html", 256)).withColumn("size", F.octet_length("html"))
    repeated = materialize(
        keyed.where(F.col("size") >= least_bytes).groupBy("sha256", "size")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n")).where("n > 1"), "repeated-payloads")
    marked = keyed.join(repeated, ["sha256", "size"], "left").select(
        "page_id", "url", "html", "sha256", "first_page",
        (F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            columns = [c.to_pylist() for c in (batch.column(i) for i in range(6) if i != 2)]
            for (page_id, url, sha256, first, revisit), html in zip(zip(*columns), batch.column(2)):
                made = records_of(page_id, url, html.as_py().encode(), sha256, first, revisit,
                                  date, segment_bytes, chunk_bytes)
                out += made
                size += sum(map(len, made))
                if size > 4_000_000:
                    yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    (marked.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").text(folder))


def parse_record(data: bytes) -> tuple | None:
    """A row of RECORDS from what stands between two version lines; null where nothing does."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    number = lambda name: int(fields[name]) if name in fields else None
    return (fields.get("warc-record-id"), fields.get("warc-type"), number("warc-page-id"),
            number("warc-refers-to-page-id"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            fields.get("warc-segment-origin-id"), number("warc-segment-number"),
            number("warc-segment-total-length"), len(rest) >= length, rest[:length])


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives in `folder`, by RECORDS; `whole` is false where a block is shorter than
    its Content-Length says."""
    types = [f.dataType for f in spark.createDataFrame([], RECORDS).schema]
    arrow = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
              "binary": pa.binary()}[t.simpleString()] for t in types]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for value in batch.column(0):
                row = parse_record(value.as_py())
                if row:
                    rows.append(row)
                    size += len(row[-1])
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow)], names=names)

    return (spark.read.schema("value string").option("lineSep", VERSION.decode()).text(folder)
            .select(F.col("value").cast("binary").alias("value")).mapInArrow(run, RECORDS))


def reassembled(records: DataFrame) -> DataFrame:
    """Records with their whole block: record_id, type, page_id, refers_to, digest, block, complete.

    Only segmented records are moved, by their origin. `complete` is false where a segment is missing or
    short, or where the lengths do not add up to the total of the last segment; a segment that occurs
    twice counts once."""
    single = records.where("segment is null").select(
        "record_id", "type", "page_id", "refers_to", "digest", "block", F.col("whole").alias("complete"))
    parts = records.where("segment is not null")
    first = F.col("segment") == 1
    by_origin = parts.groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        F.max(F.when(first, F.col("type"))).alias("type"), F.max(F.when(first, F.col("page_id"))).alias("page_id"),
        F.max(F.when(first, F.col("refers_to"))).alias("refers_to"),
        F.max(F.when(first, F.col("digest"))).alias("digest"), F.max("total").alias("total"),
        F.min("whole").alias("whole"), F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"))
    # Strings of any bytes: neither the casts nor array_join look at what they hold.
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    return single.unionByName(by_origin.withColumn("block", block).select(
        "record_id", "type", "page_id", "refers_to", "digest", "block",
        (F.col("whole") & (F.octet_length("block") == F.col("total"))
         & (F.size("parts") == F.element_at("parts", -1)["segment"])).alias("complete")))


def payloads(records: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest and intact of reassembled records.

    The payload of a response is its block without HTTP head and chunk framing; size and digest are taken
    from it, and `intact` says whether the record is complete and has the digest that its header gives. A
    revisit has no payload; its size and digest are those of its header. Null where the framing is broken.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, intact = [], [], []
            for kind, named, block, complete in zip(*(batch.column(i) for i in range(3, 7))):
                size, found = _measure(kind.as_py(), named.as_py(), block.as_py())
                sizes.append(size)
                digests.append(found)
                intact.append(bool(complete.as_py() and found is not None and found == named.as_py()))
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column(0), "record_id": batch.column(1), "refers_to": batch.column(2),
                "record_type": batch.column(3), "payload_bytes": pa.array(sizes, pa.int64()),
                "payload_digest": pa.array(digests, pa.string()), "intact": pa.array(intact, pa.bool_())})

    return records.select("page_id", "record_id", "refers_to", "type", "digest", "block", "complete").mapInArrow(
        run, "page_id bigint, record_id string, refers_to bigint, record_type string, payload_bytes bigint, "
             "payload_digest string, intact boolean")


def _measure(kind: str | None, named: str | None, block: bytes) -> tuple[int | None, str | None]:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(line.lower().split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    try:
        if kind == "revisit":
            return int(fields[b"content-length"]), named
        if fields.get(b"transfer-encoding") == b"chunked":
            body = unchunked(body)
    except (ValueError, KeyError):
        return None, None
    return len(body), digest(body)


def page_archive_digests(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes `pages` as WARC archives into the shared folder and gives per page what is read back:
    page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Rows that repeat page_id and html are one page. An empty table gives an empty result."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, least_bytes)
    return (payloads(reassembled(read_records(spark, folder)))
            .dropDuplicates(["record_id"])
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"))
