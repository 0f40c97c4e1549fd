"""WARC archives: a writer that goes through Spark's text sink, and a reader that salvages what damage has left.

The reader checks every record (version line, header, length, closing blank lines,
payload digest). After a failed check it looks for the next version line, or the next
member of a compressed archive, from which reading succeeds again; the bytes between are logged as a
gap, with the reason.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from nightledger.llm.common import saved, scratch_path, small_batches

#: Fixed values of the format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"

#: Payloads from this many bytes on are written once.
REVISIT_BYTES = 1000
#: An archive is closed at the first record that fills so many bytes as written: one task can hold it.
ARCHIVE_BYTES = 32 << 20
#: The last byte of a member of less than 16 MB: the top of its size.
MEMBER_END = "\0"
DATE = "2026-01-01T00:00:00Z"
PAGE_ID = "urn:nightledger:page:"

#: What the reader returns: a row per record and per gap.
FOUND = pa.schema(
    [(name, pa.string()) for name in ("kind", "archive", "reason", "record_id", "record_type", "target_uri", "refers_to")]
    + [(name, pa.int64()) for name in ("member", "start", "length", "payload_bytes")]
    + [("payload_digest", pa.string()), ("payload", pa.binary())]
)


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of at least REVISIT_BYTES the one with the largest page_id is the
    response and the others refer to it; rows that repeat that page_id, or groups
    without any, are all responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    large = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest", "payload_bytes")
    groups = saved(large.agg(F.max("page_id").alias("last_id"), F.count("*").alias("n")).filter("n > 1").drop("n"), "payloads")
    revisits = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return rows.join(groups, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("last_id")).alias("refers_to"),
    )


def record_text() -> Column:
    """A whole record but for its closing blank lines, from the columns of `with_types`."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda page_id: F.concat(F.lit(f"<{PAGE_ID}"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\x00-\x20\x7F]", "%20")
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", uri),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", urn(F.col("refers_to"))))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"), http, F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )


def gzip_member(record: bytes) -> bytes:
    """The record as a member of its own; where its last byte is not MEMBER_END an empty member follows."""
    member = gzip.compress(record, mtime=0)
    return member if member.endswith(MEMBER_END.encode()) else member + gzip.compress(b"", mtime=0)


def _archives(compression: str, size: int):
    """Records as whole archives but for their last bytes, which are the separator of the text sink."""
    end = END if compression == "none" else MEMBER_END.encode()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filled = [], 0
        whole = lambda: pa.RecordBatch.from_pydict({"value": [b"".join(held)[: -len(end)]]})
        for batch in batches:
            for value in batch.column(0):
                record = value.as_py() + END
                held.append(record if compression == "none" else gzip_member(record))
                filled += len(held[-1])
                if filled >= size:
                    yield whole()
                    held, filled = [], 0
        if held:
            yield whole()

    return pack


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A record per row of `pages` (page_id, url, html; other columns are not looked at; null html: empty).

    With `gzip` each record is a member of its own, so that damage costs no other; the other choice is `none`. Archives
    are of about `archive_bytes`. Spark's text sink commits whole files, on any store, also when executors
    are lost; it takes bytes as they are.
    """
    if compression not in ("gzip", "none"):
        raise ValueError(f"unknown compression {compression!r}: expected 'gzip' or 'none'")
    small_batches(pages.sparkSession)
    records = with_types(pages).select(record_text().cast("binary").alias("value"))
    archives = records.mapInArrow(_archives(compression, archive_bytes), "value binary").select(F.col("value").cast("string"))
    end = END.decode() if compression == "none" else MEMBER_END
    archives.write.option("lineSep", end).option("compression", "none").option("maxRecordsPerFile", 1).text(path)


class Damaged(ValueError):
    """A check of a record has failed."""


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    return first, fields


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise Damaged("no content length")
    return int(value)


def read_record(data: bytes, at: int) -> tuple[int, dict]:
    """End and content of the record that starts at `at`; Damaged if it fails a check."""
    if not data.startswith(b"WARC/1.", at):
        raise Damaged("no version line")
    body = data.find(END, at)
    if body < 0:
        raise Damaged("header does not end")
    version, fields = _fields(data[at:body])
    body += len(END)
    end = body + _length(fields)
    if end + len(END) > len(data):
        raise Damaged("record is cut off")
    if data[end : end + len(END)] != END:
        raise Damaged("no blank lines after the record")
    kind = fields.get("warc-type", "")
    if not kind or not fields.get("warc-record-id", "").strip("<>"):
        raise Damaged("record without a type or an id")
    payload, size = data[body:end], None
    if fields.get("content-type", "").startswith("application/http"):
        split = payload.find(END)
        if split < 0:
            raise Damaged("HTTP header does not end")
        size = _length(_fields(payload[:split])[1]) if kind == "revisit" else None
        payload = payload[split + len(END) :]
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if kind != "revisit":
        digest, told = hashlib.sha1(payload).hexdigest(), digest
        if algorithm == "sha1" and told.lower() not in ("", digest):
            raise Damaged("payload digest differs")
    return end + len(END), {
        "record_id": fields["warc-record-id"].strip("<>"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "payload_bytes": len(payload) if size is None else size,
        "payload_digest": digest.lower(),
        "payload": payload,
    }


def _next_version(data: bytes, after: int) -> int:
    at = data.find(b"\nWARC/1.", after)
    return len(data) if at < 0 else at + 1


def salvage_records(data: bytes, member: int | None = None) -> Iterator[dict]:
    """Records and gaps of uncompressed bytes, in order; together they cover every byte."""
    at = gap = 0
    reason = None
    while at < len(data):
        try:
            end, record = read_record(data, at)
        except Damaged as damage:
            reason = reason or str(damage)
            at = _next_version(data, at)
            continue
        if reason:
            yield {"kind": "gap", "member": member, "start": gap, "length": at - gap, "reason": reason}
            reason = None
        yield {"kind": "record", "member": member, "start": at, "length": end - at, **record}
        at = gap = end
    if reason:
        yield {"kind": "gap", "member": member, "start": gap, "length": len(data) - gap, "reason": reason}


def _inflate(data: bytes, at: int, steps: tuple[int, ...] = (1 << 16, 1 << 8, 1)) -> tuple[bytes, int, str | None]:
    """What the member at `at` holds, where it ends, and what is wrong with it.

    At damage it goes back to before the step, and on by smaller ones, for all that
    can still be read.
    """
    stream, out, here = zlib.decompressobj(31), [], at
    for step in steps:
        try:
            while here < len(data) and not stream.eof:
                before = stream.copy()
                piece = data[here : here + step]
                out.append(stream.decompress(piece))
                here += len(piece) - len(stream.unused_data)
        except zlib.error as error:
            stream, damage = before, f"member is damaged: {error}"
            continue
        return b"".join(out), here, None if stream.eof else "member is cut off"
    return b"".join(out), here, damage


def compressed(data: bytes) -> bool:
    """Whether a member that holds a version line comes before any version line as it is.

    Bodies of records of a plain archive may be members too, but come later.
    """
    plain = 0 if data.startswith(b"WARC/1.") else _next_version(data, 0)
    at = data.find(MEMBER)
    while 0 <= at < plain:
        try:
            if zlib.decompressobj(31).decompress(data[at : at + (1 << 16)], 7) == b"WARC/1.":
                return True
        except zlib.error:
            pass
        at = data.find(MEMBER, at + 1)
    return data.startswith(MEMBER) and plain == len(data)


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive, compressed by members or not.

    Gaps with a member lie in what that member holds, others in the archive itself. Of a
    damaged member the records before the damage count, but for the last, and carry the
    reason; the member is logged as a gap.
    """
    if not compressed(data):
        yield from salvage_records(data)
        return
    at = gap = 0
    reason = None
    while at < len(data):
        if not data.startswith(MEMBER, at):
            reason = reason or "no member"
            at = data.find(MEMBER, at)
            at = len(data) if at < 0 else at
            continue
        content, end, damage = _inflate(data, at)
        found = list(salvage_records(content, at))
        if damage:
            # Damage shows after it has begun: the last record before it is not trusted, the others are marked.
            found = [f | {"reason": damage} for f in found if f["kind"] == "record"][:-1]
        if reason and (found or not damage):
            yield {"kind": "gap", "start": gap, "length": at - gap, "reason": reason}
            reason, gap = None, at
        yield from found
        if not damage:
            at = gap = end
            continue
        reason = reason or damage
        at = data.find(MEMBER, at + 1)
        at = len(data) if at < 0 else at
    if reason:
        yield {"kind": "gap", "start": gap, "length": len(data) - gap, "reason": reason}


def _blocks(found: Iterator[dict], size: int = 1 << 24) -> Iterator[list[dict]]:
    """Lists of rows with about `size` bytes of payload, at most 1000 rows each."""
    rows, held = [], 0
    for row in found:
        rows.append(row)
        held += len(row.get("payload") or b"")
        if held >= size or len(rows) >= 1000:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records (kind `record`) and quarantined gaps (kind `gap`) of all archives under `path`.

    An archive is read by one task, in memory. Empty archives give no rows.
    """
    small_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch["path"], batch["content"]):
                for rows in _blocks(salvage(data.as_py())):
                    for row in rows:
                        row["archive"] = archive.as_py()
                        if not payload:
                            row["payload"] = None
                    yield pa.RecordBatch.from_pylist(rows, schema=FOUND)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, from_arrow_schema(FOUND))


def pages_through_warc(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads those back, and returns a row per page.

    page_id, payload_bytes, payload_digest (both of the full payload, also for
    revisits), record_type, refers_to (a page_id). An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    number = lambda urn: F.expr(f"try_cast(substring({urn}, {len(PAGE_ID) + 1}) as bigint)")
    return read_warc(spark, path, payload=False).filter("kind = 'record'").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
