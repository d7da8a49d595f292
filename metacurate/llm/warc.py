"""WARC archives: a writer with revisit records and a salvage reader for damaged files."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import new_folder, stored
from metacurate.operators.joins import join_unique

MIN_REVISIT = 100
_END = b"\r\n\r\n"
_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def _header_text(c: Column) -> Column:
    """A value that cannot end its header line."""
    return F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def warc_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """One record per row of ``pages(page_id, url, html)``: its page, type and text.

    The payload is the html in UTF-8, empty if null. Of the rows with equal
    payloads of at least ``min_revisit`` bytes the one with the smallest
    ``page_id`` is a response and the others revisit it; rows that repeat that
    id are responses as well. A null ``page_id`` is never the smallest, unless
    the payload has no other page, whose rows are then all responses.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).select("*", F.octet_length("html").cast("bigint").alias("size"), F.sha2("html", 256).alias("digest"))
    shared = (
        rows.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("refers_to"))
        .where("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to")
    )
    # stored, so that its size is known: payloads travel only if there are too many shared ones to broadcast
    shared = stored(shared, "shared_payloads")
    joined = join_unique(rows, shared, "digest", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(""),
        line("WARC-Target-URI", _header_text(F.col("url"))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("size").cast("string")),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, F.sha2(F.lit(""), 256)).otherwise(F.col("digest")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block, F.lit("\r\n\r\n"),
    )
    return joined.select("page_id", F.when(revisit, "revisit").otherwise("response").alias("record_type"), text.alias("record"))


def write_warc(records: DataFrame, path: str, per_file: int = 1000) -> None:
    """Write records as archives of at most ``per_file`` records, through Spark's writer, to any store it knows."""
    last = F.col("record").substr(F.lit(1), F.length("record") - 1)  # the writer adds the last line feed
    records.select(last.alias("value")).write.option("maxRecordsPerFile", per_file).text(path, lineSep="\n")


def _parse(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """End, headers and block of the plain record at ``at``, or why there is none."""
    version = _VERSION.match(data, at)
    if not version:
        return "no version line"
    head = data.find(_END, version.end() - 2)
    if head < 0:
        return "headers do not end"
    headers = {}
    for raw in data[version.end() : head].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if raw and not colon:
            return "header line without a colon"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()) or "warc-type" not in headers or "warc-record-id" not in headers:
        return "mandatory header missing"
    start = head + len(_END)
    end = start + int(size)
    if data[end : end + len(_END)] != _END:
        return "block does not end where it should"
    block = data[start:end]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
        return "block digest differs"
    return end + len(_END), headers, block


def _before_damage(reader: zlib._Decompress, chunk: bytes) -> bytes:
    """What a reader makes of a chunk before it fails."""
    out = []
    while len(chunk) > 1:  # down to the byte that fails
        kept, half = reader.copy(), len(chunk) // 2
        try:
            out.append(reader.decompress(chunk[:half]))
            chunk = chunk[half:]
        except zlib.error:
            reader, chunk = kept, chunk[:half]
    size = 1 << 12
    while size:
        kept = reader.copy()
        try:
            out.append(reader.decompress(chunk, size))
        except zlib.error:
            reader, size = kept, size // 2
            continue
        chunk = reader.unconsumed_tail
        if not out[-1] and not chunk:
            break
    return b"".join(out)


def _member(data: bytes, at: int) -> tuple[int, bytes, str]:
    """End and content of the gzip member at ``at``, and why it is not whole; the content is then what comes before the damage."""
    reader = zlib.decompressobj(31)
    out = []
    for start in range(at, len(data), 1 << 16):
        chunk, kept = data[start : start + (1 << 16)], reader.copy()
        try:
            out.append(reader.decompress(chunk))
        except zlib.error as e:
            out.append(_before_damage(kept, chunk))
            return len(data), b"".join(out), f"gzip member: {e}"
        if reader.eof:
            return start + len(chunk) - len(reader.unused_data), b"".join(out), ""
    return len(data), b"".join(out), "gzip member does not end"


def _reach(data: bytes, at: int, size: int) -> int:
    """Where the first ``size`` bytes of content of the gzip member at ``at`` end in the archive."""
    reader, step = zlib.decompressobj(31), 1 << 16
    while step and at < len(data):
        kept = reader.copy()
        try:
            n = len(reader.decompress(data[at : at + step]))
        except zlib.error:  # behind those bytes
            n = size
        if n < size:
            at, size = at + step, size - n
        else:
            reader, step = kept, step // 2
    return min(at + 1, len(data))


def _plain(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """Records and gaps of the content of a gzip member."""
    at, gap, why = 0, None, ""
    while at < len(data):
        record = _parse(data, at)
        if isinstance(record, str):
            if gap is None:
                gap, why = at, record
            following = _VERSION.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, None, b"", why
            gap = None
        yield at, *record, ""
        at = record[0]
    if gap is not None:
        yield gap, at, None, b"", why


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """Records ``(start, end, headers, block, "")`` and gaps ``(start, end, None, b"", reason)`` of an archive.

    What fails a check is skipped up to the next gzip member or version line at
    which a valid record starts; the bytes between are one gap. The content of a
    gzip member, also what comes before its damage, is searched alike. Its
    records and the gaps between them have the place of the member; the reason
    of such a gap tells the place in the content. A damaged member ends where its
    last valid record does, and a gap follows it.
    """
    at, gap, why = 0, None, ""
    while at < len(data):
        found: list[tuple[int, int, dict[str, str] | None, bytes, str]] = []
        damage = ""
        if data.startswith(b"\x1f\x8b\x08", at):
            end, content, damage = _member(data, at)
            found = list(_plain(content))
            last = max((stop for _, stop, headers, _, _ in found if headers is not None), default=0)
            reason = "" if last else damage or (f"in gzip member: {found[0][4]}" if found else "empty gzip member")
            if last and damage:
                end, found = _reach(data, at, last), [f for f in found if f[1] <= last]
        else:
            record = _parse(data, at)
            end, reason = (at, record) if isinstance(record, str) else (record[0], "")
            if not reason:
                found.append((at, *record, ""))
        if reason:
            if gap is None:
                gap, why = at, reason
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, None, b"", why
            gap = None
        for start, stop, headers, block, inner in found:
            yield at, end, headers, block, inner and f"in gzip member, bytes {start} to {stop}: {inner}"
        at = end
        if damage:
            gap, why = at, damage
            following = _START.search(data, at)
            at = following.start() if following else len(data)
    if gap is not None:
        yield gap, len(data), None, b"", why


def read_archives(files: DataFrame) -> DataFrame:
    """Records and quarantined gaps of ``files(path, content)``, as ``binaryFile`` reads them.

    Returns ``path, start, stop, kind`` (record or gap), ``reason`` of a gap, and
    of a record its headers, the length and SHA-256 of its block, and the block.
    A null content is an empty archive.
    """
    schema = pa.schema([
        ("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("reason", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())), ("block_bytes", pa.int64()), ("block_sha256", pa.string()), ("block", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out = []
                size = 0
                for start, end, headers, block, why in salvage(content.as_py() or b""):
                    if headers is None:
                        out.append((path, start, end, "gap", why, None, None, None, None))
                    else:
                        digest = hashlib.sha256(block).hexdigest()
                        out.append((path, start, end, "record", None, list(headers.items()), len(block), digest, block))
                        size += len(block)
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    return files.select("path", "content").mapInArrow(
        read,
        "path string, start bigint, stop bigint, kind string, reason string, headers map<string,string>, "
        "block_bytes bigint, block_sha256 string, block binary",
    )


def page_records(records: DataFrame) -> DataFrame:
    """Pages as the archives tell them: full payload size and digest, type, and what a revisit refers to."""
    header = lambda name: F.element_at("headers", name)
    page = lambda name: F.regexp_extract(header(name), "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
    revisit = header("warc-type") == "revisit"
    return records.where("kind = 'record'").select(
        page("warc-record-id").alias("page_id"),
        F.when(revisit, header("x-payload-length").cast("bigint")).otherwise(F.col("block_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(header("warc-payload-digest"), ":", -1)).otherwise(F.col("block_sha256")).alias("payload_digest"),
        header("warc-type").alias("record_type"),
        F.when(revisit, page("warc-refers-to")).alias("refers_to"),
    )


@query(
    "op10_warc_round_trip",
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), f AS (
      SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS kept FROM p
    )
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN kept <> page_id THEN kept END AS refers_to
    FROM f
    """,
)
def op10_warc_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_warc(warc_records(table(spark, sf, "pages")), path)
    files = spark.read.format("binaryFile").load(path)
    return page_records(read_archives(files))
