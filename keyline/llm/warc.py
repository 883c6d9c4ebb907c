"""WARC archives: a writer with revisit records and a salvage reader.

The writer makes each record one string and writes them as text files whose line
separator is the second half of the blank line that ends a WARC record; or each record is a
gzip member and the separator an empty member. Large pages share a file with few others, so
an archive has a bound in bytes. The reader takes whole archive files, plain or with gzip
members.
A record must have a version line, a header, a block as long as it says, the blank line
after it and, where the header gives one, the right block digest. After a failed check the
reader searches for the next place where a member or version line begins a valid record,
goes on there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyline.llm.common import MAX_BROADCAST_BYTES, as_bytes, materialize, scratch, table

MIN_REVISIT_BYTES = 1000
# Pages of up to so many bytes go so many to a file (64 MB at most), larger ones alone.
SIZE_CLASSES = ((64 << 10, 1000), (1 << 20, 64), (16 << 20, 4), (None, 1))
# A gzip member without content: what stands between the members of an archive.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
INFLATE_BYTES = 1 << 16  # of compressed bytes looked at together
REPEATED_BYTES = 200  # of one row of repeated payloads in a broadcast
DATE = "2024-01-01T00:00:00Z"
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
CRLF = "\r\n"


def _record_id(page: Column) -> Column:
    """A page's record id; pages without an id have one each."""
    none = F.concat(F.lit("null:"), F.monotonically_increasing_id().cast("string"))
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), none), F.lit(">"))


def with_revisits(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` as ``page_id, payload, digest, refers_to`` and ``url`` if there is one; equal payloads of at least
    1000 bytes refer to the one with the largest id. Digests are compared first on the ids
    alone; what is joined back is one row for each payload that occurs more than once,
    broadcast where that table is small enough, else by a shuffle of the pages."""
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    url = [F.col("url")] if "url" in pages.columns else []
    p = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), payload.alias("payload"), *url)
    p = p.withColumn("content", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT_BYTES
    repeated = p.filter(large).groupBy("content").agg(F.count("*").alias("n"), F.max("page_id").alias("response")).filter("n > 1")
    repeated = materialize(repeated.select("content", "response"), "warc-repeated")
    small = repeated.count() * REPEATED_BYTES <= MAX_BROADCAST_BYTES
    joined = p.join(F.broadcast(repeated) if small else repeated, "content", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return joined.select("page_id", "payload", F.sha1("payload").alias("digest"), refers.alias("refers_to"), *url)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record, with the end of its blank line, as a gzip member."""
    for batch in batches:
        packed = [gzip.compress(r + CRLF.encode(), mtime=0) for r in as_bytes(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["value"])


def write_warc(pages: DataFrame, path: str, *, records_per_file: int | None = None, compress: bool = False) -> None:
    """One record for each row of ``page_id, payload, digest, refers_to[, url]``: a response
    with its HTTP block, or a revisit, whose block is the HTTP header alone. With
    ``compress`` each record is a gzip member. Files hold ``records_per_file`` records, by
    default as ``SIZE_CLASSES`` has it for payloads of their size (a folder a class that
    occurs), so that no archive outgrows a task. Payloads of any length are written whole;
    null ids get a record id each, repeated ids share theirs, a null url is ``urn:none``,
    and no rows write no records. Columns but these are not written.
    """
    if records_per_file is None:
        size = F.octet_length("payload")
        at = reduce(lambda kind, i: kind + F.when(size > SIZE_CLASSES[i][0], 1).otherwise(0), range(len(SIZE_CLASSES) - 1), F.lit(0))
        kinds = sorted(r[0] for r in pages.select(at).distinct().collect()) or [0]
        for kind in kinds:
            write_warc(pages.filter(at == kind), f"{path}/size-{kind}", records_per_file=SIZE_CLASSES[kind][1], compress=compress)
        return
    lines = lambda *parts: F.concat(*[x for p in parts for x in (p, F.lit(CRLF))])
    http = lines(
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string")),
        F.lit(""),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("urn:none")), r"[\x00-\x20]", "") if "url" in pages.columns else F.lit("urn:none")
    made = pages.select("*", block.alias("block"), url.alias("uri"))
    refers = F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")), F.lit(CRLF))).otherwise(F.lit(""))
    record = F.concat(
        lines(
            F.lit("WARC/1.1"),
            F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
            F.lit(f"WARC-Date: {DATE}"),
            F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        ),
        refers,
        lines(
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
            F.concat(F.lit("WARC-Block-Digest: sha1:"), F.sha1("block")),
            F.lit("Content-Type: application/http; msgtype=response"),
            F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
            F.lit(""),
        ),
        F.col("block"),
        F.lit(CRLF),  # the writer's separator is the other half of the blank line
    )
    made = made.select(record.alias("value"))
    separator = CRLF
    if compress:
        made = made.mapInArrow(_members, "value binary").select(F.col("value").cast("string").alias("value"))
        separator = EMPTY_MEMBER.decode("latin-1")
    writer = made.write.option("encoding", "ISO-8859-1").option("lineSep", separator)
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def _digest_is(declared: str, data: bytes) -> bool:
    """A digest as ``sha1:`` and hex, or base 32 as most crawlers write it; others pass."""
    name, _, value = declared.partition(":")
    if name.lower() != "sha1":
        return True
    raw = hashlib.sha1(data).digest()
    return value.strip().lower() == raw.hex() or value.strip().upper() == base64.b32encode(raw).decode()


class _Blank:
    """The next blank line from a place on; places only grow, so no byte is searched twice."""

    def __init__(self, data: bytes):
        self.data, self.found, self.since = data, -2, 0

    def after(self, at: int) -> int:
        if self.found == -1 and at >= self.since:
            return -1
        if self.found < at or at < self.since:
            self.found, self.since = self.data.find(b"\r\n\r\n", at), at
        return self.found


def _one(data: bytes, at: int, blank: _Blank) -> tuple[dict[str, str], bytes, int] | str:
    """The record at ``at`` as header, block and end, or why there is none."""
    if not re.match(rb"WARC/1\.[01]\r\n", data[at : at + 10]):
        return "no version line"
    stop = blank.after(at)
    if stop < 0:
        return "header without end"
    header: dict[str, str] = {}
    here = at + 10
    while here < stop:  # line by line: a false start fails at its first one
        line_end = data.find(b"\r\n", here, stop + 2)
        name, colon, value = data[here:line_end].decode("utf-8", "replace").partition(":")
        if not colon:
            return "malformed header line"
        header[name.strip().lower()] = value.strip()
        here = line_end + 2
    if not re.fullmatch(r"[0-9]{1,18}", header.get("content-length", "")):
        return "no content length"
    end = stop + 4 + int(header["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "block does not end where it should"
    block = data[stop + 4 : end]
    if not _digest_is(header.get("warc-block-digest", ""), block):
        return "block digest differs"
    return header, block, end + 4


def _member(data: bytes, at: int) -> tuple[list, int] | str:
    """The records of the gzip member at ``at`` and its end, or why there are none."""
    inflate, view, parts, here = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not inflate.eof and here < len(data):
            window = view[here : here + INFLATE_BYTES]
            parts.append(inflate.decompress(window))
            here += len(window)
    except zlib.error:
        return "gzip member damaged"
    if not inflate.eof:
        return "gzip member cut short"
    end, inner = here - len(inflate.unused_data), b"".join(parts)
    records, here, blank = [], 0, _Blank(inner)
    while here < len(inner):
        got = _one(inner, here, blank)
        if isinstance(got, str):
            return got
        records.append(got[:2])
        here = got[2]
    return records, end


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """``(start, end, header, block, reason)`` of every record in order; a gap has no header
    and the reason why the first check in it failed."""
    at, gap, reason, blank = 0, -1, "", _Blank(data)
    while at < len(data):
        packed = data[at : at + 3] == b"\x1f\x8b\x08"
        got = _member(data, at) if packed else _one(data, at, blank)
        if isinstance(got, str):
            if gap < 0:
                gap, reason = at, got
            found = START.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap >= 0:
            yield gap, at, None, b"", reason
            gap = -1
        if packed:
            records, end = got
            for header, block in records:
                yield at, end, header, block, ""
        else:
            header, block, end = got
            yield at, end, header, block, ""
        at = end
    if gap >= 0:
        yield gap, len(data), None, b"", reason


SCHEMA = (
    "archive string, start long, end long, gap string, type string, record_id string, refers_to string, "
    "uri string, payload binary, payload_bytes long, payload_digest string"
)


def _salvaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in SCHEMA.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            archive, rows, size = batch.column(0)[i].as_py(), [], 0
            for start, end, header, block, reason in salvage(batch.column(1)[i].as_py()):
                if header is None:
                    rows.append((archive, start, end, reason, *[None] * 7))
                    continue
                _, blank, payload = block.partition(b"\r\n\r\n") if "application/http" in header.get("content-type", "") else (b"", b"", block)
                digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
                if header.get("warc-type") == "revisit":  # what it says of the payload it leaves out
                    digest = header.get("warc-payload-digest", "").partition(":")[2].lower() or None
                    said = re.search(rb"(?im)^content-length: *([0-9]{1,18})\r?$", block)
                    n = int(said[1]) if said else None
                rows.append((archive, start, end, None, header.get("warc-type"), header.get("warc-record-id"), header.get("warc-refers-to"), header.get("warc-target-uri"), payload, n, digest))
                size += len(payload)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, and one row with ``gap`` (the reason)
    for each quarantined range of bytes, ``start`` to ``end`` of ``archive``.

    An empty file has no rows; a file without any valid record is one gap. A record cut
    off by the end of its file is a gap. Repeated records are all returned. Headers and
    payloads of any length are taken whole; a file must fit a task (2 GB at most). Folders
    are searched for files at any depth.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_salvaged, SCHEMA)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null html is an empty payload; rows with equal payloads and the same largest id are
    all responses; a null id never is the largest unless all are null."""
    pages = table(spark, sf_dir, "pages")
    path = scratch(spark, "warc")
    made = with_revisits(pages)
    packed = F.pmod(F.xxhash64("digest"), F.lit(2)) == 0  # half of the archives are gzip members
    write_warc(made.filter(~packed), f"{path}/plain")
    write_warc(made.filter(packed), f"{path}/gzip", compress=True)
    records = read_warc(spark, path).filter("gap is null")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), number("refers_to").alias("refers_to")
    )


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT *, strlen(t) AS n, max(page_id) OVER (PARTITION BY t) AS best FROM p)
SELECT page_id, n AS payload_bytes, sha1(t) AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM g"""
