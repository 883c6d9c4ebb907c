"""Line sources (SRC-1, SRC-1b) and file-order line numbering (PRJ-4).

Single-byte and UTF-8 files go through Spark's text source, which splits large
files into blocks and breaks lines on LF, CR and CRLF. UTF-16/32 files cannot be
split on bytes (a break byte pair may straddle two code units); they go through
``keyline.sources.wide``, which splits them on code-unit boundaries instead.

Every scan can carry its split coordinates: ``_f`` (file path), ``_b`` (byte
offset of the split) and ``_m`` (a per-task increasing id taken in the scan's own
projection). Within one split the ``_m`` values follow file order, so file order
is the order of ``(_f, _b, _m)``. Ordering by ``_m`` alone is wrong once several
files are packed into one task.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyline.functions.encoding import WIDE, decode_bytes, resolve_encoding
from keyline.session import BROADCAST_BYTES, reliable_checkpoint
from keyline.sources.wide import open_file, scan_wide

SPLIT_COLS = ["_f", "_b"]
_PART_NO = "^part-([0-9]+)"


def file_order(path_col="_f") -> list:
    """Sort columns giving file order: folder, then Spark part number, then name.

    Spark names output files ``part-00000...``; past 99,999 parts the number gets a
    sixth digit, so plain name order would put part 100000 before part 99999.
    """
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    folder = F.regexp_extract(p, "^(.*)/[^/]*$", 1)
    name = F.regexp_extract(p, "([^/]*)$", 1)
    part = F.regexp_extract(name, _PART_NO, 1)
    part_no = F.when(part != F.lit(""), part.cast("bigint"))
    return [folder, part_no, p]


LINE_BREAKS = "\\r\\n|\\r|\\n"


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


# Byte-order marks, the longer of two with one beginning first.
MARKS = [
    (b"\xff\xfe\x00\x00", "UTF-32LE"),
    (b"\x00\x00\xfe\xff", "UTF-32BE"),
    (b"\xff\xfe", "UTF-16LE"),
    (b"\xfe\xff", "UTF-16BE"),
    (b"\xef\xbb\xbf", "UTF-8"),
]
# Up to so many files the driver reads the marks itself, which is quicker than a job.
DRIVER_READS = 64


def mark_charset(head: bytes) -> str | None:
    """The charset that a file's first bytes name, if they are a byte-order mark."""
    return next((charset for mark, charset in MARKS if head.startswith(mark)), None)


def _read_marks(batches):
    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = []
        for p in paths:
            with open_file(p) as f:
                found.append(mark_charset(f.read(4)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "charset"])


def _head(spark: SparkSession, path: str) -> bytes:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        return bytes(b for b in (stream.read() for _ in range(4)) if b >= 0)
    finally:
        stream.close()


def list_files(spark: SparkSession, path) -> list[str]:
    """The files of ``path`` in file order (one path a file reaches the driver)."""
    files = spark.read.format("binaryFile").load(_paths(path)).select("path")
    return [r.path for r in files.orderBy(*file_order("path")).collect()]


def paths_by_charset(spark: SparkSession, path, declared: str) -> "Listing":
    """The files of ``path`` by charset: what their byte-order mark says, else ``declared``.
    Only the listing and the first four bytes of each file are read."""
    files = spark.read.format("binaryFile").load(_paths(path)).select("path")
    listing = sorted(r.path for r in files.collect())
    if len(listing) <= DRIVER_READS:
        marked = {p: mark_charset(_head(spark, p)) for p in listing}
    else:
        rows = files.mapInArrow(_read_marks, "path string, charset string").filter("charset is not null")
        marked = {r.path: r.charset for r in rows.collect()}
    groups: dict[str, list[str]] = {}
    for p in listing:
        groups.setdefault(marked.get(p) or declared, []).append(p)
    if set(groups) <= {declared}:
        return [(declared, _paths(path))]
    return list(groups.items())


# Windows of the input that the driver reads to judge the length of sort keys.
KEY_WINDOWS = 64
KEY_WINDOW_BYTES = 16 << 10
_CODECS = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate")


def mean_key_bytes(spark: SparkSession, listing: "Listing") -> float | None:
    """Bytes of a line as a sample of equally many lines from every split would have
    them: the mean, over ``KEY_WINDOWS`` windows evenly spread over all bytes, of the mean
    line length in a window (the whole window where no line ends in it). At most 1 MB is
    read, by the driver. None where files are compressed, or there are none."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for _, paths in listing:
        for p in paths:
            hadoop = jvm.org.apache.hadoop.fs.Path(p)
            fs = hadoop.getFileSystem(conf)
            for status in fs.globStatus(hadoop) or []:
                inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
                files += [(fs, x.getPath(), x.getLen()) for x in inner if x.getLen() and not x.getPath().getName().startswith(("_", "."))]
    total = sum(n for _, _, n in files)
    if not total or any(p.getName().endswith(_CODECS) for _, p, _ in files):
        return None
    ends = list(accumulate(n for _, _, n in files))
    means = []
    for k in range(KEY_WINDOWS):
        at = total * k // KEY_WINDOWS
        i = bisect_right(ends, at)
        fs, path, size = files[i]
        start = at - (ends[i] - size)
        stream = fs.open(path)
        try:
            stream.seek(start)
            data = bytes(stream.readNBytes(KEY_WINDOW_BYTES))
        finally:
            stream.close()
        means.append(len(data) / max(1, data.count(b"\n") or data.count(b"\r")))
    return sum(means) / len(means)


Listing = list[tuple[str, list[str]]]  # files, or the paths they came from, by charset


def scan_lines(
    spark: SparkSession, path, encoding: str = "utf-8", with_split: bool | str = True, listing: Listing | None = None
) -> DataFrame:
    """Read text lines as ``value`` (plus ``_f, _b, _m`` when ``with_split``;
    only ``_m``, a unique scan position, when ``with_split="id"``).

    A byte-order mark is dropped and, whatever ``encoding`` says, names its file's
    charset. Invalid UTF-8 becomes U+FFFD, blank lines are kept, and a final line
    without a break is a line. ``listing`` is what :func:`paths_by_charset` gave for the
    path, for jobs that scan it several times.
    """
    listing = listing or paths_by_charset(spark, path, resolve_encoding(encoding))
    scans = [_scan(spark, p, c, with_split) for c, p in listing]
    return reduce(DataFrame.unionByName, scans)


def _scan(spark: SparkSession, path, charset: str, with_split: bool | str) -> DataFrame:
    if charset in WIDE:
        return _scan_wide(spark, path, charset, with_split)
    raw = spark.read.format("text").load(_paths(path))
    if with_split == "id":
        raw = raw.select("value", F.monotonically_increasing_id().alias("_m"))
    elif with_split:
        raw = raw.select(
            "value",
            F.col("_metadata.file_path").alias("_f"),
            F.col("_metadata.file_block_start").alias("_b"),
            F.monotonically_increasing_id().alias("_m"),
        )
    if charset == "UTF-8":
        value = F.make_valid_utf8(F.col("value"))
    else:
        value = decode_bytes(F.col("value").cast("binary"), charset)
    return raw.withColumn("value", value)


def _scan_wide(spark: SparkSession, path, charset: str, with_split: bool | str) -> DataFrame:
    if with_split == "id":
        columns = ("value", "_m")
    elif with_split:
        columns = ("value", "_f", "_b", "_m")
    else:
        columns = ("value",)
    return scan_wide(spark, _paths(path), charset, columns=columns)


def read_lines(spark: SparkSession, path, encoding: str = "utf-8") -> DataFrame:
    """SRC-1 / SRC-1b: one row per line, column ``value``."""
    return scan_lines(spark, path, encoding, with_split=False)


def split_offsets(scan: DataFrame, per_file: bool = False) -> DataFrame:
    """One row per split: ``_f, _b, _n`` (lines), ``_m0`` (first id), ``_off`` (lines before).

    The table is small (one row per input split); it is aggregated map-side, so
    only one partial count per split is shuffled. The running sum over splits runs
    on that small table alone.
    """
    counts = scan.groupBy(*SPLIT_COLS).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    w = Window.orderBy(*file_order("_f"), "_b") if not per_file else Window.partitionBy("_f").orderBy("_b")
    prior = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_off", F.coalesce(prior, F.lit(0)).cast("bigint"))


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", row_bytes: int = 32) -> DataFrame:
    """Join a per-split (or per-partition) table back to the rows.

    ``small`` is a written table (every task must see the same one) whose rows take about
    ``row_bytes``. It is broadcast up to ``BROADCAST_BYTES``; otherwise the join is a
    regular shuffle join, whose groups are bounded by one split each.
    """
    side = F.broadcast(small) if small.count() * row_bytes <= BROADCAST_BYTES else small
    return big.join(side, on=on, how=how)


def number_lines(scan: DataFrame, per_file: bool = False, keep_split: bool = False) -> DataFrame:
    """PRJ-4: add ``line_no`` (from 1) in file order without a global window.

    ``line_no = offset(split) + (_m - first _m of split) + 1``. Numbers run over all
    files in path order (a folder reads as one file) unless ``per_file``. The table of
    splits is written once; a split is known in it by a 64-bit hash of its file and
    block, so a row is three numbers whatever the paths. Should two splits ever share a
    hash, paths and blocks are joined instead.
    """
    offsets = reliable_checkpoint(split_offsets(scan, per_file).select(*SPLIT_COLS, "_m0", "_off"))
    split = F.xxhash64(*SPLIT_COLS).alias("_s")
    hashed = offsets.select(split, "_m0", "_off")
    if hashed.select("_s").distinct().count() == offsets.count():
        out = join_small(scan.select("*", split), hashed, ["_s"]).drop("_s")
    else:
        out = scan.join(offsets, SPLIT_COLS)
    out = out.withColumn("line_no", F.col("_off") + (F.col("_m") - F.col("_m0")) + F.lit(1))
    drop = ["_m0", "_off"] + ([] if keep_split else ["_f", "_b", "_m"])
    return out.drop(*drop)


def read_numbered_lines(spark: SparkSession, path, encoding: str = "utf-8", per_file: bool = False) -> DataFrame:
    """``line_no, value`` for every line, in file order."""
    out = number_lines(scan_lines(spark, path, encoding), per_file=per_file, keep_split=per_file)
    cols = ["line_no", "value"] + (["_f"] if per_file else [])
    out = out.select(*cols)
    return out.withColumnRenamed("_f", "file_path") if per_file else out
