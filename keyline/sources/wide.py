"""Splittable UTF-16 / UTF-32 line source (SRC-1 for wide charsets).

Spark's text source breaks lines on bytes, which is wrong for UTF-16/32: the byte
pair ``0A 00`` can straddle two code units. This Python data source splits every
file into byte ranges aligned to the code unit (2 or 4 bytes from offset 0) and
applies the usual split rule: a line belongs to the split holding its first
byte. A split reads one code unit before its start (to see whether a break ends
there) and reads past its end only to finish its last line, so splits need no
coordination and a task retry reads the same rows.

Rows carry the same split coordinates as the text scan: ``_f`` (file path),
``_b`` (split start) and ``_m`` (an increasing id, partition index in the high
bits like ``monotonically_increasing_id``), so numbering and the audit work on
them unchanged. Breaks are LF, CR and CRLF (code units 0x0A / 0x0D); a BOM at the
start of a file is dropped; malformed units decode to U+FFFD.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from keyline.session import conf_bytes

FORMAT_NAME = "keyline_wide_lines"
_TYPES = {"value": "string", "_f": "string", "_b": "bigint", "_m": "bigint"}


def _columns(options) -> list[str]:
    """Requested columns (option ``columns``); Spark does not prune Python sources."""
    cols = [c.strip() for c in options.get("columns", "value,_f,_b,_m").split(",") if c.strip()]
    if not cols or cols[0] != "value" or any(c not in _TYPES for c in cols):
        raise ValueError(f"columns must start with value and be among {list(_TYPES)}: {cols}")
    return cols

# Numpy dtype, Python codec and byte-order mark of each charset.
_UNITS = {
    "UTF-16LE": ("<u2", "utf-16-le", b"\xff\xfe"),
    "UTF-16BE": (">u2", "utf-16-be", b"\xfe\xff"),
    "UTF-32LE": ("<u4", "utf-32-le", b"\xff\xfe\x00\x00"),
    "UTF-32BE": (">u4", "utf-32-be", b"\x00\x00\xfe\xff"),
}

# Bytes decoded per step inside a split (bounds a task's Python memory).
WINDOW_BYTES = 8 << 20
# Most rows per Arrow batch handed back to Spark.
BATCH_ROWS = 65_536
_LF, _CR = 10, 13


class _Part(InputPartition):
    def __init__(self, index: int, splits: list):
        super().__init__(index)
        self.index = index
        self.splits = splits  # [(path, start, end, length)]


def open_file(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem().open_input_file(local)
    for hadoop_scheme in ("s3a://", "s3n://"):  # Hadoop's S3 connector names
        if path.startswith(hadoop_scheme):
            path = "s3://" + path[len(hadoop_scheme):]
    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def window_lines(f, charset: str, start: int, end: int, length: int):
    """Lines whose first byte lies in ``[start, end)`` of an open file, as an
    Arrow string array (None when there are none).

    ``start`` and ``end`` are multiples of the code unit. The caller's windows
    partition the file, so every line is returned by exactly one window.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    dtype, codec, bom = _UNITS[charset]
    u = len(bom)
    lo = max(start - u, 0)
    hi = min(end + u, length)
    buf = f.read_at(hi - lo, lo)
    units = np.frombuffer(buf, dtype=dtype, count=len(buf) // u)
    is_break = (units == _LF) | (units == _CR)
    brk = np.flatnonzero(is_break)
    # A break at unit i starts a line at i + 1, except CR directly followed by LF.
    nxt = np.append(units[1:], np.array([0], dtype=units.dtype))
    crlf_head = (units[brk] == _CR) & (nxt[brk] == _LF) & (brk + 1 < len(units))
    starts = brk[~crlf_head] + 1
    start_bytes = lo + starts.astype(np.int64) * u
    if lo == 0:  # the file's first line starts after a BOM, possibly in the second split
        first = u if buf[:u] == bom else 0
        start_bytes = np.concatenate([np.array([first], dtype=np.int64), start_bytes])
    keep = (start_bytes >= start) & (start_bytes < end) & (start_bytes < length)
    start_bytes = start_bytes[keep]
    if len(start_bytes) == 0:
        return None
    first_start = int(start_bytes[0])
    last_start = int(start_bytes[-1])
    # End of the last line: the next break at or after it, reading on if needed.
    after = brk[(lo + brk.astype(np.int64) * u) >= last_start]
    if len(after):
        stop = lo + int(after[0]) * u
        body = buf[first_start - lo : stop - lo]
    else:
        tail = [buf[first_start - lo :]]
        pos = hi
        stop = length
        while pos < length:
            more = f.read_at(min(WINDOW_BYTES, length - pos), pos)
            m = np.frombuffer(more, dtype=dtype, count=len(more) // u)
            hit = np.flatnonzero((m == _LF) | (m == _CR))
            if len(hit):
                tail.append(more[: int(hit[0]) * u])
                stop = pos + int(hit[0]) * u
                break
            tail.append(more)
            pos += len(more)
        body = b"".join(tail)
    # One decode per window; Arrow splits the text in C++ (no Python string per line).
    text = body.decode(codec, errors="replace").replace("\r\n", "\n").replace("\r", "\n")
    lines = pc.split_pattern(pa.array([text], pa.large_string()), pattern="\n").flatten().cast(pa.string())
    if len(lines) != len(start_bytes):  # defensive: the two break scans must agree
        raise RuntimeError(f"line split mismatch in window [{start}, {end}): {len(lines)} != {len(start_bytes)}")
    return lines


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.charset = options["charset"]
        # Kept as text: tasks get a pickled copy of the reader, and only
        # partitions() (planning, on the driver side) needs the parsed listing.
        self.files_json = options["files"]
        self.split_bytes = int(options["split_bytes"])
        self.open_cost = int(options.get("open_cost", "4194304"))
        self.window = int(options.get("window_bytes", str(WINDOW_BYTES)))
        self.columns = _columns(options)

    def partitions(self):
        """Code-unit aligned splits, small ones packed up to ``split_bytes`` per task."""
        parts, current, size = [], [], 0
        for path, length in json.loads(self.files_json):
            if length <= 0:
                continue
            for s in range(0, length, self.split_bytes):
                e = min(s + self.split_bytes, length)
                cost = e - s + self.open_cost
                if current and size + cost > self.split_bytes:
                    parts.append(_Part(len(parts), current))
                    current, size = [], 0
                current.append((path, s, e, length))
                size += cost
        if current:
            parts.append(_Part(len(parts), current))
        return parts or [_Part(0, [])]

    def __getstate__(self):
        """What tasks get: their own splits come with the partition, not the listing."""
        return self.__dict__ | {"files_json": "[]"}

    def read(self, partition):
        u = len(_UNITS[self.charset][2])
        window = max(u, (self.window // u) * u)
        next_id = partition.index << 33
        for path, s, e, length in partition.splits:
            f = open_file(path)
            try:
                for w in range(s, e, window):
                    lines = window_lines(f, self.charset, w, min(w + window, e), length)
                    if lines is None:
                        continue
                    for off in range(0, len(lines), BATCH_ROWS):
                        chunk = lines.slice(off, BATCH_ROWS)
                        yield _batch(chunk, path, s, next_id, self.columns)
                        next_id += len(chunk)
            finally:
                f.close()


def _batch(lines, path, split_start, first_id, columns):
    import numpy as np
    import pyarrow as pa

    n = len(lines)
    make = {
        "value": lambda: lines,
        "_f": lambda: pa.repeat(pa.scalar(path, pa.string()), n),
        "_b": lambda: pa.repeat(pa.scalar(split_start, pa.int64()), n),
        "_m": lambda: pa.array(np.arange(first_id, first_id + n, dtype=np.int64)),
    }
    return pa.RecordBatch.from_arrays([make[c]() for c in columns], names=list(columns))


class WideLineSource(DataSource):
    """Options: ``charset`` (a WIDE charset), ``files`` (JSON ``[[path, length], ...]``
    in read order), ``split_bytes`` (a multiple of 4), ``open_cost``, ``columns``."""

    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        return ", ".join(f"{c} {_TYPES[c]}" for c in _columns(self.options))

    def reader(self, schema):
        return _Reader(self.options)


def scan_wide(
    spark: SparkSession,
    paths: list[str],
    charset: str,
    window_bytes: int = WINDOW_BYTES,
    columns: tuple[str, ...] = ("value", "_f", "_b", "_m"),
) -> DataFrame:
    """``columns`` (of ``value, _f, _b, _m``) for every line of UTF-16/32 files,
    split like the text source. Ask only for what is used: a Python source is
    not pruned by Spark, and ``_f`` repeats the path on every row.

    Only the file listing (path and length, one row per file) reaches the driver;
    ``binaryFile`` lists the files without reading their content.
    """
    if charset not in _UNITS:
        raise ValueError(f"not a wide charset: {charset}")
    listing = sorted(spark.read.format("binaryFile").load(paths).select("path", "length").collect())
    split = conf_bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20)
    split = max(4, (split // 4) * 4)
    open_cost = conf_bytes(spark, "spark.sql.files.openCostInBytes", 4 << 20)
    spark.dataSource.register(WideLineSource)
    return (
        spark.read.format(FORMAT_NAME)
        .option("charset", charset)
        .option("files", json.dumps([[r.path, int(r.length)] for r in listing]))
        .option("split_bytes", str(split))
        .option("open_cost", str(open_cost))
        .option("window_bytes", str(window_bytes))
        .option("columns", ",".join(columns))
        .load()
    )
