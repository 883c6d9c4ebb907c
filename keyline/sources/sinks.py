"""Line sinks: write records as text lines in a charset (SNK-1), one final file
(SNK-2) and the run report (SNK-3)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.functions.encoding import CODE_UNIT, encode_text, resolve_encoding

# Line separator bytes per charset, given as a string the text writer encodes in UTF-8.
_WIDE_SEPARATORS = {
    "UTF-16LE": "\n\u0000",
    "UTF-16BE": "\u0000\n",
    "UTF-32LE": "\n\u0000\u0000\u0000",
    "UTF-32BE": "\u0000\u0000\u0000\n",
}


def _places(spark: SparkSession, path: str) -> list[tuple[str, tuple[str, ...]]]:
    """What ``path`` names, globs expanded: (file system, path parts) of each place, as
    the Hadoop file system resolves it; local links are followed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.globStatus(hadoop) or []] or [hadoop]
    out = []
    for p in found:
        uri = fs.makeQualified(p).toUri()
        place = uri.getPath()
        if uri.getScheme() == "file":
            place = os.path.realpath(place)
        out.append((f"{uri.getScheme()}://{uri.getAuthority() or ''}", tuple(x for x in place.split("/") if x)))
    return out


def check_not_same(spark: SparkSession, inputs, output: str) -> None:
    """Refuse an output that is an input, holds one or lies within one: Spark deletes
    the output before it reads the input."""
    for p in [inputs] if isinstance(inputs, str) else list(inputs):
        for fs, place in _places(spark, p):
            for out_fs, out in _places(spark, output):
                shorter = min(len(place), len(out))
                if fs == out_fs and place[:shorter] == out[:shorter]:
                    raise ValueError(f"output {output!r} and input {p!r} overlap; write elsewhere")


def encoded_line(line: Column, encoding: str = "utf-8") -> tuple[Column, str]:
    """Line column ready for the text writer, and the separator to use.

    Non-UTF-8 charsets are written as their encoded bytes (the text writer copies
    string bytes verbatim); no byte-order mark is written.
    """
    charset = resolve_encoding(encoding)
    if charset == "UTF-8":
        return line, "\n"
    sep = _WIDE_SEPARATORS.get(charset, "\n")
    return encode_text(line, charset).cast("string"), sep


def write_lines(
    df: DataFrame,
    path: str,
    line: Column | str = "value",
    encoding: str = "utf-8",
    single_file: bool = False,
    compression: str | None = None,
) -> None:
    """SNK-1 / SNK-2: write one line per row, in place of what ``path`` holds.

    Rows keep their partition order, so a range-sorted DataFrame yields part files
    whose name order is the global order. Parts are written beside ``path`` and take its
    place when all are there: a job that fails leaves the old output whole.
    ``single_file`` joins the parts, in name order, into one file at that point, byte by byte on
    the driver's file system client, so no task writes more than its part.
    """
    col = F.col(line) if isinstance(line, str) else line
    value, sep = encoded_line(col, encoding)
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:12]}"
    w = df.select(value.alias("value")).write.mode("error").option("lineSep", sep)
    if compression:
        w = w.option("compression", compression)
    try:
        w.text(staged)
        if single_file:
            _join_parts(spark, staged)
        _take_place(spark, staged, path)
    finally:
        _delete(spark, staged)


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    hadoop, fs = _hadoop(spark, path)
    fs.delete(hadoop, True)


def _take_place(spark: SparkSession, staged: str, path: str) -> None:
    """``staged`` becomes ``path``; what was there goes only after that."""
    new, fs = _hadoop(spark, staged)
    target, _ = _hadoop(spark, path)
    old, _ = _hadoop(spark, f"{staged}.old")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"can't move {path!r} aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"can't put the output at {path!r}")
    if had:
        fs.delete(old, True)


def _join_parts(spark: SparkSession, folder: str) -> None:
    """The part files of ``folder`` as one, ``part-00000`` with their suffix."""
    jvm = spark.sparkContext._jvm
    base, fs = _hadoop(spark, folder)
    parts = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName().startswith("part-")]
    if len(parts) < 2:
        return
    parts.sort(key=lambda p: (int(p.getName().split("-")[1].split(".")[0]), p.getName()))
    suffix = "." + parts[0].getName().partition(".")[2] if "." in parts[0].getName() else ""
    whole = jvm.org.apache.hadoop.fs.Path(base, "joined")
    out = fs.create(whole)
    try:
        for p in parts:
            stream = fs.open(p)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            stream.close()
    finally:
        out.close()
    for p in parts:
        fs.delete(p, False)
    fs.rename(whole, jvm.org.apache.hadoop.fs.Path(base, f"part-00000{suffix}"))


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
    ]
)


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    """SNK-3: the run report as a one-row DataFrame."""
    row = tuple(report.get(f.name) for f in REPORT_SCHEMA.fields)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    report_frame(spark, report).coalesce(1).write.mode("overwrite").json(path)


__all__ = ["write_lines", "write_report", "report_frame", "check_not_same", "encoded_line", "CODE_UNIT"]
