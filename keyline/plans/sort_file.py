"""Sort a keyed line file: read -> parse -> drop (or fail on) malformed lines ->
global sort -> write canonical lines, plus a run report.

Physical plan: FileScan text -> Project (parse, key; whole-stage codegen) ->
Exchange rangepartitioning(_k, number, _u) -> Sort -> Project (format) ->
text write. The exchange is the only shuffle; its bounds come from Spark's
sampling pass over the scan. The number of range partitions grows with the
input (at most 1 GB of input each), so reduce-side sorts stay bounded.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyline.functions.encoding import resolve_encoding
from keyline.functions.record import KEYED_LINE, LineFormat
from keyline.functions.text import text_from_key
from keyline.operators.filter import all_parsed
from keyline.operators.sort import bound_key_sample, range_partitions, restore_key_sample
from keyline.sources.lines import Listing, mean_key_bytes, paths_by_charset, scan_lines
from keyline.sources.sinks import check_not_same, write_lines, write_report

MODES = ("drop", "strict")

def validate_paths(*paths) -> None:
    """VAL-1: paths must be given and non-blank (Spark reports missing inputs)."""
    for p in paths:
        items = [p] if isinstance(p, str) or p is None else list(p)
        if not items or any(i is None or not str(i).strip() for i in items):
            raise ValueError("file path cannot be empty")


def parsed_scan(
    spark: SparkSession, path, encoding: str = "utf-8", mode: str = "drop", line_format: LineFormat = KEYED_LINE, listing: Listing | None = None
) -> DataFrame:
    """``value, number, text, parse_error, _m`` for every line of ``path``.

    ``mode="strict"`` (FLT-2) fails the job on the first malformed line with its
    exact message.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    scan = scan_lines(spark, path, encoding, with_split="id", listing=listing)
    parsed = line_format.parse_frame(scan, keep=["value", "_m"])
    return parsed.where(all_parsed()) if mode == "strict" else parsed


def sorted_records(
    spark: SparkSession,
    path,
    encoding: str = "utf-8",
    mode: str = "drop",
    text_order: str = "utf16",
    num_partitions: int | None = None,
    observation: Observation | None = None,
    line_format: LineFormat | None = None,
) -> DataFrame:
    """Records of ``path`` in global record order: ``number, text``.

    With an ``observation``, malformed lines travel through the exchange as tiny
    null-key rows (key, number and text null) and are counted and dropped after
    it, so ``rows_in`` and ``rows_rejected`` are exact in the same single pass
    (metrics taken before a range exchange would also count its sampling pass).
    Without one, they are dropped before the exchange.
    """
    fmt = line_format or LineFormat(text_order)
    listing = paths_by_charset(spark, path, resolve_encoding(encoding))
    parsed = parsed_scan(spark, path, encoding, mode, fmt, listing)
    parts = num_partitions or range_partitions(spark, scan_lines(spark, path, encoding, with_split=False, listing=listing))
    rows = parsed.select(*fmt.columns, "parse_error", "_m")
    if observation is None and mode != "strict":
        rows = rows.filter(F.col("parse_error").isNull())
    keyed = fmt.keyed(rows)
    staged = keyed.select("_k", "number", "_t", F.col("_m").alias("_u"))
    keys = [*fmt.order_by("_k", "number"), "_u"]
    bound_key_sample(spark, None, None, parts, mean_key_bytes(spark, listing))
    ordered = staged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    if observation is not None:
        ordered = ordered.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count(F.when(F.col("_k").isNull(), F.lit(1))).alias("rows_rejected"),
        ).filter(F.col("_k").isNotNull())
    return ordered.select("number", text_from_key(F.col("_k"), F.col("_t")).alias("text"))


def sort_file(
    spark: SparkSession,
    input_path,
    output_path: str,
    encoding: str = "utf-8",
    mode: str = "drop",
    text_order: str = "utf16",
    num_partitions: int | None = None,
    single_file: bool = False,
    report_path: str | None = "auto",
    line_format: LineFormat | None = None,
) -> dict:
    """SRT-1 end to end: write the sorted canonical lines of ``input_path`` to
    ``output_path`` (a folder of part files in order) and return the run report.

    ``report_path="auto"`` writes the report as JSON to ``<output>.report``;
    ``None`` writes none.
    """
    validate_paths(input_path, output_path)
    check_not_same(spark, input_path, output_path)
    fmt = line_format or LineFormat(text_order)
    started = time.time()
    obs = Observation("keyline_sort")
    try:
        recs = sorted_records(spark, input_path, encoding, mode, fmt.text_order, num_partitions, obs, fmt)
        write_lines(recs, output_path, fmt.format(F.col("number"), F.col("text")), encoding, single_file)
    finally:
        restore_key_sample(spark)
    metrics = obs.get
    report = {
        "status": "ok",
        "input": input_path if isinstance(input_path, str) else ",".join(input_path),
        "output": output_path,
        "rows_in": int(metrics.get("rows_in", 0)),
        "rows_rejected": int(metrics.get("rows_rejected", 0)),
        "elapsed_seconds": round(time.time() - started, 3),
    }
    report["rows_out"] = report["rows_in"] - report["rows_rejected"]
    if report_path:
        target = output_path.rstrip("/") + ".report" if report_path == "auto" else report_path
        write_report(spark, report, target)
    return report
