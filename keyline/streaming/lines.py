"""Keyed lines arriving as files in a folder (Structured Streaming).

The reference works on bounded files only; its per-line operators (parse,
canonicalise, drop or quarantine malformed lines) are stateless Column
expressions, so the same code applies unchanged to a streaming DataFrame. No
state, watermark or window is involved; the global sort and the audit are
whole-file operations and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyline.functions.record import format_record, with_parsed


def stream_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in ``folder`` as a stream of ``value`` lines (SRC-1)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select(F.make_valid_utf8(F.col("value")).alias("value"))


def stream_records(spark: SparkSession, folder: str, **kw) -> DataFrame:
    """``value, number, text, parse_error, line`` for every arriving line, where
    ``line`` is the canonical form (null for a malformed line)."""
    parsed = with_parsed(stream_lines(spark, folder, **kw))
    return parsed.select("*", format_record(F.col("number"), F.col("text")).alias("line"))


def split_stream(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed ``number, text``; quarantined ``value, parse_error``)."""
    good = records.where(F.col("parse_error").isNull()).select("number", "text")
    bad = records.where(F.col("parse_error").isNotNull()).select("value", "parse_error")
    return good, bad


def write_line_stream(
    lines: DataFrame,
    output_path: str,
    checkpoint_location: str | None = None,
    column: str = "line",
    trigger_once: bool = False,
) -> StreamingQuery:
    """Append one text line per row to ``output_path`` (file sink, exactly once).

    The query's progress is kept in ``checkpoint_location``; by default in
    ``<output_path>.checkpoint``, beside the output, so a restart with the same output
    resumes where the last run stopped (the sink's own log in the output skips batches
    it has seen, so a fresh location would lose rows).
    """
    if not output_path or not str(output_path).strip():
        raise ValueError("file path cannot be empty")
    location = checkpoint_location or output_path.rstrip("/") + ".checkpoint"
    writer = (
        lines.select(F.col(column).alias("value"))
        .writeStream.format("text")
        .option("path", output_path)
        .option("checkpointLocation", location)
        .outputMode("append")
    )
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
