"""Malformed-line handling: drop (FLT-1), fail (FLT-2), quarantine (FLT-3), and the
blank-line test of the audit (FLT-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyline.functions.record import with_parsed
from keyline.functions.text import is_blank

MODES = ("drop", "strict")


def parse_records(df: DataFrame, value: str = "value", mode: str = "drop", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``number, text`` of every well-formed line.

    ``mode="drop"`` silently drops malformed lines (FLT-1); ``"strict"`` fails the
    job at the first malformed line with its exact message (FLT-2), whatever
    columns or counts are asked for: the check is a filter, which is never pruned.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keep = list(keep or [])
    p = with_parsed(df, value, keep=keep)
    err = F.col("parse_error")
    if mode == "strict":
        return p.where(all_parsed()).select(*keep, "number", "text")
    return p.where(err.isNull()).select(*keep, "number", "text")


def all_parsed(parse_error: str = "parse_error") -> Column:
    """FLT-2 as a predicate: true, or fails with the line's message."""
    err = F.col(parse_error)
    return F.when(err.isNotNull(), F.raise_error(err).cast("boolean")).otherwise(F.lit(True))


def rejected_lines(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """FLT-3: the malformed lines with their exact reason (``value, parse_error``)."""
    keep = list(keep or [])
    p = with_parsed(df, value, keep=keep + ([value] if value not in keep else []))
    return p.where(F.col("parse_error").isNotNull()).select(*keep, value, "parse_error")


def reject_reason(parse_error: F.Column) -> F.Column:
    """Short reason class of a parse error: ``empty``, ``no_dot``, ``bad_number`` or null."""
    return (
        F.when(parse_error.startswith("Malformed line: is null"), F.lit("empty"))
        .when(parse_error.startswith("Malformed line: no dot"), F.lit("no_dot"))
        .when(parse_error.startswith("Malformed line (invalid number part"), F.lit("bad_number"))
    )


def drop_blank(df: DataFrame, value: str = "value") -> DataFrame:
    """FLT-4: drop null and white-space-only lines."""
    return df.where(~is_blank(F.col(value)))
