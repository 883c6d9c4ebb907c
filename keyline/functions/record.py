"""The keyed line record: ``<number>. <text>``.

Parse (PRJ-1), format (PRJ-2), canonicalise (PRJ-3), compare (CMP-1..3), hash (CMP-4)
and the strict int64 parse (NUM-1), all as native Column expressions.

A parse yields three columns: ``number`` (bigint), ``text`` (string) and
``parse_error`` (string). On success ``parse_error`` is null; on failure ``number``
and ``text`` are null and ``parse_error`` holds one of three exact messages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyline.functions.text import WHITESPACE, ends_with_ws, ordinal_key, with_ordinal_key, ws_ltrim, ws_trim

# The three reject messages of the record format.
MSG_EMPTY = "Malformed line: is null or empty"
MSG_NO_DOT = "Malformed line: no dot or no text after dot. Value: "
MSG_BAD_NUMBER_HEAD = "Malformed line (invalid number part '"
MSG_BAD_NUMBER_TAIL = "'). Full line: "

# Optional sign, then ASCII digits only: no separators, exponents or other digit
# scripts. ``try_cast`` alone would also accept surrounding control characters.
INT64_PATTERN = "^[+-]?[0-9]+$"

RECORD_SEPARATOR = ". "


def parse_int64(part: Column) -> Column:
    """Strict int64 parse (NUM-1): null unless ``part`` is a signed decimal in range."""
    return F.when(part.rlike(INT64_PATTERN), part.try_cast("bigint"))


@dataclass(frozen=True)
class ParsedColumns:
    number: Column
    text: Column
    parse_error: Column
    number_part: Column


def parse_columns(value: Column, separator: str = ".") -> ParsedColumns:
    """PRJ-1: split at the first dot, trim both parts, parse the number strictly."""
    dot = F.instr(value, separator)
    after = F.substr(value, dot + F.lit(1))
    number_part = ws_trim(F.substr(value, F.lit(1), dot - F.lit(1)))
    number = parse_int64(number_part)
    error = _error(value, dot, after, number, number_part)
    ok = error.isNull()
    return ParsedColumns(
        number=F.when(ok, number),
        text=F.when(ok, ws_trim(after)),
        parse_error=error,
        number_part=number_part,
    )


def _error(value: Column, dot: Column, after: Column, number: Column, number_part: Column) -> Column:
    return (
        F.when(value.isNull() | (value == F.lit("")), F.lit(MSG_EMPTY))
        .when((dot == F.lit(0)) | (after == F.lit("")), F.concat(F.lit(MSG_NO_DOT), value))
        .when(
            number.isNull(),
            F.concat(F.lit(MSG_BAD_NUMBER_HEAD), number_part, F.lit(MSG_BAD_NUMBER_TAIL), value),
        )
    )


def with_parsed(df, value: str = "value", keep: list[str] | None = None, separator: str = "."):
    """PRJ-1 as a chain of projections: ``keep`` columns (all by default) plus
    ``number``, ``text`` and ``parse_error``.

    Same result as :func:`parse_columns`, but the dot position and the two
    halves are their own columns, computed once per row. The right trim of the
    text (Spark's right trim with a character set scans the whole string) only
    runs when the *line* ends in white space: the text is a suffix of the line,
    and testing the raw column keeps the expression small even where Catalyst
    inlines it (e.g. into a pushed-down filter).
    """
    v = F.col(value)
    cols = df.columns if keep is None else list(keep)
    carry = [value] if value not in cols else []
    s = df.select(*cols, *carry, F.instr(v, separator).alias("_dot"))
    dot = F.col("_dot")
    s = s.select(
        "*",
        F.substr(v, dot + F.lit(1)).alias("_after"),
        ws_trim(F.substr(v, F.lit(1), dot - F.lit(1))).alias("_npart"),
    )
    s = s.select("*", ws_ltrim(F.col("_after")).alias("_tl"), parse_int64(F.col("_npart")).alias("_num"))
    tl = F.col("_tl")
    text = F.when(ends_with_ws(v), F.rtrim(tl, F.lit(WHITESPACE))).otherwise(tl)
    err = _error(v, dot, F.col("_after"), F.col("_num"), F.col("_npart"))
    s = s.select("*", text.alias("_text"), err.alias("parse_error"))
    ok = F.col("parse_error").isNull()
    out = s.select(
        *cols,
        *carry,
        F.when(ok, F.col("_num")).alias("number"),
        F.when(ok, F.col("_text")).alias("text"),
        "parse_error",
    )
    return out.drop(*carry) if carry else out


def parse_line(value: Column) -> list[Column]:
    """``[number, text, parse_error]`` aliased, ready for ``select``."""
    p = parse_columns(value)
    return [p.number.alias("number"), p.text.alias("text"), p.parse_error.alias("parse_error")]


def format_record(number: Column, text: Column, joiner: str = RECORD_SEPARATOR) -> Column:
    """PRJ-2: ``"{number}. {text}"``."""
    return F.concat(number.cast("string"), F.lit(joiner), text)


def canonical_line(value: Column) -> Column:
    """PRJ-3: parse then format; null for a malformed line."""
    p = parse_columns(value)
    return format_record(p.number, p.text)


def records_equal(n1: Column, t1: Column, n2: Column, t2: Column) -> Column:
    """CMP-1: value equality; false (not null) when a side is absent."""
    return F.coalesce((n1 == n2) & (t1 == t2), F.lit(False))


def sort_key(number: Column, text: Column, text_order: str = "utf16") -> Column:
    """Struct whose natural order is record order: text by UTF-16 code units, then number."""
    return F.struct(ordinal_key(text, text_order).alias("k"), number.alias("n"))


def record_compare(n1: Column, t1: Column, n2: Column, t2: Column, text_order: str = "utf16") -> Column:
    """CMP-3: -1, 0 or 1 (only the sign is the contract)."""
    a = sort_key(n1, t1, text_order)
    b = sort_key(n2, t2, text_order)
    return F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).when(a == b, F.lit(0))


def record_less(n1: Column, t1: Column, n2: Column, t2: Column, text_order: str = "utf16") -> Column:
    """CMP-2 ``<``."""
    return sort_key(n1, t1, text_order) < sort_key(n2, t2, text_order)


def record_less_equal(n1: Column, t1: Column, n2: Column, t2: Column, text_order: str = "utf16") -> Column:
    """CMP-2 ``<=``."""
    return sort_key(n1, t1, text_order) <= sort_key(n2, t2, text_order)


def record_greater(n1: Column, t1: Column, n2: Column, t2: Column, text_order: str = "utf16") -> Column:
    """CMP-2 ``>``."""
    return sort_key(n1, t1, text_order) > sort_key(n2, t2, text_order)


def record_greater_equal(n1: Column, t1: Column, n2: Column, t2: Column, text_order: str = "utf16") -> Column:
    """CMP-2 ``>=``."""
    return sort_key(n1, t1, text_order) >= sort_key(n2, t2, text_order)


def record_hash(number: Column, text: Column) -> Column:
    """CMP-4: hash consistent with equality (values need not match any other runtime)."""
    return F.xxhash64(number, text)


@dataclass(frozen=True)
class LineFormat:
    """Record format (UDF-1): what separates number and text in a line that is read, what
    joins them in a line that is written, and which comes first in record order.

    The sorter and the auditor take a ``LineFormat``; the default is the keyed line.
    Everything stays a native expression, no Python UDF.
    """

    text_order: str = "utf16"
    separator: str = "."
    joiner: str = RECORD_SEPARATOR
    number_first: bool = False
    columns: tuple[str, ...] = ("number", "text")  # what a parsed record is made of

    def parse(self, value: Column) -> ParsedColumns:
        return parse_columns(value, self.separator)

    def parse_frame(self, df, value: str = "value", keep: list[str] | None = None):
        """``keep`` columns plus ``number, text, parse_error`` (the staged parse)."""
        return with_parsed(df, value, keep, self.separator)

    def keyed(self, df, text_order: str | None = None):
        """``df`` with the text's sort key ``_k``, and the text ``_t`` where the key is not it."""
        return with_ordinal_key(df, "text", "_k", "_t", text_order or self.text_order)

    def format(self, number: Column, text: Column) -> Column:
        return format_record(number, text, self.joiner)

    def order_by(self, key, number) -> list:
        """``key`` (the text's) and ``number``, the first to compare first."""
        return [number, key] if self.number_first else [key, number]


KEYED_LINE = LineFormat()
