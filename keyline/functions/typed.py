"""Records of several typed fields (UDF-1), ordered by one byte string (CMP-2).

Each field is written so that comparing bytes compares values: whole numbers and dates as
eight big-endian bytes with the sign turned over, texts in UTF-16 order with a terminator
that sorts below any character. A descending field has its bytes turned over. Joined, they
compare like the fields one after the other and are equal only if all fields are, so one
binary column serves a range exchange, a sort, an audit and an equality test.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyline.functions.record import MSG_EMPTY, parse_int64
from keyline.functions.text import ordinal_key, ws_trim

KINDS = ("long", "date", "text")
_DIGITS = "0123456789ABCDEF"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class Field:
    """One field of a line: its name, its kind (``long``, ``date`` or ``text``) and whether
    larger values come first."""

    name: str
    kind: str
    descending: bool = False

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}, got {self.kind!r}")

    def parse(self, part: Column) -> Column:
        """The value of a trimmed part; null where it is none."""
        if self.kind == "long":
            return parse_int64(part)
        if self.kind == "date":
            return F.when(part.rlike(_DAY), part.try_cast("date"))
        return part

    def key(self, value: Column, text_order: str = "utf16") -> Column:
        """Bytes that compare as the (non-null) value does."""
        if self.kind == "text":
            # 00 ends the field; a 00 or 01 inside is written 01 01 or 01 02.
            k = F.replace(ordinal_key(value, text_order), F.lit("\x01"), F.lit("\x01\x02"))
            k = F.concat(F.replace(k, F.lit("\x00"), F.lit("\x01\x01")), F.lit("\x00")).cast("binary")
            return F.unhex(F.translate(F.hex(k), _DIGITS, _DIGITS[::-1])) if self.descending else k
        whole = F.unix_date(value) if self.kind == "date" else value
        whole = whole.cast("bigint").bitwiseXOR(F.lit(-(2**63)))
        if self.descending:
            whole = F.bitwise_not(whole)
        return F.unhex(F.lpad(F.hex(whole), 16, "0"))


def composite_key(fields: list[tuple[Field, Column]], text_order: str = "utf16") -> Column:
    """One binary that compares like the fields in turn."""
    return F.concat(*[field.key(value, text_order) for field, value in fields])


@dataclass(frozen=True)
class TypedFormat:
    """Lines of ``separator``-joined typed fields, for :func:`keyline.plans.sort_file.sort_file`
    and :func:`keyline.operators.audit.audit_lines` in place of a ``LineFormat``.

    Parts are trimmed; a line is malformed if it is empty, has another number of parts or a
    part that is not of its field's kind. A record travels as its key and its canonical
    line (``text``); ``number`` is 0. Two neighbours are duplicates if all fields are equal.
    """

    fields: tuple[Field, ...]
    separator: str = "|"
    text_order: str = "utf16"
    joiner: None = None  # the canonical line is shown as it is
    number_first: bool = False
    columns: tuple[str, ...] = ("number", "text", "_key")

    def parse_frame(self, df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
        """``keep`` columns plus ``number, text, parse_error, _key``."""
        cols = df.columns if keep is None else list(keep)
        carry = [] if value in cols else [value]
        v = F.col(value)
        s = df.select(*cols, *carry, F.split(v, re.escape(self.separator), -1).alias("_parts"))
        parts = [ws_trim(F.try_element_at("_parts", F.lit(i + 1))) for i in range(len(self.fields))]
        s = s.select("*", *[p.alias(f"_part{i}") for i, p in enumerate(parts)])
        s = s.select("*", *[f.parse(F.col(f"_part{i}")).alias(f"_value{i}") for i, f in enumerate(self.fields)])
        error = F.when(v.isNull() | (v == F.lit("")), F.lit(MSG_EMPTY)).when(
            F.size("_parts") != len(self.fields), F.concat(F.lit(f"Malformed line: not {len(self.fields)} fields. Value: "), v)
        )
        for i, f in enumerate(self.fields):
            bad = F.concat(F.lit(f"Malformed line (invalid {f.name} '"), F.col(f"_part{i}"), F.lit("'). Full line: "), v)
            error = error.when(F.col(f"_value{i}").isNull(), bad)
        s = s.select("*", error.alias("parse_error"))
        ok = F.col("parse_error").isNull()
        values = [F.col(f"_value{i}") for i in range(len(self.fields))]
        line = F.concat_ws(self.separator, *[x.cast("string") for x in values])
        key = composite_key(list(zip(self.fields, values)), self.text_order)
        return s.select(*cols, F.when(ok, F.lit(0).cast("bigint")).alias("number"), F.when(ok, line).alias("text"), "parse_error", F.when(ok, key).alias("_key"))

    def keyed(self, df: DataFrame, text_order: str | None = None) -> DataFrame:
        """``df`` with the sort key ``_k`` and the line ``_t``."""
        return df.select("*", F.col("_key").cast("string").alias("_k"), F.col("text").alias("_t"))

    def format(self, number: Column, text: Column) -> Column:
        return text

    def order_by(self, key, number) -> list:
        return [key, number]
