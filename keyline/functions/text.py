"""String helpers shared by the parser, the sorter and the auditor.

All helpers return native Column expressions, so they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that the record format treats as white space when
# trimming a number or text part and when deciding that a line is blank. This is
# the Unicode White_Space set of the .NET runtime (Char.IsWhiteSpace):
# U+0009..U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029,
# U+202F, U+205F, U+3000.
WHITESPACE = "".join(
    [
        "\u0009", "\u000a", "\u000b", "\u000c", "\u000d", "\u0020", "\u0085", "\u00a0",
        "\u1680", "\u2000", "\u2001", "\u2002", "\u2003", "\u2004", "\u2005", "\u2006",
        "\u2007", "\u2008", "\u2009", "\u200a", "\u2028", "\u2029", "\u202f", "\u205f",
        "\u3000",
    ]
)

# UTF-8 lead bytes of U+E000..U+FFFF, and the bytes they are moved to in the
# ordinal sort key (both above every lead byte of a supplementary character).
_BMP_HIGH_LEADS = "\u00ee\u00ef"
_BMP_HIGH_MOVED = "\u00f5\u00f6"
_BMP_HIGH_BYTES = (b"\xee", b"\xef")

TEXT_ORDERS = ("utf16", "utf8")


def ends_with_ws(col: Column) -> Column:
    """True if the last character is in WHITESPACE (a few byte compares at the end)."""
    cond = None
    for ch in WHITESPACE:
        c = col.endswith(F.lit(ch))
        cond = c if cond is None else cond | c
    return cond


def ws_trim(col: Column) -> Column:
    """Trim every WHITESPACE code point from both ends (``trim`` alone strips U+0020 only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def ws_ltrim(col: Column) -> Column:
    return F.ltrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for null, empty or white-space-only strings."""
    return F.coalesce(ws_trim(col), F.lit("")) == F.lit("")


def has_bmp_high(col: Column, raw: Column | None = None) -> Column:
    """True if the string holds a character in U+E000..U+FFFF, i.e. its UTF-8 bytes
    hold the lead byte EE or EF (a byte search, no regex)."""
    raw = col.cast("binary") if raw is None else raw
    return F.contains(raw, F.lit(_BMP_HIGH_BYTES[0])) | F.contains(raw, F.lit(_BMP_HIGH_BYTES[1]))


def ordinal_key(col: Column, text_order: str = "utf16") -> Column:
    """Sort key whose byte order is the order of the string in UTF-16 code units.

    Spark compares strings by UTF-8 bytes, i.e. by code point. UTF-16 code-unit
    order differs only in that supplementary characters (surrogate pairs, D800..DFFF)
    sort *before* U+E000..U+FFFF. In UTF-8 those BMP characters start with the lead
    bytes EE/EF and supplementary ones with F0..F4, so moving EE->F5 and EF->F6
    (bytes that never occur in UTF-8) yields UTF-16 order on plain byte comparison.

    The key is a string column compared bytewise (Spark's default collation). For
    rows without such characters it *is* the text (no copy); the rare remapped
    rows hold bytes that are not valid UTF-8 and are only ever compared, never
    shown (see :func:`with_ordinal_key`, which keeps their text aside).
    ``text_order="utf8"`` gives Spark's own code-point order (same result on data
    with no character at or above U+E000).
    """
    if text_order not in TEXT_ORDERS:
        raise ValueError(f"text_order must be one of {TEXT_ORDERS}, got {text_order!r}")
    if text_order == "utf8":
        return col
    raw = col.cast("binary")
    return F.when(has_bmp_high(col, raw), _remapped(raw)).otherwise(col)


def _remapped(raw: Column) -> Column:
    moved = F.translate(F.decode(raw, "ISO-8859-1"), _BMP_HIGH_LEADS, _BMP_HIGH_MOVED)
    return F.encode(moved, "ISO-8859-1").cast("string")


def with_ordinal_key(df, text: str = "text", key: str = "_k", moved: str | None = "_t", text_order: str = "utf16"):
    """Add the sort key of ``text`` as ``key`` (see :func:`ordinal_key`) and, when
    ``moved`` is given, the text itself as ``moved`` for the rare remapped rows
    (null elsewhere), so that ``coalesce(moved, key)`` gives the text back."""
    if text_order not in TEXT_ORDERS:
        raise ValueError(f"text_order must be one of {TEXT_ORDERS}, got {text_order!r}")
    t = F.col(text)
    if text_order == "utf8":
        extra = [F.lit(None).cast("string").alias(moved)] if moved else []
        return df.select("*", t.alias(key), *extra)
    s = df.select("*", has_bmp_high(t).alias("_hi"))
    hi = F.col("_hi")
    extra = [F.when(hi, t).alias(moved)] if moved else []
    k = F.when(hi, _remapped(t.cast("binary"))).otherwise(t)
    return s.select("*", k.alias(key), *extra).drop("_hi")


def text_from_key(key: Column, moved_text: Column) -> Column:
    """Inverse of :func:`ordinal_key` given the text kept aside for remapped rows."""
    return F.coalesce(moved_text, key)


def utf16_compare_key(col: Column) -> Column:
    """Reference key: the UTF-16BE encoding, whose byte order is code-unit order.

    Slower than :func:`ordinal_key` (doubles ASCII width); used in tests as an oracle.
    """
    return F.encode(col, "UTF-16BE")
