"""Encoding names (ENC-1) and encoded byte lengths (STR-7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted encoding names (case-insensitive) and the charset each one
# means. "utf16"/"unicode" is little-endian UTF-16, "utf32" little-endian UTF-32.
ENCODING_ALIASES = {
    "utf8": "UTF-8",
    "utf-8": "UTF-8",
    "ascii": "US-ASCII",
    "us-ascii": "US-ASCII",
    "utf16": "UTF-16LE",
    "utf-16": "UTF-16LE",
    "unicode": "UTF-16LE",
    "utf-16le": "UTF-16LE",
    "utf-16be": "UTF-16BE",
    "utf32": "UTF-32LE",
    "utf-32": "UTF-32LE",
    "utf-32le": "UTF-32LE",
    "utf-32be": "UTF-32BE",
    "latin1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
}

# Other single-byte charsets, each ASCII below 0x80; the upper half comes from Python's codec.
TABLE_CHARSETS = ("windows-1250", "windows-1251", "windows-1252", "iso-8859-2", "iso-8859-5", "iso-8859-15", "koi8-r")
ENCODING_ALIASES |= {name: name for name in TABLE_CHARSETS} | {"cp1252": "windows-1252", "latin9": "iso-8859-15"}

SINGLE_BYTE = ("US-ASCII", "ISO-8859-1", *TABLE_CHARSETS)
_LATIN_HIGH = "".join(map(chr, range(0x80, 0x100)))
WIDE = ("UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE")
CODE_UNIT = {"UTF-16LE": 2, "UTF-16BE": 2, "UTF-32LE": 4, "UTF-32BE": 4}


def resolve_encoding(name: str | None) -> str:
    """Map a user encoding name to a charset; blank or unknown names raise ``ValueError``."""
    if name is None or not str(name).strip():
        raise ValueError("encoding name must not be blank")
    key = str(name).strip().lower()
    if key not in ENCODING_ALIASES:
        raise ValueError(
            f"unsupported encoding {name!r}; use one of {sorted(set(ENCODING_ALIASES))}"
        )
    return ENCODING_ALIASES[key]


def upper_half(charset: str) -> str:
    """The characters of the bytes 0x80 to 0xFF; a byte without one stands for the control
    character of its own number."""
    out = []
    for b in range(0x80, 0x100):
        try:
            out.append(bytes([b]).decode(charset))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def replace_unmappable(col: Column, charset: str) -> Column:
    """Replace characters the charset cannot hold with ``?`` (one per code point)."""
    if charset == "US-ASCII":
        return F.regexp_replace(col, "[^\\x{00}-\\x{7F}]", "?")
    if charset == "ISO-8859-1":
        return F.regexp_replace(col, "[^\\x{00}-\\x{FF}]", "?")
    if charset in TABLE_CHARSETS:
        high = "".join(f"\\x{{{ord(c):X}}}" for c in upper_half(charset))
        return F.regexp_replace(col, f"[^\\x{{00}}-\\x{{7F}}{high}]", "?")
    return col


def encode_text(col: Column, charset: str) -> Column:
    """Encoded bytes of ``col`` in ``charset`` (unmappable characters become ``?``)."""
    if charset == "UTF-8":
        return col.cast("binary")
    if charset == "UTF-32LE":
        return _utf32le(col)
    if charset == "UTF-32BE":
        return F.encode(col, "UTF-32")
    if charset in TABLE_CHARSETS:
        moved = F.translate(replace_unmappable(col, charset), upper_half(charset), _LATIN_HIGH)
        return F.encode(moved, "ISO-8859-1")
    return F.encode(replace_unmappable(col, charset), charset)


def swap_code_units(raw: Column, width: int) -> Column:
    """Reverse the byte order inside every ``width``-byte code unit of a binary."""
    if width == 2:
        pattern, repl = "(..)(..)", "$2$1"
    elif width == 4:
        pattern, repl = "(..)(..)(..)(..)", "$4$3$2$1"
    else:
        raise ValueError("width must be 2 or 4")
    return F.unhex(F.regexp_replace(F.hex(raw), pattern, repl))


def _utf32le(col: Column) -> Column:
    # Spark's UTF-32 codec is big-endian only; swap each 4-byte unit.
    return swap_code_units(F.encode(col, "UTF-32"), 4)


def decode_bytes(raw: Column, charset: str) -> Column:
    """Decode encoded bytes; US-ASCII maps bytes above 0x7F to ``?``."""
    if charset == "UTF-8":
        return F.make_valid_utf8(raw.cast("string"))
    if charset == "US-ASCII":
        return F.regexp_replace(F.decode(raw, "ISO-8859-1"), "[^\\x{00}-\\x{7F}]", "?")
    if charset in TABLE_CHARSETS:
        return F.translate(F.decode(raw, "ISO-8859-1"), _LATIN_HIGH, upper_half(charset))
    if charset == "UTF-32LE":
        return F.decode(swap_code_units(raw, 4), "UTF-32")
    if charset == "UTF-32BE":
        return F.decode(raw, "UTF-32")
    return F.decode(raw, charset)


def byte_length(col: Column, charset: str = "UTF-8") -> Column:
    """STR-7: number of bytes of ``col`` encoded in ``charset`` (no BOM)."""
    if charset == "UTF-8":
        return F.octet_length(col)
    if charset in SINGLE_BYTE:
        return F.char_length(col)
    if charset in ("UTF-32LE", "UTF-32BE"):
        return F.char_length(col) * F.lit(4)
    return F.octet_length(F.encode(col, charset))
