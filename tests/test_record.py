"""Record semantics: parse, format, compare, hash (FIXTURES.md §2, §3)."""

import pytest
from pyspark.sql import functions as F

from keyline.functions.record import (
    canonical_line,
    format_record,
    parse_line,
    record_compare,
    record_greater,
    record_greater_equal,
    record_hash,
    record_less,
    record_less_equal,
    records_equal,
)
from keyline.functions.text import is_blank, ordinal_key, utf16_compare_key

VALID = [
    ("31. plum jam", 31, "plum jam"),
    ("64.   pear", 64, "pear"),
    ("\t9 . fig \u2003", 9, "fig"),
    ("5. ", 5, ""),
    ("1.5. x", 1, "5. x"),
    ("+7.x", 7, "x"),
    ("007. x", 7, "x"),
    ("-0. x", 0, "x"),
    ("9223372036854775807. x", 9223372036854775807, "x"),
    ("-9223372036854775808. x", -9223372036854775808, "x"),
    (" 1\u3000. x\t", 1, "x"),
]

# The beginnings of the messages.
INVALID = [
    (None, "Malformed line: is null or empty"),
    ("", "Malformed line: is null or empty"),
    ("88 plums", "Malformed line: no dot or no text after dot. Value: 88 plums"),
    ("88.", "Malformed line: no dot or no text after dot. Value: 88."),
    ("x8. plums", "Malformed line (invalid number part 'x8'). Full line: x8. plums"),
    (".plums", "Malformed line (invalid number part ''). Full line: .plums"),
    ("  ", "Malformed line: no dot or no text after dot. Value:   "),
]

BAD_NUMBERS = [
    "9223372036854775808. x",
    "1_000. x",
    "1e3. x",
    "1,000. x",
    "- 5. x",
    "\u0663. x",
    "\u00015. x",
]


def _parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.select("value", *parse_line(F.col("value"))).collect()


def test_valid_lines(spark):
    rows = _parse(spark, [v for v, _, _ in VALID])
    for (value, number, text), row in zip(VALID, rows):
        assert (row.number, row.text, row.parse_error) == (number, text, None), value


def test_invalid_lines_exact_messages(spark):
    rows = _parse(spark, [v for v, _ in INVALID])
    for (value, message), row in zip(INVALID, rows):
        assert row.number is None and row.text is None
        assert row.parse_error == message, value


def test_invalid_number_parts(spark):
    rows = _parse(spark, BAD_NUMBERS)
    for value, row in zip(BAD_NUMBERS, rows):
        assert row.parse_error is not None and "invalid number part" in row.parse_error, value


def test_canonical_form(spark):
    df = spark.createDataFrame([("+7.x",), ("007. x",), ("-0. x",), ("bad",)], "value string")
    out = [r.c for r in df.select(canonical_line(F.col("value")).alias("c")).collect()]
    assert out == ["7. x", "7. x", "0. x", None]


def test_format(spark):
    row = spark.range(1).select(format_record(F.lit(-7).cast("bigint"), F.lit("plum. jam")).alias("s")).first()
    assert row.s == "-7. plum. jam"


NUMBERS, TEXTS = (-(2**63), -3, 0, 5, 2**63 - 1), ("", "fig", "figs", "Fig", "\u00e9")


def test_compare_and_operators(spark):
    """Every pair of records, each operator by itself against the order of (text, number)."""
    records = [(n, t) for n in NUMBERS for t in TEXTS]
    pairs = [(*a, *b) for a in records for b in records]
    df = spark.createDataFrame(pairs, "n1 long, t1 string, n2 long, t2 string")
    sides = [F.col(c) for c in ("n1", "t1", "n2", "t2")]
    functions = {"cmp": record_compare, "lt": record_less, "le": record_less_equal, "gt": record_greater, "ge": record_greater_equal, "eq": records_equal}
    for r in df.select("*", *[f(*sides).alias(name) for name, f in functions.items()]).collect():
        a, b = (r.t1, r.n1), (r.t2, r.n2)
        assert r.cmp == (a > b) - (a < b)
        assert (r.lt, r.le, r.gt, r.ge, r.eq) == (a < b, a <= b, a > b, a >= b, a == b)


def test_absent_records_are_not_equal(spark):
    absent = spark.range(1).select(
        records_equal(F.lit(1), F.lit("a"), F.lit(None).cast("long"), F.lit(None).cast("string")).alias("x")
    ).first()
    assert absent.x is False


def test_hash(spark):
    df = spark.createDataFrame([(4, "plum"), (4, "plum"), (4, "plums"), (5, "plum")], "n long, t string")
    h = [r.h for r in df.select(record_hash(F.col("n"), F.col("t")).alias("h")).collect()]
    assert h[0] == h[1] and len(set(h)) == 3


ORDINAL = ["", "Z", "a", "\u00e9", "\ud7ff", "\U00010000", "\U0001f600", "\ue000", "\ufffd"]


def test_ordinal_order_utf16(spark):
    df = spark.createDataFrame([(t,) for t in reversed(ORDINAL)], "t string")
    got = [r.t for r in df.orderBy(ordinal_key(F.col("t"))).collect()]
    assert got == ORDINAL
    plain = [r.t for r in df.orderBy("t").collect()]
    assert plain[-4:] == ["\ue000", "\ufffd", "\U00010000", "\U0001f600"]


# Sample lines of the record format with their required messages and order.
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ordinal_key_matches_utf16be(spark, seed):
    import random

    rng = random.Random(seed)
    pool = ["a", "b", "\u00e9", "\ud7ff", "\ue000", "\uffff", "\ufffd", "\U00010000", "\U0001f600", "\U0010fffd", " "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 5))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    a = [r.i for r in df.orderBy(ordinal_key(F.col("t")), "i").collect()]
    b = [r.i for r in df.orderBy(utf16_compare_key(F.col("t")), "i").collect()]
    assert a == b
    expected = sorted(range(len(texts)), key=lambda i: (texts[i].encode("utf-16-be"), i))
    assert a == expected


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  \t",), (" x ",)], "v string")
    assert [r.b for r in df.select(is_blank(F.col("v")).alias("b")).collect()] == [True, True, True, False]
