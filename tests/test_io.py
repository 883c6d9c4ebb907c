"""Line sources, numbering, sinks and the sort job (FIXTURES.md §4)."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from keyline.functions.encoding import resolve_encoding
from keyline.plans.sort_file import sort_file
from keyline.sources.lines import read_lines, read_numbered_lines
from keyline.sources.sinks import write_lines


def _raw(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _lines(spark, path, encoding="utf-8"):
    return [r.value for r in read_numbered_lines(spark, path, encoding).orderBy("line_no").collect()]


def test_mixed_breaks_and_bom(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.txt")
    _raw(p, b"\xef\xbb\xbf1. a\r\n2. b\r3. c\n\n  \n4. d\n")
    assert _lines(spark, p) == ["1. a", "2. b", "3. c", "", "  ", "4. d"]


def test_no_final_newline_and_empty(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.txt")
    _raw(p, b"1. a\n2. b")
    assert _lines(spark, p) == ["1. a", "2. b"]
    e = os.path.join(tmp_dir, "e", "empty.txt")
    _raw(e, b"")
    assert read_lines(spark, e).count() == 0


def test_latin1_and_invalid_utf8(spark, tmp_dir):
    p = os.path.join(tmp_dir, "l.txt")
    _raw(p, b"1. caf\xe9\n")
    assert _lines(spark, p, "latin1") == ["1. café"]
    q = os.path.join(tmp_dir, "u.txt")
    _raw(q, b"1. a\xffb\n")
    assert _lines(spark, q) == ["1. a�b"]


def test_utf16_misaligned_break_bytes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "w.txt")
    text = "1. x\n\u0a41\u0100\n"
    _raw(p, b"\xff\xfe" + text.encode("utf-16-le"))
    assert _lines(spark, p, "utf16") == ["1. x", "\u0a41\u0100"]


def test_numbering_over_files_of_unequal_size(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    sizes = [500, 4000, 100]
    expected = []
    for i, n in enumerate(sizes):
        lines = [f"{i}-{j}" for j in range(n)]
        expected.extend(lines)
        _raw(os.path.join(folder, f"part-{i:05d}.txt"), ("\n".join(lines) + "\n").encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = read_numbered_lines(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_no = {r.line_no: r.value for r in got}
    assert sorted(by_no) == list(range(1, len(expected) + 1))
    assert [by_no[i + 1] for i in range(len(expected))] == expected


def test_part_number_order_past_five_digits(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "parts")
    _raw(os.path.join(folder, "part-99999-x.txt"), b"first\n")
    _raw(os.path.join(folder, "part-100000-x.txt"), b"second\n")
    assert _lines(spark, folder) == ["first", "second"]


@pytest.mark.parametrize("encoding", ["utf-8", "latin1", "utf16", "utf-16be", "utf32", "ascii"])
def test_write_read_roundtrip(spark, tmp_dir, encoding):
    texts = ["1. plain", "2. café", "3. 中文", "4. \U0001f600 x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").orderBy("i")
    out = os.path.join(tmp_dir, "rt")
    write_lines(df.coalesce(1), out, "value", encoding=encoding)
    got = _lines(spark, out, encoding)
    charset = resolve_encoding(encoding)
    if charset == "ISO-8859-1":
        texts = ["1. plain", "2. café", "3. ??", "4. ? x"]
    elif charset == "US-ASCII":
        texts = ["1. plain", "2. caf?", "3. ??", "4. ? x"]
    assert got == texts


def test_encoding_names():
    assert resolve_encoding("UTF8") == "UTF-8"
    assert resolve_encoding("unicode") == "UTF-16LE"
    with pytest.raises(ValueError):
        resolve_encoding(" ")
    with pytest.raises(ValueError):
        resolve_encoding("ebcdic")


def test_sort_file_report_and_order(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in.txt")
    _raw(src, "3. b\nbad\n+01. b\n\n2. a\n10. é\n7. a\n".encode())
    out = os.path.join(tmp_dir, "out")
    rep = sort_file(spark, src, out)
    assert (rep["rows_in"], rep["rows_rejected"], rep["rows_out"]) == (7, 2, 5)
    assert _lines(spark, out) == ["2. a", "7. a", "1. b", "3. b", "10. é"]
    saved = json.loads(open(glob.glob(out + ".report/part-*")[0]).read())
    assert saved["rows_out"] == 5 and saved["status"] == "ok"


def test_sort_file_strict_and_same_path(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in.txt")
    _raw(src, b"1. a\nabc. x\n")
    with pytest.raises(Exception, match="invalid number part 'abc'"):
        sort_file(spark, src, os.path.join(tmp_dir, "o"), mode="strict", report_path=None)
    with pytest.raises(ValueError):
        sort_file(spark, src, src)


def test_single_file_output(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in.txt")
    _raw(src, "".join(f"{i}. t{i % 7}\n" for i in range(300)).encode())
    out = os.path.join(tmp_dir, "one")
    sort_file(spark, src, out, single_file=True, num_partitions=4, report_path=None)
    parts = glob.glob(os.path.join(out, "part-*"))
    assert len(parts) == 1
    lines = open(parts[0]).read().splitlines()
    keys = [(ln.split(". ", 1)[1], int(ln.split(". ", 1)[0])) for ln in lines]
    assert keys == sorted(keys) and len(lines) == 300


def test_sort_tiebreak_splits_a_hot_record(spark, tmp_dir):
    """A record repeated for most of the input still spreads over range partitions."""
    from keyline.operators.sort import sort_records

    hot = spark.range(0, 20000).select(F.lit(5).cast("bigint").alias("number"), F.lit("same").alias("text"))
    rest = spark.range(0, 2000).select(F.col("id").alias("number"), F.lit("other").alias("text"))
    s = sort_records(hot.unionByName(rest), num_partitions=8)
    sizes = s.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 20000


def test_range_partitions_grow_with_input(spark, tmp_dir, monkeypatch):
    import keyline.operators.sort as S

    p = os.path.join(tmp_dir, "big.txt")
    _raw(p, b"1. x\n" * 20000)
    scan = read_lines(spark, p)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert S.range_partitions(spark, scan) == base
    monkeypatch.setattr(S, "SORT_PARTITION_BYTES", 1000)
    assert S.range_partitions(spark, scan) == 100


@pytest.mark.parametrize("encoding", ["utf-8", "utf16"])
def test_numbering_per_file(spark, tmp_dir, encoding):
    folder = os.path.join(tmp_dir, "per-file-" + encoding)
    codec = "utf-8" if encoding == "utf-8" else "utf-16-le"
    sizes = {"part-00000.txt": 30, "part-00001.txt": 7, "part-00002.txt": 55}
    for name, n in sizes.items():
        _raw(os.path.join(folder, name), "".join(f"{name[5:10]}-{j}\n" for j in range(n)).encode(codec))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        rows = read_numbered_lines(spark, folder, encoding, per_file=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name, n in sizes.items():
        mine = sorted((r.line_no, r.value) for r in rows if r.file_path.endswith(name))
        assert mine == [(j + 1, f"{name[5:10]}-{j}") for j in range(n)]


@pytest.mark.parametrize("driver_reads", [64, 0])
def test_byte_order_marks_name_the_charset(spark, tmp_dir, monkeypatch, driver_reads):
    """Marked files are read right under any declared name, beside unmarked ones."""
    import codecs

    from keyline.sources import lines as L

    monkeypatch.setattr(L, "DRIVER_READS", driver_reads)
    folder = os.path.join(tmp_dir, "marks")
    os.makedirs(folder)
    marks = {"utf-16-le": codecs.BOM_UTF16_LE, "utf-16-be": codecs.BOM_UTF16_BE, "utf-32-le": codecs.BOM_UTF32_LE, "utf-32-be": codecs.BOM_UTF32_BE, "utf-8": codecs.BOM_UTF8}
    want = []
    for i, (name, mark) in enumerate(marks.items()):
        _raw(os.path.join(folder, f"{i}.txt"), mark + f"{i}. é\u4e2d\n{i}0. b".encode(name))
        want += [f"{i}. é\u4e2d", f"{i}0. b"]
    _raw(os.path.join(folder, "plain.txt"), b"7. c\n")
    for declared in ("utf-8", "latin1"):
        assert sorted(r.value for r in L.read_lines(spark, folder, declared).collect()) == sorted([*want, "7. c"])
    one = os.path.join(folder, "0.txt")
    assert [r.value for r in L.read_numbered_lines(spark, one, "utf-32be").orderBy("line_no").collect()] == want[:2]
