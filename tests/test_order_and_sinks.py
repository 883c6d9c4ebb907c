"""Typed keys, neighbours, shards over several tasks, audits in waves, blank counts, staged output."""

import datetime
import os
import pickle
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keyline.functions.typed import Field, TypedFormat, composite_key
from keyline.operators.audit import audit_lines
from keyline.operators.neighbours import with_previous
from keyline.operators.sort import SAMPLE_SETTING, sort_records, sort_shards
from keyline.plans.sort_file import parsed_scan, sort_file
from keyline.sources import lines as L
from keyline.sources.sinks import write_lines
from keyline.sources.wide import _Reader

FIELDS = (Field("day", "date", descending=True), Field("text", "text"), Field("n", "long"), Field("tail", "text", descending=True))


def _model_key(row):
    day, text, n, tail = row
    units = lambda t: t.encode("utf-16-be")
    return (-day.toordinal(), units(text), n, [255 - b for b in units(tail)] + [256])


def test_composite_key_orders_like_the_fields(spark):
    r = random.Random(3)
    texts = ["", "a", "ab", "a\x00", "a\x00b", "a\x01", "\x01", "\x00", "b", "\U0001f600", "￡", "é", "ab\x02"]
    rows = [(datetime.date(1969 + r.randrange(4), 1, 1), r.choice(texts), r.choice([-(2**63), -1, 0, 1, 2**63 - 1, r.randrange(99)]), r.choice(texts)) for _ in range(400)]
    df = spark.createDataFrame(rows, "day date, text string, n long, tail string")
    got = df.select("*", composite_key([(f, F.col(f.name)) for f in FIELDS]).alias("key")).collect()
    by_key = sorted(got, key=lambda x: bytes(x.key))
    assert [tuple(x)[:4] for x in by_key] == sorted(rows, key=_model_key)
    keys = {}
    for x in got:
        assert keys.setdefault(bytes(x.key), tuple(x)[:4]) == tuple(x)[:4]


def test_typed_files_sort_and_audit(spark, tmp_dir):
    fmt = TypedFormat((Field("day", "date", True), Field("name", "text"), Field("n", "long")), separator=";")
    lines = ["2024-01-05; b ;3", "2024-01-05;a;10", "2024-01-05;a;-9", "2025-02-01;z;0", "2023-13-01;x;1", "2024-01-05;a", "", "2024-01-05;a;ten", "2024-01-05;a;10"]
    src, out = os.path.join(tmp_dir, "in.txt"), os.path.join(tmp_dir, "out")
    with open(src, "w") as f:
        f.write("\n".join(lines) + "\n")
    report = sort_file(spark, src, out, line_format=fmt)
    assert (report["rows_in"], report["rows_rejected"]) == (9, 4)
    want = ["2025-02-01;z;0", "2024-01-05;a;-9", "2024-01-05;a;10", "2024-01-05;a;10", "2024-01-05;b;3"]
    assert [r.value for r in L.read_numbered_lines(spark, out).orderBy("line_no").collect()] == want
    for method in ("arrow", "window"):
        row = audit_lines(spark, out, out, line_format=fmt, method=method).first()
        assert row.status == "ok" and row.found_duplicate
        bad = audit_lines(spark, src, src, line_format=fmt, method=method).first()
        assert (bad.violation_line, bad.previous_line, bad.current_line) == (2, "2024-01-05;b;3", "2024-01-05;a;10")
    with pytest.raises(PySparkException, match="invalid day '2023-13-01'|not 3 fields|null or empty|invalid n 'ten'"):
        parsed_scan(spark, src, mode="strict", line_format=fmt).count()
    with pytest.raises(ValueError):
        Field("x", "float")


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_previous_record_is_that_of_the_order(spark, parts):
    rows = [(i * 37 % 101, f"t{i % 5}" if i % 7 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "n int, t string").repartitionByRange(parts, "n", "t").sortWithinPartitions("n", "t")
    got = with_previous(df, ["n", "t"]).orderBy("pos").collect()
    want = sorted(rows, key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    assert [r.pos for r in got] == list(range(1, 301)) and [(r.n, r.t) for r in got] == want
    assert [(r.prev_n, r.prev_t) for r in got] == [(None, None), *want[:-1]]


def test_previous_record_of_empty_partitions_and_frames(spark):
    rows = spark.createDataFrame([(5,), (5,), (9,)], "n int").repartitionByRange(30, "n").sortWithinPartitions("n")
    assert [(r.pos, r.n, r.prev_n) for r in with_previous(rows, ["n"]).orderBy("pos").collect()] == [(1, 5, None), (2, 5, 5), (3, 9, 5)]
    assert with_previous(rows.filter("n < 0"), ["n"]).collect() == []


def test_neighbours_shuffle_no_records(spark):
    df = sort_records(spark.range(5000).select(F.col("id").alias("number"), F.lit("x").alias("text")))
    plan = with_previous(df, ["text"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


def test_hot_shard_spans_tasks_with_dense_ranks(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 9).alias("shard"), F.col("id").alias("number"), F.concat(F.lit("t"), F.col("id") % 50).alias("text")
    )
    out = sort_shards(rows, ["shard"], num_partitions=16)
    placed = out.select("shard", "rank", "text", "number", F.spark_partition_id().alias("p")).collect()
    hot = [r for r in placed if r.shard is None]
    assert len({r.p for r in hot}) >= 4
    for shard in {r.shard for r in placed}:
        own = sorted((r for r in placed if r.shard == shard), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(own) + 1))
        assert [(r.text, r.number) for r in own] == sorted((r.text, r.number) for r in own)


def _files(folder, contents):
    os.makedirs(folder)
    for i, lines in enumerate(contents):
        with open(os.path.join(folder, f"part-{i:05d}.txt"), "w") as f:
            f.write("".join(x + "\n" for x in lines))


@pytest.mark.parametrize("broken", [None, 0, 1, 5, 19])
def test_audit_in_waves_gives_the_same_row(spark, tmp_dir, broken):
    contents = [[f"{k}. t{i:02d}{k}" for k in range(5)] + [""] for i in range(20)]
    if broken is not None:
        contents[broken][3] = "7. a"
    folder = os.path.join(tmp_dir, "f")
    _files(folder, contents)
    whole = audit_lines(spark, folder, folder, blank_lines=True).first()
    waves = audit_lines(spark, folder, folder, blank_lines=True, first_wave=1).first()
    assert tuple(waves)[:-2] == tuple(whole) and waves.files_total == 20
    assert waves.files_read == {None: 20, 0: 1, 1: 3, 5: 7, 19: 20}[broken]
    assert whole.blank_lines == (20 if broken is None else broken)


def test_blank_lines_before_a_violation_at_a_file_s_begin(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "f")
    _files(folder, [["", "1. b", " "], ["", "\t", "1. a", ""]])
    for method in ("arrow", "window"):
        row = audit_lines(spark, folder, folder, method=method, blank_lines=True).first()
        assert (row.violation_line, row.blank_lines, row.previous_line) == (6, 4, "1. b")


def test_failed_job_leaves_the_old_output(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    write_lines(spark.createDataFrame([("kept",)], "value string"), out)
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.lit("new")).alias("value"))
    with pytest.raises(Exception):
        write_lines(bad, out)
    assert [r.value for r in L.read_lines(spark, out).collect()] == ["kept"]
    assert sorted(os.listdir(tmp_dir)) == ["out"]
    write_lines(spark.createDataFrame([("new",)], "value string"), out)
    assert [r.value for r in L.read_lines(spark, out).collect()] == ["new"] and sorted(os.listdir(tmp_dir)) == ["out"]


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_single_file_is_the_parts_in_order(spark, tmp_dir, compression):
    df = sort_records(spark.range(3000).select((F.col("id") * 7919 % 3000).alias("number"), F.lit("t").alias("text")), num_partitions=13)
    df = df.select(F.concat("number", F.lit(". "), "text").alias("value"))
    out = os.path.join(tmp_dir, "out")
    write_lines(df, out, single_file=True, compression=compression)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1 and parts[0].endswith(".txt.gz" if compression else ".txt")
    assert [r.value for r in L.read_numbered_lines(spark, out).orderBy("line_no").collect()] == [f"{i}. t" for i in range(3000)]


def test_key_sample_is_bounded_by_windows_and_restored(spark, tmp_dir):
    """Short lines first, long lines behind: every split counts by its own mean."""
    path = os.path.join(tmp_dir, "in.txt")
    with open(path, "w") as f:
        f.write("1. a\n" * 100_000 + ("2. " + "b" * 2000 + "\n") * 250)
    mean = L.mean_key_bytes(spark, [("UTF-8", [path])])
    assert 800 < mean < 1200  # half of the bytes are in long lines
    assert L.mean_key_bytes(spark, [("UTF-8", [os.path.join(tmp_dir, "none*")])]) is None
    before = spark.conf.get(SAMPLE_SETTING, "100")
    sort_file(spark, path, os.path.join(tmp_dir, "out"), num_partitions=20_000 // 100, report_path=None)
    assert spark.conf.get(SAMPLE_SETTING, "100") == before


def test_a_sort_lists_its_input_once(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "in.txt")
    with open(path, "w") as f:
        f.write("2. b\n1. a\n")
    calls, real = [], L.paths_by_charset
    counted = lambda *a: calls.append(a) or real(*a)
    monkeypatch.setattr(L, "paths_by_charset", counted)
    monkeypatch.setattr("keyline.plans.sort_file.paths_by_charset", counted)
    sort_file(spark, path, os.path.join(tmp_dir, "out"), report_path=None)
    assert len(calls) == 1


def test_wide_tasks_get_no_listing():
    options = {"charset": "UTF-16LE", "files": '[["/a", 100], ["/b", 100]]', "split_bytes": "64", "columns": "value"}
    reader = _Reader(options)
    assert len(reader.partitions()) > 1 and b"/a" not in pickle.dumps(reader)
