"""Plan shapes: one range exchange for the sort, no full-data exchange in the
Arrow audit, pruned scans, broadcast of the split table; plus the entry smoke."""

import os

import pytest

from keyline.operators.audit import audit_lines, split_summaries, split_summaries_arrow
from keyline.plans.sort_file import sort_file, sorted_records, validate_paths
from keyline.sources.lines import number_lines, scan_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def line_file(tmp_dir):
    p = os.path.join(tmp_dir, "lines.txt")
    with open(p, "w") as f:
        f.write("".join(f"{i}. t{i % 13}\n" for i in range(2000)))
    return p


def test_sort_has_one_range_exchange(spark, line_file):
    plan = _plan(sorted_records(spark, line_file))
    assert plan.count("Exchange rangepartitioning") == 1
    assert "hashpartitioning" not in plan
    assert "ReadSchema: struct<value:string>" in plan or "struct<value:string>" in plan


def test_arrow_audit_summaries_do_not_shuffle_lines(spark, line_file):
    scan = scan_lines(spark, line_file)
    arrow_plan = _plan(split_summaries_arrow(scan))
    assert "MapInArrow" in arrow_plan and "Exchange" not in arrow_plan
    window_plan = _plan(split_summaries(scan))
    assert "Exchange hashpartitioning(_f" in window_plan


def test_numbering_broadcasts_the_split_table(spark, line_file):
    plan = _plan(number_lines(scan_lines(spark, line_file)))
    assert "BroadcastHashJoin" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["pos", "number", "text"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_path_validation(spark, line_file):
    with pytest.raises(ValueError):
        validate_paths(" ")
    with pytest.raises(ValueError):
        sort_file(spark, "", "/tmp/x")
    with pytest.raises(ValueError):
        audit_lines(spark, line_file, "")


def test_generate_sort_audit_end_to_end(spark, tmp_dir):
    """The reference's manual check as a test: generator -> sorter -> auditor."""
    from keyline.plans.generate_file import generate_file
    from keyline.plans.sort_file import sort_file

    src, out = os.path.join(tmp_dir, "gen"), os.path.join(tmp_dir, "gen.sorted")
    generate_file(spark, src, 1, reuse_chance=0.2, seed=5)
    report = sort_file(spark, src, out, num_partitions=6, report_path=None)
    verdict = audit_lines(spark, src, out).first()
    assert report["rows_rejected"] == 0 and report["rows_out"] == verdict.original_lines
    assert verdict.status == "ok" and verdict.is_sorted and verdict.found_duplicate
    assert verdict.sorted_lines == verdict.original_lines


def test_audit_stitch_keeps_text_out_of_windows(spark, line_file):
    """No window but over numbers: none of its rows holds a line, key or record."""
    from keyline.operators.audit import _located

    plan = _plan(_located(split_summaries_arrow(scan_lines(spark, line_file))))
    for node in plan.split("\n"):
        if "Window " in node:
            assert not any(c in node for c in ("first#", "last#", "viol#", "_k#", "plast"))


@pytest.mark.parametrize("ask", ["count", "text", "sorted"])
def test_strict_mode_cannot_be_pruned(spark, tmp_dir, ask):
    from keyline.operators.filter import parse_records

    p = os.path.join(tmp_dir, "mixed.txt")
    with open(p, "w") as f:
        f.write("1. a\nabc. x\n2. b\n")
    lines = spark.read.text(p)
    with pytest.raises(Exception, match="invalid number part 'abc'"):
        if ask == "count":
            parse_records(lines, mode="strict").count()
        elif ask == "text":
            parse_records(lines, mode="strict").select("text").collect()
        else:
            sorted_records(spark, p, mode="strict").select("text").collect()


def test_overlapping_paths_are_refused_before_any_delete(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "x", "in")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.txt"), "w") as f:
        f.write("1. a\n")
    os.symlink(folder, os.path.join(tmp_dir, "link"))
    cases = [
        (folder, f"file://{folder}"),
        (folder, f"file:{folder}/"),
        (folder, os.path.join(tmp_dir, "x")),
        (folder, os.path.join(folder, "deep")),
        (os.path.join(tmp_dir, "*", "in"), folder),
        ([os.path.join(folder, "a.txt")], folder),
        (os.path.join(tmp_dir, "link"), folder),
        (os.path.join(folder, "..", "in"), folder),
    ]
    for source, target in cases:
        with pytest.raises(ValueError, match="overlap"):
            sort_file(spark, source, target, report_path=None)
    assert open(os.path.join(folder, "a.txt")).read() == "1. a\n"
    sort_file(spark, folder, os.path.join(tmp_dir, "x", "in2"), report_path=None)


def test_key_sample_fits_a_byte_budget(spark):
    """Long lines over many range partitions lower the sample; short ones leave it."""
    from pyspark.sql import functions as F

    from keyline.operators.sort import SAMPLE_SETTING, bound_key_sample

    before = spark.conf.get(SAMPLE_SETTING, "100")
    try:
        spark.conf.set(SAMPLE_SETTING, "100")
        bound_key_sample(spark, spark.range(10).select(F.lit("short").alias("v")), "v", 8)
        assert int(spark.conf.get(SAMPLE_SETTING)) == 100
        bound_key_sample(spark, spark.range(10).select(F.repeat(F.lit("x"), 60_000).alias("v")), "v", 400)
        samples = int(spark.conf.get(SAMPLE_SETTING))
        assert samples * 3 * 400 * 60_000 <= (1 << 30) / 4 and samples >= 1
    finally:
        spark.conf.set(SAMPLE_SETTING, before)


def test_key_sample_counts_long_lines_behind_short_ones(spark):
    from pyspark.sql import functions as F

    from keyline.operators.sort import SAMPLE_SETTING, bound_key_sample

    before = spark.conf.get(SAMPLE_SETTING, "100")
    try:
        spark.conf.set(SAMPLE_SETTING, "100")
        lines = spark.range(0, 40_000, 1, 1).select(F.when(F.col("id") < 20_000, F.lit("short")).otherwise(F.repeat(F.lit("x"), 4_000)).alias("v"))
        bound_key_sample(spark, lines, "v", 20_000)
        assert 1 <= int(spark.conf.get(SAMPLE_SETTING)) * 3 * 20_000 * 2_000 <= (1 << 30) / 4
    finally:
        spark.conf.set(SAMPLE_SETTING, before)


def test_merge_has_one_exchange_and_takes_no_inputs(spark):
    from keyline.operators.sort import merge_sorted

    a = spark.createDataFrame([(2, "b"), (1, "a")], "number long, text string")
    merged = merge_sorted([a, a])
    assert _plan(merged).count("Exchange rangepartitioning") == 1
    assert [tuple(r) for r in merged.collect()] == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert merge_sorted([], spark=spark).collect() == []


def test_timed_audit(spark, line_file):
    from keyline.operators.audit import timed_audit

    row = timed_audit(spark, line_file, line_file).first()
    assert row["elapsed_seconds"] > 0 and row["original_lines"] == 2000


def test_single_byte_charsets_follow_their_tables(spark):
    from pyspark.sql import functions as F

    from keyline.functions.encoding import TABLE_CHARSETS, decode_bytes, encode_text

    text = "aé€ŠЖ\u0142я\u2014z\u3042"
    for charset in TABLE_CHARSETS:
        row = spark.createDataFrame([(text,)], "t string").select(encode_text(F.col("t"), charset).alias("e"))
        got = row.select("e", decode_bytes(F.col("e"), charset).alias("d")).first()
        assert bytes(got["e"]) == text.encode(charset, "replace") and got["d"] == text.encode(charset, "replace").decode(charset)
