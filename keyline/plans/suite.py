"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads whole tables (part, orders, lineitem, documents), turns them
into keyed lines (corpora C1-C5) and runs one of the library's operators; the
oracle computes the same result in SQL. File operators write the corpus to a
fresh folder under the checkpoint folder first and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyline.functions.encoding import byte_length, upper_half
from keyline.functions.record import (
    LineFormat,
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
from keyline.functions.typed import Field, TypedFormat
from keyline.operators.audit import NO_PREVIOUS, audit_lines
from keyline.operators.filter import parse_records, reject_reason, rejected_lines
from keyline.operators.neighbours import with_previous
from keyline.operators.sort import merge_sorted, sort_records, sort_shards, sort_within_shards, with_positions
from keyline.plans import corpora as C
from keyline.plans.sort_file import parsed_scan, sort_file
from keyline.session import scratch_path
from keyline.sources import generator as G
from keyline.sources.generator import SIZE_UNIT, generate_lines, line_size
from keyline.sources.lines import read_numbered_lines, scan_lines
from keyline.sources.sinks import REPORT_SCHEMA, write_lines

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_COLUMNS = [
    "original_lines",
    "sorted_lines",
    "is_sorted",
    "violation_line",
    "previous_line",
    "current_line",
    "found_duplicate",
    "line_counts_match",
    "status",
    "passed",
]


def _records(df: DataFrame, keep=("line_id",)) -> DataFrame:
    return parse_records(df, keep=list(keep))


def _write_file(spark: SparkSession, df: DataFrame, name: str, order: list[str] | None = None, encoding="utf-8") -> str:
    path = scratch_path(spark, name)
    out = df.orderBy(*order) if order else df
    write_lines(out, path, "value", encoding=encoding)
    return path


# ---------------------------------------------------------------- parse / filter


def parse_lines(spark, sf):
    """PRJ-1, NUM-1, STR-1..4 over C5."""
    return C.c5_mixed(spark, sf).select("line_id", "value", *parse_line(F.col("value")))


def _reject_sources(spark, sf):
    c5 = C.c5_mixed(spark, sf).select(F.lit("orders").alias("source"), F.col("line_id").alias("id"), F.lit(0).alias("idx"), "value")
    c4 = C.c4_raw_documents(spark, sf).select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "idx", "value")
    return c5.unionByName(c4)


def parse_rejects(spark, sf):
    """FLT-3 over C5 and C4: the quarantine with exact reasons."""
    return rejected_lines(_reject_sources(spark, sf), keep=["source", "id", "idx"])


def reject_counts(spark, sf):
    """FLT-3 + count per reason class over C5 and C4."""
    p = _reject_sources(spark, sf).select(*parse_line(F.col("value")))
    reason = F.coalesce(reject_reason(F.col("parse_error")), F.lit("ok"))
    return p.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def drop_malformed(spark, sf):
    """FLT-1 over C5."""
    return _records(C.c5_mixed(spark, sf))


def strict_parse(spark, sf):
    """FLT-2 over C2 (all lines valid, so the job completes)."""
    return parse_records(C.c2_orders(spark, sf), mode="strict", keep=["line_id"])


def strict_failure(spark, sf):
    """FLT-2: C2 and one malformed line (the first of C5) read strictly; the message that
    fails a count, which needs no column of the records."""
    bad = rejected_lines(C.c5_mixed(spark, sf), keep=["line_id"]).orderBy("line_id").limit(1).select("value")
    lines = C.c2_orders(spark, sf).select("value").unionByName(bad)
    try:
        parse_records(lines, mode="strict").count()
        message = None
    except PySparkException as e:
        message = (e.getMessageParameters() or {}).get("errorMessage")
    return spark.createDataFrame([(message,)], "message string")


def format_lines(spark, sf):
    """PRJ-2 over C1 records."""
    r = _records(C.c1_part(spark, sf))
    return r.select("line_id", format_record(F.col("number"), F.col("text")).alias("line"))


def canonical_lines(spark, sf):
    """PRJ-3 over C5 (null for malformed lines)."""
    return C.c5_mixed(spark, sf).select("line_id", canonical_line(F.col("value")).alias("canonical"))


# ---------------------------------------------------------------- order


def sort_lines(spark, sf):
    """SRT-1 + SRT-4 over C1."""
    return with_positions(sort_records(_records(C.c1_part(spark, sf))))


def sort_documents(spark, sf):
    """SRT-1 + SRT-4 over C3 (non-ASCII, long lines)."""
    return with_positions(sort_records(_records(C.c3_documents(spark, sf), keep=())))


def sorted_shards(spark, sf):
    """SRT-2 over C1 dealt by key modulo 16: each partition sorted on its own; ``rank`` is
    a record's physical place among its shard's, which only sorted runs get right."""
    r = _records(C.c1_part(spark, sf)).withColumn("shard", F.col("line_id") % 16)
    runs = sort_within_shards(r.repartition("shard"), keep=["shard"]).withColumn("_at", F.monotonically_increasing_id())
    rank = F.row_number().over(Window.partitionBy("shard").orderBy("_at")).cast("bigint")
    return runs.select("shard", rank.alias("rank"), "number", "text")


def _skewed_shards(spark, sf):
    k = F.col("line_id")
    shard = F.when(k % 2 == 0, 0).otherwise(F.floor(k / 500) + 1).cast("bigint")
    return _records(C.c1_part(spark, sf)).withColumn("shard", shard)


def sorted_skewed_shards(spark, sf):
    """SRT-2 over C1: even keys are one shard, half of all records; the odd ones are a
    shard for every 500 keys, so shards grow with the table."""
    return sort_shards(_skewed_shards(spark, sf), ["shard"])


def merge_sorted_inputs(spark, sf):
    """SRT-3 over C1 and C2: one range exchange merges both."""
    return with_positions(merge_sorted([_records(C.c1_part(spark, sf)), _records(C.c2_orders(spark, sf))]))


def _high_lines(spark, sf):
    k = F.col("p_partkey")
    head = F.when(k % 3 == 0, F.lit("\U0001f600")).when(k % 3 == 1, F.lit("\uff21")).otherwise(F.lit("z"))
    return C.table(spark, sf, "part").select(k.alias("line_id"), F.concat(k.cast("string"), F.lit(". "), head, F.col("p_name")).alias("value"))


def sort_high_characters(spark, sf):
    """STR-6 over C1 texts headed by z, U+1F600 or U+FF21: by UTF-16 units they sort in
    that order, by code points the last two would change places."""
    return with_positions(sort_records(_records(_high_lines(spark, sf)), tiebreak=None))


PIPE = LineFormat(separator="|", joiner="|", number_first=True)


def _pipe_files(spark, sf):
    p = C.table(spark, sf, "part")
    lines = p.select(F.concat(F.col("p_partkey").cast("string"), F.lit(" | "), F.col("p_name")).alias("value"))
    src = _write_file(spark, lines, "pipe")
    out = scratch_path(spark, "pipe-sorted")
    sort_file(spark, src, out, report_path=None, line_format=PIPE)
    return src, out


def sort_pipe_format(spark, sf):
    """UDF-1: a file of ``number | text`` lines sorted by number, then text."""
    return read_numbered_lines(spark, _pipe_files(spark, sf)[1])


def audit_pipe_format(spark, sf):
    """UDF-1: the audit of that file in its own format and order."""
    return audit_lines(spark, *_pipe_files(spark, sf), line_format=PIPE)


# UDF-1, CMP-2: order date (newest first), priority, key.
ORDER_FORMAT = TypedFormat((Field("day", "date", descending=True), Field("priority", "text"), Field("order", "long")), separator="|")


def _typed_files(spark, sf):
    o = C.table(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 3 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    day = F.col("o_orderdate").cast("date").cast("string")
    line = F.concat_ws("| ", day, "o_orderpriority", key.cast("string"))
    bad = F.when(F.col("o_orderkey") % 50 == 1, F.concat(F.lit("soon"), line)).when(F.col("o_orderkey") % 50 == 2, day)
    src = _write_file(spark, o.select(F.coalesce(bad, line).alias("value")), "typed")
    out = scratch_path(spark, "typed-sorted")
    sort_file(spark, src, out, report_path=None, line_format=ORDER_FORMAT)
    return src, out


def sort_typed_format(spark, sf):
    """UDF-1, CMP-2: lines of three typed fields, one of them descending, sorted as a file."""
    return read_numbered_lines(spark, _typed_files(spark, sf)[1])


def audit_typed_format(spark, sf):
    """UDF-1: the audit of that file in its own format; malformed lines make the counts differ."""
    return audit_lines(spark, *_typed_files(spark, sf), line_format=ORDER_FORMAT, require_duplicates=False)


def typed_rejects(spark, sf):
    """UDF-1, FLT-3: the lines that are not of the typed format, with their reasons."""
    rows = ORDER_FORMAT.parse_frame(scan_lines(spark, _typed_files(spark, sf)[0], with_split=False))
    return rows.where("parse_error is not null").select("value", "parse_error")


def strict_reread(spark, sf):
    """SRC-2: a sorted file is read strictly, every line a record; the C5 file it came from
    is not, and the read fails on a malformed line."""
    src = _write_file(spark, C.c5_mixed(spark, sf), "c5")
    out = scratch_path(spark, "c5-sorted")
    sort_file(spark, src, out, report_path=None)
    try:
        parsed_scan(spark, src, mode="strict").count()
        refused = False
    except PySparkException as e:
        refused = "Malformed line" in ((e.getMessageParameters() or {}).get("errorMessage") or "")
    records = parsed_scan(spark, out, mode="strict").select("number", "text")
    return records.select("*", F.lit(refused).alias("source_refused"))


def refused_arguments(spark, sf):
    """VAL-1: jobs that must be refused before any work, on a written file; nulls and empty
    paths, an output over its input, sizes and chances out of range."""
    src = _write_file(spark, C.c1_part(spark, sf), "c1")
    n = C.table(spark, sf, "part").count()
    cases = {
        "blank input": lambda: sort_file(spark, " ", f"{src}-x"),
        "no output": lambda: sort_file(spark, src, None),
        "output is input": lambda: sort_file(spark, src, src),
        "output in input": lambda: sort_file(spark, src, f"{src}/inside"),
        "size 0": lambda: G.validate(n - n, 0.01),
        "chance over 1": lambda: G.validate(n, 1.5),
        "negative chance": lambda: G.validate(n, -0.1),
        "blank audit": lambda: audit_lines(spark, src, ""),
    }
    rows = []
    for name, job in cases.items():
        try:
            job()
            rows.append((name, False))
        except ValueError:
            rows.append((name, True))
    kept = read_numbered_lines(spark, src).count()  # the input is as it was
    return spark.createDataFrame([(*r, kept) for r in rows], "job string, refused boolean, input_lines long")


def least_greatest(spark, sf):
    """NUM-6: the lesser and the greater of discount and tax per lineitem row, null only
    where both are (a rate of 0 is taken for none)."""
    rates = [F.nullif(F.col(c), F.lit(0)) for c in ("l_discount", "l_tax")]
    return C.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.least(*rates).alias("least"), F.greatest(*rates).alias("greatest"))


def sort_lines_file(spark, sf):
    """SRC-1, SRT-1, SNK-1, PRJ-4: sort the C5 file, read the output back numbered."""
    src = _write_file(spark, C.c5_mixed(spark, sf), "c5")
    out = scratch_path(spark, "c5-sorted")
    sort_file(spark, src, out, report_path=None)
    return read_numbered_lines(spark, out)


def number_lines(spark, sf):
    """SRC-1 + PRJ-4: C2 written in key order over several part files, numbered back."""
    path = _write_file(spark, C.c2_orders(spark, sf), "c2", order=["line_id"])
    return read_numbered_lines(spark, path)


def compare_pairs(spark, sf):
    """CMP-1..3 on neighbouring C1 records (key k against k + 1), by an equi-join."""
    r = _records(C.c1_part(spark, sf))
    a = r.select(F.col("line_id").alias("a_id"), F.col("number").alias("an"), F.col("text").alias("at"))
    b = r.select(F.col("line_id").alias("b_id"), F.col("number").alias("bn"), F.col("text").alias("bt"))
    j = a.join(b, F.col("b_id") == F.col("a_id") + 1)
    return j.select(
        "a_id",
        "b_id",
        record_compare(F.col("an"), F.col("at"), F.col("bn"), F.col("bt")).alias("cmp"),
        records_equal(F.col("an"), F.col("at"), F.col("bn"), F.col("bt")).alias("eq"),
        *[
            compare(F.col("an"), F.col("at"), F.col("bn"), F.col("bt")).alias(name)
            for name, compare in (("lt", record_less), ("le", record_less_equal), ("gt", record_greater), ("ge", record_greater_equal))
        ],
    )


def equal_record_groups(spark, sf):
    """CMP-4: records of lineitem lines ``l_partkey. l_returnflag`` grouped by hash and value."""
    li = C.table(spark, sf, "lineitem")
    lines = li.select(F.concat(F.col("l_partkey").cast("string"), F.lit(". "), F.col("l_returnflag")).alias("value"))
    r = parse_records(lines)
    g = r.groupBy(record_hash(F.col("number"), F.col("text")).alias("h"), "number", "text")
    return g.agg(F.count(F.lit(1)).alias("n")).drop("h")


def adjacent_duplicates(spark, sf):
    """WIN-2 over sorted C1: records whose text equals the previous record's text.

    One range exchange; records are not joined, only the last record of each partition is.
    """
    s = with_previous(sort_records(_records(C.c1_part(spark, sf))), ["text"])
    return s.where(F.col("text") == F.col("prev_text")).select("pos", "number", "text")


def neighbouring_orders(spark, sf):
    """WIN-2 over another frame: each order of a customer (by date and key) beside the
    order before it in the whole order; days between where the customer is the same."""
    o = C.table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    keys = ["o_custkey", "day", "o_orderkey"]
    ordered = o.repartitionByRange(*keys).sortWithinPartitions(*keys)
    s = with_previous(ordered, ["o_custkey", "day"])
    gap = F.when(F.col("o_custkey") == F.col("prev_o_custkey"), F.datediff("day", "prev_day"))
    return s.select("pos", "o_orderkey", F.col("prev_o_custkey").alias("previous_customer"), gap.alias("days_since"))


# ---------------------------------------------------------------- audit


def audit_ok(spark, sf):
    """AUD-1..4 on C1 sorted by the library (status ok)."""
    src = _write_file(spark, C.c1_part(spark, sf), "c1")
    out = scratch_path(spark, "c1-sorted")
    sort_file(spark, src, out, report_path=None)
    return audit_lines(spark, src, out)


def audit_violation(spark, sf):
    """WIN-1, SRT-5, AGG-2 on C1 in key order (not text order)."""
    path = _write_file(spark, C.c1_part(spark, sf), "c1-keyorder", order=["line_id"])
    return audit_lines(spark, path, path)


def audit_malformed(spark, sf):
    """AUD-2 on C5 in key order: the first malformed line is the violation."""
    path = _write_file(spark, C.c5_mixed(spark, sf), "c5-keyorder", order=["line_id"])
    return audit_lines(spark, path, path)


def audit_count_mismatch(spark, sf):
    """AUD-3/4, AGG-1: sorted C5 (malformed lines dropped) against raw C5."""
    src = _write_file(spark, C.c5_mixed(spark, sf), "c5")
    out = scratch_path(spark, "c5-sorted")
    sort_file(spark, src, out, report_path=None)
    return audit_lines(spark, src, out)


def _distinct_texts(spark, sf):
    p = C.table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k"))
    return p.select(F.concat(F.col("k").cast("string"), F.lit(". "), F.col("p_name")).alias("value"))


def audit_no_duplicates(spark, sf):
    """AUD-3, AGG-3: one line per distinct C1 text, sorted: no adjacent duplicate."""
    src = _write_file(spark, _distinct_texts(spark, sf), "c1-distinct")
    out = scratch_path(spark, "c1-distinct-sorted")
    sort_file(spark, src, out, report_path=None)
    return audit_lines(spark, src, out)


def _with_blanks(spark, sf):
    r = _records(C.c1_part(spark, sf))
    recs = r.select("text", "number", F.lit(0).alias("flag"), format_record(F.col("number"), F.col("text")).alias("value"))
    k = F.col("number")
    blank = F.when(k % 20 == 0, F.lit("  ")).when(k % 30 == 0, F.lit("\u3000 ")).otherwise(F.lit(""))
    blanks = r.where(k % 10 == 0).select("text", "number", F.lit(1).alias("flag"), blank.alias("value"))
    return recs.unionByName(blanks)


def audit_blank_lines(spark, sf):
    """FLT-4, STR-5: sorted C1 with blank and white-space lines inserted (counted, skipped)."""
    path = _write_file(spark, _with_blanks(spark, sf), "c1-blanks", order=["text", "number", "flag"])
    return audit_lines(spark, path, path, blank_lines=True)


def audit_blank_violation(spark, sf):
    """FLT-4: the same lines in key order: blank lines are counted up to the violation."""
    path = _write_file(spark, _with_blanks(spark, sf), "c1-blanks-key", order=["number", "flag"])
    return audit_lines(spark, path, path, blank_lines=True)


def audit_broken_early(spark, sf):
    """SRT-5: sorted C1 in 16 files behind one line that sorts last, read in waves of 2, 4,
    ... files: the first wave holds the violation, and most files are not read."""
    folder = scratch_path(spark, "c1-broken")
    first = C.c1_part(spark, sf).limit(1).select(F.lit("0. ~~~~ last of all").alias("value"))
    write_lines(first, f"{folder}/a")
    records = sort_records(_records(C.c1_part(spark, sf)), num_partitions=16)
    write_lines(records, f"{folder}/b", format_record(F.col("number"), F.col("text")))
    row = audit_lines(spark, f"{folder}/*", [f"{folder}/a", f"{folder}/b"], first_wave=2)
    stopped = (F.col("files_read") < F.col("files_total")).alias("stopped_early")
    return row.select(*AUDIT_COLUMNS, "files_read", stopped)


# ---------------------------------------------------------------- encodings


def line_bytes(spark, sf):
    """STR-7 over C3: encoded lengths in UTF-8 and UTF-16."""
    c3 = C.c3_documents(spark, sf)
    return c3.select(
        "doc_id",
        "idx",
        byte_length(F.col("value"), "UTF-8").alias("n_bytes"),
        byte_length(F.col("value"), "UTF-16LE").alias("n_utf16_bytes"),
        F.char_length("value").alias("n_chars"),
    )


def encoding_roundtrip_latin1(spark, sf):
    """SRC-1b + SNK-1: C3 written as ISO-8859-1 (unmappable characters become ``?``) and read back."""
    path = _write_file(spark, C.c3_documents(spark, sf), "c3-latin1", order=["doc_id", "idx"], encoding="latin1")
    return read_numbered_lines(spark, path, encoding="latin1")


def encoding_roundtrip_utf16(spark, sf):
    """SRC-1b + SNK-1: C3 written as UTF-16LE and read back exactly."""
    path = _write_file(spark, C.c3_documents(spark, sf), "c3-utf16", order=["doc_id", "idx"], encoding="utf16")
    return read_numbered_lines(spark, path, encoding="utf16")


# ---------------------------------------------------------------- report, generator


def run_report(spark, sf):
    """SNK-3 + AGG-4: counts of the sort of the C5 file, from the report it wrote."""
    src = _write_file(spark, C.c5_mixed(spark, sf), "c5")
    report = scratch_path(spark, "c5-report")
    sort_file(spark, src, scratch_path(spark, "c5-sorted"), report_path=report)
    return spark.read.schema(REPORT_SCHEMA).json(report).select("status", "rows_in", "rows_rejected", "rows_out")


def _roundtrip(spark, sf, encoding):
    path = _write_file(spark, C.c3_documents(spark, sf), f"c3-{encoding}", order=["doc_id", "idx"], encoding=encoding)
    return read_numbered_lines(spark, path, encoding=encoding)


def encoding_roundtrip_utf32(spark, sf):
    """SRC-1b + SNK-1: C3 written as UTF-32LE and read back exactly."""
    return _roundtrip(spark, sf, "utf32")


def encoding_roundtrip_ascii(spark, sf):
    """SRC-1b + SNK-1: C3 written as ASCII (others become ``?``) and read back."""
    return _roundtrip(spark, sf, "ascii")


def encoding_roundtrip_windows1252(spark, sf):
    """ENC-1: C3 written as windows-1252 (others become ``?``) and read back."""
    return _roundtrip(spark, sf, "windows-1252")


def _doc_chars(spark, sf) -> int:
    return C.table(spark, sf, "documents").agg(F.sum(F.char_length("text"))).first()[0]


def generate_lines_q(spark, sf):
    """SRC-3: as many generated characters as the documents table holds."""
    return generate_lines(spark, target_chars=_doc_chars(spark, sf), seed=42).select("id", "number", "text")


def generate_size_check(spark, sf):
    """WIN-3: the generated output reaches the target, and would not without its last line."""
    target = _doc_chars(spark, sf)
    g = generate_lines(spark, target_chars=target, seed=42)
    size = line_size(F.col("number"), F.char_length("text"))
    s = g.agg(F.sum(size).alias("total"), F.max_by(size, "id").alias("last"))
    return s.select(
        F.lit(target).cast("bigint").alias("target_chars"),
        (F.col("total") >= F.lit(target)).alias("reached"),
        (F.col("total") - F.col("last") < F.lit(target)).alias("minimal"),
    )


def generate_totals(spark, sf):
    """GEN-2/3, NUM-3..6, STR-10/12: totals of the generated lines, reuse and signs among them."""
    n_rows, pool = G.find_cut(spark, _doc_chars(spark, sf), 42, 0.01)
    rows = G.with_source(G.generated_lines(spark, n_rows, 42, 0.01, pool), 42, 0.01, pool)
    text = F.char_length("text")
    return rows.agg(
        F.count("*").alias("n_lines"),
        F.sum(line_size(F.col("number"), text)).cast("bigint").alias("n_chars"),
        F.max("id").alias("last_id"),
        F.count_if(F.col("number") < 0).alias("n_negative"),
        F.count_if(F.col("src") != F.col("id")).alias("n_reused"),
        F.min(text).alias("shortest"),
        F.max(text).alias("longest"),
    )


QUERIES: dict[str, Query] = {
    "parse_lines": parse_lines,
    "parse_rejects": parse_rejects,
    "reject_counts": reject_counts,
    "drop_malformed": drop_malformed,
    "strict_parse": strict_parse,
    "format_lines": format_lines,
    "canonical_lines": canonical_lines,
    "sort_lines": sort_lines,
    "sort_documents": sort_documents,
    "sorted_shards": sorted_shards,
    "sorted_skewed_shards": sorted_skewed_shards,
    "merge_sorted": merge_sorted_inputs,
    "sort_lines_file": sort_lines_file,
    "number_lines": number_lines,
    "compare_pairs": compare_pairs,
    "equal_record_groups": equal_record_groups,
    "adjacent_duplicates": adjacent_duplicates,
    "neighbouring_orders": neighbouring_orders,
    "audit_ok": audit_ok,
    "audit_violation": audit_violation,
    "audit_malformed": audit_malformed,
    "audit_count_mismatch": audit_count_mismatch,
    "audit_no_duplicates": audit_no_duplicates,
    "audit_blank_lines": audit_blank_lines,
    "line_bytes": line_bytes,
    "encoding_roundtrip_latin1": encoding_roundtrip_latin1,
    "encoding_roundtrip_utf16": encoding_roundtrip_utf16,
    "run_report": run_report,
    "strict_failure": strict_failure,
    "sort_high_characters": sort_high_characters,
    "sort_pipe_format": sort_pipe_format,
    "audit_pipe_format": audit_pipe_format,
    "sort_typed_format": sort_typed_format,
    "audit_typed_format": audit_typed_format,
    "typed_rejects": typed_rejects,
    "strict_reread": strict_reread,
    "refused_arguments": refused_arguments,
    "audit_blank_violation": audit_blank_violation,
    "audit_broken_early": audit_broken_early,
    "least_greatest": least_greatest,
    "encoding_roundtrip_utf32": encoding_roundtrip_utf32,
    "encoding_roundtrip_ascii": encoding_roundtrip_ascii,
    "encoding_roundtrip_windows1252": encoding_roundtrip_windows1252,
    "generate_lines": generate_lines_q,
    "generate_totals": generate_totals,
    "generate_size_check": generate_size_check,
}


# ---------------------------------------------------------------- oracles

P1 = C.parse_sql(C.C1_SQL)
P2 = C.parse_sql(C.C2_SQL)
P5 = C.parse_sql(C.C5_SQL)
P3 = C.parse_sql(C.C3_SQL, ids="doc_id, idx")
REJECT_SRC = (
    f"SELECT 'orders' AS source, line_id AS id, 0 AS idx, value FROM ({C.C5_SQL}) "
    f"UNION ALL SELECT 'documents' AS source, doc_id AS id, idx, value FROM ({C.C4_SQL})"
)
PR = C.parse_sql(REJECT_SRC, ids="source, id, idx")
NOT_BLANK = f"NOT (value IS NULL OR trim(value, {C.WS_SQL}) = '')"


def _sorted_sql(parsed: str) -> str:
    return (
        "SELECT row_number() OVER (ORDER BY text, number) AS pos, number, text "
        f"FROM ({parsed}) WHERE parse_error IS NULL"
    )


def audit_sql(lines: str, original_lines: str) -> str:
    """Sequential audit in SQL: ``lines`` yields ``ln, value`` of the sorted file."""
    parsed = C.parse_sql(f"SELECT ln, value FROM ({lines}) WHERE {NOT_BLANK}", ids="ln")
    return f"""WITH f AS ({lines}),
w AS (SELECT *, lag(number) OVER (ORDER BY ln) AS pn, lag(text) OVER (ORDER BY ln) AS pt,
             lag(ln) OVER (ORDER BY ln) AS pln FROM ({parsed})),
v AS (SELECT min(ln) AS vl FROM w WHERE parse_error IS NOT NULL
      OR (pln IS NOT NULL AND (text < pt OR (text = pt AND number < pn)))),
d AS (SELECT min(ln) AS dl FROM w WHERE parse_error IS NULL AND pt IS NOT NULL AND text = pt),
t AS (SELECT count(*) AS total FROM f),
o AS (SELECT ({original_lines}) AS original_lines),
vr AS (SELECT w.* FROM w, v WHERE w.ln = v.vl),
r AS (SELECT CAST(o.original_lines AS BIGINT) AS original_lines,
        CAST(coalesce(v.vl, t.total) AS BIGINT) AS sorted_lines,
        v.vl IS NULL AS is_sorted,
        CAST(coalesce(v.vl, -1) AS BIGINT) AS violation_line,
        (SELECT CASE WHEN pln IS NULL THEN '{NO_PREVIOUS}' ELSE CAST(pn AS VARCHAR) || '. ' || pt END FROM vr) AS previous_line,
        (SELECT CASE WHEN parse_error IS NULL THEN CAST(number AS VARCHAR) || '. ' || text ELSE value END FROM vr) AS current_line,
        coalesce(d.dl < coalesce(v.vl, 9000000000000000000), false) AS found_duplicate
      FROM o, t, v, d)
SELECT original_lines, sorted_lines, is_sorted, violation_line, previous_line, current_line, found_duplicate,
  sorted_lines = original_lines AS line_counts_match,
  CASE WHEN NOT is_sorted THEN 'order_violation' WHEN sorted_lines <> original_lines THEN 'count_mismatch'
       WHEN NOT found_duplicate THEN 'no_duplicates' ELSE 'ok' END AS status,
  (is_sorted AND sorted_lines = original_lines AND found_duplicate) AS passed
FROM r"""


def _sorted_file_sql(parsed: str) -> str:
    return (
        "SELECT row_number() OVER (ORDER BY text, number) AS ln, CAST(number AS VARCHAR) || '. ' || text AS value "
        f"FROM ({parsed}) WHERE parse_error IS NULL"
    )


DISTINCT_SQL = (
    "SELECT k AS line_id, CAST(k AS VARCHAR) || '. ' || p_name AS value "
    "FROM (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name)"
)
BLANKS_SQL = f"""SELECT row_number() OVER (ORDER BY text, number, flag) AS ln, value FROM (
  SELECT text, number, 0 AS flag, CAST(number AS VARCHAR) || '. ' || text AS value FROM ({P1}) WHERE parse_error IS NULL
  UNION ALL
  SELECT text, number, 1 AS flag, CASE WHEN number % 20 = 0 THEN '  ' WHEN number % 30 = 0 THEN chr(12288) || ' ' ELSE '' END
  FROM ({P1}) WHERE parse_error IS NULL AND number % 10 = 0)"""
# The same lines by number.
BLANKS_BY_NUMBER_SQL = BLANKS_SQL.replace("ORDER BY text, number, flag", "ORDER BY number, flag")
DOC_CHARS_SQL = "SELECT sum(length(text)) FROM documents"


def blank_audit_sql(lines: str) -> str:
    """:func:`audit_sql` of one file against itself, with ``blank_lines``."""
    blank = f"SELECT count(*) FROM ({lines}) b WHERE NOT ({NOT_BLANK}) AND (a.is_sorted OR b.ln < a.violation_line)"
    return f"SELECT a.*, ({blank}) AS blank_lines FROM ({audit_sql(lines, f'SELECT count(*) FROM ({lines})')}) a"


BROKEN_SQL = f"""SELECT 1 AS ln, '0. ~~~~ last of all' AS value UNION ALL SELECT ln + 1, value FROM ({_sorted_file_sql(P1)})"""
TYPED_SQL = """SELECT day, o_orderpriority AS priority, number, CASE WHEN k % 50 = 1 THEN 'soon' || line WHEN k % 50 = 2 THEN CAST(day AS VARCHAR) ELSE line END AS value,
  CASE WHEN k % 50 = 1 THEN 'Malformed line (invalid day ' || chr(39) || 'soon' || day || chr(39) || '). Full line: soon' || line
       WHEN k % 50 = 2 THEN 'Malformed line: not 3 fields. Value: ' || day END AS parse_error
FROM (SELECT *, day || '| ' || o_orderpriority || '| ' || number AS line FROM (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END AS number FROM orders))"""


def generated_sql(target: str, seed: int, reuse_chance: float) -> str:
    """DuckDB SQL of the generated lines (id, number, text, size) up to a size."""
    words = "[" + ", ".join(f"'{w}'" for w in G.WORDS) + "]"
    span, n = G.MAX_TEXT - G.MIN_TEXT + 1, len(G.WORDS)
    return f"""
        WITH target AS (SELECT CAST(({target}) AS BIGINT) AS chars),
        ids AS (SELECT unnest(range(0, (SELECT chars // {G.MIN_TEXT + 4} + 2 FROM target))) AS id),
        drawn AS (SELECT id, CAST(('0x' || substr(h, 1, 16)) AS UBIGINT) & 9223372036854775807 AS v, CAST(('0x' || substr(h, 17, 15)) AS BIGINT) AS y
            FROM (SELECT id, md5('{seed}:' || id) AS h FROM ids)),
        rolled AS (SELECT id, y, CASE WHEN y % 100 < {int(100 * G.NEGATIVE_CHANCE)} THEN -CAST(v AS BIGINT) ELSE CAST(v AS BIGINT) END AS number,
            id = 0 OR (y // 100) % 1000000 >= {reuse_chance * 1_000_000} AS fresh FROM drawn),
        pool AS (SELECT id AS pool_id, row_number() OVER (ORDER BY id) - 1 AS k FROM rolled WHERE fresh ORDER BY id LIMIT {G.POOL_SIZE}),
        reusing AS (SELECT r.id, (any_value(r.y) // 100000000) % count(*) AS k FROM rolled r JOIN pool p ON p.pool_id < r.id WHERE NOT r.fresh GROUP BY r.id),
        sourced AS (SELECT r.id, r.number, coalesce(p.pool_id, r.id) AS src FROM rolled r LEFT JOIN reusing u USING (id) LEFT JOIN pool p USING (k)),
        worded AS (SELECT *, 10 + x % {span} AS len, 1 + (x // {span}) % least({G.MAX_WORDS}, (10 + x % {span}) // 5) AS n_words
            FROM (SELECT *, CAST(('0x' || substr(t, 1, 15)) AS BIGINT) AS x, CAST(('0x' || substr(t, 16, 15)) AS BIGINT) AS z
                FROM (SELECT *, md5('{seed}:' || src || ':t') AS t FROM sourced))),
        sized AS (SELECT *, length(CAST(number AS VARCHAR)) + 3 + len AS size FROM worded),
        kept AS (SELECT * FROM (SELECT *, sum(size) OVER (ORDER BY id) - size AS before FROM sized) WHERE before < (SELECT chars FROM target)),
        joined AS (SELECT *, array_to_string([({words})[CAST((z // CAST(pow({n}, k) AS BIGINT)) % {n} AS INTEGER) + 1] for k in range(0, n_words)], ' ') AS j FROM kept),
        cut AS (SELECT *, CASE WHEN length(j) > len AND substr(j, len, 1) = ' ' THEN substr(j, 1, len - 1) || substr(j, len + 1, 1) ELSE substr(j, 1, len) END AS c FROM joined),
        padded AS (SELECT *, replace(replace(array_to_string([to_base64(unhex(substr(sha256('{seed}:' || src || ':' || b), 1, {G._PAD_HEX})))
            for b in range(0, (len - length(c) + {G._PAD_BLOCK - 1}) // {G._PAD_BLOCK} + 1)], ''), '+', ''), '/', '') AS pad FROM cut)
        SELECT id, number, CASE WHEN len > length(c) THEN c || rpad(pad, CAST(len - length(c) AS INTEGER), 'a') ELSE c END AS text, CAST(size AS BIGINT) AS size, src FROM padded"""


GENERATED = generated_sql(DOC_CHARS_SQL, 42, 0.01)

ORACLES: dict[str, str] = {
    "parse_lines": f"SELECT line_id, value, number, text, parse_error FROM ({P5})",
    "parse_rejects": f"SELECT source, id, idx, value, parse_error FROM ({PR}) WHERE parse_error IS NOT NULL",
    "reject_counts": f"""SELECT CASE WHEN parse_error IS NULL THEN 'ok'
        WHEN starts_with(parse_error, 'Malformed line: is null') THEN 'empty'
        WHEN starts_with(parse_error, 'Malformed line: no dot') THEN 'no_dot'
        ELSE 'bad_number' END AS reason, count(*) AS n FROM ({PR}) GROUP BY 1""",
    "drop_malformed": f"SELECT line_id, number, text FROM ({P5}) WHERE parse_error IS NULL",
    "strict_parse": f"SELECT line_id, number, text FROM ({P2}) WHERE parse_error IS NULL",
    "format_lines": f"SELECT line_id, CAST(number AS VARCHAR) || '. ' || text AS line FROM ({P1}) WHERE parse_error IS NULL",
    "canonical_lines": f"SELECT line_id, CASE WHEN parse_error IS NULL THEN CAST(number AS VARCHAR) || '. ' || text END AS canonical FROM ({P5})",
    "sort_lines": _sorted_sql(P1),
    "sort_documents": _sorted_sql(P3),
    "sorted_shards": f"""SELECT line_id % 16 AS shard, row_number() OVER (PARTITION BY line_id % 16 ORDER BY text, number) AS rank,
  number, text FROM ({P1}) WHERE parse_error IS NULL""",
    "sorted_skewed_shards": f"""SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY text, number) AS rank, number, text FROM (
  SELECT CASE WHEN line_id % 2 = 0 THEN 0 ELSE line_id // 500 + 1 END AS shard, number, text FROM ({P1}) WHERE parse_error IS NULL)""",
    "neighbouring_orders": """SELECT row_number() OVER w AS pos, o_orderkey, lag(o_custkey) OVER w AS previous_customer,
  CASE WHEN o_custkey = lag(o_custkey) OVER w THEN CAST(CAST(o_orderdate AS DATE) - lag(CAST(o_orderdate AS DATE)) OVER w AS INTEGER) END AS days_since
FROM orders WINDOW w AS (ORDER BY o_custkey, CAST(o_orderdate AS DATE), o_orderkey)""",
    "strict_failure": f"SELECT parse_error AS message FROM ({P5}) WHERE parse_error IS NOT NULL ORDER BY line_id LIMIT 1",
    "sort_high_characters": """SELECT row_number() OVER (ORDER BY CASE p_partkey % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END, p_name, p_partkey) AS pos,
  p_partkey AS number, CASE p_partkey % 3 WHEN 0 THEN chr(128512) WHEN 1 THEN chr(65313) ELSE 'z' END || p_name AS text FROM part""",
    "sort_pipe_format": """SELECT row_number() OVER (ORDER BY p_partkey) AS line_no, CAST(p_partkey AS VARCHAR) || '|' || p_name AS value FROM part""",
    "audit_pipe_format": """SELECT count(*) AS original_lines, count(*) AS sorted_lines, true AS is_sorted, CAST(-1 AS BIGINT) AS violation_line,
  CAST(NULL AS VARCHAR) AS previous_line, CAST(NULL AS VARCHAR) AS current_line, coalesce(bool_or(same), false) AS found_duplicate,
  true AS line_counts_match, CASE WHEN bool_or(same) THEN 'ok' ELSE 'no_duplicates' END AS status, coalesce(bool_or(same), false) AS passed
FROM (SELECT p_name = lag(p_name) OVER (ORDER BY p_partkey) AS same FROM part)""",
    "encoding_roundtrip_utf32": f"SELECT row_number() OVER (ORDER BY doc_id, idx) AS line_no, value FROM ({C.C3_SQL})",
    "encoding_roundtrip_ascii": (
        "SELECT row_number() OVER (ORDER BY doc_id, idx) AS line_no, "
        f"regexp_replace(value, '[^\\x{{00}}-\\x{{7F}}]', '?', 'g') AS value FROM ({C.C3_SQL})"
    ),
    "encoding_roundtrip_windows1252": (
        "SELECT row_number() OVER (ORDER BY doc_id, idx) AS line_no, regexp_replace(value, '[^\\x{00}-\\x{7F}"
        + "".join(f"\\x{{{ord(c):X}}}" for c in upper_half("windows-1252"))
        + f"]', '?', 'g') AS value FROM ({C.C3_SQL})"
    ),
    "merge_sorted": (
        "SELECT row_number() OVER (ORDER BY text, number) AS pos, number, text FROM ("
        f"SELECT number, text FROM ({P1}) WHERE parse_error IS NULL UNION ALL "
        f"SELECT number, text FROM ({P2}) WHERE parse_error IS NULL)"
    ),
    "sort_lines_file": f"SELECT ln AS line_no, value FROM ({_sorted_file_sql(P5)})",
    "number_lines": f"SELECT row_number() OVER (ORDER BY line_id) AS line_no, value FROM ({C.C2_SQL})",
    "compare_pairs": f"""WITH r AS (SELECT line_id, number, text FROM ({P1}) WHERE parse_error IS NULL)
SELECT a.line_id AS a_id, b.line_id AS b_id,
  CASE WHEN a.text < b.text OR (a.text = b.text AND a.number < b.number) THEN -1
       WHEN a.text = b.text AND a.number = b.number THEN 0 ELSE 1 END AS cmp,
  (a.text = b.text AND a.number = b.number) AS eq,
  (a.text, a.number) < (b.text, b.number) AS lt, (a.text, a.number) <= (b.text, b.number) AS le,
  (a.text, a.number) > (b.text, b.number) AS gt, (a.text, a.number) >= (b.text, b.number) AS ge
FROM r a JOIN r b ON b.line_id = a.line_id + 1""",
    "equal_record_groups": (
        "SELECT number, text, count(*) AS n FROM ("
        + C.parse_sql("SELECT 0 AS line_id, CAST(l_partkey AS VARCHAR) || '. ' || l_returnflag AS value FROM lineitem")
        + ") WHERE parse_error IS NULL GROUP BY number, text"
    ),
    "adjacent_duplicates": f"""SELECT pos, number, text FROM (
  SELECT *, lag(text) OVER (ORDER BY pos) AS prev_text FROM ({_sorted_sql(P1)})) WHERE text = prev_text""",
    "audit_ok": audit_sql(_sorted_file_sql(P1), "SELECT count(*) FROM part"),
    "audit_violation": audit_sql(
        f"SELECT row_number() OVER (ORDER BY line_id) AS ln, value FROM ({C.C1_SQL})", "SELECT count(*) FROM part"
    ),
    "audit_malformed": audit_sql(
        f"SELECT row_number() OVER (ORDER BY line_id) AS ln, value FROM ({C.C5_SQL})", "SELECT count(*) FROM orders"
    ),
    "audit_count_mismatch": audit_sql(_sorted_file_sql(P5), "SELECT count(*) FROM orders"),
    "audit_no_duplicates": audit_sql(
        _sorted_file_sql(C.parse_sql(DISTINCT_SQL)), "SELECT count(*) FROM (SELECT DISTINCT p_name FROM part)"
    ),
    "audit_blank_lines": blank_audit_sql(BLANKS_SQL),
    "audit_blank_violation": blank_audit_sql(BLANKS_BY_NUMBER_SQL),
    "audit_broken_early": f"SELECT *, CAST(2 AS BIGINT) AS files_read, true AS stopped_early FROM ({audit_sql(BROKEN_SQL, f'SELECT count(*) FROM ({BROKEN_SQL})')})",
    "sort_typed_format": f"""SELECT row_number() OVER (ORDER BY day DESC, priority, number) AS line_no, day || '|' || priority || '|' || number AS value
  FROM ({TYPED_SQL}) WHERE parse_error IS NULL""",
    "audit_typed_format": f"""SELECT count(*) AS original_lines, count(*) FILTER (parse_error IS NULL) AS sorted_lines, true AS is_sorted, CAST(-1 AS BIGINT) AS violation_line,
  CAST(NULL AS VARCHAR) AS previous_line, CAST(NULL AS VARCHAR) AS current_line, false AS found_duplicate, count(parse_error) = 0 AS line_counts_match,
  CASE WHEN count(parse_error) = 0 THEN 'ok' ELSE 'count_mismatch' END AS status, count(parse_error) = 0 AS passed FROM ({TYPED_SQL})""",
    "typed_rejects": f"SELECT value, parse_error FROM ({TYPED_SQL}) WHERE parse_error IS NOT NULL",
    "strict_reread": f"SELECT number, text, (SELECT count(parse_error) > 0 FROM ({P5})) AS source_refused FROM ({P5}) WHERE parse_error IS NULL",
    "refused_arguments": """SELECT unnest(['blank input', 'no output', 'output is input', 'output in input', 'size 0', 'chance over 1', 'negative chance', 'blank audit']) AS job,
  true AS refused, (SELECT count(*) FROM part) AS input_lines""",
    "least_greatest": """SELECT l_orderkey, l_partkey, least(nullif(l_discount, 0), nullif(l_tax, 0)) AS least,
  greatest(nullif(l_discount, 0), nullif(l_tax, 0)) AS greatest FROM lineitem""",
    "line_bytes": f"""SELECT doc_id, idx, CAST(strlen(value) AS INTEGER) AS n_bytes,
  CAST(2 * (length(value) + length(regexp_replace(value, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))) AS INTEGER) AS n_utf16_bytes,
  CAST(length(value) AS INTEGER) AS n_chars FROM ({C.C3_SQL})""",
    "encoding_roundtrip_latin1": (
        "SELECT row_number() OVER (ORDER BY doc_id, idx) AS line_no, "
        f"regexp_replace(value, '[^\\x{{00}}-\\x{{FF}}]', '?', 'g') AS value FROM ({C.C3_SQL})"
    ),
    "encoding_roundtrip_utf16": f"SELECT row_number() OVER (ORDER BY doc_id, idx) AS line_no, value FROM ({C.C3_SQL})",
    "run_report": f"""SELECT 'ok' AS status, count(*) AS rows_in, count(parse_error) AS rows_rejected,
  count(*) - count(parse_error) AS rows_out FROM ({P5})""",
    "generate_lines": f"SELECT id, number, text FROM ({GENERATED})",
    "generate_totals": f"""SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(size) AS BIGINT) AS n_chars, CAST(max(id) AS BIGINT) AS last_id,
        CAST(count(*) FILTER (number < 0) AS BIGINT) AS n_negative, CAST(count(*) FILTER (src <> id) AS BIGINT) AS n_reused,
        CAST(min(length(text)) AS INTEGER) AS shortest, CAST(max(length(text)) AS INTEGER) AS longest FROM ({GENERATED})""",
    "generate_size_check": f"SELECT CAST(({DOC_CHARS_SQL}) AS BIGINT) AS target_chars, true AS reached, true AS minimal",
}

__all__ = ["QUERIES", "ORACLES", "AUDIT_COLUMNS", "SIZE_UNIT", "audit_sql"]
