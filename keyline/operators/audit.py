"""Sort audit (AUD-1..4, WIN-1/2, SRT-5, AGG-1..3, FLT-4).

The sequential check "each non-blank line must parse and be >= the previous
non-blank record; stop at the first violation; note whether two adjacent records
share their text before it" is rebuilt without a global order:

1. One scan of the sorted file keeps each line's split coordinates
   ``(_f, _b, _m)``. Inside a split the lines are in file order.
2. A window *per split* finds each non-blank line's previous non-blank record
   (``last(..., ignorenulls)`` over the rows before it). Each window group is one
   input split (bounded by ``spark.sql.files.maxPartitionBytes``), so no group can
   grow with the data.
3. Per split: line count, first id, first/last non-blank record, first violation
   and first adjacent duplicate, as local offsets. This table has one row per
   split.
4. A stitch over the split table turns local offsets into line numbers (sums within
   each file, then over files), tests each split's first record against the last one
   of the non-blank split before it (a join on ordinals), and reduces to the first
   violation and the first duplicate.

Every line before the first violation parses, so "previous non-blank line"
equals the reference's "previous valid record" wherever it matters.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyline.functions.record import KEYED_LINE, LineFormat
from keyline.functions.text import is_blank, text_from_key
from keyline.functions.typed import TypedFormat
from keyline.operators.split_scan import SUMMARY_SCHEMA, summarize_partition
from keyline.session import reliable_checkpoint
from keyline.sources.lines import file_order, list_files, scan_lines

# Fixed value: previous-line text when a malformed line has no valid record before it.
NO_PREVIOUS = "N/A (first or previous was invalid)"

STATUSES = ("order_violation", "count_mismatch", "no_duplicates", "ok")


def _rec(key: Column, number: Column, moved: Column) -> Column:
    # The text is not stored twice: it is the key's bytes, except for the rare
    # rows whose key was remapped (their text is kept in ``t``, null elsewhere).
    return F.struct(key.alias("k"), number.alias("n"), moved.alias("t"))


def _fmt(rec: Column, fmt: LineFormat) -> Column:
    return fmt.format(rec.n, text_from_key(rec.k, rec.t))


def _before(a: Column, b: Column, fmt: LineFormat) -> Column:
    """Whether record ``a`` comes before record ``b``."""
    return F.struct(*fmt.order_by(a.k, a.n)) < F.struct(*fmt.order_by(b.k, b.n))


def split_summaries(lines: DataFrame, text_order: str = "utf16", line_format: LineFormat = KEYED_LINE) -> DataFrame:
    """Steps 2-3: one row per split of a scanned file (``value, _f, _b, _m``)."""
    parsed = line_format.parse_frame(lines.select("value", "_f", "_b", "_m", is_blank(F.col("value")).alias("_blank")))
    keyed = line_format.keyed(parsed, text_order)
    blank, err = F.col("_blank"), F.col("parse_error")
    staged = keyed.select(
        "_f",
        "_b",
        "_m",
        "_blank",
        F.when(~blank, err.isNull()).alias("_ok"),
        F.when(~blank & err.isNull(), _rec(F.col("_k"), F.col("number"), F.col("_t"))).alias("_r"),
        F.when(~blank & err.isNotNull(), F.col("value")).alias("_bad"),
    )
    w = Window.partitionBy("_f", "_b").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    # Previous non-blank line of the split: a record, or a marker for a malformed one.
    prev_any = F.last(F.when(~F.col("_blank"), F.struct(F.col("_m").alias("m"), F.col("_r").alias("r"))), True).over(w)
    blanks = F.sum(F.col("_blank").cast("bigint")).over(w)
    with_prev = staged.select("*", prev_any.alias("_prev"), F.coalesce(blanks, F.lit(0)).alias("_blanks"))
    cur, prev = F.col("_r"), F.col("_prev.r")
    has_prev = F.col("_prev").isNotNull()
    in_order_break = has_prev & _before(cur, prev, line_format)
    violation = (F.col("_ok") == F.lit(False)) | (F.col("_ok") & prev.isNotNull() & in_order_break)
    duplicate = F.col("_ok") & prev.isNotNull() & (cur.k == prev.k)
    cur_line = F.when(F.col("_ok"), _fmt(cur, line_format)).otherwise(F.col("_bad"))
    prev_line = F.when(has_prev, _fmt(prev, line_format))
    nonblank = F.when(~F.col("_blank"), F.struct(F.col("_m").alias("m"), F.col("_r").alias("r")))
    return with_prev.groupBy("_f", "_b").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("_m").alias("m0"),
        F.min(nonblank).alias("first"),
        F.max(nonblank).alias("last"),
        F.min(
            F.when(
                violation,
                F.struct(
                    F.col("_m").alias("m"),
                    has_prev.alias("has_prev"),
                    prev_line.alias("prev_line"),
                    cur_line.alias("cur_line"),
                    F.col("_blanks").alias("blanks"),
                ),
            )
        ).alias("viol"),
        F.min(F.when(duplicate, F.col("_m"))).alias("dup_m"),
        F.count_if("_blank").alias("n_blank"),
    )


def split_summaries_arrow(
    lines: DataFrame, text_order: str = "utf16", line_format: LineFormat = KEYED_LINE
) -> DataFrame:
    """Steps 2-3 without a shuffle: the per-split facts of :func:`split_summaries`
    from one ``mapInArrow`` pass over the scan (see ``keyline.operators.split_scan``)."""
    parsed = line_format.parse_frame(lines.select("value", "_f", "_b", "_m", is_blank(F.col("value")).alias("_blank")))
    keyed = line_format.keyed(parsed, text_order)
    blank, err = F.col("_blank"), F.col("parse_error")
    ok = ~blank & err.isNull()
    staged = keyed.select(
        "_f",
        F.xxhash64("_f").alias("_fh"),
        "_b",
        "_m",
        "_blank",
        F.when(~blank, err.isNull()).alias("_ok"),
        F.when(ok, F.col("_k").cast("binary")).alias("_k"),
        F.when(ok, F.col("number")).alias("_n"),
        F.when(ok, F.col("_t")).alias("_t"),
        F.when(~blank & err.isNotNull(), F.col("value")).alias("_bad"),
    )
    flat = staged.mapInArrow(summarize_partition(line_format.joiner, line_format.number_first), SUMMARY_SCHEMA)

    def rec(prefix):
        r = F.struct(
            F.col(f"{prefix}_k").cast("string").alias("k"),
            F.col(f"{prefix}_n").alias("n"),
            F.col(f"{prefix}_t").alias("t"),
        )
        return F.when(
            F.col(f"{prefix}_m").isNotNull(),
            F.struct(F.col(f"{prefix}_m").alias("m"), F.when(F.col(f"{prefix}_ok"), r).alias("r")),
        )

    viol = F.when(
        F.col("viol_m").isNotNull(),
        F.struct(
            F.col("viol_m").alias("m"),
            F.col("viol_has_prev").alias("has_prev"),
            F.col("viol_prev_line").alias("prev_line"),
            F.col("viol_cur_line").alias("cur_line"),
            F.col("viol_blank").alias("blanks"),
        ),
    )
    return flat.select(
        "_f", "_b", "n_lines", "m0", rec("first").alias("first"), rec("last").alias("last"), viol.alias("viol"), "dup_m", "n_blank"
    )


def _located(summaries: DataFrame) -> DataFrame:
    """Each split with ``off``, the lines before it, ``blank_off``, the blank ones of them,
    and ``nb``, the splits with a non-blank line before it. Sums run within each file, then
    over one row (path and three numbers) a file; no line's text is in a window."""
    used = F.when(F.col("first").isNotNull(), 1).otherwise(0).cast("bigint")
    sums = {"n_lines": "off", "used": "nb", "n_blank": "blank_off"}
    numbers = summaries.select("_f", "_b", "n_lines", used.alias("used"), "n_blank")
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    inside = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    files = numbers.groupBy("_f").agg(*[F.sum(c).alias(c) for c in sums])
    over = Window.orderBy(*file_order("_f")).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_f", *[before(c, over).alias(f"_{to}") for c, to in sums.items()])
    numbers = numbers.select("_f", "_b", *[before(c, inside).alias(to) for c, to in sums.items()])
    placed = numbers.join(files, "_f").select("_f", "_b", *[(F.col(to) + F.col(f"_{to}")).alias(to) for to in sums.values()])
    return summaries.join(placed, ["_f", "_b"])


def stitch(summaries: DataFrame, line_format: LineFormat = KEYED_LINE) -> DataFrame:
    """Step 4: one row with ``sorted_lines_total``, ``blank_total``, ``v`` (line, previous
    and current line of the first violation, blank lines before it) and ``first_duplicate_line``.

    A split meets the last record of the non-blank split before it by an equi-join on
    their ordinals. ``summaries`` is read several times: pass a written table.
    """
    s = _located(summaries)
    before = s.filter(F.col("first").isNotNull()).select((F.col("nb") + 1).alias("nb"), F.col("last").alias("plast"))
    used = s.filter(F.col("first").isNotNull()).join(before, "nb", "left")
    total = summaries.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(to) for c, to in (("n_lines", "sorted_lines_total"), ("n_blank", "blank_total"))])
    line_of = lambda m: F.col("off") + (m - F.col("m0")) + F.lit(1)
    first, plast = F.col("first"), F.col("plast")
    first_ok = first.isNotNull() & first.r.isNotNull()
    both = first_ok & plast.isNotNull() & plast.r.isNotNull()
    boundary_break = both & _before(first.r, plast.r, line_format)
    boundary_dup = both & (first.r.k == plast.r.k)
    plast_line = F.when(plast.r.isNotNull(), _fmt(plast.r, line_format))
    viol = F.col("viol")
    in_split = F.when(
        viol.isNotNull(),
        F.struct(
            line_of(viol.m).alias("line"),
            F.when(viol.has_prev, viol.prev_line).otherwise(F.coalesce(plast_line, F.lit(NO_PREVIOUS))).alias("prev"),
            viol.cur_line.alias("cur"),
            (F.col("blank_off") + viol.blanks).alias("blanks"),
        ),
    )
    at_boundary = F.when(
        boundary_break,
        F.struct(
            line_of(first.m).alias("line"),
            plast_line.alias("prev"),
            _fmt(first.r, line_format).alias("cur"),
            (F.col("blank_off") + first.m - F.col("m0")).alias("blanks"),
        ),
    )
    dup_line = F.least(
        F.when(F.col("dup_m").isNotNull(), line_of(F.col("dup_m"))),
        F.when(boundary_dup, line_of(first.m)),
    )
    firsts = used.agg(F.min(F.least(in_split, at_boundary)).alias("v"), F.min(dup_line).alias("first_duplicate_line"))
    return _side_by_side(total, firsts)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row results as one row, without a join: union, then one aggregate."""
    wide = [*a.schema.fields, *b.schema.fields]
    rows = [d.select(*[F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wide]) for d in (a, b)]
    return rows[0].union(rows[1]).agg(*[F.max(f.name).alias(f.name) for f in wide])


def audit_lines(
    spark: SparkSession,
    original_path,
    sorted_path,
    encoding: str = "utf-8",
    text_order: str = "utf16",
    require_duplicates: bool = True,
    method: str = "arrow",
    line_format: LineFormat | TypedFormat | None = None,
    blank_lines: bool = False,
    first_wave: int | None = None,
) -> DataFrame:
    """AUD-1: audit ``sorted_path`` against ``original_path``; one-row DataFrame.

    Columns: ``original_lines, sorted_lines, is_sorted, violation_line,
    previous_line, current_line, found_duplicate, line_counts_match, status,
    passed``. ``status`` is the first that applies of ``order_violation``,
    ``count_mismatch``, ``no_duplicates`` (only if ``require_duplicates``) and
    ``ok``. The scan of the sorted file runs at once and leaves one row a split in the
    shared checkpoint folder; counts and stitch run with the first action.
    :func:`timed_audit` adds ``elapsed_seconds``.

    ``method="arrow"`` (default) summarises each split in the scan's own tasks
    (no shuffle); ``"window"`` does the same with a per-split window (one hash
    exchange of the sorted file). Both give the same row.

    ``blank_lines`` adds the column of that name: blank lines that were skipped, up to the
    violation if there is one (FLT-4). ``first_wave`` (a number of files) reads the sorted
    files in waves of file order, each twice as many files as the one before, and stops at
    the first wave that holds or ends a violation; ``files_read`` and ``files_total`` are
    then added. Later files cannot change the row: it is cut off at the first violation.
    """
    if method not in ("arrow", "window"):
        raise ValueError("method must be 'arrow' or 'window'")
    for p in (original_path, sorted_path):
        if p is None or (isinstance(p, str) and not p.strip()):
            raise ValueError("file path cannot be empty")
    fmt = line_format or LineFormat(text_order)
    original = scan_lines(spark, original_path, encoding, with_split=False).agg(
        F.count(F.lit(1)).alias("original_lines")
    )
    summaries = split_summaries_arrow if method == "arrow" else split_summaries

    def read(files) -> DataFrame:
        scan = scan_lines(spark, files, encoding, with_split=True)
        return reliable_checkpoint(summaries(scan, fmt.text_order, fmt))

    if first_wave is None:
        return verdict(_side_by_side(stitch(read(sorted_path), fmt), original), require_duplicates, blank_lines)
    files = list_files(spark, sorted_path)
    done, wave, seen = 0, max(1, first_wave), None
    while done < len(files) or seen is None:
        own = read(files[done : done + wave] or sorted_path)
        seen = own if seen is None else seen.unionByName(own)
        done, wave = min(len(files), done + wave), 2 * wave
        st = stitch(seen, fmt)
        if done < len(files) and st.filter(F.col("v").isNotNull()).count():
            break
    row = verdict(_side_by_side(st, original), require_duplicates, blank_lines)
    return row.select("*", F.lit(done).cast("bigint").alias("files_read"), F.lit(len(files)).cast("bigint").alias("files_total"))


def timed_audit(spark: SparkSession, *args, **kw) -> DataFrame:
    """:func:`audit_lines`, run at once, with ``elapsed_seconds`` as one more column."""
    started = time.time()
    row = audit_lines(spark, *args, **kw)
    done = spark.createDataFrame(row.collect(), row.schema)
    return done.withColumn("elapsed_seconds", F.lit(round(time.time() - started, 3)))


def verdict(one: DataFrame, require_duplicates: bool = True, blank_lines: bool = False) -> DataFrame:
    """AUD-3/4: counts, flags and status from the reduced audit row."""
    v = F.col("v")
    is_sorted = v.isNull()
    sorted_lines = F.coalesce(v.line, F.col("sorted_lines_total"), F.lit(0)).cast("bigint")
    found_dup = F.coalesce(F.col("first_duplicate_line") < F.coalesce(v.line, F.lit(2**62)), F.lit(False))
    counts_match = sorted_lines == F.col("original_lines")
    status = (
        F.when(~is_sorted, F.lit("order_violation"))
        .when(~counts_match, F.lit("count_mismatch"))
        .when(F.lit(require_duplicates) & ~found_dup, F.lit("no_duplicates"))
        .otherwise(F.lit("ok"))
    )
    return one.select(
        F.col("original_lines").cast("bigint").alias("original_lines"),
        sorted_lines.alias("sorted_lines"),
        is_sorted.alias("is_sorted"),
        F.coalesce(v.line, F.lit(-1)).cast("bigint").alias("violation_line"),
        v.prev.alias("previous_line"),
        v.cur.alias("current_line"),
        found_dup.alias("found_duplicate"),
        counts_match.alias("line_counts_match"),
        status.alias("status"),
        (status == F.lit("ok")).alias("passed"),
        *([F.coalesce(v.blanks, F.col("blank_total")).alias("blank_lines")] if blank_lines else []),
    )
