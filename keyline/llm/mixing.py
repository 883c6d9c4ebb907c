"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key. The keys of a source are cut into 65,536 equal
ranges; a hash is uniform, so these are the range partitions of a range sort, known
without sampling, and the same on every rerun. Range totals give distributed prefix sums
(a window over at most 65,536 rows a source), a window inside each range adds the rest,
and the cut falls at the exact word of each source's budget. A budget over the source's
size repeats whole epochs first.

A hot source is spread over all its ranges; only the per-source table (one row a source)
and its running sums are ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyline.llm.common import WORD, materialize, table

RANGE_DIGITS = 4  # hex digits of the key that name its range: 65,536 ranges a source
MAX_EPOCHS = 3
WEIGHT_CYCLE = 3


def word_count(text: Column) -> Column:
    """Words of the whole text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(per_source: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets for ``source, source_size``: shares of the total by weight, capped at
    ``max_epochs`` times the size, the excess reshared among the rest.

    Sources by code point, null last, weigh 1, 2, 3, repeating. With the sources in order
    of cap / weight, the capped ones are a prefix: source j is free when its cap is at
    least its share of what the sources before it leave. One pass of running sums finds
    the prefix, so nothing iterates. An all-empty input gives targets of 0.
    """
    exact = lambda c: c.cast("decimal(38,0)")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = per_source.withColumn("weight", ((F.row_number().over(by_name) - 1) % WEIGHT_CYCLE + 1).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    free = exact(F.col("cap")) * exact(F.col("all_weight") - F.col("weight_before")) >= exact(F.col("weight")) * exact(
        F.col("all_size") - F.col("cap_before")
    )
    s = s.withColumn("free", free)
    s = s.select(
        "*",
        (F.col("all_size") - F.coalesce(F.sum(F.when(~F.col("free"), F.col("cap"))).over(everything), F.lit(0))).alias("rest"),
        F.sum(F.when(F.col("free"), F.col("weight"))).over(everything).alias("rest_weight"),
    )
    target = F.when(
        F.col("free"), (F.col("weight") * F.col("rest")).cast("double") / F.col("rest_weight").cast("double")
    ).otherwise(F.col("cap").cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, taken`` for every row of ``docs``.

    ``taken`` is the words the mix takes from the row: whole epochs times its size, plus
    what the last, partial epoch takes in key order; the row at the cut gives only the
    words up to the budget, so a source's ``taken`` adds up to its target rounded down.
    Null or empty text: size 0, taken 0. Null source: a source of its own, ordered last.
    Null or repeated ids share a key; equal keys are ordered by id, then size, and rows
    equal in both are interchangeable. An empty table gives an empty result. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    sized = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )
    key = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 16)
    keyed = materialize(sized.select("*", key.alias("key"), F.substring(key, 1, RANGE_DIGITS).alias("range")), "mix")

    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("source", "range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), max_epochs)
    cuts = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
    cuts = cuts.select("o.source", "o.range", "offset", "source_size", "target")

    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.alias("p").join(
        cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.range") == F.col("c.range"))
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = budget - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("inside")
    partial = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), left))
    return joined.select("p.doc_id", "p.source", "size", "source_size", "target", epochs.alias("epochs"), "offset", "inside").select(
        "doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + partial).cast("long").alias("taken")
    )


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {WEIGHT_CYCLE} + 1 AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum({MAX_EPOCHS} * source_size) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM s
  WINDOW before AS (ORDER BY {MAX_EPOCHS} * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, cap * (weights - weight_before) >= weight * (total - cap_before) AS is_free FROM f),
t AS (
  SELECT source, source_size, CASE WHEN is_free
      THEN CAST(weight * (total - coalesce(sum(cap) FILTER (WHERE NOT is_free) OVER (), 0)) AS DOUBLE)
           / CAST(sum(weight) FILTER (WHERE is_free) OVER () AS DOUBLE)
      ELSE CAST(cap AS DOUBLE) END AS target
  FROM g),
p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, CAST(epochs AS BIGINT) AS epochs,
       CAST(epochs * size + least(size, greatest(0, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM p"""
