"""Record order operators: global sort (SRT-1), sorted shards (SRT-2), merge (SRT-3)
and positions in the sorted result (SRT-4).

The global sort is Spark's own: a range exchange on the sort key (bounds from a
sample) followed by a spillable per-partition sort. Only the key is ours: the text
as a binary whose byte order is UTF-16 code-unit order (see
``keyline.functions.text.ordinal_key``). The text itself is not shuffled twice:
the key *is* the text's UTF-8 bytes except for the rare rows holding
U+E000..U+FFFF, whose text rides along in ``_t`` and is null elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyline.functions.text import text_from_key, with_ordinal_key
from keyline.session import conf_bytes, reliable_checkpoint
from keyline.sources.lines import join_small


# Input bytes per range partition when the count is derived from the input size.
SORT_PARTITION_BYTES = 1 << 30


def range_partitions(spark, df: DataFrame) -> int:
    """Range partitions for a sort: the session's shuffle partitions, raised so that
    no partition gets more than ``SORT_PARTITION_BYTES`` of input (AQE can merge
    small range partitions but never splits one). The size is the optimizer's
    estimate for ``df`` (file sizes for a scan); no job runs."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= 0 or size >= 1 << 56:
        # No estimate: a Python data source reports the default (Long.MaxValue),
        # which projections scale down but keep far above any real input (64 PiB
        # here). Bound the input by its splits, each at most
        # spark.sql.files.maxPartitionBytes. Planning only, no job.
        split = conf_bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20)
        size = df.rdd.getNumPartitions() * split
    return max(base, -(-size // SORT_PARTITION_BYTES))


# Share of the driver's result limit that the sample of sort keys may take.
SAMPLE_SHARE = 8
SAMPLE_SETTING = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


_sample_before: dict[int, str] = {}  # the setting before it was lowered, by session


def bound_key_sample(spark, df: DataFrame | None, column: str | None, parts: int, mean: float | None = None) -> None:
    """Bound the bytes of sort keys that a range exchange samples to the driver.

    Spark samples about 3 x sampleSizePerPartition x partitions whole keys. The setting
    is lowered (never raised) so that keys of ``mean`` bytes fit in an eighth of
    ``spark.driver.maxResultSize``; without ``mean`` it is that of ``df.column``, over all
    its rows (one aggregate). The setting is read when the exchange runs:
    :func:`restore_key_sample` puts it back after the job. Fewer samples only make
    partitions less even.
    """
    limit = conf_bytes(spark, "spark.driver.maxResultSize", 1 << 30) or 1 << 30
    if mean is None:
        mean = df.agg(F.avg(F.octet_length(column))).first()[0] or 0
    fit = max(1, int(limit / SAMPLE_SHARE / (mean + 48) / 3 / max(1, parts)))
    now = spark.conf.get(SAMPLE_SETTING, "100")
    if fit < int(now):
        _sample_before.setdefault(id(spark), now)
        spark.conf.set(SAMPLE_SETTING, fit)


def restore_key_sample(spark) -> None:
    """Put the setting that :func:`bound_key_sample` lowered back."""
    if id(spark) in _sample_before:
        spark.conf.set(SAMPLE_SETTING, _sample_before.pop(id(spark)))


def _fixed(sorted_df: DataFrame) -> DataFrame:
    """``sorted_df`` written to the checkpoint folder; its exchange has then run."""
    out = reliable_checkpoint(sorted_df)
    restore_key_sample(sorted_df.sparkSession)
    return out


def _staged(df: DataFrame, number: str, text: str, text_order: str, tiebreak: str | None) -> DataFrame:
    cols = [F.col(number).alias("number"), F.col(text).alias("_text")]
    if tiebreak is not None:
        tb = F.monotonically_increasing_id() if tiebreak == "" else F.col(tiebreak)
        cols.append(tb.alias("_u"))
    keyed = with_ordinal_key(df.select(*cols), "_text", "_k", "_t", text_order)
    return keyed.select("_k", "number", "_t", *(["_u"] if tiebreak is not None else []))


def _unstaged(staged: DataFrame) -> DataFrame:
    return staged.select(F.col("number"), text_from_key(F.col("_k"), F.col("_t")).alias("text"))


def sort_records(
    df: DataFrame,
    number: str = "number",
    text: str = "text",
    text_order: str = "utf16",
    tiebreak: str | None = "",
    num_partitions: int | None = None,
) -> DataFrame:
    """SRT-1: globally sort ``(number, text)`` records by text (ordinal), then number.

    Output is ``number, text``, range-partitioned: partition i holds keys below
    those of partition i+1, and each partition is sorted, so writing it gives part
    files whose name order is the global order.

    ``tiebreak`` adds a unique id as the last sort column so that a record repeated
    millions of times is still split across range partitions instead of landing in
    one task (equal records are identical, so the order among them is not
    observable). ``""`` (default) uses ``monotonically_increasing_id()`` taken
    right after ``df``, which is the same on a retry only where ``df``'s row order is
    (a scan); over shuffled rows pass a column name holding a stable unique id, or
    ``None`` to switch it off.

    The sample of keys is bounded as :func:`bound_key_sample` says; a job of one's own over
    the result calls :func:`restore_key_sample` when it is done (:func:`with_positions` and
    the file jobs do).
    """
    staged = _staged(df, number, text, text_order, tiebreak)
    keys = ["_k", "number"] + (["_u"] if tiebreak is not None else [])
    parts = num_partitions or range_partitions(df.sparkSession, df)
    bound_key_sample(df.sparkSession, df, text, parts)
    out = staged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return _unstaged(out)


def sort_within_shards(
    df: DataFrame, number: str = "number", text: str = "text", text_order: str = "utf16", keep: list[str] | None = None
) -> DataFrame:
    """SRT-2: sort each partition on its own (sorted runs), no exchange; ``keep`` names
    columns that stay with their record."""
    keep = list(keep or [])
    rows = df.select(*keep, F.col(number).alias("number"), F.col(text).alias("_text"))
    keyed = with_ordinal_key(rows, "_text", "_k", "_t", text_order)
    runs = keyed.select(*keep, "_k", "number", "_t").sortWithinPartitions("_k", "number")
    return runs.select(*keep, "number", text_from_key(F.col("_k"), F.col("_t")).alias("text"))


def sort_shards(
    df: DataFrame,
    shards: list[str],
    number: str = "number",
    text: str = "text",
    text_order: str = "utf16",
    num_partitions: int | None = None,
) -> DataFrame:
    """SRT-2: every shard sorted on its own, whatever its size: ``shards`` columns,
    ``rank`` (1-based within the shard), ``number, text``, in (shard, record) order.

    One range exchange on (shard, key, number, scan position) cuts a large shard into
    several tasks and packs small ones together, so no task depends on how records fall
    into shards. Ranks come from the fixed copy: the records of a shard in the partitions
    before it (one row a shard and partition that meet) plus the place in its own.
    """
    spark = df.sparkSession
    rows = df.select(*shards, F.col(number).alias("number"), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_u"))
    keyed = with_ordinal_key(rows, "_text", "_k", "_t", text_order).select(*shards, "_k", "number", "_t", "_u")
    keys = [*shards, "_k", "number", "_u"]
    parts = num_partitions or range_partitions(spark, df)
    bound_key_sample(spark, df, text, parts)
    runs = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_u")
    fixed = _fixed(runs)
    shard = F.struct(*shards).alias("_s")  # null shards are equal as parts of a struct
    placed = fixed.select("*", shard, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    # Shards meet partitions in runs, so this has at most shards + partitions rows.
    met = placed.groupBy("_p", "_s").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_i0"))
    before = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    met = reliable_checkpoint(met.select("_p", "_s", "_i0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    out = join_small(placed, met, ["_p", "_s"], row_bytes=256)
    rank = (F.col("_off") + F.col("_i") - F.col("_i0") + F.lit(1)).alias("rank")
    return out.select(*shards, rank, "number", text_from_key(F.col("_k"), F.col("_t")).alias("text"))


def merge_sorted(inputs: list[DataFrame], text_order: str = "utf16", spark: SparkSession | None = None) -> DataFrame:
    """SRT-3: merge record inputs into one sorted output, duplicates kept (bag union).

    Zero inputs give an empty result; empty inputs are harmless. One range exchange does
    the merge work, so pass inputs as they are read: sorting them first only adds
    exchanges.
    """
    cols = ["number", "text"]
    if not inputs:
        return (spark or SparkSession.active()).createDataFrame([], "number long, text string")
    union = reduce(lambda a, b: a.unionByName(b), [d.select(*cols) for d in inputs])
    return sort_records(union, text_order=text_order)


def with_positions(sorted_df: DataFrame) -> DataFrame:
    """SRT-4: add ``pos`` (1-based rank in the global order) to a sorted DataFrame.

    A range exchange samples its bounds each time the plan runs, so positions
    must come from one fixed copy: the sorted data is checkpointed to the shared
    checkpoint folder first. Then one count per partition (a table with one row
    per partition), a running sum over that small table, and a broadcast join
    give ``pos = offset(partition) + index in partition + 1``. No single-partition
    window over the data.
    """
    fixed = _fixed(sorted_df)
    ided = fixed.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    counts = ided.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_i0"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = reliable_checkpoint(counts.select("_p", "_i0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")))
    out = join_small(ided, offsets, ["_p"])
    pos = (F.col("_off") + F.col("_i") - F.col("_i0") + F.lit(1)).alias("pos")
    return out.select(pos, *[c for c in fixed.columns])
