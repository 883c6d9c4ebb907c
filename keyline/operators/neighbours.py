"""Each record beside the record before it (WIN-2), for any sorted frame.

A window over the whole order would put all records into one task, and joining positions
shuffles every record twice more. Here the sorted frame is fixed once, each partition
shifts its own columns by one record, and only the first record of a partition has to look
elsewhere: the last record of every partition, one row each, is kept aside and joined to
the first record of the next partition that has any.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.operators.sort import restore_key_sample
from keyline.session import reliable_checkpoint
from keyline.sources.lines import join_small

_PLACE = ["_p", "_i"]


def _shifted(columns: list[int], names: list[str]):
    """Each batch with the columns of the record before; the carry is one record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[pa.Array] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(i) for i in columns]
            before = [
                pa.concat_arrays([carry[k] if carry else pa.nulls(1, c.type), c.slice(0, len(c) - 1)]) for k, c in enumerate(own)
            ]
            head = pa.array([carry is None] + [False] * (batch.num_rows - 1))
            carry = [c.slice(len(c) - 1, 1) for c in own]
            yield pa.RecordBatch.from_arrays([*batch.columns, *before, head], names=names)

    return run


def with_previous(sorted_df: DataFrame, columns: list[str], prefix: str = "prev_") -> DataFrame:
    """``pos`` (1-based, in the order of ``sorted_df``), its columns, and for each of
    ``columns`` the value in the record before as ``prefix + name`` (null in the first).

    ``sorted_df`` is range-partitioned and sorted within its partitions (as
    :func:`keyline.operators.sort.sort_records` gives it); it is written once to the
    checkpoint folder, since a range exchange draws new bounds each time it runs. Records
    themselves are neither joined nor shuffled again: the tables joined have one row a
    partition.
    """
    fixed = reliable_checkpoint(sorted_df)
    restore_key_sample(sorted_df.sparkSession)
    placed = fixed.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    previous = [T.StructField(prefix + c, fixed.schema[c].dataType) for c in columns]
    schema = T.StructType([*placed.schema.fields, *previous, T.StructField("_head", T.BooleanType())])
    shifted = placed.mapInArrow(_shifted([placed.columns.index(c) for c in columns], [f.name for f in schema]), schema)

    last = F.max_by(F.struct(*[F.col(c).alias(prefix + c) for c in columns]), "_i").alias("_last")
    ends = reliable_checkpoint(placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_i0"), last))
    order = Window.orderBy("_p")  # numbers only, one row a partition
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbers = ends.select("_p", "_i0", F.row_number().over(order).alias("_k"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbers = reliable_checkpoint(numbers)
    tails = ends.join(numbers.select("_p", (F.col("_k") + 1).alias("_k")), "_p").select("_k", "_last")
    heads = shifted.filter("_head").drop(*[f.name for f in previous]).join(numbers.select("_p", "_k"), "_p").join(tails, "_k", "left")
    heads = heads.select(*placed.columns, *[F.col(f"_last.{f.name}").alias(f.name) for f in previous])
    rows = shifted.filter(~F.col("_head")).drop("_head").unionByName(heads)
    rows = join_small(rows, numbers.select("_p", "_i0", "_off"), ["_p"])
    pos = (F.col("_off") + F.col("_i") - F.col("_i0") + 1).alias("pos")
    return rows.select(pos, *fixed.columns, *[f.name for f in previous])
