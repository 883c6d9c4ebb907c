"""Exact duplicates by Grace hashing.

Records are partitioned by content hash into buckets (Spark's shuffle files are the spill
files). A bucket is streamed through an open-addressing table (CPython's dict, keyed by
the complete normalised bytes, so equal hashes never stand for equal texts). The table
takes new texts only up to a byte budget; records whose text it does not hold overflow to
a written spill table, which the next level partitions again by another hash, until no
bucket overflows. A group never straddles levels: once a table is full it admits no new
text, so all records of a refused text overflow together.

Before the exchange every Arrow batch is collapsed by the same table to one record a
distinct text with its member ids, so a group that holds a third of all rows crosses the
network once a batch, and the members themselves (ids only) never meet in one task. A
first pass counts content hashes; a bitmap of fixed size marks those that several rows
have, and only records with a marked hash need comparing and are partitioned.
A record that is marked by chance finds itself alone there.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import MAX_BROADCAST_BYTES, as_bytes, checked_broadcast, extended, free_name, materialize, table

# Bytes of distinct text that one bucket's table may hold.
TABLE_BYTES = 64 << 20
# Bits of the bitmap of repeated hashes, as a power of two: 4 MB, at most 524,288 words.
# Where very many hashes repeat, more records are marked by chance and compared.
MARK_BITS = 25
LOST_BYTES = 16  # of one record's number, in a broadcast


def _better(a: int | None, b: int | None) -> bool:
    """Whether id ``a`` wins over ``b``: larger wins, any id wins over null."""
    return a is not None and (b is None or a > b)


def _content_hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The content hashes of an Arrow batch, with the number of its rows that have them."""
    for batch in batches:
        counts = Counter(_content_hash((raw or b"").lower()) for raw in as_bytes(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["h", "n"])


def repeated_hashes(docs: DataFrame, text_col: str) -> np.ndarray:
    """Bitmap, as words, of the hashes that several rows of ``docs`` have."""
    hashed = docs.select(text_col).mapInArrow(_hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
    place = F.shiftrightunsigned("h", 64 - MARK_BITS)
    word = hashed.select(F.floor(place / 64).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - MARK_BITS}) % 64 AS INT))").alias("bit"))
    rows = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    marks = np.zeros(1 << (MARK_BITS - 6), np.int64)
    marks[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return marks


def marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.view(np.uint64) >> np.uint64(64 - MARK_BITS)
    return (marks.view(np.uint64)[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _collapse(id_index: int, text_index: int, carry: bool, marks: Broadcast, names: list[str]):
    """Per Arrow batch: one row a distinct text, the winning member's row plus the group.
    Without ``carry`` the text goes along only where it has to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, serial = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            ids = batch.column(id_index).to_pylist()
            slots: dict[bytes, int] = {}
            members: list[list[int | None]] = []
            best: list[int] = []
            for row, raw in enumerate(as_bytes(batch.column(text_index))):
                slot = slots.setdefault((raw or b"").lower(), len(members))
                if slot == len(members):
                    members.append([])
                    best.append(row)
                elif _better(ids[row], ids[best[slot]]):
                    best[slot] = row
                members[slot].append(ids[row])
            rows = batch.take(pa.array(best, pa.int64()))
            hashes = np.array([_content_hash(t) for t in slots], np.int64)
            compare = pa.array(marked(marks.value, hashes))
            kept = list(rows.columns[:id_index])
            if not carry:
                kept[text_index] = pc.if_else(compare, kept[text_index], pa.scalar(None, kept[text_index].type))
            own = [
                pa.array(range(base + serial, base + serial + len(best)), pa.int64()),
                pa.array(hashes),
                pa.array([hashlib.sha256(t).hexdigest() for t in slots], pa.string()),
                pa.array([len(t) for t in slots], pa.int64()),
                pa.array([ids[r] for r in best], pa.int64()),
                pa.array(members, pa.list_(pa.int64())),
                compare,
            ]
            serial += len(best)
            yield pa.RecordBatch.from_arrays([*kept, *own], names=names)

    return run


def _probe(budget: int):
    """One bucket: resolved records with their group, or overflow records with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[bytes, int] = {}
        keep: list[int | None] = []
        winner: list[int] = []
        size: list[int] = []
        seen_gid, seen_slot = array("q"), array("q")
        held = 0
        for batch in batches:
            spilled = []
            gids, sizes, ids = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for row, raw in enumerate(as_bytes(batch.column(4))):
                text = (raw or b"").lower()
                slot = slots.get(text)
                if slot is None:
                    if held and held + len(text) > budget:
                        spilled.append(row)
                        continue
                    held += len(text) + 100
                    slot = slots[text] = len(keep)
                    keep.append(ids[row])
                    winner.append(gids[row])
                    size.append(0)
                elif _better(ids[row], keep[slot]) or (ids[row] == keep[slot] and gids[row] < winner[slot]):
                    keep[slot], winner[slot] = ids[row], gids[row]
                size[slot] += sizes[row]
                seen_gid.append(gids[row])
                seen_slot.append(slot)
            if spilled:
                out = batch.take(pa.array(spilled, pa.int64()))
                none = pa.nulls(len(spilled), pa.int64())
                yield pa.RecordBatch.from_arrays([*out.columns, none, none, none, pa.array([True] * len(spilled))], names=PROBED)
        for i in range(0, len(seen_gid), 10_000):
            part, gid = seen_slot[i : i + 10_000], seen_gid[i : i + 10_000]
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gid, pa.int64()), none, none, none, pa.nulls(len(part), pa.string()),
                    pa.array([keep[s] for s in part], pa.int64()),
                    pa.array([winner[s] for s in part], pa.int64()),
                    pa.array([size[s] for s in part], pa.int64()),
                    pa.array([False] * len(part)),
                ],
                names=PROBED,
            )

    return run


PROBED = ["gid", "h", "n", "id", "text", "keep_id", "winner", "group_size", "spilled"]
PROBED_SCHEMA = (
    "gid long, h long, n long, id long, text string, keep_id long, winner long, group_size long, spilled boolean"
)


class ExactGroups:
    """Groups of equal texts of ``docs``; see :func:`exact_groups`."""

    def __init__(self, docs: DataFrame, collapsed: DataFrame, resolved: DataFrame, own: dict[str, str]):
        self._columns, self._collapsed, self._resolved, self._own = docs.columns, collapsed, resolved, own

    def decisions(self) -> DataFrame:
        """``doc_id, keep_id, group_size, kept, text_sha256``: one row per input row."""
        o = self._own
        c = self._collapsed.select(
            F.col(o["gid"]).alias("gid"), F.col(o["sha"]).alias("text_sha256"), F.col(o["members"]).alias("members"), F.col(o["id"]).alias("best")
        )
        r = self._resolved.select("gid", "keep_id", "winner", "group_size")
        # The place of the row that stays in its batch's member list; -1 in other batches.
        place = F.when(F.col("gid") != F.col("winner"), F.lit(-1)).otherwise(
            F.when(F.col("best").isNull(), F.lit(0)).otherwise(F.array_position("members", F.col("best")) - 1)
        )
        rows = c.join(r, "gid").select("text_sha256", "keep_id", "group_size", place.alias("place"), F.posexplode("members").alias("pos", "doc_id"))
        return rows.select("doc_id", "keep_id", "group_size", (F.col("pos") == F.col("place")).alias("kept"), "text_sha256")

    def survivors(self) -> DataFrame:
        """The rows that stay, with all columns of the input, unchanged; rows are not shuffled
        while the numbers of those that go fit a broadcast."""
        lost = self._resolved.filter(F.col("gid") != F.col("winner")).select(F.col("gid").alias(self._own["gid"]))
        lost = F.broadcast(lost) if lost.count() * LOST_BYTES <= MAX_BROADCAST_BYTES else lost
        return self._collapsed.join(lost, self._own["gid"], "left_anti").select(*[F.col(f"`{c}`") for c in self._columns])


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, carry: bool = True) -> ExactGroups:
    """Group rows whose texts are identical after lower-casing A-Z; of a group, the row
    with the largest id stays.

    Null text counts as empty, so null and empty texts are one group. A null id loses to
    any id; a group of null ids only keeps one of them and has a null ``keep_id``. Of
    rows that repeat both id and text exactly one stays. Texts of any length are compared
    whole; a text over ``table_bytes`` has a table to itself. An empty table gives empty
    results. Extra columns travel with their row, under any name. Without ``carry`` texts
    are not written again unless they must be compared, and ``survivors`` has none.
    """
    spark = docs.sparkSession
    own = {k: free_name(docs, f"grace_{k}") for k in ("gid", "h", "sha", "bytes", "id", "members", "compare")}
    marks = repeated_hashes(docs, text_col)
    shared = checked_broadcast(spark, marks, marks.nbytes)
    number = free_name(docs, "grace_number")
    typed = docs.withColumn(number, F.col(f"`{id_col}`").cast("long"))
    kinds = {"sha": T.StringType(), "members": T.ArrayType(T.LongType()), "compare": T.BooleanType()}
    schema = extended(docs, **{name: kinds.get(k, T.LongType()) for k, name in own.items()})
    collapse = _collapse(len(docs.columns), docs.columns.index(text_col), carry, shared, [f.name for f in schema])
    collapsed = materialize(typed.mapInArrow(collapse, schema), "grace-collapsed")
    every = collapsed.select(
        F.col(own["gid"]).alias("gid"),
        F.col(own["h"]).alias("h"),
        F.size(own["members"]).cast("long").alias("n"),
        F.col(own["id"]).alias("id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(own["compare"]).alias("compare"),
    )
    alone = every.filter(~F.col("compare")).select("gid", "h", "n", "id", F.lit(None).cast("string").alias("text"), F.col("id").alias("keep_id"), F.col("gid").alias("winner"), F.col("n").alias("group_size"), F.lit(False).alias("spilled"))
    records = every.filter("compare").drop("compare")
    collapsed_marked = collapsed.filter(F.col(own["compare"]))
    volume = collapsed_marked.agg(F.coalesce(F.sum(own["bytes"]), F.lit(0))).first()[0]
    resolved, level = alone, 0
    while records is not None:
        # Twice the buckets that an even split needs, so that most levels are the last.
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * volume // table_bytes + 1)
        spread = records.repartition(buckets, F.xxhash64("h", F.lit(level)))
        probed = materialize(spread.mapInArrow(_probe(table_bytes), PROBED_SCHEMA), f"grace-level{level}")
        done = probed.filter(~F.col("spilled"))
        resolved = resolved.unionByName(done)
        spilled = probed.filter("spilled")
        left, volume = spilled.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        records = spilled.select("gid", "h", "n", "id", "text") if left else None
        level += 1
    return ExactGroups(docs, collapsed, resolved, own)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs, carry=False).decisions()


ORACLE = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)"""
