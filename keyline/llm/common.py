"""Helpers shared by the operators of this subpackage: written intermediate tables in
the shared checkpoint folder, size-checked broadcasts, Arrow batch access, folds."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.session import checkpoint_dir

# A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# No broadcast of this subpackage may exceed this many bytes; see checked_broadcast.
MAX_BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


# Folders written while ``recorded`` is open; None otherwise.
_recording: list[str] | None = None


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``materialize`` writes meanwhile, for :func:`discard`."""
    global _recording
    before, _recording = _recording, []
    try:
        yield _recording
    finally:
        _recording = before


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Deletes intermediate tables that nothing reads any more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    folders.clear()


def release_memory() -> None:
    """Gives memory that the driver's Python no longer uses back to the system: collected
    tables and models that have been broadcast."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage,
    fixes any task-dependent value, survives the loss of an executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    if _recording is not None:
        _recording.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(spark: SparkSession, value: object, n_bytes: int) -> Broadcast:
    """Broadcast ``value`` whose size the caller measured; over the bound is an error."""
    if n_bytes > MAX_BROADCAST_BYTES:
        raise ValueError(f"broadcast of {n_bytes} bytes is over the bound of {MAX_BROADCAST_BYTES}")
    return spark.sparkContext.broadcast(value)


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(id_col.cast("string")) % modulus


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, made longer until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def extended(df: DataFrame, **columns: T.DataType) -> T.StructType:
    """The schema of ``df`` with more columns at its end."""
    return T.StructType([*df.schema.fields, *[T.StructField(c, t) for c, t in columns.items()]])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def runs(texts: Sequence[str | bytes | None], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of at most ``limit`` characters or bytes (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
