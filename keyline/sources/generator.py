"""Synthetic keyed lines (SRC-3, GEN-1..3, NUM-3..6, STR-9..12, WIN-3).

Randomness is a counter-based stream that any engine can repeat: the MD5 of
``"{seed}:{id}"`` gives row ``id`` its number, sign and reuse, the MD5 of
``"{seed}:{id}:t"`` its text's length and words, and the SHA-256 of
``"{seed}:{id}:{block}"`` its padding. Whole numbers are runs of 15 hex digits, taken
apart by division. A row thus depends on its id alone: the same ``(size, seed,
reuse_chance)`` gives the same lines on any cluster size, at any size of the output and on
task retries, and the DuckDB oracle of ``generate_lines`` computes them again.

Per line: a non-negative 63-bit number, negated with probability 0.01; a text of
length 10..1024 made of 1..min(9, length/5) words from a fixed list joined by
spaces and cut to length, then padded with random letters and digits. With
probability ``reuse_chance`` a row reuses, uniformly, one of the first 1,000 fresh
texts that came before it (row 0 is always fresh): the text is worked out again from
the id of that row.

Size: lines are written until the running character count (line + newline)
reaches the target. The cut row is found without a window: sizes are summed
per id bucket (map-side partial aggregation, at most 4,096 buckets), the bucket
where the running total crosses the target is kept, and the search repeats
inside it until at most 4,096 rows remain. The output is the id prefix
``[0, cut]``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The word list and the padding alphabet of generated texts.
WORDS = [
    "apple", "banana", "cherry", "date", "elderberry", "fig", "grape", "honeydew", "kiwi", "lemon",
    "mango", "nectarine", "orange", "papaya", "quince", "raspberry", "strawberry", "tangerine", "ugli",
    "vanilla", "watermelon", "yam", "zucchini", "amazing", "brilliant", "creative", "dynamic",
    "energetic", "fantastic", "gorgeous", "helpful", "incredible", "joyful", "kind", "lovely",
    "magnificent", "natural", "outstanding", "powerful", "quick", "radiant", "stunning", "tremendous",
    "unique", "vibrant", "wonderful", "excellent", "beautiful", "charming", "delightful", "elegant",
    "fabulous", "graceful", "harmonious", "inspiring",
]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

POOL_SIZE = 1000
MIN_TEXT, MAX_TEXT = 10, 1024
MAX_WORDS = 9
NEGATIVE_CHANCE = 0.01
SIZE_UNIT = 1_000_000  # characters per "MB" of --size

_REUSE_UNIT = 1_000_000  # steps of the reuse chance
# Fewest padding characters counted on per block: a block is 40 signs of base 64 (30 bytes,
# so that every sign has six random bits), about 38.8 of them letters or digits.
_PAD_HEX = 60
_PAD_BLOCK = 36
_PAD_BLOCKS = 2 + (MAX_TEXT - 1) // _PAD_BLOCK
ROWS_PER_PARTITION = 25_000  # grid cell of generated rows (about 13.5 MB of text per task)
MAX_PARTITIONS = 100_000  # larger outputs get larger cells instead of more tasks
FANOUT = 4096  # buckets per level of the size-cut search


def _digest(id_col: Column, seed: int, stream: str = "") -> Column:
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), id_col.cast("string"), F.lit(stream)))


def _whole(digest: Column, start: int) -> Column:
    """NUM-4, NUM-5: a whole number below 2^60 from 15 hex digits of a digest."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a, F.lit(n).cast("bigint"))


def number_expr(id_col: Column, seed: int) -> Column:
    """NUM-3: non-negative 63-bit value, negated with probability 0.01."""
    digest = _digest(id_col, seed)
    value = F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    return F.when(_whole(digest, 17) % 100 < int(100 * NEGATIVE_CHANCE), -value).otherwise(value)


def is_fresh(id_col: Column, seed: int, reuse_chance: float) -> Column:
    """GEN-2: a row draws a new text unless the pool is non-empty and it rolls reuse."""
    roll = _div(_whole(_digest(id_col, seed), 17), 100) % _REUSE_UNIT
    return (id_col == 0) | (roll >= F.lit(float(reuse_chance) * _REUSE_UNIT))


def _pick(id_col: Column, seed: int, n: Column) -> Column:
    """The pool slot below ``n`` that a reusing row takes."""
    return (_div(_whole(_digest(id_col, seed), 17), 100 * _REUSE_UNIT) % n).cast("int")


def text_length(src: Column, seed: int) -> Column:
    span = MAX_TEXT - MIN_TEXT + 1
    return (F.lit(MIN_TEXT) + _whole(_digest(src, seed, ":t"), 1) % span).cast("int")


def pool_table(spark: SparkSession, pool: list[int]) -> DataFrame:
    """``k, pool_id``: the pool in id order (at most 1,000 rows, so broadcast)."""
    return spark.createDataFrame([(k, int(p)) for k, p in enumerate(pool)], "k int, pool_id bigint")


def with_source(df: DataFrame, seed: int, reuse_chance: float, pool: list[int], out: str = "src") -> DataFrame:
    """Add ``out``: the id whose fresh text row ``id`` carries (itself, or a pool pick).

    A reusing row picks slot ``k`` uniformly among the ``fill`` pool ids below it
    (the whole pool past its last id; before that, its rank among the sorted pool
    ids, computed only for those few rows) and finds the id by a broadcast join
    with the pool table.
    """
    i = F.col("id")
    if not pool or reuse_chance <= 0:
        return df.select("*", i.alias(out))
    # One SQL literal instead of a thousand client-side ``lit`` calls.
    arr = F.expr("array(" + ",".join(f"{int(p)}L" for p in pool) + ")")
    staged = df.select("*", is_fresh(i, seed, reuse_chance).alias("_fresh"))
    rank = F.array_position(F.sort_array(F.array_union(arr, F.array(i))), i) - F.lit(1)
    fill = F.when(F.col("_fresh"), F.lit(None).cast("int")).when(i > F.lit(int(pool[-1])), F.lit(len(pool)))
    staged = staged.select("*", fill.otherwise(rank.cast("int")).alias("_fill"))
    staged = staged.select("*", F.when(~F.col("_fresh"), _pick(i, seed, F.col("_fill"))).alias("_k"))
    table = F.broadcast(pool_table(df.sparkSession, pool))
    joined = staged.join(table, F.col("_k") == F.col("k"), "left")
    return joined.select(*df.columns, F.coalesce(F.col("pool_id"), i).alias(out))


def word_picks(src: Column, seed: int) -> tuple[Column, Column, list[Column]]:
    """Length, word count and the (up to 9) chosen words of fresh row ``src``."""
    digest, span = _digest(src, seed, ":t"), MAX_TEXT - MIN_TEXT + 1
    length = text_length(src, seed)
    most = F.least(F.lit(MAX_WORDS), F.floor(length / 5)).cast("bigint")
    n_words = (F.lit(1) + _div(_whole(digest, 1), span) % most).cast("int")
    words = F.array(*[F.lit(w) for w in WORDS])
    drawn = _whole(digest, 16)
    picked = [F.element_at(words, (_div(drawn, len(WORDS) ** k) % len(WORDS) + 1).cast("int")) for k in range(MAX_WORDS)]
    return length, n_words, picked


def with_text(df: DataFrame, seed: int, src: str = "src") -> DataFrame:
    """GEN-1: add ``text`` for the fresh-row ids in column ``src`` (STR-9..11).

    Built in steps (words, cut, padding) so each sub-result is computed once;
    Catalyst keeps a multiply-referenced, non-trivial column in its own projection.
    """
    s = F.col(src)
    length, n_words, picked = word_picks(s, seed)
    joined = F.array_join(F.slice(F.array(*picked), F.lit(1), n_words), " ")
    step = df.select("*", length.alias("_len"), joined.alias("_joined"))
    joined, length = F.col("_joined"), F.col("_len")
    # Cut to length; a cut that would end on a joining space takes the next
    # word's first letter instead (the space is only written if two more
    # characters fit).
    ends_on_space = (F.char_length(joined) > length) & (F.substr(joined, length, F.lit(1)) == F.lit(" "))
    cut = F.when(
        ends_on_space,
        F.concat(F.substr(joined, F.lit(1), length - 1), F.substr(joined, length + 1, F.lit(1))),
    ).otherwise(F.substr(joined, F.lit(1), length))
    step = step.select("*", cut.alias("_cut")).drop("_joined")
    step = step.select("*", (F.col("_len") - F.char_length("_cut")).alias("_need"))
    text = F.concat(F.col("_cut"), padding(s, seed, F.col("_need")))
    return step.select("*", text.alias("text")).drop("_len", "_cut", "_need")


def padding(src: Column, seed: int, need: Column) -> Column:
    """STR-11: ``need`` letters/digits, uniform over the 62-character alphabet.

    Blocks are the base 64 of SHA-256 digests of (id, seed, block) without its two other
    signs, so the padding depends on the id alone, whatever the partitions. Blocks are
    drawn while fewer than ``need`` characters are sure; should they still fall short,
    "a" fills up.
    """
    head = F.concat(F.lit(f"{int(seed)}:"), src.cast("string"), F.lit(":"))
    blocks = [
        F.when(need > (j - 1) * _PAD_BLOCK, F.base64(F.unhex(F.substring(F.sha2(F.concat(head, F.lit(str(j))), 256), 1, _PAD_HEX)))).otherwise(F.lit(""))
        for j in range(_PAD_BLOCKS)
    ]
    drawn = F.concat(*blocks)
    for sign in "+/":
        drawn = F.replace(drawn, F.lit(sign), F.lit(""))
    return F.when(need > 0, F.rpad(drawn, need, F.lit("a"))).otherwise(F.lit(""))


def line_size(number: Column, length: Column) -> Column:
    """STR-12: characters of ``"{number}. {text}"`` plus the newline."""
    return F.char_length(number.cast("string")) + F.lit(3) + length


def pool_ids(spark: SparkSession, n_rows: int, seed: int, reuse_chance: float) -> list[int]:
    """The first 1,000 fresh ids below ``n_rows`` (a bounded table of at most 1,000 ids)."""
    if reuse_chance <= 0:
        return []
    if reuse_chance >= 1:
        return [0]  # only row 0 is ever fresh
    # The 1,000th fresh id is expected near 1000 / (1 - p): search a growing prefix
    # instead of the whole id range.
    upto = min(n_rows, int(2 * POOL_SIZE / (1 - reuse_chance)) + 1000)
    while True:
        ids = spark.range(0, upto).where(is_fresh(F.col("id"), seed, reuse_chance))
        found = [r.id for r in ids.orderBy("id").limit(POOL_SIZE).collect()]
        if len(found) == POOL_SIZE or upto >= n_rows:
            return found
        upto = min(n_rows, upto * 4)


def _size_rows(spark: SparkSession, lo: int, hi: int, seed: int, reuse_chance: float, pool: list[int]) -> DataFrame:
    """``id, size`` for ids ``[lo, hi)``; sizes depend on id hashes only, not on the grid."""
    staged = with_source(spark.range(lo, hi), seed, reuse_chance, pool)
    size = line_size(number_expr(F.col("id"), seed), text_length(F.col("src"), seed))
    return staged.select("id", size.alias("size"))


def find_cut(spark: SparkSession, target_chars: int, seed: int, reuse_chance: float) -> tuple[int, list[int]]:
    """WIN-3: number of rows whose running size first reaches ``target_chars``.

    Returns ``(rows, pool)``. A row is kept while the size *before* it is below
    the target. The search narrows an id interval level by level: sizes are
    summed into at most ``FANOUT`` equal id buckets (partial aggregation; only
    those sums reach the driver), the bucket where the running total crosses the
    target is kept, and the next level looks inside it alone. No window and no
    single task sees more than ``FANOUT`` rows. The row budget starts at the
    expected count (mean line about 540 characters) and doubles while the total
    falls short.
    """
    n_rows = int(target_chars / 540 * 1.05) + 1000
    while True:
        pool = pool_ids(spark, n_rows, seed, reuse_chance)
        lo, hi, before = 0, n_rows, 0
        found = True
        while hi - lo > FANOUT:
            width = math.ceil((hi - lo) / FANOUT)
            bucket = F.floor((F.col("id") - F.lit(lo)) / F.lit(width)).cast("bigint")
            sums = _size_rows(spark, lo, hi, seed, reuse_chance, pool).groupBy(bucket.alias("b")).agg(
                F.sum("size").alias("s")
            )
            acc, hit = before, None
            for row in sorted(sums.collect(), key=lambda r: r["b"]):
                if acc + row["s"] >= target_chars:
                    hit = row["b"]
                    break
                acc += row["s"]
            if hit is None:
                found = False
                break
            lo, hi, before = lo + hit * width, min(hi, lo + (hit + 1) * width), acc
        if found:
            acc = before
            for row in _size_rows(spark, lo, hi, seed, reuse_chance, pool).orderBy("id").collect():
                acc += row["size"]
                if acc >= target_chars:
                    return int(row["id"]) + 1, pool
        n_rows *= 2


def rows_per_partition(n_rows: int) -> int:
    """Grid cell size: ``ROWS_PER_PARTITION``, grown so that there are at most
    ``MAX_PARTITIONS`` tasks (about 1 GB of text per task at 100 TB). No row depends on it."""
    return max(ROWS_PER_PARTITION, math.ceil(n_rows / MAX_PARTITIONS))


def grid(spark: SparkSession, n_rows: int, cell: int | None = None) -> DataFrame:
    """Ids ``[0, n_rows)``, partition k holding ``[k*R, (k+1)*R)`` (R = ``cell``)."""
    cell = cell or rows_per_partition(n_rows)
    parts = max(1, math.ceil(n_rows / cell))
    return spark.range(0, parts * cell, numPartitions=parts).where(F.col("id") < F.lit(n_rows))


def generated_lines(
    spark: SparkSession,
    n_rows: int,
    seed: int = 0,
    reuse_chance: float = 0.01,
    pool: list[int] | None = None,
) -> DataFrame:
    """GEN-3: rows ``id, number, text, value`` for ids ``[0, n_rows)``; ``value`` is the line."""
    if pool is None:
        pool = pool_ids(spark, n_rows, seed, reuse_chance)
    i = F.col("id")
    rows = with_source(grid(spark, n_rows), seed, reuse_chance, pool)
    rows = rows.select("id", number_expr(i, seed).alias("number"), "src")
    # A reused text is worked out again from its id, which is cheaper than joining it.
    out = with_text(rows, seed, "src").select("id", "number", "text")
    return out.select("id", "number", "text", F.concat(F.col("number").cast("string"), F.lit(". "), "text").alias("value"))


def validate(size_mb: int, reuse_chance: float) -> None:
    """VAL-1 for the generator."""
    if size_mb is None or int(size_mb) <= 0:
        raise ValueError(f"size_mb must be at least 1, got {size_mb!r}")
    if reuse_chance is None or not 0.0 <= float(reuse_chance) <= 1.0:
        raise ValueError(f"reuse_chance must lie in [0, 1], got {reuse_chance!r}")


def generate_lines(
    spark: SparkSession,
    size_mb: int | None = None,
    seed: int = 0,
    reuse_chance: float = 0.01,
    target_chars: int | None = None,
) -> DataFrame:
    """SRC-3: generated lines whose total size (with newlines) first reaches
    ``size_mb * 1,000,000`` characters (or ``target_chars``)."""
    if target_chars is None:
        validate(size_mb, reuse_chance)
        target_chars = int(size_mb) * SIZE_UNIT
    elif target_chars <= 0 or not 0.0 <= float(reuse_chance) <= 1.0:
        raise ValueError("target_chars must be positive and reuse_chance in [0, 1]")
    n_rows, pool = find_cut(spark, target_chars, seed, reuse_chance)
    return generated_lines(spark, n_rows, seed, reuse_chance, pool)
