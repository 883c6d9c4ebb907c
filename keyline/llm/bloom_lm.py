"""Language-model scoring from a log-frequency Bloom filter.

An n-gram counted c times has the level 1 + floor(log2 c) and is put into a Bloom filter
once a level, so that a count is read back by repeated membership probes: level 1, 2, ...
until one misses. A level stands for the mean of the counts it covers. The probability of
a token after a history is smoothed by the shorter history (Dirichlet prior of ``MASS``):

    P(w | h) = (min(c(hw), c(h)) + MASS * P(w | h')) / (c(h) + MASS),  P(w) = (c(w) + 1) / (N + V + 1)

An n-gram cannot be more frequent than its parts, so its level is cut to theirs, which
removes most false positives and no true level.

The n-grams of all training texts are counted: each task adds up sorted 64-bit hashes in
bounded windows and passes on packed runs by hash range ("part"). A part's own bits are
sized by its own levels, so errors do not grow with the corpus. Parts are broadcast
together up to ``FILTER_BYTES``; a larger filter is broadcast range after range, and each
document carries the levels found so far from one pass to the next.

Exact counts of single tokens, for the plain score, are two-tier: a broadcast table of the
most frequent ones, and a join for the others, none of which is frequent.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import as_bytes, checked_broadcast, extended, fold, free_name, materialize, runs, table
from keyline.llm.shingles import mix, word_hashes

ORDER = 2  # longest n-gram
MASS = 64.0  # weight of the shorter history, in counts
HASHES = 5  # bits a level; about one false level in 2^HASHES before levels are cut
FILTER_BYTES = 60 << 20  # of the filter that is broadcast at a time
PART_TOKENS = 1 << 19  # n-grams, counted with repeats, that a part is meant for
WINDOW = 1 << 20  # distinct n-grams that a task holds
RUN_BYTES = 1 << 20  # texts that are hashed at a time; one text at least
FREQUENT = 1 << 18  # entries of the broadcast table of tokens
VOCABULARY = 1 << 19  # distinct tokens that a task holds
KEY_BYTES = 64  # a longer token is known by its digest
END = b""  # the end of a text, as a token: no word is empty

_BEGIN, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_MUL, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- tokens ----------------------------------------------------------------------------


def token_key(token: bytes) -> bytes:
    """A token of bounded length: itself, or its digest, which is longer than any token
    that stands for itself."""
    return token if len(token) <= KEY_BYTES else b"sha256:" + hashlib.sha256(token).hexdigest().encode()


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lowered; ``bytes`` methods know ASCII letters and spaces only."""
    return [t if len(t) <= KEY_BYTES else token_key(t) for t in text.lower().split()]


def distinct_tokens(text: bytes) -> Counter[bytes]:
    """Tokens of a text, the end among them, with their numbers."""
    counted = Counter(text.lower().split())
    for t in [t for t in counted if len(t) > KEY_BYTES]:
        counted[token_key(t)] += counted.pop(t)
    counted[END] = 1
    return counted


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])
        counts.clear()

    for batch in batches:
        for text in as_bytes(batch.column(0)):
            counts.update(tokens(text or b""))
            counts[END] += 1
            if len(counts) > VOCABULARY:
                yield from flush()
    yield from flush()


def gram_hashes(words: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams, n = 1 ... ``order``, that end at the begin of a text, at each
    of its words and at its end."""
    padded = np.concatenate([np.full(order, _BEGIN), words, [_END]])
    out = [mix(padded ^ _STEP)]
    for _ in range(1, order):
        out.append(mix(out[-1][:-1] * _MUL + padded[-len(out[-1]) + 1 :]))
    return [g[-len(words) - 2 :] for g in out]


# --- the filter ------------------------------------------------------------------------


def _window(grams: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with their sums."""
    keys, n = np.concatenate(grams), np.concatenate(times)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _part_and_key(grams: np.ndarray, part_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's leading bits choose its part; the next 48 are its key in there."""
    part = (grams >> np.uint64(64 - part_bits)).astype(np.int64)
    return part, (grams << np.uint64(part_bits)) >> np.uint64(16)


def _gram_counts(order: int, part_bits: int):
    """Packed runs of counted n-grams: part, keys of 6 bytes each, counts of 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])

        def flush() -> Iterator[pa.RecordBatch]:
            if not held[0]:
                return
            grams, n = _window(*held)
            part, key = _part_and_key(grams, part_bits)
            first = np.flatnonzero(np.diff(part, prepend=-1))
            packed = np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, :6]
            n = np.minimum(n, 0xFFFFFFFF).astype("<u4")
            for some in np.array_split(first, -(-len(first) // 256)):
                ends = [int(first[i]) if i < len(first) else len(grams) for i in np.searchsorted(first, some) + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[some], pa.int64()),
                        pa.array([packed[a:b].tobytes() for a, b in zip(some, ends)], pa.binary()),
                        pa.array([n[a:b].tobytes() for a, b in zip(some, ends)], pa.binary()),
                    ],
                    names=["part", "keys", "n"],
                )
            held[0].clear()
            held[1].clear()

        size = 0
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for start, end in runs(texts, RUN_BYTES):
                found = [g for words in word_hashes([(t or b"").lower() for t in texts[start:end]]) for g in gram_hashes(words, order)]
                keys, n = _window(found, [np.ones(len(g), np.int64) for g in found])
                held[0].append(keys)
                held[1].append(n)
                size += len(keys)
                if size > WINDOW:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c) of whole positive counts."""
    return np.frexp(counts.astype(np.float64))[1]


def count_of(levels: np.ndarray) -> np.ndarray:
    """The mean of the counts 2^(q-1) ... 2^q - 1 that a level q covers; 0 for level 0."""
    return np.where(levels > 0, 0.75 * np.exp2(levels.astype(np.float64)) - 0.5, 0.0)


def _places(keys: np.ndarray, level: int, hashes: int, n_bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bits of a level of each key."""
    x = mix(keys * _MUL + np.uint64(level * int(_STEP) % (1 << 64)))
    step = (x >> np.uint64(32)) | np.uint64(1)
    size = np.uint64(n_bits) if np.isscalar(n_bits) else n_bits.astype(np.uint64)
    for _ in range(hashes):
        yield ((x & np.uint64(0xFFFFFFFF)) * size) >> np.uint64(32)
        x = x * _STEP + step


def part_filter(keys: np.ndarray, counts: np.ndarray, hashes: int) -> np.ndarray:
    """The bits of one part, half of them set: packed, at least 8."""
    levels = levels_of(counts)
    n_bits = 8 * max(1, int(np.ceil(levels.sum() * hashes / np.log(2) / 8)))
    bits = np.zeros(n_bits, bool)
    for level in range(1, int(levels.max()) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for place in _places(keys, level, hashes, n_bits):
            bits[place] = True
    return np.packbits(bits)


def _filters(hashes: int):
    """The bits of each part, from its packed runs, which come part after part."""

    def built(part: int, keys: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
        packed = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 6)
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, :6] = packed
        grams, n = _window([wide.view(np.uint64).ravel()], [np.frombuffer(b"".join(counts), "<u4").astype(np.int64)])
        bits = part_filter(grams, n, hashes).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([bits], pa.binary()), pa.array([len(grams)], pa.int64())], names=["part", "bits", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []
        for batch in batches:
            for part, key, n in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now and keys:
                    yield built(now, keys, counts)
                    keys, counts = [], []
                now = part
                keys.append(key)
                counts.append(n)
        if keys:
            yield built(now, keys, counts)

    return run


@dataclass(frozen=True)
class Shard:
    """The bits of a range of parts, laid end to end; what is broadcast."""

    first: int  # part
    start: np.ndarray  # bytes, one more than parts
    bits: np.ndarray
    part_bits: int
    hashes: int

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 where none is found or another shard holds it."""
        distinct, back = np.unique(grams, return_inverse=True)  # ascending: parts in turn
        part, key = _part_and_key(distinct, self.part_bits)
        part = part - self.first
        live = np.flatnonzero((part >= 0) & (part < len(self.start) - 1))
        size = 8 * np.diff(self.start)
        live = live[size[part[live]] > 0]
        out = np.zeros(len(distinct), np.uint8)
        level = 1
        while len(live):
            n_bits, base = size[part[live]], 8 * self.start[part[live]]
            hit = np.arange(len(live))
            for place in _places(key[live], level, self.hashes, n_bits):
                at = base[hit] + place[hit].astype(np.int64)
                hit = hit[(self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            live = live[hit]
            out[live] = level
            level += 1
            if level > 64:
                break
        return out[back]


@dataclass
class LanguageModel:
    """A trained model: the tables of parts and of token counts, and their totals."""

    parts: DataFrame  # part, bits, grams
    vocabulary: DataFrame  # token, n
    tokens: int
    distinct: int
    order: int
    part_bits: int
    hashes: int

    def shards(self, limit: int) -> Iterator[Shard]:
        """The filter in ranges of parts of at most ``limit`` bytes each (one part at
        least). Hashes deal parts evenly, so equal ranges are of about one size."""
        n_parts = 1 << self.part_bits
        size = F.sum(F.octet_length("bits") + 8)
        ranges = 1
        while True:
            span = n_parts // ranges
            sizes = self.parts.groupBy(F.expr(f"part div {span}L").alias("r")).agg(size.alias("bytes"))
            if ranges == n_parts or (sizes.agg(F.max("bytes")).first()[0] or 0) <= limit:
                break
            ranges *= 2
        for r in range(ranges):
            rows = self.parts.filter(F.col("part").between(r * span, (r + 1) * span - 1)).select("part", "bits").toArrow()
            bits = dict(zip(rows.column("part").to_pylist(), rows.column("bits").to_pylist()))
            own = [bits.get(p, b"") for p in range(r * span, (r + 1) * span)]
            yield Shard(r * span, np.cumsum([0, *map(len, own)]), np.frombuffer(b"".join(own), np.uint8), self.part_bits, self.hashes)


def train(docs: DataFrame, *, text_col: str = "text", order: int = ORDER, hashes: int = HASHES) -> LanguageModel:
    """A model of all texts of ``docs``, null ones as empty. Every row counts, repeated
    ones too; an empty table gives a model that knows nothing."""
    spark = docs.sparkSession
    texts = docs.select(text_col)
    vocabulary = texts.mapInArrow(_token_counts, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    vocabulary = materialize(vocabulary, "vocabulary")
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    part_bits = max(6, (n * order // PART_TOKENS).bit_length())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << part_bits) // 4)
    grams = texts.mapInArrow(_gram_counts(order, part_bits), "part long, keys binary, n binary")
    grams = grams.repartition(tasks, "part").sortWithinPartitions("part")
    parts = materialize(grams.mapInArrow(_filters(hashes), "part long, bits binary, grams long"), "ngram-filter")
    return LanguageModel(parts, vocabulary, n, v, order, part_bits, hashes)


# --- scores ----------------------------------------------------------------------------


def text_score(levels: np.ndarray, n_tokens: int, n_distinct: int) -> float:
    """log10 probability of a text. ``levels[k]``: those of its (k + 1)-grams that end at
    its begin, at each word and at its end."""
    cut = [levels[0]]
    for own in levels[1:]:
        before = np.concatenate([cut[-1][:1], cut[-1][:-1]])
        cut.append(np.minimum(own, np.minimum(cut[-1], before)))
    counts = [count_of(q) for q in cut]
    p = (counts[0][1:] + 1) / (n_tokens + n_distinct + 1)
    for shorter, own in zip(counts, counts[1:]):
        history = shorter[:-1]
        p = (np.minimum(own[1:], history) + MASS * p) / (history + MASS)
    return float(np.log10(p).sum())


def _frequent_tokens(vocabulary: DataFrame, entries: int) -> dict[bytes, int]:
    """The most frequent tokens with their counts, at most ``entries``: whole classes of
    counts (sixteenths of an octave), from the highest down."""
    octave = F.floor(F.log2("n") * 16)
    least, held = None, 0
    for row in vocabulary.groupBy(octave.alias("c")).count().orderBy(F.desc("c")).collect():
        held += row["count"]
        if held > entries:
            break
        least = row["c"]
    if least is None:
        return {}
    rows = vocabulary.filter(octave >= least).toArrow()
    return dict(zip(rows.column("token").to_pylist(), rows.column("n").to_pylist()))


_RARE = pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int64())]))


def _scored(shard: Broadcast, known: Broadcast | None, n: int, v: int, order: int, index: int, levels_at: int | None, kept: list[int], names: list[str]):
    """One pass over documents. With ``known``, the last: scores and token figures; else
    the texts with the levels found so far."""

    def found_levels(words: list[np.ndarray], before: list[bytes] | None) -> list[np.ndarray]:
        """Levels of each text's n-grams, order by order, end to end."""
        grams = [np.concatenate(gram_hashes(w, order)) for w in words]
        found = shard.value.levels(np.concatenate(grams))
        split = np.split(found, np.cumsum([len(g) for g in grams])[:-1])
        return split if before is None else [np.maximum(a, np.frombuffer(b, np.uint8)) for a, b in zip(split, before)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = np.log10
        for batch in batches:
            texts = [t or b"" for t in as_bytes(batch.column(index))]
            before = None if levels_at is None else batch.column(levels_at).to_pylist()
            for start, end in runs(texts, RUN_BYTES):
                own = texts[start:end]
                levels = found_levels(word_hashes([t.lower() for t in own]), before and before[start:end])
                rest = [batch.column(i).slice(start, end - start) for i in kept]
                if known is None:
                    new = [pa.array([q.tobytes() for q in levels], pa.binary())]
                else:
                    get, figures = known.value.get, ([], [], [], [], [])
                    for text, q in zip(own, levels):
                        counted = distinct_tokens(text)
                        keys, times = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
                        c = np.fromiter(map(get, keys, repeat(0)), np.float64, len(keys))
                        missed, hit = np.flatnonzero(c == 0).tolist(), c > 0
                        rare = [{"token": keys[i], "times": counted[keys[i]]} for i in missed]
                        plain = float((times[hit] * log((c[hit] + 1) / (n + v + 1))).sum())
                        row = (int(times.sum()), int(times[hit].sum()), plain, text_score(q.reshape(order, -1), n, v), rare)
                        for column, value in zip(figures, row):
                            column.append(value)
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), _RARE)
                    new = [pa.array(x, kind) for x, kind in zip(figures, kinds)]
                yield pa.RecordBatch.from_arrays([*rest, *new], names=names)

    return run


def score_documents(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", filter_bytes: int = FILTER_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """The rows of ``docs`` without ``text_col``, with ``n_tokens`` (words and the end),
    ``n_known`` (tokens that training has), ``base_score`` (add-one log10 probability from
    exact counts) and ``score`` (the model's log10 probability).

    Null and empty texts are their end alone. Texts of any length are taken whole. Rows
    are independent: repeated rows, ties and null ids need no rule; an empty table gives
    an empty result. New names that ``docs`` has already get leading underscores.
    """
    spark = docs.sparkSession
    n, v = model.tokens, model.distinct
    table_ = _frequent_tokens(model.vocabulary, frequent)
    known = checked_broadcast(spark, table_, sum(map(len, table_)) + 100 * len(table_))
    names = {c: free_name(docs, c) for c in ("levels", "n_tokens", "n_known", "base_score", "score", "rare", "row")}
    kept = [c for c in docs.columns if c != text_col]

    now, shards = docs, model.shards(filter_bytes)
    shard = next(shards)
    while shard is not None:
        after = next(shards, None)
        sent = checked_broadcast(spark, shard, shard.bits.nbytes + shard.start.nbytes)
        levels_at = now.columns.index(names["levels"]) if names["levels"] in now.columns else None
        index = now.columns.index(text_col)
        if after is None:
            fields = [docs.schema[c] for c in kept]
            schema = T.StructType([*fields, T.StructField(names["n_tokens"], T.LongType()), T.StructField(names["n_known"], T.LongType()), T.StructField(names["base_score"], T.DoubleType()), T.StructField(names["score"], T.DoubleType())])
            schema.add(names["rare"], T.ArrayType(T.StructType([T.StructField("token", T.BinaryType()), T.StructField("times", T.LongType())])))
            run = _scored(sent, known, n, v, model.order, index, levels_at, [now.columns.index(c) for c in kept], [f.name for f in schema])
            now = materialize(now.mapInArrow(run, schema).withColumn(names["row"], F.monotonically_increasing_id()), "scored")
        else:
            schema = extended(docs, **{names["levels"]: T.BinaryType()})
            run = _scored(sent, None, n, v, model.order, index, levels_at, list(range(len(docs.columns))), [f.name for f in schema])
            now = materialize(now.mapInArrow(run, schema), "levels")
        sent.unpersist()
        shard = after

    counts = model.vocabulary.select("token", F.col("n").alias("count"))
    rare = now.select(F.col(names["row"]).alias("row"), F.inline(names["rare"])).join(counts, "token", "left")
    count = F.coalesce(F.col("count"), F.lit(0))
    plain = F.col("times") * F.log10((count + 1) / F.lit(float(n + v + 1)))
    rare = rare.groupBy("row").agg(F.sum(plain).alias("more_score"), F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"))
    rare = rare.select(*[F.col(c).alias(free_name(now, c)) for c in rare.columns])
    row, more_score, more_known = rare.columns
    joined = now.join(rare, now[names["row"]] == rare[row], "left")
    return joined.select(
        *[now[c] for c in kept],
        now[names["n_tokens"]],
        (now[names["n_known"]] + F.coalesce(rare[more_known], F.lit(0))).alias(names["n_known"]),
        (now[names["base_score"]] + F.coalesce(rare[more_score], F.lit(0.0))).alias(names["base_score"]),
        now[names["score"]],
    )


def held_out(id_col: Column) -> Column:
    """Rows that do not teach: crc32 of the id modulo 7 is 2."""
    return F.coalesce(fold(id_col, 7) == 2, F.lit(False))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.filter(F.coalesce(fold(F.col("doc_id"), 7) != 2, F.lit(False))))
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
