"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over lower-cased UTF-8 bytes, of orders 0 to ``ORDER``.
A byte costs -log2 c/(n+d) in the longest context that has it, where the context was seen
n times with d different bytes; each longer context of the language that lacks the byte
adds its escape, -log2 d/(n+d); a byte unseen everywhere costs 8 bits more. The statistics
are frozen, so the cost depends on the last ``ORDER`` bytes alone, and the costs of all
languages for each n-gram that any language knows are worked out once. Scoring a text is
one table look-up a byte (a few more for n-grams that no language knows) and exact.

Training counts n-grams in Spark over a sample of pieces of labelled rows bounded by
``TRAIN_BYTES`` in all, with one piece of every language at least; the tables are broadcast behind a check of their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import checked_broadcast, extended, fold, free_name, table

ORDER = 4
TRAIN_BYTES = 8 << 20  # of text, over all languages, in expectation
LANGUAGE_BYTES = 2 << 20  # of text, a language at most
PIECE = 1 << 14  # characters of a row that are drawn together
MIN_COUNT = 2  # n-grams of order 3 and up that were seen less are left out of the trees
MAX_NODES = 4_000_000
CHUNK = 1 << 18  # bytes scored at a time
EVIDENCE = 32  # bytes of evidence that a score stands for
ACCEPT = 0.5
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"


class _Table:
    """Open addressing from byte n-grams packed in uint64 to row numbers, looked up in bulk."""

    _MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._row = np.full(1 << bits, -1, np.int32)
        self._key = np.zeros(1 << bits, np.uint64)
        todo, place = np.arange(len(keys)), self._home(keys)
        self._probes = 0
        while len(todo):
            free = self._row[place] < 0
            claim = todo[free]
            self._row[place[free]] = claim  # of several claims to a slot one stays
            won = self._row[place] == todo
            self._key[place[won]] = keys[todo[won]]
            todo, place = todo[~won], (place[~won] + 1) & self._mask
            self._probes += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self._MIX) >> self._shift).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 for a key that is not there."""
        place = self._home(keys)
        out = self._row[place]
        wrong = np.flatnonzero((out >= 0) & (self._key[place] != keys))
        for _ in range(self._probes):
            if not len(wrong):
                break
            place[wrong] = (place[wrong] + 1) & self._mask
            row = self._row[place[wrong]]
            out[wrong] = row
            wrong = wrong[(row >= 0) & (self._key[place[wrong]] != keys[wrong])]
        out[wrong] = -1
        return out

    def nbytes(self) -> int:
        return self._row.nbytes + self._key.nbytes


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """At each byte, it and the ``order`` bytes before it as one number (zeros before the start)."""
    out = np.zeros(len(data), np.uint64)
    for j in range(min(order + 1, len(data))):
        out[j:] |= data[: len(data) - j].astype(np.uint64) << np.uint64(8 * j)
    return out


class PpmModel:
    """Frozen context trees of several languages."""

    def __init__(self, languages: list[str], counts: pd.DataFrame, order: int = ORDER):
        """``counts``: columns language (index), order, key, n."""
        self.languages, self.order = languages, order
        width = len(languages)
        self._grams: list[_Table] = []
        self._cost: list[np.ndarray] = []
        self._contexts: list[_Table | None] = []
        self._escape: list[np.ndarray | None] = []
        self._floor = np.full(width, 8.0)
        for k in range(order + 1):
            c = counts[counts["order"] == k]
            key = c["key"].to_numpy().astype(np.uint64)
            lang, n = c["language"].to_numpy(), c["n"].to_numpy().astype(float)
            grams, gram_row = np.unique(key, return_inverse=True)
            contexts, context_row = np.unique(key >> np.uint64(8), return_inverse=True)
            total = np.zeros((len(contexts), width))
            distinct = np.zeros((len(contexts), width))
            np.add.at(total, (context_row, lang), n)
            np.add.at(distinct, (context_row, lang), 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            # Start from the escape to the next lower order, then set what a language has seen.
            if k == 0:
                self._floor = 8.0 + (escape[0] if len(escape) else np.zeros(width))
                cost = np.tile(self._floor, (len(grams), 1))
            else:
                lower = self._grams[k - 1].rows(grams & np.uint64((1 << (8 * k)) - 1))
                cost = np.where((lower >= 0)[:, None], self._cost[k - 1][lower] if len(self._cost[k - 1]) else self._floor, self._floor)
                cost = cost + escape[np.searchsorted(contexts, grams >> np.uint64(8))]
            cost[gram_row, lang] = -np.log2(n / (total + distinct)[context_row, lang])
            self._grams.append(_Table(grams))
            self._cost.append(cost.astype(np.float32))
            self._contexts.append(_Table(contexts) if k else None)
            self._escape.append(escape.astype(np.float32) if k else None)

    def nbytes(self) -> int:
        tables = [*self._grams, *[t for t in self._contexts if t]]
        return sum(t.nbytes() for t in tables) + sum(a.nbytes for a in [*self._cost, *[e for e in self._escape if e is not None]])

    def _byte_costs(self, data: np.ndarray, offset: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Bits of each byte under each language; ``offset``: bytes of its text before it."""
        grams = _grams(data, self.order)
        cost = np.zeros((len(data), len(self.languages)), np.float32)
        todo = np.flatnonzero(wanted)
        for k in range(self.order, -1, -1):
            deep = offset[todo] >= k
            at = todo[deep]
            row = self._grams[k].rows(grams[at] & np.uint64((1 << (8 * k + 8)) - 1))
            hit = row >= 0
            cost[at[hit]] += self._cost[k][row[hit]]
            missed = at[~hit]
            if k and len(missed):
                row = self._contexts[k].rows((grams[missed] >> np.uint64(8)) & np.uint64((1 << (8 * k)) - 1))
                known = row >= 0
                cost[missed[known]] += self._escape[k][row[known]]
            todo = np.concatenate([todo[~deep], missed])
        cost[todo] += self._floor.astype(np.float32)
        return cost

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language, in pieces of at most ``CHUNK`` bytes."""
        out = np.zeros((len(texts), len(self.languages)))
        pieces: list[tuple[int, bytes, int]] = []
        size = 0
        for i, t in enumerate(texts):
            for start in range(0, len(t), CHUNK):
                back = min(start, self.order)
                piece = t[start - back : start + CHUNK]
                if pieces and size + len(piece) > CHUNK:
                    self._add(out, pieces)
                    pieces, size = [], 0
                pieces.append((i, piece, back))
                size += len(piece)
        if pieces:
            self._add(out, pieces)
        return out

    def _add(self, out: np.ndarray, pieces: list[tuple[int, bytes, int]]) -> None:
        data = np.frombuffer(b"".join(p for _, p, _ in pieces), np.uint8)
        lengths = np.array([len(p) for _, p, _ in pieces])
        starts = np.cumsum(lengths) - lengths
        offset = np.arange(len(data)) - np.repeat(starts, lengths)
        wanted = offset >= np.repeat(np.array([b for _, _, b in pieces]), lengths)
        sums = np.add.reduceat(self._byte_costs(data, offset, wanted).astype(np.float64), starts, axis=0)
        np.add.at(out, np.array([i for i, _, _ in pieces]), sums)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each whole text. The score is the posterior share of the
        best language after ``EVIDENCE`` bytes (or the text, if shorter) at the text's mean
        costs: near 1 where one language fits best, 1 / languages where none does."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        raw = [t.lower().encode("utf-8", "surrogatepass") if t and LETTER.search(t) else b"" for t in texts]
        bits, n = self.code_lengths(raw), np.array([len(t) for t in raw], float)
        excess = (bits - bits.min(axis=1, keepdims=True)) * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
        share = 1 / np.exp2(-np.minimum(excess, 500)).sum(axis=1)
        best = bits.argmin(axis=1)
        return (
            [self.languages[b] if t else UNDETERMINED for b, t in zip(best, raw)],
            [float(s) if t else 0.0 for s, t in zip(share, raw)],
        )


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array(batch.column(0).to_pylist(), np.int64)
            texts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for lang in np.unique(codes):
                held: list[bytes] = []
                for i in np.flatnonzero(codes == lang):
                    held += [texts[i][s : s + CHUNK] for s in range(0, len(texts[i]), CHUNK)]
                    if sum(map(len, held)) > 4 * CHUNK:
                        yield from _counted(held, int(lang), order)
                        held = []
                yield from _counted(held, int(lang), order)

    return run


def _counted(texts: list[bytes], lang: int, order: int) -> Iterator[pa.RecordBatch]:
    if not texts:
        return
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    offset = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    grams = _grams(data, order)
    for k in range(order + 1):
        keys, n = np.unique(grams[offset >= k] & np.uint64((1 << (8 * k + 8)) - 1), return_counts=True)
        arrays = [np.full(len(keys), lang), np.full(len(keys), k), keys.astype(np.int64), n]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["language", "order", "key", "n"])


def _draw(k: Column) -> Column:
    """Draw of piece ``k`` of a row, in [0, 1)."""
    seed = F.lit("language sample")
    hashed = F.when(k == 0, F.xxhash64(seed, F.col("id"))).otherwise(F.xxhash64(seed, F.col("id"), k))
    return F.pmod(hashed, F.lit(1 << 20)) / float(1 << 20)


def train(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER) -> PpmModel:
    """Context trees of the languages of ``labelled``. Rows with null label, text or id
    teach nothing. Pieces of at most ``PIECE`` characters are picked by a hash of the row's
    id and their place, at one rate a language, so that a language gives ``LANGUAGE_BYTES``,
    and all give ``TRAIN_BYTES``, in expectation. The piece of a language with the least
    hash is always picked, so that no language with text goes untaught."""
    rows = labelled.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull())
    last = F.greatest(F.lit(0), F.floor((F.length("text") - 1) / PIECE)).cast("int")
    draws = F.transform(F.sequence(F.lit(0), last), _draw)
    least = F.min(F.when(F.length("text") > 0, F.array_min(draws))).alias("least")
    found = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("b"), least).collect()
    sizes = {r["lang"]: r["b"] for r in found}
    leasts = {r["lang"]: 0.0 if r["least"] is None else r["least"] for r in found}
    languages = sorted(sizes)
    if not languages:
        return PpmModel([], pd.DataFrame({c: pd.Series(dtype="int64") for c in ("language", "order", "key", "n")}), order)
    each = min(LANGUAGE_BYTES, TRAIN_BYTES // len(languages))
    rates = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, each / max(1, sizes[lang])))])
    codes = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    first = F.create_map(*[F.lit(x) for lang in languages for x in (lang, leasts[lang])])
    lang = F.col("lang")
    picked = F.filter(F.sequence(F.lit(0), last), lambda k: (_draw(k) < rates[lang]) | (_draw(k) <= first[lang]))
    pieces = F.transform(picked, lambda k: F.substr(F.col("text"), k * PIECE + 1, F.lit(PIECE)))
    sample = rows.select(codes[lang].cast("long").alias("code"), F.explode(pieces).alias("text"))
    counts = sample.mapInArrow(_count(order), "language long, order long, key long, n long")
    counts = counts.groupBy("language", "order", "key").agg(F.sum("n").alias("n"))
    kept = counts.filter((F.col("order") < 3) | (F.col("n") >= MIN_COUNT)).limit(MAX_NODES + 1).toPandas()
    if len(kept) > MAX_NODES:
        raise ValueError(f"the context trees have over {MAX_NODES} nodes; lower TRAIN_BYTES")
    return PpmModel(languages, kept.sort_values(["order", "key", "language"]), order)


def _predicted(model: Broadcast, index: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = model.value.predict(batch.column(index).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=names)

    return run


def identify(docs: DataFrame, model: PpmModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    Null text, and text without a letter, is ``und`` with score 0; so is everything if
    no language was learned. Equal costs go to the language first by code point. Texts of
    any length are scored whole. Rows are independent, so repeated rows and null ids need
    no rule; an empty table gives an empty result. Where ``docs`` already has a column of
    that name, the new one gets leading underscores.
    """
    new = {free_name(docs, "lang_pred"): T.StringType(), free_name(docs, "score"): T.DoubleType()}
    schema = extended(docs, **new)
    broadcast = checked_broadcast(docs.sparkSession, model, model.nbytes())
    return docs.mapInArrow(_predicted(broadcast, docs.columns.index(text_col), [f.name for f in schema]), schema)


def teaches(id_col: Column) -> Column:
    """Rows that may teach: crc32 of the id modulo 4 is not 2."""
    return F.coalesce(fold(id_col, 4) != 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(teaches(F.col("doc_id"))))
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
