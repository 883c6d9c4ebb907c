"""Toxicity by compression distance.

Text is cut into windows of ``WINDOW_WORDS`` lower-cased words. Two zstandard dictionaries
of one size are trained: both end with what ordinary text is made of, and the toxic one
begins with the byte strings that tell toxic documents from ordinary ones, where the
ordinary one has filler. A window without such a string thus compresses to the same length
under both; one that holds any, as a word or as the stem of a word never seen, gets
shorter under the toxic dictionary. The differences of a text's windows are counted at
every size, and a logistic calibration of these counts, fitted on the labelled rows with
both classes of one weight, turns them into a score.

The strings are runs of ``GRAM_MIN`` to ``GRAM_MAX`` bytes within words (with their
spaces) of toxic documents, chosen by log-likelihood gain among those that hardly an
ordinary document has. Words of labelled rows are counted in Spark; dictionaries and
calibration come from a sample of whole labelled rows bounded by ``TRAIN_DOCS`` a class,
in expectation.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import checked_broadcast, extended, fold, free_name, materialize, table

TRAIN_DOCS = 20_000  # labelled rows a class
WINDOW_WORDS = 4
ORDINARY_BYTES = 24 << 10  # of the dictionaries' common part
TOXIC_BYTES = 1 << 10  # of what the toxic dictionary has besides
GRAM_MIN, GRAM_MAX = 5, 12  # bytes of a telling string
CANDIDATES = 8_192  # strings that are weighed against ordinary documents
IMPURITY = 0.001  # share of ordinary documents that may have a telling string
EVIDENCE = 10.0  # least log-likelihood gain of a telling string
LEVEL = 12
# The compressor looks for no match in the last 8 bytes; these are the same in all windows.
TAIL = b"\n" * 8
MAX_DIFFERENCE = 8
MAX_WORD = 64  # characters; a longer word is cut into words of this length
TOGETHER = 20_000  # windows that are compressed in one call
TOXIC_SCORE = 0.7
WORD = regex.compile(rf"[\p{{L}}\p{{N}}]{{1,{MAX_WORD}}}")


def words(text: str | None) -> list[str]:
    """Words of the whole text, lower-cased."""
    return WORD.findall(text.lower()) if text else []


def windows(text: str | None) -> list[bytes]:
    """Windows of the whole text, each with a space on either side and the tail."""
    own = words(text)
    return [f" {' '.join(own[i : i + WINDOW_WORDS])} ".encode() + TAIL for i in range(0, len(own), WINDOW_WORDS)]


def grams(word: str) -> set[bytes]:
    """Byte strings within a word and its spaces."""
    raw = f" {word} ".encode()
    return {raw[i : i + n] for n in range(GRAM_MIN, GRAM_MAX + 1) for i in range(len(raw) - n + 1)}


def _dictionary(parts: list[str], limit: int) -> bytes:
    """Words, the first one last: nearer the end is cheaper to refer to."""
    out, size = [], 0
    for w in parts:
        raw = f" {w} ".encode()
        if size + len(raw) > limit:
            break
        out.append(raw)
        size += len(raw)
    return b"".join(reversed(out))


def _telling(parts: list[bytes], limit: int) -> bytes:
    """Strings end to end, none that an earlier one holds."""
    out = b""
    for raw in parts:
        if raw not in out and len(out) + len(raw) <= limit:
            out += raw
    return out


class CompressionModel:
    """The two dictionaries and the calibration; small enough to pickle."""

    def __init__(self, ordinary: list[str], toxic: list[bytes]):
        common, telling = _dictionary(ordinary, ORDINARY_BYTES), _telling(toxic, TOXIC_BYTES)
        self._contents = (b"\x01" * len(telling) + common, telling + common) if telling else ()
        self.weights = np.zeros(2 * MAX_DIFFERENCE + 1)
        self.mean, self.scale = np.zeros(2 * MAX_DIFFERENCE), np.ones(2 * MAX_DIFFERENCE)
        self._compressors: list[zstandard.ZstdCompressor] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def nbytes(self) -> int:
        return sum(map(len, self._contents)) + 10_000

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)

    def differences(self, raw: list[bytes]) -> np.ndarray:
        """Bytes that each window is shorter under the toxic dictionary."""
        if not self._contents:
            return np.zeros(len(raw), np.int64)
        if self._compressors is None:
            self._compressors = [self._compressor(c) for c in self._contents]
        lengths = []
        for compressor in self._compressors:
            own: list[int] = []
            for start in range(0, len(raw), TOGETHER):
                out = compressor.multi_compress_to_buffer(raw[start : start + TOGETHER])
                own += [len(out[i]) for i in range(len(out))]
            lengths.append(np.array(own, np.int64))
        return lengths[0] - lengths[1]

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Of each whole text: windows that differ by at least 1, 2, ... bytes, as log
        counts and shares."""
        out = np.zeros((len(texts), 2 * MAX_DIFFERENCE))
        for row, text in enumerate(texts):
            raw = windows(text)
            if raw:
                at = np.bincount(np.clip(self.differences(raw), 0, MAX_DIFFERENCE), minlength=MAX_DIFFERENCE + 1)
                least = np.cumsum(at[::-1])[::-1][1:]
                out[row, :MAX_DIFFERENCE] = np.log1p(least)
                out[row, MAX_DIFFERENCE:] = least / len(raw)
        return out

    def calibrate(self, features: np.ndarray, toxic: np.ndarray) -> None:
        """Ridge logistic regression by Newton steps; both classes weigh the same."""
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))])
        weight = np.where(toxic == 1, (toxic == 0).sum() / max(1, (toxic == 1).sum()), 1.0)
        ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
        w = np.zeros(x.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (toxic - p)) - ridge @ w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = (self.features(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the batch that have each word, by class."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for w in set(words(text)):
                counts.setdefault(w, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *[pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1)]],
            names=["w", "ordinary", "toxic"],
        )


def _gram_counts(known: frozenset[bytes] | None):
    """Documents that have each string, by a count of their words (``w``, ``n``): strings
    of ``known``, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = grams(w) if known is None else grams(w) & known
                counts.update(dict.fromkeys(own, n))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["g", "n"])

    return run


def telling_strings(counts: DataFrame, n: dict[int, float]) -> list[bytes]:
    """Strings by falling gain, from the words' document counts ``w, ordinary, toxic``.
    Candidates are the ``CANDIDATES`` most frequent strings of words that several toxic
    documents and hardly an ordinary one have; their ordinary documents are then counted
    over all words."""
    rare = F.col("ordinary") <= IMPURITY * n[0]
    own = counts.filter((F.col("toxic") > 1) & rare).select("w", F.col("toxic").alias("n"))
    own = own.mapInArrow(_gram_counts(None), "g binary, n long").groupBy("g").agg(F.sum("n").alias("n"))
    toxic = {bytes(r["g"]): r["n"] for r in own.filter("n > 2").orderBy(F.desc("n"), "g").limit(CANDIDATES).collect()}
    if not toxic:
        return []
    others = counts.filter("ordinary > 0").select("w", F.col("ordinary").alias("n"))
    others = others.mapInArrow(_gram_counts(frozenset(toxic)), "g binary, n long").groupBy("g").agg(F.sum("n").alias("n"))
    ordinary = {bytes(r["g"]): r["n"] for r in others.collect()}  # at most CANDIDATES rows
    gain = {
        g: c * math.log(((c + 0.5) / (n[1] + 1)) / ((ordinary.get(g, 0) + 0.5) / (n[0] + 1)))
        for g, c in toxic.items()
        if ordinary.get(g, 0) <= IMPURITY * n[0]
    }
    return sorted((g for g, x in gain.items() if x >= EVIDENCE), key=lambda g: (-gain[g], -len(g), g))


def _feature_rows(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.value.features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    return run


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> CompressionModel:
    """Dictionaries and calibration from ``docs`` and their ``labels``. Rows with a null
    label, id or text teach nothing, an id that is labelled twice is toxic if any label says so; with one class only (or none) every score is that
    class's share. The sample is drawn from the labels, so that only its ids (bounded by
    ``TRAIN_DOCS``) meet the documents, which are not shuffled."""
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("toxic"))
    marked = marked.filter(F.col("toxic").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    spark = docs.sparkSession
    rate = {k: min(1.0, TRAIN_DOCS / max(1, sizes.get(k, 0))) for k in (0, 1)}
    draw = F.pmod(F.xxhash64(F.lit("toxicity sample"), "id"), F.lit(1 << 20)) / float(1 << 20)
    drawn = marked.filter(draw < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("text is not null")
    side = F.broadcast(drawn) if drawn.count() <= 4 * TRAIN_DOCS else drawn  # ids of the sample
    sample = materialize(rows.join(side, "id").select("text", "toxic"), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n = {k: max(1.0, float(sizes.get(k, 0))) for k in (0, 1)}

    counts = sample.mapInArrow(_distinct_words, "w string, ordinary long, toxic long")
    counts = materialize(counts.groupBy("w").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "toxicity-words")
    # A word is at least 3 bytes with its spaces, which bounds what the dictionary can hold.
    common = counts.filter("ordinary > 1").orderBy(F.desc("ordinary"), "w").limit(ORDINARY_BYTES // 3)
    model = CompressionModel([r["w"] for r in common.collect()], telling_strings(counts, n))

    rows_x = sample.mapInArrow(_feature_rows(checked_broadcast(spark, model, model.nbytes())), "x array<double>, toxic int")
    fitted = rows_x.toPandas()
    if sizes.get(0) and sizes.get(1) and fitted["toxic"].nunique() == 2:
        order = fitted.assign(x=fitted["x"].map(tuple)).sort_values(["toxic", "x"])  # sums in one order on every run
        model.calibrate(np.array(order["x"].tolist()), order["toxic"].to_numpy(float))
    else:
        share = min(1 - 1e-6, max(1e-6, sizes.get(1, 0) / max(1, sum(sizes.values()))))
        model.weights[-1] = math.log(share / (1 - share))
    return model


def _scored(model: Broadcast, index: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.value.scores(batch.column(index).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    return run


def score_toxicity(docs: DataFrame, model: CompressionModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1, from the text alone.

    Null and empty text, or text without a word, gets the score of no evidence. Texts of
    any length are scored whole. Rows are independent, so repeated rows, ties and null ids
    need no rule; an empty table gives an empty result. Where ``docs`` already has a
    column ``score``, the new one gets leading underscores.
    """
    name = free_name(docs, "score")
    schema = extended(docs, **{name: T.DoubleType()})
    broadcast = checked_broadcast(docs.sparkSession, model, model.nbytes())
    return docs.mapInArrow(_scored(broadcast, docs.columns.index(text_col), [f.name for f in schema]), schema)


def teaches(id_col: Column) -> Column:
    """Rows that may teach: crc32 of the id modulo 3 is not 1."""
    return F.coalesce(fold(id_col, 3) != 1, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(teaches(F.col("doc_id")))
    model = train(docs, labels)
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))
