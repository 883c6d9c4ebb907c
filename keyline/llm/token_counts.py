"""Token counts of a SentencePiece BPE model by a map-side two-tier lookup.

No piece of such a model has a space mark after another character, or a line break, so
no merge crosses the cut before a run of spaces or around a line break: the count of a
text is the sum over its pre-tokens (a run of spaces with the run of other characters
after it). The first pass counts pre-tokens over all documents in bounded summaries, one
a task, and the most frequent ones, with their counts of tokens, are broadcast as a
compact hash table. The second pass looks every pre-token up there; a miss goes through
the worker's own bounded cache to the encoder. Pre-tokens are never shuffled; the
summaries are at most ``SUMMARY`` rows a task. The table only saves work: whatever is in
it, the counts are the encoder's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import checked_broadcast, extended, free_name, table

MODEL = "piece_bpe_32k.model"
MAX_TOKENS = 4096
FREQUENT = 65_536  # entries of the broadcast table
SUMMARY = 16_384  # entries that one task's summary keeps
KEY_CHARS = 48  # longer pre-tokens are never in the table
CACHE = 200_000  # entries of a worker's cache
MARK = "▁"
PRE_TOKEN = re.compile(rf"\n|[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+")


class Encoder:
    """Counts of tokens of pre-tokens, for one model; the cache lives as long as the worker."""

    _loaded: dict[bytes, "Encoder"] = {}

    def __init__(self, proto: bytes):
        self._sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self._cache: dict[str, int] = {}
        sp = self._sp
        normal = [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
        if any(re.search(rf"[^{MARK}]{MARK}|\n", p) for p in normal) or sp.encode(" ", out_type=str) != [MARK * 2]:
            raise ValueError("the model's pieces cross pre-tokens, or it normalises white space")

    @classmethod
    def of(cls, proto: bytes) -> "Encoder":
        if proto not in cls._loaded:
            cls._loaded[proto] = cls(proto)
        return cls._loaded[proto]

    def count(self, pre_token: str) -> int:
        """Tokens of a pre-token as part of a text; the encoder puts one space mark first."""
        n = self._cache.get(pre_token)
        if n is None:
            if pre_token in ("\n", " ", MARK):
                n = 1
            elif pre_token[0] in (" ", MARK):
                n = len(self._sp.encode(pre_token[1:]))
            else:  # after a line break: no space mark; "\n" itself adds the mark and one byte
                n = len(self._sp.encode("\n" + pre_token)) - 2
            if len(self._cache) >= CACHE:
                self._cache.clear()
            self._cache[pre_token] = n
        return n


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text; the encoder sees a space before a text that is not empty."""
    return PRE_TOKEN.findall(" " + text) if text else []


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(pre_tokens(text or ""))
            if len(counts) > 8 * SUMMARY:
                counts = Counter(dict(counts.most_common(4 * SUMMARY)))
    top = [(k, n) for k, n in counts.most_common(SUMMARY) if len(k) <= KEY_CHARS and n > 1]
    if top:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top]), pa.array([n for _, n in top], pa.int64())], names=["pre", "n"])


def frequent_lengths(docs: DataFrame, text_col: str, proto: bytes, entries: int = FREQUENT) -> Broadcast:
    """Broadcast table pre-token -> tokens of the ``entries`` most frequent pre-tokens.
    Its size is bound by ``entries`` keys of at most ``KEY_CHARS`` characters."""
    summaries = docs.select(text_col).mapInArrow(_summaries, "pre string, n long")
    top = summaries.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(entries).collect()
    encoder = Encoder.of(proto)
    lengths = {r["pre"]: encoder.count(r["pre"]) for r in top}
    return checked_broadcast(docs.sparkSession, lengths, sum(4 * len(k) + 100 for k in lengths))


def _counted(model: Broadcast, lengths: Broadcast, index: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = Encoder.of(model.value), lengths.value
        get, count = known.get, encoder.count
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(index).to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(sum([get(p) or count(p) for p in pre_tokens(text)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], names=names)

    return run


def count_tokens(docs: DataFrame, *, text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """``docs`` with the columns ``n_bytes`` (UTF-8) and ``n_tokens``.

    Counts are those of the encoder for the whole text, without begin or end tokens;
    null counts as empty, empty has no tokens. Rows are independent: repeated rows,
    ties and null ids need no rule; an empty table gives an empty result. Where ``docs``
    already has a column ``n_bytes`` or ``n_tokens``, the new one gets leading underscores.
    """
    spark = docs.sparkSession
    with open(model_path or public_tokenizers.path(MODEL), "rb") as f:
        proto = f.read()
    lengths = frequent_lengths(docs, text_col, proto)
    model = checked_broadcast(spark, proto, len(proto))
    new = [free_name(docs, "n_bytes"), free_name(docs, "n_tokens")]
    schema = extended(docs, **{name: T.LongType() for name in new})
    run = _counted(model, lengths, docs.columns.index(text_col), [f.name for f in schema])
    return docs.mapInArrow(run, schema)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))
