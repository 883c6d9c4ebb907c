"""Alignment of two tokenizers' tokens by sparse products of incidence matrices.

Over the bytes of a text, each tokenizer gives a token-byte incidence matrix. The row
products A·Bᵀ (Gustavson: each row of A picks rows of Bᵀ and adds them up) hold the bytes
that an A and a B token share, the overlap links. These walk down a staircase, which falls
in both directions at once exactly where both tokens end: there a group ends. The products
of the two group-incidence matrices are the shared-group links. Matrices are plain CSR
arrays; texts are laid end to end in runs of bounded size, so one product serves many.

Corpus counts: each document gives its distinct linked id pairs, written once with its
other figures. Pairs are counted in bounded summaries a task and added up by Spark. The
most frequent ones (at most ``FREQUENT``) come back as a broadcast table; the rest, none
of which is frequent, are joined.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import checked_broadcast, free_name, materialize, runs, table
from keyline.llm.token_counts import MARK, Encoder, pre_tokens

BYTE_MODEL = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
RUN_BYTES = 1 << 20  # texts laid end to end for one product; one text at least
CHUNK = 1 << 22  # entries that a product expands at a time
COLLAPSE = 1 << 12  # links of a group from which equal tokens in it are one row
FREQUENT = 1 << 20  # pairs in the broadcast table
SUMMARY = 1 << 21  # pairs that a task holds before it passes their counts on
POOL_CHARS = 1 << 22  # characters of pre-tokens that a worker keeps with their ids


# --- sparse matrices -------------------------------------------------------------------


@dataclass(frozen=True)
class Csr:
    """Rows ``start[i]:start[i + 1]`` of columns and values."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray

    @staticmethod
    def of_rows(row: np.ndarray, column: np.ndarray, value: np.ndarray, n_rows: int) -> "Csr":
        """From entries sorted by row."""
        return Csr(np.searchsorted(row, np.arange(n_rows + 1)), column, value)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def _added(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their values."""
    if not len(key):
        return key, value
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(value, first)


def expanded(a: Csr, b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The terms of the row products of ``a`` and ``b``, before equal places are added up:
    row, column and value arrays of about ``CHUNK`` terms (one row of ``b`` at least)."""
    sizes = np.diff(b.start)[a.column]
    ends = np.cumsum(sizes)
    row_of = a.rows()
    at = 0
    while at < len(sizes):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        size = sizes[at:to]
        place = np.repeat(b.start[a.column[at:to]] - (ends[at:to] - size - done), size) + np.arange(int(ends[to - 1]) - done)
        yield np.repeat(row_of[at:to], size), b.column[place], np.repeat(a.value[at:to], size) * b.value[place]
        at = to


def multiply(a: Csr, b: Csr, n_columns: int) -> Csr:
    """The product of ``a`` and ``b`` (``n_columns`` wide) by rows; columns ascend in a row."""
    parts = [_added(row * n_columns + column, value) for row, column, value in expanded(a, b)]
    key, value = parts[0] if len(parts) == 1 else _added(*(np.concatenate(x) for x in zip(*parts))) if parts else (np.zeros(0, np.int64),) * 2
    return Csr.of_rows(key // n_columns, key % n_columns, value, len(a.start) - 1)


def byte_incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that end before ``ends``."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64))


def byte_incidence_t(ends: np.ndarray) -> Csr:
    """Bytes by tokens: each byte lies in one token."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.arange(n + 1), np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), np.ones(n, np.int64))


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> Csr:
    """A tokens by B tokens: the bytes that they share."""
    return multiply(byte_incidence(ends_a), byte_incidence_t(ends_b), max(len(ends_b), 1))


def groups_of(overlaps: Csr, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, numbered in order, from the overlap links."""
    a, b = overlaps.rows(), overlaps.column
    down = np.concatenate([[False], (a[1:] > a[:-1]) & (b[1:] > b[:-1])]) if len(a) else np.zeros(0, bool)
    link = np.cumsum(down)
    group_b = np.zeros(n_b, np.int64)
    group_b[b] = link
    return link[overlaps.start[:-1]], group_b


def shared_group_terms(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Shared-group links as (group, A id, B id, links), from the products of the two
    group-incidence matrices. Tokens are rows; where groups are large, equal ids of a
    group are one row whose value is their number."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    values_a, values_b = np.ones(len(ids_a), np.int64), np.ones(len(ids_b), np.int64)
    if n and int((np.bincount(group_a, minlength=n) * np.bincount(group_b, minlength=n)).max()) > COLLAPSE:
        wide = int(max(ids_a.max(), ids_b.max())) + 1
        key, values_a = _added(group_a * wide + ids_a, values_a)
        group_a, ids_a = key // wide, key % wide
        key, values_b = _added(group_b * wide + ids_b, values_b)
        group_b, ids_b = key // wide, key % wide
    incidence = Csr(np.arange(len(ids_a) + 1), group_a, values_a)
    for row, column, value in expanded(incidence, Csr.of_rows(group_b, np.arange(len(ids_b)), values_b, n)):
        yield group_a[row], ids_a[row], ids_b[column], value


# --- tokenizers ------------------------------------------------------------------------


def _byte_decoder() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: printable Latin-1
    stands for itself, the rest follow from U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Ids and bytes of both tokenizers; one a worker and pair of models.

    A byte-level model whose ids follow its merges is run by the faster library with the
    same vocabulary; that one overflows its stack on thousands of spaces in a row. Such
    texts, and models of other form, go to the library the model is written for. Ids of the
    piece model are worked out once a pre-token and kept in a pool of bounded size.
    """

    _loaded: dict[str, "Tokens"] = {}

    def __init__(self, byte_model: str, piece_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.slow = tokenizers.Tokenizer.from_str(byte_model)
        self.slow.encode_special_tokens = True
        parsed, letters = json.loads(byte_model), _byte_decoder()
        special = {t["content"] for t in parsed["added_tokens"]}
        vocab = parsed["model"]["vocab"]
        plain = {t: i for t, i in vocab.items() if t not in special}
        width = 1 + max(*vocab.values(), *(t["id"] for t in parsed["added_tokens"]))
        self.bytes_a: list[bytes] = [b""] * width
        for t in parsed["added_tokens"]:
            self.bytes_a[t["id"]] = t["content"].encode()
        for t, i in plain.items():
            self.bytes_a[i] = bytes(letters[c] for c in t)
        merges = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
        ranked = all(plain.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(plain) == 256 + len(merges)
        level = parsed["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and parsed["normalizer"] is None
        self.fast = None
        if ranked and level:
            self.fast = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks={self.bytes_a[i]: i for i in plain.values()}, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        n = self.pieces.vocab_size()
        names = self.pieces.id_to_piece(list(range(n)))
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.width_b = n
        self.length_a = np.array([len(b) for b in self.bytes_a])
        self.length_b = np.array([len(b) for b in self.bytes_b])
        Encoder(piece_model)  # checks that pieces do not cross pre-tokens
        self._clear()
        # An id with the mark that follows it in the written form of groups.
        self.inner_a, self.last_a = self._written(width, ","), self._written(width, "|")
        self.inner_b, self.last_b = self._written(n, ","), self._written(n, ";")

    @staticmethod
    def _written(n: int, mark: str) -> np.ndarray:
        return np.array([f"{i}{mark}" for i in range(n)], object)

    @classmethod
    def of(cls, models: tuple[str, str]) -> "Tokens":
        key = hashlib.sha256("\0".join(models).encode()).hexdigest()
        if key not in cls._loaded:
            cls._loaded[key] = cls(models[0], base64.b64decode(models[1]))
        return cls._loaded[key]

    def ids_a(self, text: str) -> np.ndarray:
        """Ids of a space and ``text``, special strings as plain text."""
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
            except BaseException as e:  # the overflow of its stack is no Exception
                if type(e).__name__ != "PanicException":
                    raise
        return np.array(self.slow.encode(" " + text, add_special_tokens=False).ids, np.int64)

    def gives_back(self, ids: np.ndarray, text: str) -> bool:
        """Whether the A tokens' bytes are those of a space and ``text``."""
        return b"".join([self.bytes_a[i] for i in ids.tolist()]) == b" " + text.encode()

    def _learn(self, words: list[str]) -> None:
        """Adds pre-tokens to the pool: their ids, and whether these give their bytes back."""
        # The model puts a space mark before a text; a line break keeps it off a word that follows one.
        bare = [w[0] not in (" ", MARK) and w != "\n" for w in words]
        coded = self.pieces.encode(["\n" + w if b else w[1:] if w != "\n" else w for w, b in zip(words, bare)], num_threads=1)
        mark = [self.pieces.piece_to_id(MARK)]
        coded = [ids[2:] if b else ids[1:] if w == "\n" else ids or mark for w, b, ids in zip(words, bare, coded)]
        self._index.update(zip(words, range(len(self._good), len(self._good) + len(words))))
        ends = np.cumsum([len(ids) for ids in coded]) + len(self._flat)
        flat = array("i", chain.from_iterable(coded))
        self._flat.extend(flat)
        self._start.frombytes(ends.astype("q").tobytes())
        name = self.bytes_b
        encoded = [w.encode() for w in words]
        good = np.ones(len(words), "b")
        sizes = np.diff(np.cumsum(self.length_b[flat])[np.cumsum([len(ids) for ids in coded]) - 1], prepend=0)
        if b"".join([name[i] for i in flat]) != b"".join(encoded) or (sizes != [len(w) for w in encoded]).any():
            good = np.array([b"".join([name[i] for i in ids]) == w for w, ids in zip(encoded, coded)], "b")
        self._good.frombytes(good.tobytes())
        self._held += sum(map(len, words))

    def pool_b(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens of each text as places in the pool, and the pool: ids laid end to
        end, where each pre-token's begin, and which give their bytes back."""
        if self._held > POOL_CHARS:
            self._clear()
        words = [pre_tokens(t) for t in texts]
        missing = set().union(*words).difference(self._index)
        if missing:
            self._learn(list(missing))
        get = self._index.__getitem__
        places = [np.fromiter(map(get, own), np.int64, len(own)) for own in words]
        return places, np.array(self._flat, np.int64), np.array(self._start, np.int64), np.array(self._good, bool)

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._flat, self._start, self._good, self._held = array("i"), array("q", [0]), array("b"), 0


# --- documents -------------------------------------------------------------------------


@dataclass(frozen=True)
class Alignment:
    """One text: token, group and link counts, the distinct linked pairs (A id times the
    width of B, plus the B id; ascending) with their links, and the digest of its groups."""

    n_a: int
    n_b: int
    n_groups: int
    n_overlaps: int
    n_links: int
    pairs: np.ndarray
    links: np.ndarray
    groups_sha256: str


_NONE = Alignment(0, 0, 0, 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64), "")


def taken(pool: np.ndarray, start: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The runs ``start[p]:start[p + 1]`` of ``pool``, end to end."""
    size = start[place + 1] - start[place]
    return pool[np.repeat(start[place] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def align(texts: list[str | None], tokens: Tokens) -> list[Alignment]:
    """The alignment of each text; texts without tokens have zeros, no pairs and no digest."""
    out = [_NONE] * len(texts)
    places, pool, start, good = tokens.pool_b([t or "" for t in texts])
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    for i, (text, place) in enumerate(zip(texts, places)):
        if text and good[place].all():
            a = tokens.ids_a(text)
            if tokens.gives_back(a, text):
                held.append((i, a, taken(pool, start, place)))
    if not held:
        return out
    ids_a, ids_b = np.concatenate([a for _, a, _ in held]), np.concatenate([b for _, _, b in held])
    cut_a, cut_b = np.cumsum([0, *[len(a) for _, a, _ in held]]), np.cumsum([0, *[len(b) for _, _, b in held]])
    overlaps = overlap_links(np.cumsum(tokens.length_a[ids_a]), np.cumsum(tokens.length_b[ids_b]))
    group_a, group_b = groups_of(overlaps, len(ids_b))
    n_groups = int(group_a[-1]) + 1
    cut_group = np.concatenate([group_a[cut_a[:-1]], [n_groups]])  # no group crosses texts

    size_a, size_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    links = np.concatenate([[0], np.cumsum(size_a * size_b)])
    before_a, before_b = np.concatenate([[0], np.cumsum(size_a)]), np.concatenate([[0], np.cumsum(size_b)])

    # Written form: the A ids of a group, then its B ids, each with the mark after it.
    written = np.empty(len(ids_a) + len(ids_b), object)
    last_a = np.diff(group_a, append=n_groups) > 0
    last_b = np.diff(group_b, append=n_groups) > 0
    written[np.arange(len(ids_a)) + before_b[group_a]] = np.where(last_a, tokens.last_a[ids_a], tokens.inner_a[ids_a])
    written[np.arange(len(ids_b)) + before_a[group_b + 1]] = np.where(last_b, tokens.last_b[ids_b], tokens.inner_b[ids_b])

    text_of_group = np.repeat(np.arange(len(held)), np.diff(cut_group))
    space = len(tokens.bytes_a) * tokens.width_b
    parts = [_added(text_of_group[g] * space + a * tokens.width_b + b, n) for g, a, b, n in shared_group_terms(group_a, ids_a, group_b, ids_b)]
    pairs, times = _added(*(np.concatenate(x) for x in zip(*parts)))
    cut_pair = np.searchsorted(pairs, np.arange(len(held) + 1) * space)
    for k, (i, a, b) in enumerate(held):
        joined = "".join(written[cut_a[k] + cut_b[k] : cut_a[k + 1] + cut_b[k + 1]].tolist())[:-1]
        out[i] = Alignment(
            len(a),
            len(b),
            int(cut_group[k + 1] - cut_group[k]),
            int(overlaps.start[cut_a[k + 1]] - overlaps.start[cut_a[k]]),
            int(links[cut_group[k + 1]] - links[cut_group[k]]),
            pairs[cut_pair[k] : cut_pair[k + 1]] - k * space,
            times[cut_pair[k] : cut_pair[k + 1]],
            hashlib.sha256(joined.encode()).hexdigest(),
        )
    return out


_COUNTS = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")


def _aligned(models: Broadcast, index: int, kept: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens.of(models.value)
        for batch in batches:
            texts = batch.column(index).to_pylist()
            for start, end in runs(texts, RUN_BYTES):
                found = align(texts[start:end], tokens)
                columns = [pa.array([getattr(x, c) for x in found], pa.int64()) for c in _COUNTS]
                columns.append(pa.array([x.groups_sha256 for x in found]))
                columns += [pa.array([x.pairs.astype("<i8").tobytes() for x in found], pa.binary()), pa.array([x.links.astype("<i8").tobytes() for x in found], pa.binary())]
                rest = [batch.column(i).slice(start, end - start) for i in kept]
                yield pa.RecordBatch.from_arrays([*rest, *columns], names=names)

    return run


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by pair, added up over at most about ``SUMMARY`` pairs at a time."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])
        held.clear()

    for batch in batches:
        for packed in batch.column(0):
            held.append(np.frombuffer(packed.as_buffer(), "<i8"))
            size += len(held[-1])
            if size >= SUMMARY:
                yield from flush()
                size = 0
    yield from flush()


def pair_counts(aligned: DataFrame, pairs_col: str, width_b: int) -> DataFrame:
    """``pair, n, top``: documents that hold the pair linked, and whether that is the most
    of any pair with its A id (ties included)."""
    counts = aligned.select(pairs_col).mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pair-counts")
    a = F.expr(f"pair div {width_b}L")
    best = counts.groupBy(a.alias("a")).agg(F.max("n").alias("best"))  # a row an id of the A vocabulary
    return counts.withColumn("a", a).join(best, "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))


def frequent_pairs(counts: DataFrame, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, counts and top marks of the most frequent pairs, by pair; at most ``entries``.
    Whole classes of counts (sixteenths of an octave) are taken, from the highest down."""
    octave = F.floor(F.log2("n") * 16)
    least, held = None, 0
    for row in counts.groupBy(octave.alias("c")).count().orderBy(F.desc("c")).collect():
        held += row["count"]
        if held > entries:
            break
        least = row["c"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    rows = counts.filter(octave >= least).toArrow()
    pair, n, top = (rows.column(c).to_numpy() for c in ("pair", "n", "top"))
    order = np.argsort(pair)
    return pair[order], n[order], top[order]


def _looked_up(known: Broadcast, pairs_at: int, links_at: int, kept: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, top = known.value
        for batch in batches:
            n_best, count_sum, missed = [], [], []
            for packed, packed_links in zip(batch.column(pairs_at), batch.column(links_at)):
                own, links = np.frombuffer(packed.as_buffer(), "<i8"), np.frombuffer(packed_links.as_buffer(), "<i8")
                at = np.searchsorted(pair, own)
                hit = np.zeros(len(own), bool)
                inside = at < len(pair)
                hit[inside] = pair[at[inside]] == own[inside]
                found = at[hit]
                n_best.append(int(links[hit][top[found]].sum()))
                count_sum.append(int((links[hit] * n[found]).sum()))
                missed.append([{"pair": p, "links": k} for p, k in zip(own[~hit].tolist(), links[~hit].tolist())])
            new = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(missed, pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *new], names=names)

    return run


def _longs(schema: list[T.StructField], *names: str) -> T.StructType:
    return T.StructType([*schema, *[T.StructField(n, T.LongType()) for n in names]])


def align_documents(docs: DataFrame, *, text_col: str = "text", byte_model: str | None = None, piece_model: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """The rows of ``docs`` without ``text_col``, with ``n_a``, ``n_b``, ``n_groups``,
    ``n_overlaps``, ``n_links`` (links of token places), ``groups_sha256``, ``n_best``
    (links whose pair is in as many documents as any with that A id) and ``count_sum``
    (over links, the documents that hold the pair linked).

    A text is null, empty or not given back byte for byte by a tokenizer: zeros and an
    empty digest. Every row is a document, repeated ones and null ids too; ties of counts
    are all best. Texts of any length are taken whole. An empty table gives an empty
    result. New names that ``docs`` has already get leading underscores.
    """
    spark = docs.sparkSession
    with open(byte_model or public_tokenizers.path(BYTE_MODEL), encoding="utf-8") as f:
        a = f.read()
    with open(piece_model or public_tokenizers.path(PIECE_MODEL), "rb") as f:
        b = base64.b64encode(f.read()).decode()
    models = checked_broadcast(spark, (a, b), len(a.encode()) + len(b))
    width_b = sentencepiece.SentencePieceProcessor(model_proto=base64.b64decode(b)).vocab_size()

    others = [docs.schema[i] for i, c in enumerate(docs.columns) if c != text_col]
    kept = [i for i, c in enumerate(docs.columns) if c != text_col]
    names = {c: free_name(docs, c) for c in (*_COUNTS, "groups_sha256", "pairs", "links", "row", "n_best", "count_sum", "missed")}
    digest = T.StructField(names["groups_sha256"], T.StringType())
    figures = _longs(others, *(names[c] for c in _COUNTS)).add(digest)
    schema = T.StructType([*figures, *[T.StructField(names[c], T.BinaryType()) for c in ("pairs", "links")]])
    first = docs.mapInArrow(_aligned(models, docs.columns.index(text_col), kept, [f.name for f in schema]), schema)
    first = materialize(first.withColumn(names["row"], F.monotonically_increasing_id()), "aligned")

    counts = materialize(pair_counts(first, names["pairs"], width_b), "counted-pairs")
    known = frequent_pairs(counts, frequent)
    known_b = checked_broadcast(spark, known, sum(x.nbytes for x in known))

    columns = first.columns
    at = [i for i, c in enumerate(columns) if c not in (names["pairs"], names["links"])]
    missed = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("links", T.LongType())]))
    schema = _longs([first.schema[i] for i in at], names["n_best"], names["count_sum"]).add(names["missed"], missed)
    looked = _looked_up(known_b, columns.index(names["pairs"]), columns.index(names["links"]), at, [f.name for f in schema])
    second = materialize(first.mapInArrow(looked, schema), "looked-up")

    rest = second.select(F.col(names["row"]).alias("row"), F.inline(names["missed"])).join(counts, "pair")
    rest = rest.groupBy("row").agg(F.sum(F.expr("if(top, links, 0L)")).alias("more_best"), F.sum(F.expr("links * n")).alias("more_sum"))
    rest = rest.select(*[F.col(c).alias(free_name(second, c)) for c in rest.columns])
    row, more_best, more_sum = rest.columns
    joined = second.join(rest, second[names["row"]] == rest[row], "left")
    return joined.select(
        *[second[f.name] for f in figures],
        (second[names["n_best"]] + F.coalesce(rest[more_best], F.lit(0))).alias(names["n_best"]),
        (second[names["count_sum"]] + F.coalesce(rest[more_sum], F.lit(0))).alias(names["count_sum"]),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
