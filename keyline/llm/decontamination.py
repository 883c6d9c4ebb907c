"""Benchmark decontamination: SimHash windows, Hamming index, exact verification.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text. The
first and the last words of an item, as many as the largest window size within it, and
short tiles all over it are fingerprinted; so is every window of these sizes of every whole document (differences of
running sums of the words' bit votes). Fingerprints have 64 bits in four blocks, and
within a distance of 7 at least one block differs in at most one bit; each block of an
item is indexed under its value and the 16 values one bit away, so the index misses no
window within the radius. Every window found is laid over the whole item and kept if the
weighted Jaccard similarity of their 5-word shingles, worked out exactly, is 0.75 or more.
A shingle weighs the more the fewer items of the whole benchmark have it.

Distinct item texts are collected in blocks, bounded by the bytes of their index, and
broadcast one block a pass, one at a time; the ids of the items that have a text join its hits in Spark.
The query and ``clean`` never shuffle documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import checked_broadcast, extended, free_name, materialize, runs, table
from keyline.llm.shingles import PLAIN, SHINGLE, shingle_hashes, word_hashes

SIMILARITY = 0.75
RADIUS = 7
BLOCKS = 4
BLOCK_BYTES = 16 << 20  # of index entries in one broadcast; the tables of window sizes come on top
ENTRY = 4 * 17 * 4 + 48  # bytes of a fingerprint in the index
SHINGLE_ENTRY = 150
CHUNK = 8_192  # windows fingerprinted at a time
SLICE = 1 << 20  # characters of documents hashed at a time
HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("similarity", T.DoubleType())])
TEXT_HIT = T.StructType([T.StructField("item_id", T.StringType()), *HIT.fields[1:]])  # by the digest of the item's text


def window_size(n: int) -> int:
    """The largest of 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, ... within ``n`` words."""
    size = 1
    for power in range(n.bit_length() + 1):
        for w in (1 << power, 3 << power):
            if size < w <= n:
                size = w
    return size


def item_windows(n: int) -> dict[int, list[int]]:
    """Offsets of the fingerprinted windows of an item of ``n`` words, by size: head and tail
    of its window size, and from 12 words on tiles of 6 or 8 words next to each other. Of
    shingles that weigh the same, fewer than a quarter may change at 0.75, which leaves at
    least one tile (or, below 12 words, head or tail) without a changed word."""
    size = window_size(n)
    out = {size: sorted({0, n - size})}
    if size >= 12:
        tile = 6 if size < 24 else 8
        out[tile] = sorted({*range(0, n - tile + 1, tile), n - tile})
    return out


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    return word_hashes([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts], PLAIN)


def _running_votes(words: np.ndarray, longest: int) -> np.ndarray:
    """Running sums of +1 / -1 a bit. Sums may wrap; differences within a window do not, as
    its votes fit: 16 bits for windows below 32,768 words, else 32."""
    kind = np.int16 if longest < 1 << 15 else np.int32
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1).astype(kind)
    votes = np.zeros((len(words) + 1, 64), kind)
    np.cumsum(2 * bits - 1, axis=0, out=votes[1:])
    return votes


def _fingerprints(votes: np.ndarray, size: int) -> np.ndarray:
    return np.packbits(votes[size:] - votes[:-size] > 0, axis=1).view(np.uint64).ravel()


class _Windows:
    """The items' fingerprints of one window size, indexed by blocks."""

    def __init__(self, prints: list[int], items: list[int], offsets: list[int]):
        self.prints = np.array(prints, np.uint64)
        self.items, self.offsets = np.array(items), np.array(offsets)
        blocks = self.prints.view(np.uint16).reshape(-1, BLOCKS)
        near = np.array([0, *[1 << b for b in range(16)]], np.uint16)
        self.starts, self.entries, self.some = [], [], []
        for b in range(BLOCKS):
            values = (blocks[:, b][:, None] ^ near[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.entries.append(np.repeat(np.arange(len(prints), dtype=np.int32), len(near))[order])
            self.starts.append(np.searchsorted(values[order], np.arange((1 << 16) + 1)).astype(np.int32))
            self.some.append(np.diff(self.starts[-1]) > 0)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, entry) of all pairs within the radius, each once."""
        blocks = prints.view(np.uint16).reshape(-1, BLOCKS)
        pairs = []
        for b in range(BLOCKS):
            own = blocks[:, b]
            some = np.flatnonzero(self.some[b][own])
            value = own[some].astype(np.int64)
            low = self.starts[b][value].astype(np.int64)
            n = self.starts[b][value + 1] - low
            entry = self.entries[b][np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            place = np.repeat(some, n)
            close = np.bitwise_count(prints[place] ^ self.prints[entry]) <= RADIUS
            pairs.append(place[close] * len(self.prints) + entry[close])
        return np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.prints)))


class BenchmarkIndex:
    """Items of one block: words, fingerprints, shingles with weights."""

    def __init__(self, ids: list, texts: list[str | None], weights: dict[int, float], unseen: float):
        words = words_of(texts)
        self.ids, self.lengths = ids, [len(w) for w in words]
        self.shingles = [np.unique(shingle_hashes(w)).tolist() if len(w) else [] for w in words]
        self.weights, self.unseen = weights, unseen
        held: dict[int, tuple[list[int], list[int], list[int]]] = {}
        for i, w in enumerate(words):
            if not len(w):
                continue
            votes = _running_votes(w, len(w))
            for size, places in item_windows(len(w)).items():
                prints = _fingerprints(votes, size)
                p, items, offsets = held.setdefault(size, ([], [], []))
                p += prints[places].tolist()
                items += [i] * len(places)
                offsets += places
        self.windows = {size: _Windows(*v) for size, v in sorted(held.items())}
        self.all_shingles = np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.array(x, np.uint64) for x in self.shingles]]))

    def nbytes(self) -> int:
        return sum(ENTRY * len(w.prints) + BLOCKS * 5 * ((1 << 16) + 1) for w in self.windows.values()) + (SHINGLE_ENTRY + 8) * sum(map(len, self.shingles))

    def similarity(self, item: int, words: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's shingles and those of ``words``."""
        mine, theirs = set(self.shingles[item]), set(shingle_hashes(words).tolist())
        weigh = lambda s: sum(self.weights.get(x, self.unseen) for x in sorted(s))
        return weigh(mine & theirs) / weigh(mine | theirs)

    def _known_before(self, words: list[np.ndarray], flat: np.ndarray) -> np.ndarray:
        """For each place of the texts end to end, the places before it where a shingle
        begins that some item has. Texts and items shorter than a shingle have one for all
        their words, which may begin at any place: those count as known."""
        shingle = np.zeros(len(flat), np.uint64)
        at, short = 0, any(0 < n < SHINGLE for n in self.lengths)
        for w in words:
            if len(w):
                own = shingle_hashes(w)
                shingle[at : at + len(own)] = own
            at += len(w)
        place = np.searchsorted(self.all_shingles, shingle)
        place[place == len(self.all_shingles)] = 0
        mark = self.all_shingles[place] == shingle if len(self.all_shingles) else np.zeros(len(flat), bool)
        return np.concatenate([[0], np.cumsum(mark | short)])

    def hits(self, texts: list[str | None]) -> list[list[dict]]:
        """Of each whole text: the best window of each item that is similar enough."""
        words = words_of(texts)
        found: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        lengths = np.array([len(w) for w in words])
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        first = np.cumsum(lengths) - lengths
        text_of = np.repeat(np.arange(len(words)), lengths)
        known = self._known_before(words, flat)
        item_length = np.array(self.lengths)
        longest = max(self.windows, default=0)
        seen: set[tuple[int, int]] = set()
        for a in range(0, len(flat), CHUNK):
            votes = _running_votes(flat[a : a + CHUNK + longest - 1], longest)
            for size, index in self.windows.items():
                prints = _fingerprints(votes, size)[:CHUNK] if len(votes) > size else np.zeros(0, np.uint64)
                place, entry = index.within(prints)
                place += a
                text = text_of[place]
                inside = text_of[place + size - 1] == text
                place, entry, text = place[inside], entry[inside], text[inside]
                item = index.items[entry]
                # The item laid over the text, moved inside it where it would stick out.
                start = np.maximum(0, np.minimum(place - first[text] - index.offsets[entry], lengths[text] - item_length[item]))
                begin = first[text] + start
                end = np.minimum(begin + item_length[item], first[text] + lengths[text])
                # No shingle of any item in there: the similarity is 0.
                for i in np.flatnonzero(known[end] > known[begin]).tolist():
                    key = (int(item[i]), int(begin[i]))
                    if key in seen:
                        continue
                    seen.add(key)
                    t, at = int(text[i]), int(start[i])
                    s = self.similarity(key[0], words[t][at : at + self.lengths[key[0]]])
                    best = found[t].get(key[0])
                    if s >= SIMILARITY and (best is None or (s, -at) > (best[0], -best[1])):
                        found[t][key[0]] = (s, at)
        return [
            [{"item_id": self.ids[i], "start": start, "similarity": s} for i, (s, start) in sorted(f.items())] for f in found
        ]


def _marked(index: Broadcast, text: int, names: list[str], kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            found: list[list[dict]] = []
            for a, b in runs(texts, SLICE):
                found += index.value.hits(texts[a:b])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=names)

    return run


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", hits_col: str = "hits"
) -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned too): an array of
    ``(item_id, start, similarity)``, one for each benchmark item that the text has a
    similar window of (the best one; of ties the first), empty for a clean text.

    Null and empty texts are clean; null and empty items match nothing. An item of fewer
    than five words matches its own words in a row only. Items with equal texts or ids are
    all reported. Texts of any length are searched whole. Rows are independent, so
    repeated rows and null ids need no rule; an empty table gives an empty result and an
    empty benchmark leaves every text clean. Other columns pass through, under any name.
    """
    items = _items(benchmark, item_col, item_text_col)
    marked, hits = _mark_texts(docs, items, text_col)
    row = free_name(marked, "row")
    marked = materialize(marked.withColumn(row, F.monotonically_increasing_id()), "benchmark-marked")
    found = _with_ids(marked.select(F.col(row).alias("found_row"), F.explode(hits).alias("hit")), items)
    each = found.groupBy("found_row").agg(F.array_sort(F.collect_list(F.struct("item_id", "start", "similarity"))).alias("found"))
    name = free_name(docs, hits_col)
    none = F.array().cast(T.ArrayType(HIT))
    out = marked.join(each, marked[row] == each["found_row"], "left")
    return out.select(*[marked[f"`{c}`"] for c in docs.columns], F.coalesce(each["found"], none).alias(name)), name


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which ``mark_contaminated`` finds no item; nothing is shuffled."""
    marked, hits = _mark_texts(docs, _items(benchmark, item_col, item_text_col), text_col)
    return marked.filter(F.size(F.col(hits)) == 0).select(*docs.columns)


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    return items.filter(F.length("text") > 0)


def _key():
    """Digest of an item's text."""
    return F.md5(F.col("text").cast("binary")).alias("key")


def _with_ids(found: DataFrame, items: DataFrame) -> DataFrame:
    """``found`` with a ``hit`` on a text, once for each item that has the text."""
    joined = found.join(items.select("item_id", _key()), F.col("hit.item_id") == F.col("key"))
    return joined.select(*[c for c in found.columns if c != "hit"], "item_id", "hit.start", "hit.similarity")


def _mark_texts(docs: DataFrame, items: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with an array of ``TEXT_HIT``, one for each distinct item text found.

    Distinct texts are indexed once, in blocks bounded by the bytes of their index."""
    spark, name = docs.sparkSession, free_name(docs, "text_hits")
    keyed = items.groupBy("text").agg(F.count("*").alias("n")).select(_key(), "n", "text")
    texts = materialize(keyed.mapInArrow(_sized, "key string, n long, text string, n_bytes long"), "benchmark-texts")
    buckets, ranges = _blocks(texts)
    texts = texts.withColumn("block", _bucket(buckets))
    n_items = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = materialize(_shingle_counts(texts), "benchmark-shingles")
    schema = extended(docs, **{name: T.ArrayType(TEXT_HIT)})
    names = [f.name for f in schema]
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("similarity", pa.float64())]))

    def shared(low: int, high: int) -> Broadcast:
        part = texts.filter(F.col("block").between(low, high)).select("key", "text").orderBy("key").collect()
        weights = _block_weights(counts, low, high, n_items)
        index = BenchmarkIndex([r["key"] for r in part], [r["text"] for r in part], weights, _unseen(n_items))
        return checked_broadcast(spark, index, index.nbytes())

    if len(ranges) == 1:
        return docs.mapInArrow(_marked(shared(*ranges[0]), docs.columns.index(text_col), names, kind), schema), name
    # Several blocks: one broadcast lives at a time, and each pass leaves its hits only.
    row = free_name(docs, "row")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "benchmark-rows")
    only = numbered.select(F.col(row).alias("hit_row"), F.col(f"`{text_col}`").alias("text"))
    found = None
    for low, high in ranges:
        index = shared(low, high)
        marked = only.mapInArrow(_marked(index, 1, ["hit_row", "text", "hits"], kind), extended(only, hits=T.ArrayType(TEXT_HIT)))
        own = materialize(marked.filter(F.size("hits") > 0).select("hit_row", "hits"), "benchmark-hits")
        index.unpersist()
        found = own if found is None else found.union(own)
    all_hits = found.groupBy("hit_row").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("all_hits"))  # a list a block at most
    out = numbered.join(all_hits, numbered[row] == all_hits["hit_row"], "left")
    none = F.array().cast(T.ArrayType(TEXT_HIT))
    return out.select(*[numbered[f"`{c}`"] for c in docs.columns], F.coalesce(all_hits["all_hits"], none).alias(name)), name


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, n, text`` with the bytes that the text takes in an index."""
    for batch in batches:
        sizes, texts = [], batch.column(2).to_pylist()
        for a, b in runs(texts, SLICE):
            for text, w in zip(texts[a:b], words_of(texts[a:b])):
                prints = sum(map(len, item_windows(len(w)).values())) if len(w) else 0
                sizes.append(ENTRY * prints + SHINGLE_ENTRY * len(w) + len(text))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=["key", "n", "text", "n_bytes"])


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets))


def _blocks(texts: DataFrame) -> tuple[int, list[tuple[int, int]]]:
    """A number of hash buckets and the ranges of buckets that make blocks of ``BLOCK_BYTES``
    at most (a single text may take more)."""
    total = texts.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = 2 * (total // BLOCK_BYTES) + 1
    while True:
        by_bucket = texts.groupBy(_bucket(buckets).alias("b")).agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n"))
        held = by_bucket.orderBy("b").collect()
        if not any(r["n_bytes"] > BLOCK_BYTES and r["n"] > 1 for r in held):
            break
        buckets *= 2
    ranges: list[tuple[int, int]] = []
    size = 0
    for r in held:
        if ranges and size + r["n_bytes"] <= BLOCK_BYTES:
            ranges[-1], size = (ranges[-1][0], r["b"]), size + r["n_bytes"]
        else:
            ranges.append((r["b"], r["b"]))
            size = r["n_bytes"]
    return buckets, ranges or [(0, 0)]


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, shingle, n``: of ``block, text, n`` the distinct shingles of each text."""
    for batch in batches:
        blocks, texts, n = (batch.column(i).to_pylist() for i in range(3))
        for a, b in runs(texts, SLICE):
            sets = [np.unique(shingle_hashes(w)) if len(w) else w for w in words_of(texts[a:b])]
            sizes = [len(s) for s in sets]
            columns = [np.repeat(np.array(blocks[a:b], np.int64), sizes), np.concatenate(sets).view(np.int64), np.repeat(np.array(n[a:b], np.int64), sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["block", "shingle", "n"])


def _shingle_counts(texts: DataFrame) -> DataFrame:
    """``block, shingle, n``: the shingles of each block of ``texts(block, text, n)`` and how
    many items of the whole benchmark have them."""
    by_block = texts.select("block", "text", "n").mapInArrow(_shingles, "block long, shingle long, n long").groupBy("shingle", "block").agg(F.sum("n").alias("n"))
    total = by_block.groupBy("shingle").agg(F.sum("n").alias("n"))
    return by_block.select("block", "shingle").join(total, "shingle").select("block", "shingle", "n")


def _unseen(n_items: int) -> float:
    return float(np.log1p(max(1, n_items)))


def _block_weights(counts: DataFrame, low: int, high: int, n_items: int) -> dict[int, float]:
    """Weights over the whole benchmark of the shingles of a range of blocks."""
    held = counts.filter(F.col("block").between(low, high)).select("shingle", "n").distinct().toPandas()
    shingles = held["shingle"].to_numpy(np.int64).view(np.uint64).tolist()
    return dict(zip(shingles, np.log1p(n_items / held["n"].to_numpy(np.int64)).tolist()))


def _weights(texts: list[str]) -> tuple[dict[int, float], float]:
    """Weight of each shingle of a whole benchmark's items, log(1 + items / items that have it), and
    of shingles that no item has."""
    counts: dict[int, int] = {}
    for w in words_of(texts):
        for s in set(shingle_hashes(w).tolist()) if len(w) else ():
            counts[s] = counts.get(s, 0) + 1
    n = max(1, len(texts))
    return {s: float(np.log1p(n / c)) for s, c in counts.items()}, float(np.log1p(n))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = _items(table(spark, sf_dir, "benchmark"), "item_id", "text")
    marked, hits = _mark_texts(docs, items, "text")
    found = _with_ids(marked.select("doc_id", F.explode(hits).alias("hit")), items)
    return found.select("doc_id", "item_id", F.col("start").alias("start_word"), "similarity")
