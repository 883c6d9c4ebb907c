"""Jaccard metric-space join of word-shingle sets: exact components at similarity 0.75.

Jaccard distance d is a metric; two sets link at d <= 1/4. Equal sets are one class, and
only one set a class goes on.

*Who can have a partner.* With shingles in one random (hash) order, partners share at
least l of their first n - ceil(3n/4) + l shingles, so a set with fewer than l shared ones
among them links with nothing (a first pass with a short prefix, then whole sets for the
rest, where 3n/4 must be shared). Passages that many documents repeat do not get a
document past this unless they are most of it.

*Cells.* What remains of a set is ordered from rare to frequent; partners share one of
the c - ceil(3n/4) + 1 rarest. Sets that share one form a cell.

*Pivots.* Each cell has a pivot. Every set goes to the Voronoi region of the pivot that
it shares most cells with, and d to it is taken exactly. Only links between components
matter from there on, so a cell within one component is done.

*Regions.* Cells that are not done, joined where they share a set, are regions. In a
region only sets outside its largest component need comparing: each in turn is a pivot,
d from it to the others is exact, and the distances to the first pivots leave out, by the
triangle inequality, all but a window of sets at about the same distances. A region of at
most ``REGION_SHINGLES`` is one task. A larger one is dealt into blocks, and as many
pivots as fit in half a task are replicated to every block; they are then decided against
the whole region and leave it, and what is left is a region of the next round.

*Links.* All links lie within components. A component's classes are compared with one
another, each pair once, from posting lists of whole sets; one of more than
``REGION_SHINGLES`` is dealt into blocks, and every two blocks meet in a task. A task gives
each class the number of documents that it links with there, never the pairs, so a group
of thousands of near copies yields thousands of rows.

Every link is decided by the exact sizes of intersection and union of whole sets
(of 64-bit shingle hashes; class ids are 64-bit hashes of whole sets too).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyline.llm.common import MAX_BROADCAST_BYTES, as_bytes, materialize, runs, table
from keyline.llm.components import connected_components
from keyline.llm.shingles import shingle_sets

REGION_SHINGLES = 1 << 20  # shingles of one task's region
REFERENCES = 4  # pivots of a region whose distances are kept for the triangle inequality
LOST_BYTES = 64  # of one document's id, in a broadcast
SLICE = 1 << 20  # bytes of text hashed at a time
ROWS = 50_000  # rows of a posting batch


def _sets(texts: list[bytes | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    for start, end in runs(texts, SLICE):
        yield start, shingle_sets(texts[start:end])


def _class_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=len(tokens)) - (1 << 63)


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _least(n):
    """ceil(3n/4): shingles that partners of a set of ``n`` share at least."""
    return (3 * n + 3) // 4


def _extra(n):
    """l for a set of ``n``: how far the first pass looks beyond the plain prefix."""
    return 1 + n // 10


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, cls = [], []
        for _, sets in _sets(as_bytes(batch.column(1))):
            n += [len(s) for s in sets]
            cls += [_class_id(s) for s in sets]
        own = [pa.array(n, pa.int64()), pa.array(cls, pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *own], names=["doc_id", "hash", "n", "cls"])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First-pass postings: (token, n, cls) of each set's prefix in hash order, once a class and batch."""
    for batch in batches:
        seen: set[int] = set()
        for _, sets in _sets(as_bytes(batch.column(0))):
            parts, ids = [], []
            for s in sets:
                cls = _class_id(s)
                if len(s) and cls not in seen:
                    seen.add(cls)
                    ids.append((cls, len(s)))
                    parts.append(s[: len(s) - _least(len(s)) + _extra(len(s))])
            if not parts:
                continue
            tokens = _signed(np.concatenate(parts))
            lengths = [len(p) for p in parts]
            n = np.repeat(np.array([i[1] for i in ids]), lengths)
            cls = np.repeat(np.array([i[0] for i in ids], np.int64), lengths)
            for a in range(0, len(tokens), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x[a : a + ROWS], pa.int64()) for x in (tokens, n, cls)], names=["token", "n", "cls"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets in _sets(as_bytes(batch.column(0))):
            kept = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_class_id(s) for s in kept], pa.int64()),
                    pa.array([len(s) for s in kept], pa.int64()),
                    pa.array([_signed(s) for s in kept], pa.list_(pa.int64())),
                ],
                names=["cls", "n", "tokens"],
            )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, n, cls): those with another class of compatible size at
    the same token, each once. Streams: what is held does not grow with a token's rows."""
    names = ["token", "n", "cls"]
    held = [np.zeros(0, np.int64)] * 3
    held_hit = False
    for batch in batches:
        t, n, c = (np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held))
        if not len(t):
            continue
        first = np.concatenate([[True], (t[1:] != t[:-1]) | (c[1:] != c[:-1])])
        t, n, c = t[first], n[first], c[first]
        hit = np.zeros(len(t), bool)
        near = (t[1:] == t[:-1]) & (4 * n[:-1] >= 3 * n[1:])
        hit[1:] |= near
        hit[0] |= held_hit
        last_hit = bool(hit[-1])
        hit[:-1] |= near
        out = np.flatnonzero(hit[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][out], pa.int64()) for x in (t, n, c)], names=names)
        held, held_hit = [t[-1:], n[-1:], c[-1:]], last_hit
    if held_hit:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held], names=names)


def _in_cells(postings: DataFrame) -> DataFrame:
    n = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = postings.repartition(n, "token").sortWithinPartitions("token", "n", "cls")
    return dealt.mapInArrow(_shared, "token long, n long, cls long")


def _sql_least(n: Column) -> Column:
    return F.floor((3 * n + 3) / 4).cast("long")


def _candidates(docs: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole sets that can have a partner, and the cells (token, n, cls) of their rare shingles."""
    first = _in_cells(docs.select("text").mapInArrow(_prefixes, "token long, n long, cls long"))
    needed = 1 + F.floor(_sql_least(F.col("n")) / 10)
    crowded = first.groupBy("cls", "n").agg(F.count("*").alias("c")).filter(F.col("c") >= needed).select("cls")
    # One document a class stands for it.
    stands = members.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(crowded, "cls", "left_semi")
    stands = materialize(stands.select(F.col("doc_id").alias("stands_id")), "jaccard-stands")
    small = stands.count() * LOST_BYTES <= MAX_BROADCAST_BYTES
    chosen = F.col("doc_id").eqNullSafe(F.col("stands_id"))
    texts = docs.join(F.broadcast(stands) if small else stands, chosen, "left_semi")
    sets = materialize(texts.select("text").mapInArrow(_whole_sets, "cls long, n long, tokens array<long>"), "jaccard-sets")

    by_class = Window.partitionBy("cls")
    enough = F.count("*").over(by_class) >= _sql_least(F.col("n"))
    postings = _in_cells(sets.select(F.explode("tokens").alias("token"), "n", "cls"))
    postings = materialize(postings.withColumn("enough", enough).filter("enough").drop("enough"), "jaccard-postings")
    # Again among those that are left, now with how frequent each shingle is.
    spread = postings.join(postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "token")
    c = F.count("*").over(by_class)
    rare = F.row_number().over(by_class.orderBy("df", "token"))
    ranked = spread.select("token", "n", "cls", (c - _sql_least(F.col("n")) + 1).alias("prefix"), rare.alias("rank"))
    cells = _in_cells(ranked.filter("rank <= prefix").select("token", "n", "cls"))
    return sets, materialize(cells.select(F.col("token").alias("cell"), "n", "cls"), "jaccard-cells")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x, p, shared, joint`` (sizes of intersection and union) of distinct pairs of classes."""
    x = sets.select(F.col("cls").alias("x"), F.col("tokens").alias("x_tokens"))
    p = sets.select(F.col("cls").alias("p"), F.col("tokens").alias("p_tokens"))
    shared = F.size(F.array_intersect("x_tokens", "p_tokens"))
    both = pairs.join(x, "x").join(p, "p")
    sized = both.select("x", "p", shared.alias("shared"), (F.size("x_tokens") + F.size("p_tokens")).alias("total"))
    return materialize(sized.select("x", "p", "shared", (F.col("total") - F.col("shared")).alias("joint")).distinct(), "jaccard-distances")


LINKED = "100 * shared >= 75 * joint"


def _relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (cls, component) after more links (a, b) between classes."""
    if labels is None:
        found = connected_components(links)
        return materialize(found.select(F.col("node").alias("cls"), "component"), "jaccard-labels")
    a = links.join(labels.select(F.col("cls").alias("a"), F.col("component").alias("ca")), "a", "left")
    b = a.join(labels.select(F.col("cls").alias("b"), F.col("component").alias("cb")), "b", "left")
    between = b.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = labels.join(merged, "component", "left").select("cls", F.coalesce("to", "component").alias("component"))
    new = merged.select(F.col("component").alias("cls"), F.col("to").alias("component")).join(labels.select("cls"), "cls", "left_anti")
    return materialize(old.unionByName(new), "jaccard-labels")


def _live(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Cells whose members are in several components: ``cell, n, cls, component, size``."""
    known = cells.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mixed = known.groupBy("cell").agg(
        F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low <> high").select("cell", "size")
    return known.join(mixed, "cell").select("cell", "n", "cls", "component", "size")


def _nearest_pivots(cells: DataFrame) -> DataFrame:
    """``x, p``: for each set the pivot, of its cells' pivots of compatible size, that most
    of its cells have."""
    pivots = cells.groupBy("cell").agg(F.min(F.struct("cls", "n")).alias("pivot"))
    with_pivot = cells.join(pivots, "cell").filter(F.col("cls") != F.col("pivot.cls"))
    with_pivot = with_pivot.select("n", F.col("cls").alias("x"), F.col("pivot.cls").alias("p"), F.col("pivot.n").alias("pn"))
    compatible = (4 * F.col("n") >= 3 * F.col("pn")) & (4 * F.col("pn") >= 3 * F.col("n"))
    votes = with_pivot.filter(compatible).groupBy("x", "p").agg(F.count("*").alias("votes"))
    return votes.groupBy("x").agg(F.max(F.struct("votes", "p")).alias("best")).select("x", F.col("best.p").alias("p"))


def region_links(ids: np.ndarray, sets: list[np.ndarray], component: np.ndarray, query: np.ndarray) -> list[tuple[int, int]]:
    """Links that join components, between the sets marked ``query`` and all others.
    Enough of them to connect what the exact comparison of every such pair would connect."""
    n = np.array([len(s) for s in sets])
    start = np.cumsum(n) - n
    flat = np.concatenate(sets)
    _, label = np.unique(component, return_inverse=True)
    away: list[np.ndarray] = []  # distances of all sets to the first pivots
    links = []
    for p in np.flatnonzero(query):
        reference = len(away) < REFERENCES
        open_ = np.ones(len(n), bool) if reference else label != label[p]
        if not reference:
            open_ &= (4 * n >= 3 * n[p]) & (4 * n[p] >= 3 * n)
            for d in away:
                open_ &= np.abs(d - d[p]) <= 0.25 + 1e-9
        some = np.flatnonzero(open_)
        if not len(some):
            continue
        if len(some) == len(n):
            tokens, first = flat, start
        else:
            tokens = np.concatenate([sets[i] for i in some])
            first = np.cumsum(n[some]) - n[some]
        pivot = sets[p]
        at = np.minimum(np.searchsorted(pivot, tokens), len(pivot) - 1)
        shared = np.add.reduceat((pivot[at] == tokens).astype(np.int64), first)
        joint = n[some] + n[p] - shared
        if reference:
            away.append(1 - shared / joint)
        for x in some[100 * shared >= 75 * joint]:
            if label[x] != label[p]:
                links.append((int(ids[x]), int(ids[p])))
                label[label == label[x]] = label[p]
    return links


def _region(group: pa.Table) -> pa.Table:
    group = group.sort_by("cls").combine_chunks()
    tokens = group.column("tokens").combine_chunks()
    offsets = tokens.offsets.to_numpy()
    values = tokens.values.to_numpy()
    sets = [np.sort(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    ids, component = (group.column(c).to_numpy() for c in ("cls", "component"))
    links = region_links(ids, sets, component, group.column("query").to_numpy(zero_copy_only=False))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def _class_components(sets: DataFrame, cells: DataFrame) -> DataFrame:
    """``cls, component`` of every class that links with another."""
    links = _distances(_nearest_pivots(cells), sets).filter(LINKED).select(F.col("x").alias("a"), F.col("p").alias("b"))
    labels = _relabel(None, links)
    live = materialize(_live(cells, labels), "jaccard-live")
    least = live.groupBy("cell").agg(F.min("cls").alias("least"))
    regions = connected_components(live.join(least, "cell").select(F.col("cls").alias("a"), F.col("least").alias("b")))
    sized = live.select("cls", "n").distinct()
    members = materialize(regions.select(F.col("node").alias("cls"), F.col("component").alias("region")).join(sized, "cls"), "jaccard-regions")
    while True:
        known = members.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        parts = known.groupBy("region", "component").agg(F.sum("n").alias("n"))
        whole = parts.groupBy("region").agg(
            F.sum("n").alias("total"), F.max(F.struct("n", "component")).alias("major"), F.count("*").alias("parts")
        ).filter("parts > 1")
        placed = known.join(whole.select("region", "total", F.col("major.component").alias("major")), "region")
        before = Window.partitionBy("region").orderBy("cls").rowsBetween(Window.unboundedPreceding, -1)
        minor = placed.filter("component <> major").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        small = F.col("total") <= REGION_SHINGLES
        chosen = small | (F.col("before") == 0) | (F.col("before") + F.col("n") <= REGION_SHINGLES // 2)
        minor = minor.withColumn("query", chosen).drop("before")
        placed = materialize(minor.unionByName(placed.filter("component = major").withColumn("query", F.lit(False))), "jaccard-placed")
        if placed.isEmpty():
            return labels
        blocks = F.when(small, F.lit(1)).otherwise(F.ceil(F.col("total") / (REGION_SHINGLES // 2))).cast("int")
        every = F.sequence(F.lit(0), blocks - 1)
        own = F.array(F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        dealt = placed.withColumn("block", F.explode(F.when(F.col("query"), every).otherwise(own)))
        units = dealt.select("region", "block", "cls", "component", "query").join(sets.select("cls", "tokens").dropDuplicates(["cls"]), "cls")
        links = units.groupBy("region", "block").applyInArrow(_region, "a long, b long")
        labels = _relabel(labels, materialize(links, "jaccard-links"))
        members = materialize(placed.filter(~small & ~F.col("query")).select("cls", "n", "region"), "jaccard-regions")


def link_counts(sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray, across: bool) -> np.ndarray:
    """For each set the total ``weight`` of the others that it links with: of the other
    ``side`` (0 or 1) if ``across``, else of all.

    Intersections are counted from posting lists; tokens that at least an eighth of the
    sets have are columns of a dense product instead, which has at most eight times as
    many cells as the sets have tokens.
    """
    n = np.array([len(x) for x in sets])
    out = np.zeros(len(sets), np.int64)
    rows, others = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if across else (np.arange(len(sets)),) * 2
    if not len(rows) or not len(others):
        return out
    token = np.concatenate([sets[i] for i in others])
    holder = np.repeat(np.arange(len(others), dtype=np.int32), n[others])
    order = np.argsort(token, kind="stable")
    token, holder = token[order], holder[order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    df = np.diff(first, append=len(token))
    key = token[first]
    dense = np.where(df >= max(16, len(others) / 8), np.cumsum(df >= max(16, len(others) / 8)) - 1, -1)
    width = int(dense.max()) + 1
    table = np.zeros((len(others), width), np.float32)
    of_entry = np.repeat(dense, df)
    table[holder[of_entry >= 0], of_entry[of_entry >= 0]] = 1
    for a in range(0, len(rows), 256):
        part = rows[a : a + 256]
        own = np.zeros((len(part), width), np.float32)
        shared = np.zeros((len(part), len(others)), np.int64)
        for k, i in enumerate(part):
            at = np.minimum(np.searchsorted(key, sets[i]), len(key) - 1)
            at = at[key[at] == sets[i]]
            own[k, dense[at][dense[at] >= 0]] = 1
            at = at[dense[at] < 0]
            size = df[at]
            places = np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            shared[k] = np.bincount(holder[places], minlength=len(others))
        if width:
            shared += np.rint(own @ table.T).astype(np.int64)
        linked = 100 * shared >= 75 * (n[part][:, None] + n[others][None, :] - shared)
        if across:
            out[others] += linked.T @ weight[part]
        else:
            linked[np.arange(len(part)), part] = False
        out[part] += linked @ weight[others]
    return out


def _counted(group: pa.Table) -> pa.Table:
    group = group.combine_chunks()
    tokens = group.column("tokens").combine_chunks()
    offsets, values = tokens.offsets.to_numpy(), tokens.values.to_numpy()
    sets = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    own, low, high = (group.column(c).to_numpy() for c in ("own", "low", "high"))
    links = link_counts(sets, group.column("copies").to_numpy(), (own != low).astype(np.int8), bool(low[0] != high[0]))
    return pa.table({"cls": group.column("cls"), "links": pa.array(links, pa.int64())})


def _class_links(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """``cls, links``: documents of other classes that a document of the class links with."""
    copies = members.filter("n > 0").groupBy("cls").agg(F.count("*").alias("copies"))
    known = labels.join(copies, "cls").join(sets.select("cls", "n").dropDuplicates(["cls"]), "cls")
    blocks = known.groupBy("component").agg(F.ceil(F.sum("n") / (REGION_SHINGLES // 2)).cast("int").alias("blocks"))
    dealt = known.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = dealt.select("component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cls", "copies")
    units = units.join(sets.select("cls", "tokens").dropDuplicates(["cls"]), "cls")
    counted = units.groupBy("component", "low", "high").applyInArrow(_counted, "cls long, links long")
    return materialize(counted.groupBy("cls").agg(F.sum("links").alias("links")), "jaccard-link-counts")


def _joined(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows as (doc_id, hash of the text, n, cls), the components of classes that link, and
    whole sets of those among them."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    members = materialize(hashed.mapInArrow(_members, "doc_id long, hash long, n long, cls long"), "jaccard-members")
    sets, cells = _candidates(docs, members)
    return members, _class_components(sets, cells), sets


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` (and ``class_id``, ``n_links``) for every row of ``docs``.

    A text's set is its distinct 5-word shingles over ``[^\\x20\\x09-\\x0D]+`` words with
    A-Z lower-cased; with fewer words, all of them are one shingle. Null text and text
    without words have an empty set: 0 shingles, linked with nothing, ``component_id`` the
    row's own id. Texts of any length are taken whole. Rows with equal sets link whatever
    their ids, repeated rows too. Null ids are left out of a component's least id; it is
    null if all are. ``n_links`` is the number of other rows that the row links with, its
    equals among them. An empty table gives an empty result; other columns are ignored.
    """
    members, labels, sets = _joined(docs, id_col, text_col)
    classes = members.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    classes = classes.join(_class_links(members, labels, sets), "cls", "left")
    classes = classes.withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    classes = classes.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = classes.join(least, "component").select("cls", "class_id", "component_id", "n_links")
    linked = members.filter("n > 0").join(named, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id", "n_links")
    alone = members.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one document of each component, with all their columns.

    The document with the least id stays; a null id loses to any id, and of texts with
    one id that with the least class id, then text hash, stays. Rows that repeat both id
    and text are one document and stay together. Rows without words are no one's
    duplicates and stay. An empty table stays empty. Rows are told by id and text hash;
    the table of those that go is broadcast if small enough, else joined by a shuffle.
    """
    members, labels, _ = _joined(docs, id_col, text_col)
    rows = members.filter("n > 0").join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    rows = rows.select("component", "doc_id", "hash", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "cls", "hash").alias("place"))
    best = rows.groupBy("component").agg(F.min("place").alias("best"), F.count("*").alias("n")).filter("n > 1")
    lost = rows.join(best.select("component", "best"), "component").filter("place <> best")
    lost = materialize(lost.select(F.col("doc_id").alias("lost_id"), F.col("hash").alias("lost_hash")).distinct(), "jaccard-lost")
    small = lost.count() * LOST_BYTES <= MAX_BROADCAST_BYTES
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("lost_id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("lost_hash"))
    return docs.join(F.broadcast(lost) if small else lost, same, "left_anti")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
