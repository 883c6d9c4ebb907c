"""Exact groups, Jaccard components, mixing, decontamination, licences, WARC, pipeline."""

import gzip
import random

import pytest
from helpers import jaccard_components, jaccard_links, odd_rows, prose, shingle_set
from pyspark.sql import functions as F

from keyline.llm import decontamination, exact_dedup, jaccard_join, license_scan, mixing, warc
from keyline.llm.components import connected_components


@pytest.mark.parametrize("table_bytes", [1, 400, 1 << 20])
def test_exact_groups_at_any_table_size(spark, result, table_bytes):
    """Tables too small for their bucket overflow to further levels with the same result."""
    r = random.Random(3)
    rows = [(i, r.choice(["Aa", "aA", "", None, "b " * 60, "B " * 60, f"t{i % 7}", f"u{i}"]), i) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grace_gid long").repartition(3)
    groups = exact_dedup.exact_groups(docs, table_bytes=table_bytes)
    by_text: dict[str, list[int]] = {}
    for i, t, _ in rows:
        by_text.setdefault((t or "").lower(), []).append(i)
    want = sorted((i, max(ids), len(ids), i == max(ids)) for ids in by_text.values() for i in ids)
    got = sorted((x["doc_id"], x["keep_id"], x["group_size"], x["kept"]) for x in groups.decisions().collect())
    assert got == want
    kept = {max(ids) for ids in by_text.values()}
    assert result(groups.survivors()) == result(docs.filter(F.col("doc_id").isin(list(kept))))


def test_components(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(200, 200)] + [(r.randrange(300, 360), r.randrange(300, 360)) for _ in range(40)]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {(n, find(n)) for a, b in edges if a != b for n in (a, b)}
    got = {(x["node"], x["component"]) for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_jaccard_odd_rows(spark, odd, result):
    got = jaccard_join.op2_jaccard_join(spark, odd).collect()
    plain = [(r[0], r[1]) for r in odd_rows()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(jaccard_components(plain), key=repr)
    assert sorted(((r.doc_id, r.n_links) for r in got), key=repr) == sorted(jaccard_links(plain), key=repr)


def _near_rows(seed: int) -> list[tuple]:
    """Families of near copies about the threshold, all with one common passage."""
    r = random.Random(seed)
    rows, passage = [], prose(777, 25)
    for family in range(12):
        base = prose(1000 * seed + family, r.randrange(6, 160)).split()
        for _ in range(r.randrange(1, 30)):
            w = list(base)
            for _ in range(r.randrange(0, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
            if r.random() < 0.3:
                w = w[: r.randrange(3, len(w) + 1)]
            if r.random() < 0.5:
                w += passage.split()
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,limit", [(1, 1 << 20), (2, 300), (3, 3000)])
def test_jaccard_against_brute_force(spark, monkeypatch, seed, limit):
    """Small limits force rounds of pivots over blocks of a region."""
    monkeypatch.setattr(jaccard_join, "REGION_SHINGLES", limit)
    rows = _near_rows(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, cls string").repartition(4)
    got = jaccard_join.jaccard_components(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(jaccard_components(rows))
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted(jaccard_links(rows))


def test_keep_one_of_each_component(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    base, copy = prose(61, 50), prose(62, 50)
    more = [(None, base, "en", "a", 1), (None, base, "en", "a", 1), (None, copy, "en", "a", 1), (50, copy, "en", "a", 1), (51, copy, "en", "b", 1)]
    kept = jaccard_join.keep_one(docs.unionByName(spark.createDataFrame(more, docs.schema)).withColumn("cls", F.lit(1)))
    assert kept.columns == [*docs.columns, "cls"]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    rows = {r[0]: r[1] for r in odd_rows()}
    # 2 and 3 copy 1, 11 copies 10; a null id loses to 50; rows equal in id and text stay together.
    want = [(i, rows[i]) for i in (1, 4, 5, 6, 7, 8, 10, 12, 13)] + [(9, prose(4, 40))] * 2 + [(9, prose(5, 40)), (50, copy)]
    want += [(None, base)] * 2 + [(None, prose(3, 30)), (None, None)]
    assert got == sorted(want, key=repr)


def test_shingle_hashes_follow_words():
    from keyline.llm.shingles import shingle_sets

    texts = ["A b  c", "a B\tc", "a b c d e f", "b a c", prose(8, 400_000), None, ""]
    sets = [s.tolist() for s in shingle_sets([t.encode() if t is not None else None for t in texts])]
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    assert sets[0] == sets[1] != sets[3]


def test_mix_cuts_at_the_budget(spark, odd):
    for folder in (odd, "/root/testdata/sf0.001"):
        got = mixing.op3_mix_sources(spark, folder).toPandas()
        for _, g in got.groupby("source", dropna=False):
            assert g.taken.sum() == int(g.target.iloc[0]) and g["size"].sum() == g.source_size.iloc[0]
            assert (g.taken <= 3 * g["size"]).all()


def test_targets_share_and_cap(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sources).collect()}
    # a, b, c weigh 1, 2, 3 and null 1 of 1520 words; a and c stop at 30, b and null share the rest.
    assert got == {"a": 30.0, "c": 30.0, "b": 2 * 1460 / 3, None: 1460 / 3}


def _index(items):
    return decontamination.BenchmarkIndex([i for i, _ in items], [t for _, t in items], *decontamination._weights([t for _, t in items]))


def test_decontamination_finds_passages():
    items = [(i, prose(50 + i, 15 + 3 * i)) for i in range(10)] + [(90, "only three words"), (91, "?!")]
    index = _index(items)
    clean = prose(999, 400)
    edited = items[6][1].split()
    edited[-2] = "different"
    texts = [clean, *[f"{clean} {t.upper()}! {clean}" for _, t in items[:10]], items[0][1], f"{clean} {' '.join(edited)}, {clean}", "say Only-three words, please", None, "", items[9][1] + " " + items[9][1]]
    got = [[(h["item_id"]) for h in hits] for hits in index.hits(texts)]
    assert got == [[], *[[i] for i in range(10)], [0], [6], [90], [], [], [9]]
    assert index.hits(texts)[11][0] == {"item_id": 0, "start": 0, "similarity": 1.0}


def test_hamming_index_misses_nothing():
    import numpy as np

    r = np.random.default_rng(1)
    prints = r.integers(0, 1 << 63, 50, dtype=np.uint64)
    index = decontamination._Windows(prints.tolist(), list(range(50)), [0] * 50)
    probes = prints[r.integers(0, 50, 400)].copy()
    for i in range(400):
        for b in r.choice(64, r.integers(0, 12), replace=False):
            probes[i] ^= np.uint64(1) << np.uint64(b)
    places, entries = index.within(probes)
    want = {(i, j) for i in range(400) for j in range(50) if bin(int(probes[i] ^ prints[j])).count("1") <= decontamination.RADIUS}
    assert set(zip(places.tolist(), entries.tolist())) == want


def test_decontamination_blocks_and_clashing_columns(spark, odd, monkeypatch):
    docs = spark.read.parquet(f"{odd}/documents.parquet").withColumn("hits", F.lit(5))
    benchmark = spark.read.parquet(f"{odd}/benchmark.parquet")
    one, name = decontamination.mark_contaminated(docs, benchmark)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 50)
    several, _ = decontamination.mark_contaminated(docs, benchmark)
    found = lambda df: sorted((r["doc_id"] or 0, h["item_id"], h["start"], h["hits_of"]) for r in df.collect() for h in [x.asDict() | {"hits_of": r["hits"]} for x in r[name]])
    assert name == "_hits" and found(one) == found(several) == [(7, 1, 500, 5)]


def _small_benchmark(spark):
    """Items that share shingles across blocks, and documents with one word of each changed."""
    shared = prose(70, 12)
    items = [(i, f"{prose(700 + i, 14 + i % 40)} {shared if i % 2 else ''}") for i in range(40)]
    docs = []
    for i, t in items:
        w = t.split()
        w[len(w) - 3 if i % 3 else 0] = "changedword"
        docs.append((i, f"{prose(900 + i, 30)} {' '.join(w)} {prose(950 + i, 30)}"))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), items


def test_similarity_does_not_depend_on_blocks(spark, monkeypatch):
    docs, benchmark, items = _small_benchmark(spark)
    found = lambda: {(r["doc_id"], h["item_id"], h["start"]): h["similarity"] for r in decontamination.mark_contaminated(docs, benchmark)[0].collect() for h in r["hits"]}
    one = found()
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100_000)
    several = found()
    assert len(one) > 10 and several == pytest.approx(one)
    index = _index(items)
    plain = {(r["doc_id"], h["item_id"], h["start"]): h["similarity"] for r in docs.collect() for h in index.hits([r["text"]])[0]}
    assert one == pytest.approx(plain)


def test_index_of_mixed_lengths_and_hot_texts_stays_bounded(spark, monkeypatch):
    """Items of many lengths and a third with one text: blocks hold bounded index bytes."""
    sizes = []
    shared = decontamination.checked_broadcast
    monkeypatch.setattr(decontamination, "checked_broadcast", lambda s, v, n: (sizes.append((n, len(v.ids), len(v.windows))), shared(s, v, n))[1])
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 400_000)
    items = [(i, prose(3000 + i, 3 + 5 * i % 500)) for i in range(60)] + [(100 + i, prose(7, 40)) for i in range(30)]
    docs = spark.createDataFrame([(1, f"{prose(8, 20)} {prose(7, 40)}"), (2, prose(9, 30))], "doc_id long, text string")
    marked, name = decontamination.mark_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {r["doc_id"]: [h["item_id"] for h in r[name]] for r in marked.collect()}
    assert got == {1: list(range(100, 130)), 2: []}
    assert len(sizes) > 1 and sum(n for _, n, _ in sizes) == 61
    assert all(n - w * 4 * 4 * ((1 << 16) + 1) <= 400_000 for n, _, w in sizes)


@pytest.mark.parametrize("n", [12, 13, 16, 18, 20, 23, 24, 25, 32, 33, 40, 48, 64, 100])
def test_recall_against_brute_force(n):
    """Copies with words changed at the ends and inside, of every similarity from 0.75."""
    r = random.Random(n)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    items = [(i, " ".join(word() for _ in range(n))) for i in range(40)]
    index = _index(items)
    texts, want = [], []
    for i, t in items:
        for head, tail, inside in [(1, 0, 0), (1, 1, 0), (0, 2, 0), (2, 2, 0), (0, 0, 1), (1, 1, 1), (0, 0, 2), (0, 0, 3), (n // 7, 0, 0), (0, n // 9, 1)]:
            w = t.split()
            for at in [*range(min(head, n)), *range(max(0, n - tail), n), *[r.randrange(n) for _ in range(inside)]]:
                w[at] = word()
            words = decontamination.words_of([" ".join(w)])[0]
            if index.similarity(i, words) >= decontamination.SIMILARITY:
                texts.append(f"{word()} {word()} {word()} {' '.join(w)} {word()} {word()}")
                want.append((i, index.similarity(i, words)))
    got = index.hits(texts)
    assert [[h["item_id"] for h in hits] for hits in got] == [[i] for i, _ in want]
    assert all(hits[0]["similarity"] >= s - 1e-12 for hits, (_, s) in zip(got, want))


def test_whole_licence_and_spellings(spark):
    mit = "The MIT License\n\nCopyright (c) 2020 Someone\n" + license_scan.MIT.upper().replace("SUBLICENSE", "sub-licence").replace("\n", "\r\n  ")
    rows = [(1, mit), (2, mit + " and more"), (3, "x\nLicensed under the Apache Licence, version 2.0\nreleased under the MIT license!"), (4, None), (5, "(c) 2020 Me\nAll rights reserved."), (6, "SPDX-License-Identifier: MIT")]
    got = {r["doc_id"]: (r["license_id"], r["notices"], r["n_notices"]) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][0] == "MIT" and got[2][0] is None
    assert got[3] == (None, "Apache-2.0,MIT", 2) and got[4] == (None, "", 0) and got[5] == (None, "", 0) and got[6] == ("MIT", "MIT", 1)


def test_whole_texts_at_any_wrapping(spark):
    """Every whole text is found however its paragraphs are wrapped; a copyright line is a
    notice only."""
    import re
    import textwrap

    rows, want = [], {}
    for spdx, text in license_scan.whole_texts():
        paragraphs = re.split(r"\n\s*\n", text)
        for width in (48, 66, 80, 100_000):
            want[len(rows)] = spdx
            rows.append((len(rows), "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in paragraphs)))
    got = {r["doc_id"]: r["license_id"] for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    missed = {(want[i], rows[i][1].count("\n")) for i in want if got[i] != want[i]}
    assert not missed
    assert {spdx for spdx, _ in license_scan.NAMES} - set(want.values()) == {"CC-BY-4.0", "CC-BY-NC-4.0"}
    notices = ["Copyright 2020 Me", "Copyright (c) Me", "(c) Me and others", "copyright by The Authors", "© Me", "# Copyright The Authors"]
    body = ["copyright notice and this", "copyright holders be liable", "(c) You must retain", "copyrighted material", "copyright law."]
    df = spark.createDataFrame([(x,) for x in notices + body], "text string").select(F.size(license_scan.canonical_lines(F.col("text"))).alias("n"))
    assert [r["n"] for r in df.collect()] == [0] * len(notices) + [1] * len(body)


def _record(payload: bytes, name: str = "1") -> bytes:
    import hashlib

    return f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Block-Digest: sha1:{hashlib.sha1(payload).hexdigest()}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress])
def test_salvage_after_damage(pack):
    records = [_record(bytes([65 + i]) * 200, str(i)) for i in range(6)]
    parts = [pack(r) for r in records]
    parts[1] = parts[1][:-50] + b"\x00\x00" + parts[1][-48:]  # damaged inside
    parts[3] = parts[3][:-20]  # cut short
    data = b"junk" + b"".join(parts) + parts[5][:30]
    out = list(warc.salvage(data))
    kept = [h["warc-record-id"] for _, _, h, _, _ in out if h]
    assert [x for x in ("0", "2", "4", "5") if f"<urn:page:{x}>" not in kept] == [] and "<urn:page:1>" not in kept
    spans = sorted((s, e) for s, e, *_ in out)
    assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert all(reason for _, _, h, _, reason in out if h is None)


def test_salvage_does_not_split_payloads():
    inner = _record(b"inner")
    assert [b for *_, b, _ in warc.salvage(_record(b"x" + inner + b"y"))] == [b"x" + inner + b"y"]
    assert list(warc.salvage(b"")) == []


def test_archive_round_trip_with_gaps(spark, tmp_dir):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "p" * (1500 if i % 2 else i)) for i in range(20)], "page_id long, url string, html string")
    warc.write_warc(warc.with_revisits(pages).coalesce(1), f"{tmp_dir}/w", records_per_file=7)
    records = warc.read_warc(spark, f"{tmp_dir}/w")
    assert records.filter("gap is not null").count() == 0 and records.count() == 20
    assert records.filter("type = 'revisit'").count() == 9
    import glob

    files = sorted(glob.glob(f"{tmp_dir}/w/part-*"))
    assert len(files) == 3
    data = open(files[0], "rb").read()
    broken = f"{tmp_dir}/broken.warc"
    open(broken, "wb").write(data.replace(b"Content-Length: ", b"Content-Length: 9", 1))
    after = warc.read_warc(spark, broken)
    assert after.filter("gap is null").count() == 6
    gap = after.filter("gap is not null").first()
    assert gap["start"] == 0 and gap["end"] > 100


def test_gzip_members_are_read_in_linear_time():
    """8,000 members; a damaged one is a gap and the next is found."""
    import gzip
    import time

    member = lambda i: gzip.compress(_record(b"payload %d " % i * 40), mtime=0)
    members = [member(i) for i in range(8000)]
    started = time.process_time()
    out = list(warc.salvage(warc.EMPTY_MEMBER.join(members)))
    assert len(out) == 8000 and all(h for _, _, h, _, _ in out) and time.process_time() - started < 4
    hurt = bytearray(members[1])
    hurt[len(hurt) // 2] ^= 255
    kept = list(warc.salvage(members[0] + bytes(hurt) + members[2]))
    assert [h is None for _, _, h, _, _ in kept] == [False, True, False]
    assert (kept[1][0], kept[1][1]) == (len(members[0]), len(members[0]) + len(hurt))


def test_long_headers_and_many_false_starts():
    """A header over 64 KiB is a record's; version lines in junk cost no second search."""
    long = _record(b"block").replace(b"WARC/1.1\r\n", b"WARC/1.1\r\nX-Long: " + b"h" * 100_000 + b"\r\n", 1)
    assert [b for _, _, h, b, _ in warc.salvage(long) if h] == [b"block"]
    junk = b"WARC/1.1\r\njunk\n" * 100_000
    out = list(warc.salvage(junk + long))
    assert [h is None for _, _, h, _, _ in out] == [True, False]


@pytest.mark.parametrize("compress", [False, True])
def test_archives_keep_urls_and_size_classes(spark, tmp_dir, compress):
    rows = [(i, f"http://host/{i}", "x" * n) for i, n in enumerate([10, 10, 2000, 2000, 70_000, 1_200_000, 1_300_000])] + [(None, None, "y"), (None, "http://n", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(warc.with_revisits(pages), f"{tmp_dir}/w", compress=compress)
    got = warc.read_warc(spark, f"{tmp_dir}/w").collect()
    assert all(r.gap is None for r in got) and len({r.record_id for r in got}) == len(rows)
    assert sorted(r.uri for r in got) == sorted(u or "urn:none" for _, u, _ in rows)
    assert sorted(r.payload_bytes for r in got) == sorted(len(h or "") for _, _, h in rows)
    import os

    assert sorted(os.listdir(f"{tmp_dir}/w")) == ["size-0", "size-1", "size-2"]
