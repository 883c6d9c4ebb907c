"""Whitening against numpy on exact integers, alignment against a byte-by-byte walk, language-model scores against exact counts."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from helpers import DOCS, LOWER, odd_rows, prose, split_words
from pyspark.sql import functions as F

from keyline.llm import alignment, bloom_lm, whitening

SF = "/root/testdata/sf0.001"


# --- whitening ---------------------------------------------------------------------------


def plain_whitening(rows):
    """(id, vector) rows: n, exact deviations by place, covariance of distinct vectors."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in kept]
    fit = sorted(set(v for _, v in x))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(d)]
    deviations = [(i, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in x]
    mean = [Fraction(s, n) for s in sums]
    cov = [[float(sum((v[a] - mean[a]) * (v[b] - mean[b]) for v in fit) / n) for b in range(d)] for a in range(d)]
    return n, x, deviations, np.array([[float(c - m) for c, m in zip(v, mean)] for _, v in x]), np.array(cov)


def vectors(seed, n, d, scale=1.0):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, d)) @ r.normal(size=(d, d)) * scale).tolist()


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12])
def test_whitening_is_numpy_s(spark, scale):
    rows = [(i, v) for i, v in enumerate(vectors(3, 60, 5, scale))]
    rows += [(100, rows[0][1]), (100, rows[0][1]), (None, rows[1][1]), (101, None), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [math.nan] * 5), (104, [math.inf] * 5), (105, []), (106, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("whitened", F.lit("x"))
    got, model, error = whitening.whiten(df)
    n, _, deviations, off, cov = plain_whitening([r for r in rows if r[1] is None or len(r[1]) == 5])
    assert model.n == n and got.columns == ["vec_id", "whitened", "deviation", "_whitened"]
    out = got.collect()
    assert sorted(((r["vec_id"], int(r["deviation"])) for r in out), key=repr) == sorted(deviations, key=repr)
    e, v = np.linalg.eigh(cov)
    assert model.values == pytest.approx(e[::-1][:4], rel=1e-9)
    assert model.explained == pytest.approx(e[::-1][:4] / e.sum(), rel=1e-9)
    want = np.abs(off @ v[:, ::-1][:, :4] / np.sqrt(e[::-1][:4]))
    mine = np.abs([r["_whitened"] for r in out])
    assert np.allclose(mine[np.lexsort(mine.T)], want[np.lexsort(want.T)], rtol=1e-6, atol=1e-6)
    assert error < 1e-9


def test_whitening_without_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got, model, error = whitening.whiten(df)
    assert [r["whitened"] for r in got.collect()] == [[None, None]] * 2 and model.explained == [None, None] and error is None
    line = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0])], "vec_id long, embedding array<float>")
    assert sorted(r["whitened"] for r in whitening.whiten(line)[0].collect()) == [[-1.0, None], [1.0, None]]


def test_polarisation_gives_every_covariance():
    r = random.Random(5)
    x = [[r.randrange(-(10**17), 10**17) for _ in range(4)] for _ in range(40)]
    n, sums = len(x), [sum(v[k] for v in x) for k in range(4)]
    centre = whitening.Whitening(n, sums, [], np.zeros((4, 0)), []).centre()
    y, _ = whitening.centred(np.array(x, np.int64), centre)
    squares = [int(s) for s in whitening.squares_of_sums(y.astype(object))]
    got = whitening.covariance(n, sums, centre, squares)
    for a in range(4):
        for b in range(4):
            exact = sum((Fraction(v[a]) - Fraction(sums[a], n)) * (Fraction(v[b]) - Fraction(sums[b], n)) for v in x) / n
            assert got[a, b] == float(exact)


def test_totals_are_exact_beyond_a_long(spark):
    batches = [pa.RecordBatch.from_arrays([pa.array([[2**62, -(2**62)], [2**62, -(2**62)], [2**62, 1]], pa.list_(pa.int64()))], names=["x"])]
    rows = [r for b in whitening._sums(2)(iter(batches)) for r in b.to_pylist()]
    total = defaultdict(int)
    for r in rows:
        total[r["k"]] += r["digit"] << (whitening.LIMB * r["place"])
    assert dict(total) == {0: 3, 1: 3 * 2**62, 2: 1 - 2**63}


def test_whitening_query(spark, tmp_path):
    got = whitening.op11_whitening(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, _, deviations, _, cov = plain_whitening([(r[0], list(r[1])) for r in table])
    assert set(got.n) == {n} and sorted(zip(got.vec_id, got.deviation)) == sorted(d for d in deviations for _ in range(4))
    e = np.linalg.eigvalsh(cov)[::-1]
    assert got.groupby("component").explained.first().tolist() == pytest.approx((e[:4] / e.sum()).tolist(), rel=1e-9)
    assert got.identity_error.max() < 1e-9
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert whitening.op11_whitening(spark, str(tmp_path)).collect() == []


# --- alignment ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def models():
    with open(public_tokenizers.path(alignment.BYTE_MODEL), encoding="utf-8") as f:
        a = f.read()
    with open(public_tokenizers.path(alignment.PIECE_MODEL), "rb") as f:
        return a, f.read()


@pytest.fixture(scope="module")
def walk(models):
    """Ids and groups of a text, byte by byte, with the libraries' plain calls."""
    hf = tokenizers.Tokenizer.from_str(models[0])
    hf.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_proto=models[1])
    # Letters of the byte-level vocabulary, by decoding single tokens of two bytes each.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def run(text):
        if not text:
            return None
        a, b = hf.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        bytes_a = [bytes(letter[c] for c in hf.id_to_token(i)) for i in a]
        pieces = [sp.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return None
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, at_a, at_b = [], 0, 0
        for cut in cuts:
            to_a, to_b = int(np.searchsorted(ends_a, cut)) + 1, int(np.searchsorted(ends_b, cut)) + 1
            groups.append((a[at_a:to_a], b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        return len(a), len(b), groups

    return run


def plain_alignment(rows, walk):
    """The contract's columns of (id, text) rows by counting in dictionaries."""
    found = [(i, walk(t)) for i, t in rows]
    count = Counter()
    for _, w in found:
        count.update({(p, q) for a, b in (w[2] if w else ()) for p in a for q in b})
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for i, w in found:
        if w is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(p, q) for a, b in w[2] for p in a for q in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in w[2])
        out.append((i, w[0], w[1], len(w[2]), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    r = random.Random(8)
    letters = "ab é漢▁\n\t 0<|endoftext|>‍😀ß"
    noise = ["".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(60)]
    return noise + ["<|endoftext|> </s><unk>", " ", "\n", "\n\nx", "a\n b", "▁", "x▁y", " " * 30_000 + "x", "\n" * 20_000, "word " * 400, "\x00", "aaaa" * 900, "漢字かな" * 200, "​", "ﬁ ½"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 40, 0])
def test_alignment_is_the_walk_s(spark, walk, frequent, result):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(100 + i, t) for i, t in enumerate(odd_texts())]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_a string")
    got = alignment.align_documents(df, frequent=frequent)
    assert got.columns[:3] == ["doc_id", "n_a", "_n_a"]
    names = ["doc_id", "_n_a", *ALIGNED[2:]]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(plain_alignment(rows, walk), key=repr)


def test_products_are_those_of_dense_matrices():
    r = np.random.default_rng(1)
    for _ in range(20):
        a, b = r.integers(0, 3, (6, 5)), r.integers(0, 3, (5, 7))

        def csr(m):
            i, j = np.nonzero(m)
            return alignment.Csr.of_rows(i, j, m[i, j], len(m))

        got, dense = alignment.multiply(csr(a), csr(b), 7), np.zeros((6, 7), int)
        dense[got.rows(), got.column] = got.value
        assert (dense == a @ b).all()


def test_products_in_small_chunks(monkeypatch, models):
    tokens = alignment.Tokens(models[0], models[1])
    texts = [prose(1, 300), "", None, prose(2, 200), "aaaa" * 500]
    whole = alignment.align(texts, tokens)
    monkeypatch.setattr(alignment, "CHUNK", 7)
    monkeypatch.setattr(alignment, "COLLAPSE", 0)
    monkeypatch.setattr(alignment, "POOL_CHARS", 10)
    for x, y in zip(whole, alignment.align(texts, tokens)):
        assert (x.n_links, x.groups_sha256, x.n_overlaps) == (y.n_links, y.groups_sha256, y.n_overlaps)
        assert x.pairs.tolist() == y.pairs.tolist() and x.links.tolist() == y.links.tolist()


def test_fast_ids_are_the_model_s(models):
    tokens = alignment.Tokens(models[0], models[1])
    assert tokens.fast is not None
    for text in [*odd_texts(), *(chr(c) * 2 + "x" + chr(c) + " 1" for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000)]:
        assert tokens.ids_a(text).tolist() == tokens.slow.encode(" " + text, add_special_tokens=False).ids


def test_alignment_query(spark, walk, result):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = alignment.op13_alignment(spark, SF).collect()
    assert sorted(tuple(r[c] for c in ALIGNED) for r in got) == sorted(plain_alignment(rows, walk))


# --- language-model scores -----------------------------------------------------------------


class ExactModel:
    """The same smoothing from exact counts, of words and their n-grams."""

    def __init__(self, texts, order):
        self.order, self.count = order, Counter()
        for t in texts:
            w = self.padded(t)
            for k in range(order):
                self.count.update(tuple(w[i - k : i + 1]) for i in range(order, len(w)))
                self.count[("\n<s>",) * (k + 1)] += 1
        own = [(g, c) for g, c in self.count.items() if len(g) == 1 and g != ("\n<s>",)]
        self.tokens, self.distinct = sum(c for _, c in own), len(own)

    def padded(self, text):
        return ["\n<s>"] * self.order + split_words((text or "").translate(LOWER)) + ["\n</s>"]

    def base(self, text):
        w = self.padded(text)[self.order :]
        known = sum(self.count[(x,)] > 0 for x in w)
        return len(w), known, sum(math.log10((self.count[(x,)] + 1) / (self.tokens + self.distinct + 1)) for x in w)

    def score(self, text):
        def mean(g):
            c = self.count[g]
            return 0.75 * 2 ** c.bit_length() - 0.5 if c else 0.0

        w, total = self.padded(text), 0.0
        for i in range(self.order, len(w)):
            p = (mean((w[i],)) + 1) / (self.tokens + self.distinct + 1)
            for k in range(1, self.order):
                history = mean(tuple(w[i - k : i]))
                p = (min(mean(tuple(w[i - k : i + 1])), history) + bloom_lm.MASS * p) / (history + bloom_lm.MASS)
            total += math.log10(p)
        return total


def lm_rows():
    return [*odd_rows(), *((200 + i, prose(i % 30, 60), "en", "a", 1) for i in range(60))]


@pytest.mark.parametrize("order,limit,frequent", [(2, bloom_lm.FILTER_BYTES, bloom_lm.FREQUENT), (2, 4_000, 20), (3, 1, 0)])
def test_lm_scores_are_the_exact_model_s(spark, order, limit, frequent):
    """With 24 hashes a level no false positive is left; one filter, and ranges of parts."""
    rows = lm_rows()
    df = spark.createDataFrame(rows, DOCS)
    model = bloom_lm.train(df.filter("doc_id % 3 <> 0"), order=order, hashes=24)
    exact = ExactModel([r[1] for r in rows if r[0] is not None and r[0] % 3], order)
    assert (model.tokens, model.distinct) == (exact.tokens, exact.distinct)
    got = bloom_lm.score_documents(df.withColumnRenamed("lang", "score"), model, filter_bytes=limit, frequent=frequent)
    assert got.columns == ["doc_id", "score", "source", "n_chars", "n_tokens", "n_known", "base_score", "_score"]
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[3], 3))
    mine = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["_score"]) for r in got.collect()), key=key)
    want = sorted(((r[0], *exact.base(r[1]), exact.score(r[1])) for r in rows), key=key)
    for a, b in zip(mine, want, strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_filter_levels_and_false_positives():
    r = np.random.default_rng(2)
    grams = np.unique(r.integers(0, 2**64, 40_000, dtype=np.uint64))
    counts = r.geometric(0.3, len(grams)) ** 3
    part, key = bloom_lm._part_and_key(grams, 6)
    own = [bloom_lm.part_filter(key[part == p], counts[part == p], 5) for p in range(64)]
    shard = bloom_lm.Shard(0, np.cumsum([0, *map(len, own)]), np.concatenate(own), 6, 5)
    got, true = shard.levels(grams), bloom_lm.levels_of(counts)
    assert (got >= true).all() and (got == true).mean() > 0.93  # errors are one-sided
    strangers = shard.levels(r.integers(0, 2**64, 40_000, dtype=np.uint64))
    assert 0.015 < (strangers > 0).mean() < 0.05  # 2^-5
    assert shard.bits.nbytes * 8 < 1.05 * true.sum() * 5 / math.log(2) + 64 * 8


def test_lm_query_beats_the_plain_score_on_held_out_text(spark):
    got = bloom_lm.op12_lm_scoring(spark, SF).toPandas()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    exact = ExactModel([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2], 2)
    for r in got.itertuples():
        n, known, base = exact.base(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, exact.tokens) and r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.score < 0
    held = got[got.held_out]
    assert len(held) and held.score.sum() > held.base_score.sum()


def test_reruns_agree(spark):
    a, b = (sorted(map(tuple, bloom_lm.op12_lm_scoring(spark, SF).select("doc_id", "score").collect())) for _ in range(2))
    assert a == b
