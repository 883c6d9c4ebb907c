"""Language id, token counts, toxicity, PII against brute force or held-out accuracy."""

import hashlib
import random
import re

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from helpers import odd_rows, plain_pii, prose
from pyspark.sql import functions as F

from keyline.llm import language_id, pii, token_counts, toxicity

SF = "/root/testdata/sf0.001"


def test_ppm_costs_are_the_tree_s():
    """Bulk look-ups against a byte-by-byte walk of the trees."""
    import math

    texts = {0: [b"abracadabra abra", b"cadabra"], 1: [b"hocus pocus", b"abracus"]}
    counts: dict[tuple, int] = {}
    for lang, several in texts.items():
        for t in several:
            for k in range(4):
                for i in range(k, len(t)):
                    counts[lang, t[i - k : i + 1]] = counts.get((lang, t[i - k : i + 1]), 0) + 1
    rows = [(lang, len(g) - 1, int.from_bytes(g, "big"), n) for (lang, g), n in counts.items()]
    model = language_id.PpmModel(["a", "b"], pd.DataFrame(rows, columns=["language", "order", "key", "n"]), 3)

    def walk(lang, text):
        bits = 0.0
        for i in range(len(text)):
            for k in range(min(3, i), -1, -1):
                seen = {g[-1:]: n for (x, g), n in counts.items() if x == lang and len(g) == k + 1 and g[:-1] == text[i - k : i]}
                total, distinct = sum(seen.values()), len(seen)
                if text[i : i + 1] in seen:
                    bits -= math.log2(seen[text[i : i + 1]] / (total + distinct))
                    break
                if seen:
                    bits -= math.log2(distinct / (total + distinct))
            else:
                bits += 8
        return bits

    probes = [b"abra", b"pocus abra", b"zzz\xff", b"", b"a", b"cadabrahocus" * 30]
    got = model.code_lengths(probes)
    for i, p in enumerate(probes):
        for lang in (0, 1):
            assert got[i][lang] == pytest.approx(walk(lang, p), rel=1e-5, abs=1e-4)


def test_chunks_do_not_change_costs(monkeypatch):
    rows = [(0, 0, b, 1 + b % 3) for b in range(97, 123)] + [(0, 1, (a << 8) | b, 1) for a in range(97, 123) for b in range(97, 110)]
    model = language_id.PpmModel(["a"], pd.DataFrame(rows, columns=["language", "order", "key", "n"]), 1)
    text = prose(9, 500).encode()
    whole = model.code_lengths([text])
    monkeypatch.setattr(language_id, "CHUNK", 64)
    assert model.code_lengths([text])[0] == pytest.approx(whole[0])


def test_language_held_out(spark):
    got = language_id.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out & got.lang.notna()]
    assert len(held) and (held.lang == held.lang_pred).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_language_of_few_long_documents_is_taught(spark, monkeypatch):
    """A language whose text lies in two long documents gives pieces to a small sample."""
    monkeypatch.setattr(language_id, "LANGUAGE_BYTES", 8_000)
    long = [(i, "ωκεανός " * 20_000, "el") for i in range(2)]
    short = [(10 + i, prose(i, 60), "en") for i in range(40)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == ["el", "en"] and model.predict(["ωκεανός ωκεανός"])[0] == ["el"]
    assert model.code_lengths(["ωκεανός".encode()])[0][0] < 14 * 6


def test_language_odd_rows(spark, odd):
    got = {r["doc_id"]: r for r in language_id.op1_language_id(spark, odd).collect()}
    assert [got[i]["lang_pred"] for i in (4, 5, 6, 13)] == ["und"] * 4 and got[13]["score"] == 0.0
    assert got[7]["lang_pred"] == "en" and not got[1]["score"] > 1


def test_identify_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([("a b", 1.5, "x")], "text string, score double, lang_pred string")
    model = language_id.PpmModel([], pd.DataFrame({c: pd.Series(dtype="int64") for c in ("language", "order", "key", "n")}))
    row = language_id.identify(docs, model).first()
    assert row["score"] == 1.5 and row["lang_pred"] == "x" and row["_lang_pred"] == "und" and row["_score"] == 0.0


def test_token_counts_are_the_encoder_s(spark, odd):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.op5_token_counts(spark, odd).collect()), key=repr)
    want = []
    for i, text, *_ in odd_rows():
        n = len(sp.encode(text or ""))
        want.append((i, len((text or "").encode()), n, n > 4096))
    assert got == sorted(want, key=repr)


def test_pre_tokens_on_random_texts():
    path = public_tokenizers.path(token_counts.MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        encoder = token_counts.Encoder(f.read())
    r = random.Random(7)
    parts = ["a", "b", " ", "  ", "\n", "\t", "▁", ".", "é", "<s>", "<unk>", "\x00", "😀", "漢", "word", "   "]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(20)))
        assert sum(map(encoder.count, token_counts.pre_tokens(text))) == len(sp.encode(text)), repr(text)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op6_toxicity(spark, sf)
    got = got.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").toPandas()
    held = got[got.held_out]
    rank = held.score.rank()
    n1 = int(held.toxic.sum())
    auc = (rank[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(held) - n1))
    assert auc >= 0.75 and held.toxic[held.predicted == 1].mean() >= 0.8
    assert held.predicted[held.toxic == 1].mean() >= 0.65
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()


def test_toxicity_on_enough_labels(spark):
    """Held-out recall and precision where some hundred toxic rows teach."""
    sf = "/root/testdata/sf0.1"
    got = toxicity.op6_toxicity(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").toPandas()
    assert got.predicted[got.toxic == 1].mean() >= 0.85 and got.predicted[got.toxic == 0].mean() <= 0.02


def test_differences_are_plain_zstandard_s():
    """Against one compressor a window, built anew."""
    import zstandard

    model = toxicity.CompressionModel(["plain", "words", "here"], [b" dread", b"scum "])
    raw = toxicity.windows("plain dreadful words here scum " * 9 + "last dreadnought")
    lengths = []
    for content in model._contents:
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=toxicity.LEVEL)
        lengths.append([len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False).compress(w)) for w in raw])
    assert len(model._contents[0]) == len(model._contents[1])
    assert model.differences(raw).tolist() == [a - b for a, b in zip(*lengths)] and model.differences(raw).max() > 0
    assert toxicity.windows(None) == [] and model.features(["", None, "plain words"]).sum() == 0


def test_toxicity_of_planted_words(spark):
    """Documents with the words that only toxic training documents have."""
    plain = [(i, prose(100 + i, 60), 0) for i in range(200)]
    rude = [(1000 + i, prose(300 + i, 60) + " dreadfulscum " + prose(600 + i, 10), 1) for i in range(60)]
    rows = spark.createDataFrame(plain + rude, "doc_id long, text string, toxic int")
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    new = spark.createDataFrame([(1, prose(901, 60)), (2, prose(902, 60) + " dreadfulscum"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(new, model).collect()}
    assert got[2] >= 0.7 and max(got[1], got[3], got[4]) < 0.5 and got[3] == got[4]


TRICKY = [
    "a@b.co_x@y.com, x@@y.z a@b c@d.e.f. @x.y 1@2.3",
    "1.2.3.4.5.6.7.8 1.2.3.256 01.002.3.4 1.2.3 999999.1.1.1 1.2.3.4.",
    "4111 1111 1111 1111 4111-1111-1111-1112 5500005555555559 4111  1111 1111 1111 0000000000000000000000",
    "+1 (017) 555-7713 +12 +1+1 234 567 8901 +49.30.1234567. +999 999 999 999 999 9",
    "é+1 234 567 890 é 日本 user.name+tag@mail-x.example.org",
]


@pytest.mark.parametrize("text", TRICKY)
def test_rules_on_tricky_texts(text):
    assert [(s, pii.KINDS[k], e) for s, k, e in pii.base_spans(text)] == plain_pii(text)


def test_rules_on_random_texts():
    r = random.Random(11)
    parts = ["a", "Z", "1", "23", "4111111111111111", "@", ".", "-", "+", " ", "(", ")", "é", "_", "%", "255", "256", "\n"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(30)))
        assert [(s, pii.KINDS[k], e) for s, k, e in pii.base_spans(text)] == plain_pii(text), repr(text)


def test_rules_are_linear_in_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "+" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000):
        pii.places(text, pii.base_spans(text))


def test_pii_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in pii.op10_pii(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        spans, r = plain_pii(d["text"]), got[d["doc_id"]]
        text = ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(x[1] == k for x in spans) for k in ("email", "ip", "card", "phone")]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("id:")] == [x for x in text.split(",") if x]


def test_bootstrap_goes_on_until_nothing_grows(spark):
    """A chain of six patterns, each of whose values the one before makes known."""
    edges = [(f"p{k}", f"v{j}-{i}", j == 0) for k in range(6) for j in (k, k + 1) for i in range(6 if j == k else 3)]
    # v{k+1} has six values; a pattern p{k}b shares its other half.
    edges += [(f"q{k}", f"v{j}-{i}", j == 0) for k in range(6) for j in (k, k + 1) for i in (range(6) if j == k else range(3, 6))]
    got = pii.trusted_patterns(spark.createDataFrame(edges, "pattern string, value string, known boolean"))
    assert {r["pattern"] for r in got.collect()} == {f"{x}{k}" for x in "pq" for k in range(6)}


def test_groups_and_line_starts_are_candidates(spark):
    rows = [(i, f"Please write to user{i}@mail{i}.example.com today\nand reach me at\nuser{i}@mail{i}.example.com") for i in range(8)]
    rows += [(100, "Please write to 555 123 4567 now"), (101, "and reach me at\nagent-007x"), (102, "Please write to DE89 3704 0044 0532 0130 00.")]
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    spans = lambda i: {rows[8 + i - 100][1][s["start"] : s["end"]] for s in found[i]}
    assert "555 123 4567" in spans(100) and "agent-007x" in spans(101) and "DE89 3704 0044 0532 0130 00" in spans(102)


def test_bootstrap_finds_unseen_identifiers(spark):
    """Known addresses teach "write to"; an identifier that no rule knows follows it."""
    rows = [(i, f"Please write to user{i}@mail{i}.example.com today") for i in range(8)]
    rows += [(100, "Please write to agent-007x now"), (101, "the flat agent12345 is old"), (102, "Please write to"), (103, None)]
    found = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["start"], s["kind"], s["end"]) for s in found[100]["spans"]] == [(16, 4, 26)]
    assert found[101]["spans"] == [] and found[102]["spans"] == [] and found[103]["spans"] == []
    assert [s["kind"] for s in found[3]["spans"]] == [0]


def test_bootstrap_finds_planted_secrets(spark):
    """At least 0.9 of planted places of several forms, whatever their length; prose none."""
    r = random.Random(4)
    word = lambda n: "".join(r.choice("bcdfgaeiou") for _ in range(n))
    secrets = [r.choice([*["%040x" % r.getrandbits(160)] * 6, word(11), f"{word(4)}{r.randrange(100)}", "k" * 90 + str(r.randrange(10**6))]) for _ in range(120)]
    forms = ['the token = "%s" is set', "use password: %s and go", "with api_key='%s' then", "login as                                   \n                                                          %s please"]
    rows, want = [], {}
    for i, secret in enumerate(secrets + ["%040x" % r.getrandbits(160) for _ in range(40)]):
        before, after = prose(1000 + i, 12), prose(2000 + i, 9)
        text = f"{before} {forms[i % 4] % secret} {after}"
        at = text.index(secret, len(before))
        rows.append((i, text))
        want[i] = (at, at + len(secret))
    rows += [(5000 + i, prose(4000 + i, 40)) for i in range(100)]
    got = {x["doc_id"]: {(s["start"], s["end"]) for s in x["spans"]} for x in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(place in got[i] for i, place in want.items() if i % 4 < 3) >= 0.9 * sum(i % 4 < 3 for i in want)
    assert not any(got[5000 + i] for i in range(100))


def test_bootstrap_finds_every_token_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["spans"] for r in pii.op10_pii(spark, sf).collect()}
    places = [(i, m.start(1), m.end(1)) for i, t in texts.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t)]
    assert places and all(f"id:{a}:{b}" in got[i].split(",") for i, a, b in places)


def test_bootstrap_spreads_over_rounds(spark):
    """A value known from a trusted pattern makes another pattern trusted in the next round."""
    edges = [("a b", f"v{i}", True) for i in range(6)] + [("a b", f"w{i}", False) for i in range(3)]
    edges += [("c d", f"v{i}", False) for i in range(4)] + [("c d", f"w{i}", False) for i in range(3)] + [("c d", f"z{i}", False) for i in range(4)]
    graph = spark.createDataFrame(edges, "pattern string, value string, known boolean")
    assert {r["pattern"] for r in pii.trusted_patterns(graph, 1).collect()} == {"a b"}
    assert {r["pattern"] for r in pii.trusted_patterns(graph, 3).collect()} == {"a b", "c d"}
