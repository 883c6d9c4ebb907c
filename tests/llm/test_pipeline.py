"""The pipeline against a plain version, stage by stage, and on odd and empty tables."""

import hashlib

import pytest
from helpers import jaccard_components, odd_rows, split_words

import corpus_pipeline
from keyline.llm import decontamination, language_id
from keyline.llm.common import table

SF = "/root/testdata/sf0.001"


def test_against_plain_version(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").collect()]
    model = language_id.train(table(spark, SF, "documents").filter("crc32(cast(doc_id as string)) % 4 <> 2"))
    lang, score = model.predict([d[1] for d in docs])
    docs = [d for d, x, s in zip(docs, lang, score) if x != "und" and s >= language_id.ACCEPT]
    best: dict[str, tuple] = {}
    for d in docs:
        key = (d[1] or "").lower() if (d[1] or "").isascii() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d[1])
        if key not in best or d[0] > best[key][0]:
            best[key] = d
    docs = list(best.values())
    component = {i: c for i, _, c in jaccard_components([(d[0], d[1]) for d in docs])}
    docs = [d for d in docs if component[d[0]] == d[0]]
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    index = decontamination.BenchmarkIndex([i for i, _ in items], [t for _, t in items], *decontamination._weights([t for _, t in items]))
    docs = [d for d in docs if not index.hits([d[1]])[0]]

    sizes = {d[0]: len(split_words(d[1])) for d in docs}
    sources = sorted({d[3] for d in docs})
    total = {s: sum(sizes[d[0]] for d in docs if d[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    free, rest, target = set(sources), sum(total.values()), {}
    while True:
        share = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * total[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * total[s]
            rest -= target[s]
        free -= over
    target |= {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
    want = []
    for s in sources:
        budget, before = int(target[s] + 1e-9), 0
        epochs, left = divmod(budget, total[s])
        for d in sorted((d for d in docs if d[3] == s), key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()[:16]):
            n = sizes[d[0]]
            want.append((d[0], epochs * n + min(n, max(0, left - before))))
            before += n
    got = [(r["doc_id"], r["taken"]) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns(spark, odd, empty):
    for folder in (odd, empty):
        docs = table(spark, folder, "documents")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()


def test_odd_rows(spark, odd):
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, odd).collect()]
    assert not {2, 3, 4, 5, 6, 13} - {2, 3} & set(ids)  # no letter: gone
    assert len({1, 2, 3} & set(ids)) == 1  # one of the copies
    assert len(odd_rows()) > len(ids) > 0


def test_empty(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []
