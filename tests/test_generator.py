"""Generator: text construction rule, reuse, reproducibility and the size cut."""

import pytest
from pyspark.sql import functions as F

from keyline.sources.generator import (
    ALPHABET,
    WORDS,
    generate_lines,
    generated_lines,
    text_length,
    validate,
    word_picks,
)


def _words_part(words, length):
    """What of the words a text of ``length`` shows: all of them joined, or a cut that
    never ends in a joining space (the letter after it takes its place)."""
    joined = " ".join(words)
    if len(joined) <= length:
        return joined
    return joined[: length - 1] + joined[length - 1 : length + 1].lstrip(" ")[:1]


def test_text_rule(spark):
    df = generated_lines(spark, 3000, seed=7, reuse_chance=0.0)
    length, n_words, picked = word_picks(F.col("id"), 7)
    rows = df.select("text", length.alias("L"), n_words.alias("n"), F.array(*picked).alias("w")).collect()
    for r in rows:
        words = r.w[: r.n]
        assert len(words) == r.n and 1 <= r.n <= min(9, r.L // 5)
        prefix = _words_part(words, r.L)
        assert len(r.text) == r.L and 10 <= r.L <= 1024
        assert r.text.startswith(prefix)
        assert all(c in ALPHABET for c in r.text[len(prefix):])
        assert set(words) <= set(WORDS)


def test_reuse_and_reproducible(spark):
    a = generated_lines(spark, 5000, seed=3, reuse_chance=0.3)
    b = generated_lines(spark, 5000, seed=3, reuse_chance=0.3)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    stats = a.agg(F.count("*").alias("n"), F.countDistinct("text").alias("d")).first()
    assert stats.d < stats.n * 0.8
    # every reused text is one of the first 1,000 fresh texts before it
    first = a.groupBy("text").agg(F.min("id").alias("first_id"))
    assert first.where(F.col("first_id") > 5000).count() == 0
    neg = a.where(F.col("number") < 0).count()
    assert 0 < neg < 200


def test_grid_is_independent_of_row_count(spark, monkeypatch):
    import keyline.sources.generator as G

    monkeypatch.setattr(G, "ROWS_PER_PARTITION", 700)
    a = G.generated_lines(spark, 3000, seed=5, reuse_chance=0.2).where("id < 1500")
    b = G.generated_lines(spark, 1500, seed=5, reuse_chance=0.2)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert G.grid(spark, 3000).rdd.getNumPartitions() == 5
    # every reused text is an earlier fresh text, recomputed from its own grid cell
    fresh = G.generated_lines(spark, 3000, seed=5, reuse_chance=0.0).select("id", "text")
    pool = G.pool_ids(spark, 3000, 5, 0.2)
    texts = set(r.text for r in fresh.where(F.col("id").isin(pool)).collect())
    reused = a.join(fresh.withColumnRenamed("text", "own"), "id").where("text != own")
    assert reused.count() > 0 and all(r.text in texts for r in reused.collect())


def test_all_reuse_repeats_first_text(spark):
    df = generated_lines(spark, 500, seed=1, reuse_chance=1.0)
    assert df.select("text").distinct().count() == 1


@pytest.mark.parametrize("target", [1, 537, 20_000, 300_000])
def test_size_cut(spark, target):
    df = generate_lines(spark, target_chars=target, seed=11, reuse_chance=0.01)
    sizes = [len(r.value) + 1 for r in df.orderBy("id").select("value").collect()]
    assert sum(sizes) >= target
    assert sum(sizes[:-1]) < target


def test_validation():
    with pytest.raises(ValueError):
        validate(0, 0.01)
    with pytest.raises(ValueError):
        validate(1, 1.5)


@pytest.mark.parametrize("target", [5_000, 123_457])
def test_size_cut_multi_level_search(spark, monkeypatch, target):
    import keyline.sources.generator as G

    monkeypatch.setattr(G, "FANOUT", 8)
    n, pool = G.find_cut(spark, target, 3, 0.05)
    sizes = [
        r["size"] for r in G._size_rows(spark, 0, n, 3, 0.05, pool).orderBy("id").collect()
    ]
    assert sum(sizes) >= target > sum(sizes[:-1])


def test_grid_cells_cap_task_count(monkeypatch):
    import keyline.sources.generator as G

    monkeypatch.setattr(G, "MAX_PARTITIONS", 10)
    assert G.rows_per_partition(1_000) == G.ROWS_PER_PARTITION
    assert G.rows_per_partition(10**9) == 10**8


def test_rows_do_not_depend_on_the_task_cap(spark, monkeypatch):
    import keyline.sources.generator as G

    whole = G.generated_lines(spark, 2000, seed=9, reuse_chance=0.1).where("id < 1000")
    monkeypatch.setattr(G, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(G, "MAX_PARTITIONS", 3)
    capped = G.generated_lines(spark, 1000, seed=9, reuse_chance=0.1)
    assert whole.exceptAll(capped).count() == 0 and capped.exceptAll(whole).count() == 0


def test_padding_is_uniform_over_the_alphabet(spark):
    from collections import Counter

    from keyline.sources.generator import padding

    rows = spark.range(400).select(padding(F.col("id"), 5, F.lit(500)).alias("p")).collect()
    assert all(len(r.p) == 500 for r in rows)
    counts = Counter("".join(r.p for r in rows))
    assert set(counts) == set(ALPHABET)
    assert max(counts.values()) < 1.1 * 200_000 / 62 and min(counts.values()) > 0.9 * 200_000 / 62
