"""Sort audit: FIXTURES.md §5 table and randomised audits against a sequential model."""

import os
import random

import pytest

from keyline.operators.audit import audit_lines
from model import audit_model

CASES = [
    (["1. a", "2. a", "1. b"], 3, dict(status="ok", is_sorted=True, found_duplicate=True)),
    (["1. a", "1. b"], 2, dict(status="no_duplicates", is_sorted=True, found_duplicate=False)),
    (["1. a", "2. a"], 3, dict(status="count_mismatch", is_sorted=True, line_counts_match=False)),
    (
        ["1. b", "1. a", "2. a"],
        3,
        dict(status="order_violation", violation_line=2, sorted_lines=2, found_duplicate=False,
             previous_line="1. b", current_line="1. a"),
    ),
    (["2. a", "1. a"], 2, dict(status="order_violation", violation_line=2, found_duplicate=False)),
    (
        ["x", "1. a"],
        2,
        dict(status="order_violation", violation_line=1, sorted_lines=1,
             previous_line="N/A (first or previous was invalid)", current_line="x"),
    ),
    (["1. a", "", "1. a"], 3, dict(status="ok", found_duplicate=True, sorted_lines=3)),
    (
        ["1. a", "2. a", "bad", "0. a"],
        4,
        dict(status="order_violation", violation_line=3, previous_line="2. a", current_line="bad",
             found_duplicate=True),
    ),
    ([], 0, dict(status="no_duplicates", is_sorted=True, sorted_lines=0, line_counts_match=True)),
]


def _write(path, lines, newline="\n"):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("".join(line + newline for line in lines))


@pytest.mark.parametrize("method", ["arrow", "window"])
@pytest.mark.parametrize("idx", range(len(CASES)))
def test_audit_fixture_table(spark, tmp_dir, idx, method):
    lines, n_orig, expected = CASES[idx]
    orig = os.path.join(tmp_dir, "orig.txt")
    srt = os.path.join(tmp_dir, "sorted.txt")
    _write(orig, [f"{i}. o" for i in range(n_orig)])
    _write(srt, lines)
    row = audit_lines(spark, orig, srt, method=method).first().asDict()
    model = audit_model([""] * n_orig, lines)
    assert row == model
    for k, v in expected.items():
        assert row[k] == v, (k, row)


def _random_lines(rng, n):
    texts = ["a", "b", "ab", "é", "", "\U0001f600", "z z"]
    recs = sorted(
        ((rng.randint(-3, 3), rng.choice(texts)) for _ in range(n)),
        key=lambda r: (r[1].encode("utf-16-be", "surrogatepass"), r[0]),
    )
    lines = [f"{a}. {b}" for a, b in recs]
    for _ in range(rng.randint(0, 3)):
        kind = rng.random()
        pos = rng.randint(0, len(lines))
        if kind < 0.3:
            lines.insert(pos, rng.choice(["", "  ", "　"]))
        elif kind < 0.5:
            lines.insert(pos, "junk")
        elif kind < 0.8 and len(lines) > 1:
            i, j = rng.sample(range(len(lines)), 2)
            lines[i], lines[j] = lines[j], lines[i]
    return lines


@pytest.mark.parametrize("method", ["arrow", "window"])
@pytest.mark.parametrize("seed", range(16))
def test_audit_random_tiny_splits(spark, tmp_dir, seed, method):
    rng = random.Random(seed)
    n_files = rng.randint(1, 3)
    all_lines = []
    folder = os.path.join(tmp_dir, "sorted")
    os.makedirs(folder)
    base = _random_lines(rng, rng.randint(0, 120))
    cuts = sorted(rng.randint(0, len(base)) for _ in range(n_files - 1))
    pieces = [base[i:j] for i, j in zip([0] + cuts, cuts + [len(base)])]
    for i, piece in enumerate(pieces):
        _write(os.path.join(folder, f"part-{i:05d}.txt"), piece, rng.choice(["\n", "\r\n"]))
        all_lines.extend(piece)
    orig = os.path.join(tmp_dir, "orig.txt")
    n_orig = len(all_lines) + rng.choice([0, 0, 1])
    _write(orig, ["1. x"] * n_orig)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_open = spark.conf.get("spark.sql.files.openCostInBytes")
    old_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    # tiny Arrow batches: a split's previous line is often in the batch before
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rng.choice([1, 2, 3, 10000])))
    try:
        row = audit_lines(spark, orig, folder, method=method).first().asDict()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", old_open)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old_batch)
    assert row == audit_model([""] * n_orig, all_lines)
