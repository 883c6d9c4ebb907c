"""Splittable UTF-16/32 source: every split size against a sequential model."""

import os
import random

import pytest

from keyline.sources.lines import read_numbered_lines
from keyline.sources.wide import _UNITS, window_lines

CHARSETS = ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE"]
# Pieces that stress the break scan: misaligned 0A/0D bytes, surrogate pairs, all break kinds.
PIECES = ["a", "1. x", "ੁ", "Ā", "ഊ", "਍", "\U0001f600", "\r", "\n", "\r\n", " ", ""]


def _model(data: bytes, charset: str) -> list[str]:
    _, codec, bom = _UNITS[charset]
    if data.startswith(bom):
        data = data[len(bom):]
    text = data.decode(codec, errors="replace")
    if text == "":
        return []
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def _random_file(rng, charset, bom):
    _, codec, mark = _UNITS[charset]
    text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))
    return (mark if bom else b"") + text.encode(codec, "surrogatepass")


class _Mem:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, off):
        return self.data[off : off + n]


@pytest.mark.parametrize("charset", CHARSETS)
def test_windows_partition_lines(charset):
    rng = random.Random(charset)
    u = len(_UNITS[charset][2])
    for trial in range(300):
        data = _random_file(rng, charset, bom=trial % 3 == 0)
        want = _model(data, charset)
        for split in range(u, 12 * u + 1, u):
            got = []
            for s in range(0, len(data), split):
                lines = window_lines(_Mem(data), charset, s, min(s + split, len(data)), len(data))
                got.extend([] if lines is None else lines.to_pylist())
            assert got == want, (data, split)


@pytest.mark.parametrize("charset", CHARSETS)
def test_spark_tiny_splits(spark, tmp_dir, charset):
    rng = random.Random(7)
    folder = os.path.join(tmp_dir, "wide-" + charset)
    os.makedirs(folder)
    want = []
    for i in range(3):
        data = _random_file(rng, charset, bom=i == 0) + "\n".join(f"{i}.{j} z" for j in range(50)).encode(_UNITS[charset][1])
        with open(os.path.join(folder, f"part-{i:05d}.txt"), "wb") as f:
            f.write(data)
        want.extend(_model(data, charset))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "24")
    try:
        rows = read_numbered_lines(spark, folder, charset).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(rows, key=lambda r: r.line_no)] == want
    assert sorted(r.line_no for r in rows) == list(range(1, len(want) + 1))


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-32BE"])
def test_sort_and_audit_wide_input(spark, tmp_dir, charset):
    from keyline.operators.audit import audit_lines
    from keyline.plans.sort_file import sort_file

    rng = random.Random(3)
    texts = ["b", "a", "ੁĀ", "\U0001f600 x", "", "a"]
    lines = [f"{rng.randint(1, 99)}. {rng.choice(texts)}" for _ in range(400)]
    src = os.path.join(tmp_dir, "in-" + charset)
    os.makedirs(src)
    _, codec, bom = _UNITS[charset]
    with open(os.path.join(src, "part-00000.txt"), "wb") as f:
        f.write(bom + "\r\n".join(lines).encode(codec))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        out = os.path.join(tmp_dir, "out-" + charset)
        report = sort_file(spark, src, out, encoding=charset, report_path=None)
        verdict = audit_lines(spark, src, out, encoding=charset).first()
        got = [r.value for r in sorted(read_numbered_lines(spark, out, charset).collect(), key=lambda r: r.line_no)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

    def key(line):
        n, t = line.split(". ", 1)
        return (t.encode("utf-16-be", "surrogatepass"), int(n))

    assert report["rows_out"] == 400
    assert got == sorted(lines, key=key)
    assert verdict.status == "ok" and verdict.original_lines == 400 and verdict.sorted_lines == 400
