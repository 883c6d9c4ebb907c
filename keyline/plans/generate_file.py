"""Generate a keyed line file of a given size (SRC-3 + SNK-1)."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from keyline.plans.sort_file import validate_paths
from keyline.sources.generator import SIZE_UNIT, generate_lines, validate
from keyline.sources.sinks import write_lines


def generate_file(
    spark: SparkSession,
    output_path: str,
    size_mb: int,
    reuse_chance: float = 0.01,
    seed: int = 0,
) -> dict:
    """Write generated lines totalling at least ``size_mb * 1,000,000`` characters
    (newlines included) to ``output_path`` as ordered part files; return counts."""
    validate(size_mb, reuse_chance)
    validate_paths(output_path)
    started = time.time()
    lines = generate_lines(spark, size_mb, seed, reuse_chance)
    write_lines(lines, output_path, "value")
    return {
        "output": output_path,
        "target_chars": int(size_mb) * SIZE_UNIT,
        "elapsed_seconds": round(time.time() - started, 3),
    }
