"""Benchmark: headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Inputs are line files built from the given tables (not
timed), plus a generated file of ``$BENCH_GEN_MB`` MB (generation is timed):

- ``sort_lineitem``: sort the lineitem lines file (``l_orderkey. flag status partkey``)
- ``audit_lineitem``: audit that output against its input
- ``sort_documents``: sort the document lines file (non-ASCII, long lines)
- ``parse_mixed``: parse the C5 lines file and count rejects by reason
- ``generate``: generate ``$BENCH_GEN_MB`` MB of lines
- ``sort_generated`` / ``audit_generated``: sort and audit the generated file
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from keyline.operators.audit import audit_lines  # noqa: E402
from keyline.operators.filter import reject_reason  # noqa: E402
from keyline.plans import corpora as C  # noqa: E402
from keyline.plans.generate_file import generate_file  # noqa: E402
from keyline.plans.sort_file import sort_file  # noqa: E402
from keyline.session import local_session  # noqa: E402
from keyline.functions.record import with_parsed  # noqa: E402
from keyline.sources.lines import read_lines  # noqa: E402
from keyline.sources.sinks import write_lines  # noqa: E402


def _timed(fn):
    t = time.time()
    out = fn()
    return time.time() - t, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    gen_mb = int(os.environ.get("BENCH_GEN_MB", "1000"))
    scratch = tempfile.mkdtemp(prefix="keyline-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 4 if cpus.isdigit() else 32, app="keyline-bench")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    # Inputs (not timed).
    li = C.table(spark, sf_dir, "lineitem")
    li_lines = li.select(
        F.concat(
            F.col("l_orderkey").cast("string"),
            F.lit(". "),
            F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")),
        ).alias("value")
    )
    paths = {k: os.path.join(scratch, k) for k in ("lineitem", "documents", "mixed")}
    write_lines(li_lines, paths["lineitem"])
    write_lines(C.c3_documents(spark, sf_dir), paths["documents"])
    write_lines(C.c5_mixed(spark, sf_dir), paths["mixed"])

    q: dict[str, float] = {}
    q["sort_lineitem"], rep = _timed(lambda: sort_file(spark, paths["lineitem"], paths["lineitem"] + ".sorted", report_path=None))
    q["audit_lineitem"], a1 = _timed(lambda: audit_lines(spark, paths["lineitem"], paths["lineitem"] + ".sorted").first())
    q["sort_documents"], _ = _timed(lambda: sort_file(spark, paths["documents"], paths["documents"] + ".sorted", report_path=None))

    def parse_mixed():
        p = with_parsed(read_lines(spark, paths["mixed"]))
        return p.groupBy(F.coalesce(reject_reason(F.col("parse_error")), F.lit("ok")).alias("r")).count().collect()

    q["parse_mixed"], _ = _timed(parse_mixed)
    gen = os.path.join(scratch, "generated")
    q["generate"], _ = _timed(lambda: generate_file(spark, gen, gen_mb))
    q["sort_generated"], rep_g = _timed(lambda: sort_file(spark, gen, gen + ".sorted", report_path=None))
    q["audit_generated"], a2 = _timed(lambda: audit_lines(spark, gen, gen + ".sorted").first())

    ok = a1["status"] in ("ok", "no_duplicates") and a1["is_sorted"] and a2["is_sorted"]
    mb = gen_mb * 1_000_000 / 1e6
    out = {
        "metric": "total_sec",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "generated_mb": gen_mb,
        "sort_generated_mb_per_sec": round(mb / q["sort_generated"], 2),
        "rows_sorted_generated": rep_g["rows_out"],
        "rows_sorted_lineitem": rep["rows_out"],
        "audits_sorted": bool(ok),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
