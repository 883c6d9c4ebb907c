import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import DOCS, odd_rows  # noqa: E402

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """A data folder with odd documents."""
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd_rows(), DOCS).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0, 1), (2, 1, 0), (3, 1, 0), (4, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    text = odd_rows()[8][1].split()
    items = [(1, " ".join(text[500:530])), (2, None), (3, ""), (None, "not in any of them at all here"), (4, "zz yy")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    vectors = [(1, [0.5, 1.0, -1.0], 0), (2, [0.25, 3.0, 2.0], 1), (3, None, 0), (4, [None, 1.0, 2.0], None), (None, [0.5, 1.0, -1.0], 1), (5, [float("nan")] * 3, 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    big = "<p>" + "long page " * 200
    pages = [(1, "http://a/", big), (2, "http://b/", big), (3, None, big), (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (None, "u", big), (2, "u", "é\r\n\r\nWARC/1.1\r\n" * 90), (8, "u v\r\n", "é\r\n\r\nWARC/1.1\r\n" * 90)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(spark, odd, tmp_path_factory):
    """A data folder with the same tables, without rows."""
    folder = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{odd}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.fixture(scope="session")
def oracle():
    """Rows of DuckDB SQL over a data folder, as a sorted list with columns by name."""

    def run(sql: str, folder: str) -> list[tuple]:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
        rel = con.sql(sql)
        names = sorted(rel.columns)
        return sorted((tuple(dict(zip(rel.columns, r))[c] for c in names) for r in rel.fetchall()), key=repr)

    return run


@pytest.fixture(scope="session")
def result():
    def run(df) -> list[tuple]:
        names = sorted(df.columns)
        return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)

    return run
