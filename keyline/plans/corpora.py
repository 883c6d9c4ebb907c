"""Keyed line corpora built from the driver's tables (FIXTURES.md §6), in Spark and
in DuckDB SQL. Each corpus has a stable row id so results can be compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyline.functions.text import WHITESPACE
from keyline.sources.lines import LINE_BREAKS


def _line(number, text):
    return F.concat(number.cast("string"), F.lit(". "), text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def c1_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1: ``line_id, value`` = ``p_partkey. p_name`` (many repeated texts)."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("line_id"), _line(F.col("p_partkey"), F.col("p_name")).alias("value"))


def c2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2: ``o_orderkey. o_orderpriority`` (five texts, all valid)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("line_id"), _line(F.col("o_orderkey"), F.col("o_orderpriority")).alias("value")
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, idx, line``: documents split on CRLF, CR and LF (idx from 1)."""
    d = table(spark, sf_dir, "documents")
    parts = d.select("doc_id", F.posexplode(F.split("text", LINE_BREAKS, -1)).alias("pos", "line"))
    return parts.select("doc_id", (F.col("pos") + 1).alias("idx"), "line")


def c3_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3: ``doc_id. line`` for every document line (non-ASCII, long lines)."""
    return document_lines(spark, sf_dir).select(
        "doc_id", "idx", F.concat(F.col("doc_id").cast("string"), F.lit(". "), "line").alias("value")
    )


def c4_raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: the document lines without a prefix (nearly all rejects)."""
    return document_lines(spark, sf_dir).select("doc_id", "idx", F.col("line").alias("value"))


def c5_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5: every parser branch, chosen by order key (first match wins)."""
    o = table(spark, sf_dir, "orders")
    k, pr = F.col("o_orderkey"), F.col("o_orderpriority")
    ks = k.cast("string")
    value = (
        F.when(k % 13 == 0, F.lit(""))
        .when(k % 11 == 0, F.concat(F.lit("abc. "), ks))
        .when(k % 7 == 0, F.concat(F.lit(" "), ks, F.lit(" .  "), pr, F.lit(" ")))
        .when(k % 5 == 0, F.concat(ks, F.lit(" no dot")))
        .when(k % 3 == 0, F.concat(F.lit("+00"), ks, F.lit("."), pr))
        .otherwise(F.concat(ks, F.lit(". "), pr))
    )
    return o.select(k.alias("line_id"), value.alias("value"))


# ---------------------------------------------------------------- DuckDB side

WS_SQL = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

C1_SQL = "SELECT p_partkey AS line_id, CAST(p_partkey AS VARCHAR) || '. ' || p_name AS value FROM part"
C2_SQL = "SELECT o_orderkey AS line_id, CAST(o_orderkey AS VARCHAR) || '. ' || o_orderpriority AS value FROM orders"
C5_SQL = """SELECT o_orderkey AS line_id, CASE
  WHEN o_orderkey % 13 = 0 THEN ''
  WHEN o_orderkey % 11 = 0 THEN 'abc. ' || CAST(o_orderkey AS VARCHAR)
  WHEN o_orderkey % 7 = 0 THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' .  ' || o_orderpriority || ' '
  WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) || ' no dot'
  WHEN o_orderkey % 3 = 0 THEN '+00' || CAST(o_orderkey AS VARCHAR) || '.' || o_orderpriority
  ELSE CAST(o_orderkey AS VARCHAR) || '. ' || o_orderpriority END AS value FROM orders"""
DOC_LINES_SQL = r"""SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS idx
FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS parts FROM documents)"""
C3_SQL = f"SELECT doc_id, idx, CAST(doc_id AS VARCHAR) || '. ' || line AS value FROM ({DOC_LINES_SQL})"
C4_SQL = f"SELECT doc_id, idx, line AS value FROM ({DOC_LINES_SQL})"


def parse_sql(src: str, ids: str = "line_id") -> str:
    """DuckDB form of the record parse over ``src`` (a SELECT with ``ids`` and ``value``)."""
    return f"""SELECT {ids}, value,
  CASE WHEN err IS NULL THEN num END AS number,
  CASE WHEN err IS NULL THEN trim(after, {WS_SQL}) END AS text,
  err AS parse_error
FROM (SELECT *, CASE
    WHEN value IS NULL OR value = '' THEN 'Malformed line: is null or empty'
    WHEN dot = 0 OR after = '' THEN 'Malformed line: no dot or no text after dot. Value: ' || value
    WHEN num IS NULL THEN 'Malformed line (invalid number part ''' || num_part || '''). Full line: ' || value
  END AS err
  FROM (SELECT *, CASE WHEN regexp_full_match(num_part, '[+-]?[0-9]+') THEN TRY_CAST(num_part AS BIGINT) END AS num
    FROM (SELECT *,
        trim(CASE WHEN dot > 0 THEN substr(value, 1, dot - 1) ELSE '' END, {WS_SQL}) AS num_part,
        CASE WHEN dot > 0 THEN substr(value, dot + 1) ELSE '' END AS after
      FROM (SELECT {ids}, value, strpos(value, '.') AS dot FROM ({src}) AS s0) AS s1) AS s2) AS s3) AS s4"""
