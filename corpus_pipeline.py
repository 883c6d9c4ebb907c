"""A corpus from raw documents, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), works on all
rows that the stage before kept, and returns a DataFrame. ``run`` writes each stage's
result as Parquet in the shared checkpoint folder and reads it back for the next. All but
the last return the columns of ``documents``; the last returns the mix.

A stage's result is read from tables that the stage wrote on its way. They are deleted
when the next stage begins, whose ``docs`` is the written result, so that disk never holds
the intermediates of two stages.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyline.llm import decontamination, exact_dedup, jaccard_join, language_id, mixing
from keyline.llm.common import discard, materialize, recorded, release_memory, table

_leftovers: list[str] = []


def _stage(function):
    """A stage that first deletes what the stage before has left."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _leftovers)
        with recorded() as folders:
            out = function(spark, docs, sf_dir)
        _leftovers.extend(folders)
        release_memory()
        return out

    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with a score of at least ``ACCEPT``; text
    that is null or has no letter goes, and so does text that no language fits best."""
    model = language_id.train(docs.filter(language_id.teaches(F.col("doc_id"))))
    marked = language_id.identify(docs, model)
    lang, score = marked.columns[-2:]
    kept = marked.filter((F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= language_id.ACCEPT))
    return kept.select(*docs.columns)


@_stage
def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of documents with equal texts (A-Z lowered), the one with the largest id; null
    and empty texts are equal, a null id loses to any, and of rows that repeat both id and
    text one stays. An empty table stays empty."""
    return exact_dedup.exact_groups(docs).survivors()


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each component of near duplicates, the document with the least id; a null
    id loses to any. Documents without words stay; rows that repeat both id and text are one
    document and stay together. An empty table stays empty."""
    return jaccard_join.keep_one(docs)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have no window similar to a benchmark item; null and empty texts
    stay, null and empty items match nothing. An empty table stays empty."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each remaining document with the words taken from it; null and empty texts
    have none, a null source is a source. An empty table stays empty."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language", identify_language),
    ("exact_duplicates", drop_exact_duplicates),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

# The first, third and fourth stages are no SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, _leftovers)
    return docs
