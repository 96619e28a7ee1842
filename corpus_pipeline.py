"""The corpus pipeline: five stages of the training-data operators over ``documents``.

Each stage takes (spark, docs, sf_dir), keeps the columns of ``documents`` (the last adds tokens) and is
written as Parquet and read again before the next. Decisions take effect: toxic documents go, one
document of every near-duplicate component stays, documents that hold a window of a benchmark item go,
personal data is replaced by its kind, and what is left is encoded (the ids are not decoded again).
``n_chars`` follows the text.

Rows with a null doc_id pass every stage (no decision can name them). Rows that repeat a doc_id are one
document to the near-duplicate stage: all of them stay or go. Tables may be empty.
"""

from __future__ import annotations

import hashlib
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.llm import bpe, decontaminate, jaccard, pii, queries, toxicity
from fieldguard.session import shared_dir
from fieldguard.sources.bindings import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Near copies of the stage: words of a shingle, and the Jaccard similarity that links. The op5 query has its own.
SHINGLE, PERCENT = 5, 80
# What tasks hold at once: bytes of an Arrow batch (on both sides of Python), rows a Parquet reader decodes
# together (its buffers double, and texts are long), and bytes of a row group that a writer collects.
LEAN = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "parquet.block.size": str(8 << 20),
}
# The trained models have no SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def lean(stage):
    """The stage with the ``LEAN`` settings. Its plan runs after it returned, so they stay set in the session."""

    @wraps(stage)
    def leaner(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in LEAN.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return leaner


@lean
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or over the threshold go; the models learn from what is given."""
    scorer = toxicity.Scorer.fit(docs, table(spark, sf_dir, "labels"))
    scored = scorer.score(docs.select(*COLUMNS))
    return scored.where(F.col("_score") < toxicity.THRESHOLD).select(*COLUMNS)


@lean
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the least doc_id stays."""
    linked = jaccard.link_components(docs, SHINGLE, PERCENT)
    # Documents in components of their own are named by their own id.
    others = linked.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(others, "doc_id", "left_anti").select(*COLUMNS)


@lean
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate.find_leaks(
        docs, table(spark, sf_dir, "benchmark"), keep=("text", "lang", "source", "n_chars")
    )
    return found.where("n_hit = 0").select(*COLUMNS)


@lean
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span becomes its kind in brackets."""
    return pii.redact(pii.find(docs.select(*COLUMNS))).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


@lean
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns without the text, and the ids of its tokens."""
    return bpe.encode(docs.select(*COLUMNS), queries.vocabulary(), keep=("lang", "source", "n_chars"))


STAGES = [
    ("toxicity", toxic),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is a table in the shared folder.

    While they run the ``LEAN`` settings hold; the session's own come back afterwards.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid4().hex}"
    before = {name: spark.conf.get(name, None) for name in LEAN}
    try:
        for name, stage in STAGES:
            path = f"{folder}/{hashlib.md5(name.encode()).hexdigest()[:8]}"
            made = stage(spark, docs, sf_dir)
            made.write.mode("errorifexists").parquet(path)
            docs = spark.read.schema(made.schema).parquet(path)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return docs
