"""A corpus pipeline of five stages over ``documents``, each by one operator of ``thylakoid.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``.  All stages but the last return the columns that they got.

Decisions are taken by row, not by key: a row is known by a hash of the columns that the decision
rests on, nulls among them, so keys may be null or occur with several texts, and columns may have
any names beside doc_id, text and source.  Rows that are equal throughout are judged alike.  Empty
tables give empty ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.llm.common import durable, fresh, remove, row_hash, shared_folder, sized_join, table
from thylakoid.llm.decontaminate import contaminated
from thylakoid.llm.jaccard import one_of_each
from thylakoid.llm.mixing import mix
from thylakoid.llm.quality import judge_documents
from thylakoid.llm.sharding import assign_shards

SHARDS = 8


def _marked(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """``docs`` with a hash of ``columns``, and what it is named."""
    row = fresh(docs, "row")
    return docs.withColumn(row, row_hash(docs, columns)), row


def _without(marked: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``marked`` without the rows whose hash is among ``dropped``."""
    return sized_join(marked, durable(dropped.select(row).distinct()), [row], "left_anti").drop(row)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, their own or their host's, don't reject; a null or empty text is rejected."""
    marked, row = _marked(docs, ["doc_id", "source", "text"])
    return _without(marked, row, judge_documents(marked, row).filter(~F.col("kept")))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest key, once; texts without words stay."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item; null and empty texts hold none."""
    marked, row = _marked(docs, ["text"])
    return _without(marked, row, contaminated(marked, table(spark, sf_dir, "benchmark"), row))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them: each at least once, those of small sources up to twice or so."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard; rows of one key, null among them, share it."""
    return assign_shards(docs, "doc_id", SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The alignment and the fitted exponent can't be expressed in SQL; ``tests/llm/test_pipeline.py`` holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written to the shared folder and read again.

    A stage's folder is deleted when the next one is written; the result reads the last.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
