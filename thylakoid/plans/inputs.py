"""Inputs of the queries, derived from the test tables, which hold no sequences of their own.

Letters of a text become bases, so documents are genomes and benchmark items are references that
some of them contain; line items are features along a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The base of each letter.
LETTERS, AS_BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTNCGTACGTAN"


def dna(text: Column) -> Column:
    return F.translate(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]", "")), LETTERS, AS_BASES)


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``genome_id``, ``seq``."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("genome_id"), dna(F.col("text")).alias("seq"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ref_id``, ``feature``, ``guide_no``, ``class``, ``seq``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    k = F.col("item_id").cast("string")
    pair = F.floor(F.col("item_id") / 6).cast("string")
    name = (
        F.when(F.col("item_id") % 6 == 0, F.concat(F.lit("trnK"), k, F.lit("-UUU")))
        .when(F.col("item_id") % 6 == 1, F.concat(F.lit("rrn"), k))
        .when(F.col("item_id") % 6 == 2, F.concat(F.lit("rps"), pair, F.lit("_exon1")))
        .when(F.col("item_id") % 6 == 3, F.concat(F.lit("rps"), pair, F.lit("_exon2")))
        .when(F.col("item_id") % 6 == 4, F.concat(F.lit("rpl16"), k))
        .otherwise(F.concat(F.lit("psb"), k))
    )
    guide = F.when((F.col("item_id") % 6).isin(2, 3), F.floor(F.col("item_id") / 6) % 3 + 1).otherwise(F.col("item_id") % 3 + 1).cast("int")
    kind = F.when(F.col("item_id") % 6 == 0, "tRNA").when(F.col("item_id") % 6 == 1, "rRNA").otherwise("gene")
    return items.select(F.concat(name, F.lit("XXX"), guide.cast("string")).alias("ref_id"), name.alias("feature"), guide.alias("guide_no"), kind.alias("class"), dna(F.col("text")).alias("seq"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``genome_id``, ``start``, ``end``, ``strand``, ``name``, ``gene``, ``score``, ``load_order``; not unique by interval."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    start = (F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")) + 1).cast("int")
    return items.select(
        F.col("l_partkey").alias("genome_id"), start.alias("start"), (start + F.col("l_quantity").cast("int")).alias("end"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"),
        F.concat(F.lit("g"), F.col("l_suppkey").cast("string")).alias("name"), F.concat(F.lit("g"), (F.col("l_suppkey") % 7).cast("string")).alias("gene"), F.col("l_extendedprice").alias("score"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("load_order"),
    )
