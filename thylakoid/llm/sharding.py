"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key's shard follows from the key and the number of shards alone: there is no ring table, and
when a shard is appended a key either stays or moves to the new shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import cumulative, repeated

U64 = np.uint64


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0, of each 64-bit key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = np.ascontiguousarray(keys).view(U64).copy()
    shard = np.full(len(state), -1, dtype=np.int64)
    ahead = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * U64(2862933555777941757) + U64(1)
        ahead[live] = ((shard[live] + 1) * (2.0**31 / ((state[live] >> U64(33)).astype(np.float64) + 1))).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def shard_column(key: Column, shards: int) -> Column:
    """Shard of a key column of any type.  Null is a key like any other."""

    @F.arrow_udf("int")
    def place(hashed: pa.Array) -> pa.Array:
        return pa.array(jump(hashed.to_numpy(zero_copy_only=False), shards).astype(np.int32))

    return place(F.xxhash64(key))


def assign_shards(df: DataFrame, key: str, shards: int, shard: str = "shard") -> DataFrame:
    """``df`` with the shard of each row, without a shuffle.

    A null key has one defined shard.  Rows with equal keys go to one shard.  An empty table
    stays empty.  A column named as ``shard`` is replaced; all others are kept.
    """
    return df.withColumn(shard, shard_column(F.col(key), shards))


def shard_manifest(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", bins: int = 1024) -> DataFrame:
    """What a writer of shards needs for each row: shard, gapless slot in it, size and checksum.

    Size is the text's UTF-8 bytes plus 1; a null text counts as empty, so its size is 1 and its
    checksum 0.  ``grown_shard`` is the shard after one more has been appended.  Equal rows are
    counted before the shuffle and numbered apart, so a row that is repeated a billion times is
    one row to every task.  Other columns of ``df`` are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("_key"),
        (F.octet_length(body) + 1).cast("long").alias("_size"),
        F.crc32(body).alias("_crc"),
    ).groupBy("_key", "_size", "_crc").agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_shard", shard_column(F.col("_key"), shards)).withColumn("_grown", shard_column(F.col("_key"), shards + 1))
    rows = cumulative(rows, ["_shard"], ["_key", "_size", "_crc"], F.col("_copies"), "_slot", bins)
    return repeated(rows, "_copies", "_copy").select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("_slot") + F.col("_copy")).alias("slot"),
        F.col("_grown").alias("grown_shard"),
    )
