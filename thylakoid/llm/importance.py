"""Importance resampling towards a target distribution over hashed n-gram buckets.

Each task hands its texts to DuckDB, which cuts them into words, pairs neighbours by a window,
and numbers each n-gram's bucket with a registered function, zlib's CRC-32.  The buckets of every
text and the bucket counts of every task are spilled to Parquet in the shared folder; Spark adds
the counts up, and scores each text by the mean gain of its buckets plus Gumbel noise, so that the
highest scores are a sample without replacement, weighted by the gains.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thylakoid.llm.common import bounded_batches, durable, remove, shared_folder

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Text of a batch, and what DuckDB may hold of it before it spills to the task's own folder.
BATCH_BYTES, MEMORY = 4 << 20, "512MB"
#: A-Z are lower-cased, and a word is a run of other letters than these.
_UPPER, _LOWER, _WORD = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words of the texts ``docs`` (row, body), each with the word after it in the text, and the buckets of both n-grams.
_GRAMS = f"""CREATE OR REPLACE TEMP TABLE grams AS
WITH listed AS (SELECT "row", regexp_extract_all(translate(body, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words FROM docs),
placed AS (SELECT "row", unnest(words) AS word, unnest(range(len(words))) AS place FROM listed),
paired AS (SELECT "row", word, lead(word) OVER (PARTITION BY "row" ORDER BY place) AS next FROM placed)
SELECT "row", (crc32(word) % {{buckets}})::USMALLINT AS one, (crc32(word || ' ' || next) % {{buckets}})::USMALLINT AS two FROM paired"""
_BY_TEXT = 'SELECT "row", count(*) AS n_words, list(one) AS ones, list(two) FILTER (two IS NOT NULL) AS twos FROM grams GROUP BY "row"'
_BY_BUCKET = "SELECT bucket::INT AS bucket, count(*) AS n FROM (SELECT one AS bucket FROM grams UNION ALL SELECT two FROM grams WHERE two IS NOT NULL) GROUP BY bucket"


def crc(values: pa.Array) -> pa.Array:
    """zlib's CRC-32 of each text's UTF-8 bytes."""
    return pa.array([None if v is None else zlib.crc32(v) for v in values.cast(pa.binary()).to_pylist()], pa.uint32())


def _spill(texts: DataFrame, key: str, text: str, buckets: int, folder: str) -> DataFrame:
    """Parquet of ``key``, ``n_words`` and ``held`` (the buckets of its n-grams) for each row, and of ``counts`` (by bucket) for each task."""
    taken = texts.select(F.col(key).alias("key"), F.col(text).alias("body"))
    kind = taken.schema["key"].dataType.simpleString()
    names = ["key", "n_words", "held", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        counts = np.zeros(buckets, dtype=np.int64)
        with tempfile.TemporaryDirectory() as own, duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": own}) as db:
            db.create_function("crc32", crc, ["VARCHAR"], "UINTEGER", type="arrow")
            empty = None
            for batch in batches:
                empty = batch.column(0).slice(0, 0)
                db.register("docs", pa.table({"row": pa.array(range(batch.num_rows), pa.int64()), "body": batch.column(1)}))
                db.execute(_GRAMS.format(buckets=buckets))
                db.unregister("docs")
                found = db.sql(_BY_BUCKET).to_arrow_table()
                counts[found.column("bucket").to_numpy()] += found.column("n").to_numpy()
                found = db.sql(_BY_TEXT).to_arrow_table()
                n_words, held = np.zeros(batch.num_rows, dtype=np.int64), [np.zeros(0, dtype=np.int16)] * batch.num_rows
                for row, n, *lists in zip(*[found.column(i).to_pylist() for i in range(2)], *[found.column(i).combine_chunks() for i in (2, 3)], strict=True):
                    n_words[row] = n
                    held[row] = np.concatenate([x.values.to_numpy(zero_copy_only=False).astype(np.int16) for x in lists if x.is_valid])
                ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held) if held else np.zeros(0, dtype=np.int16)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), lists, pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names)
        if empty is not None:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([empty, pa.nulls(1, empty.type)]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int16())), pa.array([counts.tolist()], pa.list_(pa.int64()))], names)

    taken.mapInArrow(run, f"key {kind}, n_words long, held array<short>, counts array<long>").write.parquet(folder)
    return texts.sparkSession.read.parquet(folder)


def _merged(spilled: DataFrame, buckets: int) -> np.ndarray:
    """The counts of all tasks, by bucket: a table of fixed size."""
    rows = spilled.filter("counts is not null").select(F.posexplode("counts").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 0")
    found = rows.toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


class Target(NamedTuple):
    """Bucket counts of the corpus and of the target."""

    corpus: np.ndarray
    target: np.ndarray

    def gains(self) -> np.ndarray:
        """Thousandths of the logarithm of each bucket's share in the target by that in the corpus, one added to each count."""
        n = float(len(self.corpus))
        up = (self.target + 1.0) * (float(self.corpus.sum()) + n)
        down = (self.corpus + 1.0) * (float(self.target.sum()) + n)
        return np.floor(1000 * np.log(up / down)).astype(np.int64)


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that follows from ``seed`` and the key; a null key is an empty text."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows``, a durable table, with ``name``: their place in ``order`` from 1, without a task that gets them all.

    Rows are dealt to ranges and sorted there; a table of the ranges' sizes, one row for each,
    tells where each begins.  Equal rows follow each other in any order.
    """
    rows = rows.withColumn("_nth", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order, "_nth").sortWithinPartitions(*order, "_nth")
    placed = durable(dealt.drop("_nth").withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_key: str = "item_id", target_text: str = "text", *, buckets: int = BUCKETS, least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of each row of ``docs``.

    Features are the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z lower-cased, and each two
    that follow one another, joined by a space; repeats count.  A bucket is a feature's CRC-32
    modulo ``buckets`` (32,768 at most).  ``weight`` is the mean gain of a row's features, floored, and 0 without
    any; ``score`` adds the noise.  Of the rows with ``least`` words or more the highest ``percent``
    of a hundred, floored, have a ``rank`` from 1, ties by the smaller key, null keys last; the rank of others is
    null.  Null and empty texts have no features.  Equal rows are all returned, and drawn one by
    one.  An empty table gives an empty one, and an empty target is one of equal counts.  Other
    columns aren't read.
    """
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark, BATCH_BYTES)
    folder = f"{shared_folder(spark)}/importance-{uuid.uuid4().hex}"
    spilled = _spill(docs, key, text, buckets, f"{folder}/corpus")
    wanted = _merged(_spill(target, target_key, target_text, buckets, f"{folder}/target"), buckets)
    shared = spark.sparkContext.broadcast(Target(_merged(spilled, buckets), wanted).gains())

    @F.arrow_udf("long")
    def weight(held: pa.Array) -> pa.Array:
        ends = held.offsets.to_numpy()
        total = np.zeros(ends[-1] - ends[0] + 1, dtype=np.int64)
        np.cumsum(shared.value[held.values.to_numpy()[ends[0] : ends[-1]]], out=total[1:])
        at = ends - ends[0]
        return pa.array((total[at[1:]] - total[at[:-1]]) // np.maximum(np.diff(ends), 1))

    rows = spilled.filter("counts is null").select("key", "n_words", F.size("held").cast("long").alias("n_features"), weight("held").alias("weight"))
    rows = durable(rows.withColumn("score", F.col("weight") + noise(F.col("key"), seed)))
    remove(spark, folder)
    able = rows.filter(F.col("n_words") >= least)
    drawn = able.count() * percent // 100
    placed = ranked(able, [F.desc("score"), F.asc_nulls_last("key")], "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.filter(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
