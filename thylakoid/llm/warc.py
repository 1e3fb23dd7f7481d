"""WARC archives: writing with payload deduplication, and reading by boundary-chain verification.

Reading doesn't trust the text ``WARC/1.1`` to begin a record.  Tasks cut the files at it, in
parallel and across input splits, and give each cut as a candidate: its offset and, from its
Content-Length, the offset of its successor.  Pointer jumping from the start of each file then
keeps those candidates that the chain of records reaches; the others lie inside payloads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thylakoid.llm.common import bounded_batches, durable, shared_folder, sized_join, skewed_join

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Payloads of fewer bytes are written again rather than referred to.
LEAST_BYTES = 100
#: Repeated digests, each of 64 letters with a key, that may be broadcast.
BROADCAST_DIGESTS = 200_000
#: Input splits, each a path and two numbers, of which a table may be broadcast.
BROADCAST_SPLITS = 100_000


def with_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """``pages`` as ``_id``, ``_url``, ``_payload``, ``_bytes``, ``_digest`` and ``_refers`` (null: response).

    Of rows with equal payloads of ``least`` bytes or more, those with the smallest key are
    responses and the others revisit it; without any key among them all are responses.  Payloads
    aren't shuffled unless the repeated digests are too many to broadcast, and those of the most
    frequent ones not even then: digests are grouped first.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), body.alias("_payload"))
    rows = rows.withColumn("_bytes", F.octet_length("_payload").cast("long")).withColumn("_digest", F.sha2("_payload", 256))
    again = rows.filter(F.col("_bytes") >= least).groupBy("_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = durable(again)
    n, total = again.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    rows = skewed_join(rows, again, "_digest", "_n", total, n, limit=BROADCAST_DIGESTS, how="left")
    return rows.select("_id", "_url", "_payload", "_bytes", "_digest", F.when(~F.col("_first").eqNullSafe(F.col("_id")), F.col("_first")).alias("_refers"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(records: DataFrame, folder: str) -> None:
    """Write the records as uncompressed WARC files, one for each task, through Spark's own writer."""
    url = F.translate(F.col("_url"), "\r\n\t ", "")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("_refers").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("_payload")))
    head = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _line("WARC-Record-ID", urn(F.col("_id"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        _line("WARC-Refers-To", urn(F.col("_refers"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END),
    )
    records.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value")).write.option("lineSep", END).text(folder)


def _field(head: Column, pattern: str) -> Column:
    found = F.regexp_extract(head, pattern, 1)
    return F.when(found != "", found)


def scan_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each place where the magic occurs: file, offset, the head's fields and the rest.

    Spark's text reader cuts the files at the magic, also where an input split ends.  A cut's
    offset is the sum of the lengths before it: within a split by a window, and over the splits
    of a file by their totals.
    """
    cut = spark.read.option("lineSep", MAGIC).text(folder).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("seq"),
    )
    head = F.substring_index("value", END, 1)
    cut = cut.withColumn("length", F.octet_length("value").cast("long") + len(MAGIC)).withColumn("head", head).withColumn("complete", F.octet_length("head") < F.octet_length("value"))
    return cut.select(
        "file", "split", "file_size", "seq", "length", "value",
        F.when(F.col("complete"), F.octet_length("head").cast("long") + len(MAGIC) + len(END)).alias("head_bytes"),
        F.when(F.col("complete"), _field(F.col("head"), r"(?m)^Content-Length: (\d+)\r?$").cast("long")).alias("content"),
        _field(F.col("head"), r"(?m)^WARC-Type: (\w+)\r?$").alias("kind"),
        _field(F.col("head"), r"(?m)^WARC-Record-ID: <urn:page:(-?\d+)>\r?$").cast("long").alias("id"),
        _field(F.col("head"), r"(?m)^WARC-Refers-To: <urn:page:(-?\d+)>\r?$").cast("long").alias("refers"),
        _field(F.col("head"), r"(?m)^WARC-Payload-Digest: sha256:(\w+)\r?$").alias("stated"),
    )


def _located(cut: DataFrame) -> DataFrame:
    """Add ``offset``: of the magic before each cut.  The text before the first magic of a file gets a negative one."""
    totals = cut.groupBy("file", "split").agg(F.sum("length").alias("total"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", "split", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("within", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(totals, ["file", "split"]).withColumn("offset", F.col("before") + F.col("within") - len(MAGIC)).drop("before", "within")


def _located_in_place(cut: DataFrame, splits: int) -> DataFrame:
    """``file``, ``offset`` and ``value`` of each cut, as ``_located`` has them, without a shuffle of values.

    A task reads its splits one after the other, so lengths add up in passing; only the totals of
    splits are shuffled, and broadcast if there aren't too many.
    """
    totals = cut.groupBy("file", "split").agg(F.sum("length").alias("total"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", "split", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, 0
        for batch in batches:
            within = []
            for name, split, length in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (name, split) != at:
                    at, total = (name, split), 0
                within.append(total)
                total += length
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(within, pa.int64()), batch.column(3)], ["file", "split", "within", "value"])

    bounded_batches(cut.sparkSession)
    rows = cut.select("file", "split", "length", "value").mapInArrow(run, "file string, split long, within long, value string")
    return rows.join(F.broadcast(totals) if splits <= BROADCAST_SPLITS else totals, ["file", "split"]).select("file", (F.col("before") + F.col("within") - len(MAGIC)).alias("offset"), "value")


def reachable(candidates: DataFrame) -> DataFrame:
    """Those rows of (file, offset, next) that a walk from offset 0 of the file visits.

    Pointer jumping: each round doubles the steps that a pointer spans, so a file of n records
    takes log2(n) rounds, each an equi-join on (file, offset).
    """
    jump = durable(candidates.join(candidates.select("file", F.col("offset").alias("next")), ["file", "next"], "left_semi").select("file", "offset", "next"))
    found = durable(candidates.filter("offset = 0").select("file", "offset"))
    while jump.take(1):
        found = durable(found.join(jump, ["file", "offset"], "left").select("file", F.explode(F.when(F.col("next").isNull(), F.array("offset")).otherwise(F.array("offset", "next"))).alias("offset")))
        onward = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        jump = durable(jump.join(onward, ["file", "next"]).select("file", "offset", F.col("after").alias("next")))
    return found


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Each record: ``file``, ``offset``, ``id``, ``kind``, ``refers``, ``payload_bytes``, ``payload_digest``, ``sound``.

    ``sound`` tells whether the payload's digest is the stated one; a revisit's bytes and digest
    are those that its record states.  Payloads with the magic in them are cut apart by the scan:
    only those are put together again by a shuffle, the others never leave the scanning task.
    """
    cut = scan_candidates(spark, folder)
    own = F.col("length") - len(MAGIC)
    body_at = F.col("head_bytes") - len(MAGIC)
    whole = F.col("content") <= own - body_at
    block = F.substring(F.encode("value", "utf-8"), (body_at + 1).cast("int"), F.col("content").cast("int"))
    stored = lambda b: F.decode(b, "utf-8")
    http = F.substring_index(stored(F.col("block")), END, 1)
    payload = F.substring(F.col("block"), F.octet_length("http") + len(END) + 1, F.lit(2147483647))

    def finished(df: DataFrame) -> DataFrame:
        df = df.withColumn("http", http)
        return df.withColumn("real", F.sha2(payload, 256)).withColumn("real_bytes", F.octet_length(payload).cast("long")).withColumn("stated_bytes", _field(F.col("http"), r"(?m)^Content-Length: (\d+)\r?$").cast("long")).drop("http", "block")

    slim = finished(cut.withColumn("block", F.when(whole, block))).withColumn("whole", F.coalesce(whole, F.lit(False))).drop("value")
    slim = durable(_located(slim).filter("offset >= 0"))
    chain = slim.filter("content is not null").select("file", "offset", (F.col("offset") + F.col("head_bytes") + F.col("content") + len(END)).alias("next"))
    records = slim.join(reachable(chain), ["file", "offset"], "left_semi")

    broken = records.filter(~F.col("whole")).select("file", "offset", "head_bytes", "content", "id", "kind", "refers", "stated")
    parts = [records.filter("whole")]
    if broken.take(1):
        broken = durable(broken)
        inner = slim.join(chain.join(durable(records.select("file", "offset")), ["file", "offset"], "left_semi").select("file", "offset"), ["file", "offset"], "left_anti").select("file", "offset")
        starts = broken.select("file", "offset", F.col("offset").alias("record")).unionByName(inner.withColumn("record", F.lit(None).cast("long")))
        starts = starts.unionByName(records.filter("whole").select("file", "offset", F.lit(-1).cast("long").alias("record")))
        last = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
        owned = starts.withColumn("record", F.last("record", ignorenulls=True).over(last)).filter("record >= 0")
        pieces = sized_join(_located_in_place(cut, slim.select("file", "split").distinct().count()), durable(owned), ["file", "offset"], "inner")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda p: p.value), MAGIC)
        joined = pieces.groupBy("file", "record").agg(text.alias("value")).withColumnRenamed("record", "offset")
        parts.append(finished(broken.join(joined, ["file", "offset"]).withColumn("block", block).drop("value")))
    named = ["file", "offset", "id", "kind", "refers", "stated", "real", "real_bytes", "stated_bytes"]
    every = parts[0].select(*named) if len(parts) == 1 else parts[0].select(*named).unionByName(parts[1].select(*named))
    revisit = F.col("kind") == "revisit"
    return every.select(
        "file", "offset", "id", "kind", "refers",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("real_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated")).otherwise(F.col("real")).alias("payload_digest"),
        (revisit | (F.col("real") == F.col("stated"))).alias("sound"),
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for an archive, in the folder that all executors share."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
