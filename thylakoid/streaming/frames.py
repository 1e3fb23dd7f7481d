"""Frames of genomes as their files arrive.

The row-wise operators neither shuffle nor keep state, so a stream of files goes through them as a
table does.  A file is read once, whole, and known by its path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from thylakoid.operators.orf import find_orfs
from thylakoid.sources.readers import sequence_lines


def genome_stream(spark: SparkSession, path: str, files: int = 1000, together: bool = False) -> DataFrame:
    """A stream of ``genome_id`` (the file) and ``seq`` of FASTA files under ``path``, ``files`` of them at a time.

    With ``together`` each record is a genome, known by what stands before the first tab of its header.
    """
    if together:
        records = spark.readStream.option("lineSep", "\n>").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).text(path)
        text = F.concat(F.lit(">"), F.regexp_replace("value", "^>", ""))
        return records.select(F.regexp_extract(text, "^>([^\t\n]*)", 1).alias("genome_id"), sequence_lines(text).alias("seq")).filter("genome_id <> ''")
    rows = spark.readStream.option("wholetext", True).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).text(path)
    return rows.select(F.col("_metadata.file_path").alias("genome_id"), sequence_lines(F.col("value")).alias("seq"))


def write_frames(genomes: DataFrame, out: str, state: str, **how) -> StreamingQuery:
    """Write the frames of all genomes that have arrived to Parquet files under ``out``, each genome's once, and end; ``state`` remembers which."""
    return find_orfs(genomes, **how).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
