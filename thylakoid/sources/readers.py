"""Readers of the flat files: FASTA, frames, features, hits, assignments, GFF3, GenBank.

Schemas are declared, never inferred.  Lines that can't be read are left out.  ``together`` reads
what the writers write so: ``genome_id`` (as text) is what stands before the first tab.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.plans.cuts import cut

FEATURES = "name string, start int, end int, strand string"
HITS = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"


#: Genomes whose records lie apart, of which a table is sent to every task.
FEW_GENOMES = 500_000


def _genome(value: Column) -> tuple[Column, Column]:
    """What stands before the first tab and what after it."""
    genome = F.substring_index(value, "\t", 1)
    return genome, F.when(F.contains(value, F.lit("\t")), F.substring(value, F.length(genome) + 2, F.length(value))).otherwise(value)


def _scattered(records: DataFrame) -> DataFrame:
    """Genomes of ``records`` (genome, id) that have an id twice, or may: all but those whose records lie together with rising ids, as the writers leave them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            genome, name = batch.columns if last is None else (pa.concat_arrays([x, y]) for x, y in zip(last, batch.columns, strict=True))
            together = pc.and_(pc.equal(genome[1:], genome[:-1]), pc.greater(name[1:], name[:-1]))
            begun = pa.concat_arrays([pa.array([last is None]), pc.invert(together)])
            last = genome[-1:], name[-1:]
            yield pa.RecordBatch.from_arrays([genome.filter(begun)], ["genome"])

    return cut(records.mapInArrow(run, "genome string").groupBy("genome").count().filter("count > 1").select("genome"))


def read_fasta(spark: SparkSession, path: str, together: bool = False) -> DataFrame:
    """``id`` (the header without ``>``) and ``seq``; records of one id are joined in file order.

    Records are cut at line starts with ``>`` by the reader itself, so a large file is read in
    parallel by many tasks.  Columns that folders are named by (``genome_id=...``) are kept, here
    and by the other readers of tables.  With ``together`` files are read once before, to find genomes that may have an id
    twice; the records of others are given as they come, without a shuffle.
    """
    lines = spark.read.option("lineSep", "\n>").text(path)
    parts = [c for c in lines.columns if c != "value"]
    rows = lines.select(*parts, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"), "value")
    record = F.when(F.col("value").startswith(">"), F.substring("value", F.lit(2), F.length("value"))).otherwise(F.col("value"))
    name = F.substring_index(record, "\n", 1)
    rows = rows.select(*parts, "file", "at", "n", name.alias("id"), F.replace(F.substring(record, F.length(name) + 2, F.length(record)), F.lit("\n"), F.lit("")).alias("seq"))
    rows = rows.filter("id <> '' or seq <> ''")

    def joined(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*parts, "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "at", "n", "seq"))), lambda r: r.seq), "").alias("seq"))

    if not together:
        return joined(rows)
    genome, name = _genome(F.col("id"))
    key = F.to_json(F.struct(*parts, "genome_id")) if parts else F.col("genome_id")
    rows, parts = rows.withColumn("genome_id", genome).withColumn("id", name).withColumn("genome", key), [*parts, "genome_id"]
    apart = _scattered(rows.select("genome", "id"))
    many = apart.count()
    if many > FEW_GENOMES:
        return joined(rows)
    out = [*parts, "id", "seq"]
    if not many:
        return rows.select(out)
    return rows.join(F.broadcast(apart), "genome", "left_anti").select(out).unionByName(joined(rows.join(F.broadcast(apart), "genome", "left_semi")))


def sequence_lines(text: Column) -> Column:
    """The lines of a FASTA text but for headers, joined."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.startswith(">")), "")


def read_genome(spark: SparkSession, path: str, together: bool = False) -> DataFrame:
    """``file`` and ``seq``: all sequence lines of each file as one string; with ``together`` ``genome_id`` and those of each genome, records in order of their names."""
    if together:
        records = F.array_sort(F.collect_list(F.struct("id", "seq")))
        return read_fasta(spark, path, True).groupBy("genome_id").agg(F.array_join(F.transform(records, lambda r: r.seq), "").alias("seq"))
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file"), sequence_lines(F.col("value")).alias("seq"))


def _fields(spark: SparkSession, path: str, together: bool = False) -> DataFrame:
    """Lines split at white space, with their place in the file."""
    rows = spark.read.text(path)
    if together:
        genome, line = _genome(F.col("value"))
        rows = rows.select(genome.alias("genome_id"), line.alias("value"))
    rows = rows.withColumn("line_no", F.monotonically_increasing_id())
    return rows.withColumn("f", F.split(F.trim("value"), r"\s+"))


def _parts(rows: DataFrame) -> list[str]:
    """Columns that come from the names of folders."""
    return [c for c in rows.columns if c not in ("value", "line_no", "f")]


def read_features(spark: SparkSession, path: str, together: bool = False) -> DataFrame:
    """Feature table: name, start, end, strand, and ``line_no``."""
    rows = _fields(spark, path, together).filter(F.size("f") >= 4)
    return rows.select(*_parts(rows), F.get("f", 0).alias("name"), F.expr("try_cast(f[1] as int)").alias("start"), F.expr("try_cast(f[2] as int)").alias("end"), F.get("f", 3).alias("strand"), "line_no").filter("start is not null and end is not null")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits of 12 columns, and ``line_no``."""
    return spark.read.csv(path, sep="\t", schema=HITS, mode="DROPMALFORMED").withColumn("line_no", F.monotonically_increasing_id())


def read_orf_coordinates(spark: SparkSession, path: str, together: bool = False) -> DataFrame:
    """``orf_id``, ``start0``, ``end0`` from lines ``id start-end``."""
    rows = _fields(spark, path, together).filter(F.size("f") >= 2)
    part = lambda i: F.regexp_extract(F.get("f", 1), r"(\d+)-(\d+)", i)
    return rows.filter(part(1) != "").select(*_parts(rows), F.get("f", 0).alias("orf_id"), part(1).cast("int").alias("start0"), part(2).cast("int").alias("end0"))


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """``query_id`` and ``ref_id`` of a best-reference table, without introns; with ``score`` (a trailing q is dropped) where there is one."""
    rows = _fields(spark, path).filter((F.size("f") >= 2) & ~F.contains(F.col("value"), F.lit("intron")))
    return rows.select(*_parts(rows), F.get("f", 0).alias("query_id"), F.get("f", 1).alias("ref_id"), F.expr("try_cast(regexp_replace(get(f, 2), 'q$', '') as double)").alias("score"))


def guide_list(spark: SparkSession, guides: str) -> DataFrame:
    """``guide_no`` from 1 and ``guide`` of a comma-separated list."""
    return spark.range(1).select(F.posexplode(F.split(F.lit(guides), ",")).alias("pos", "guide")).select((F.col("pos") + 1).alias("guide_no"), "guide")


def parse_gff3(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features (genome_id, gene, start, end, strand) and lengths (genome_id, len) of GFF3 ``lines`` (genome_id, value).

    Coding parts are named by their parent, tRNA and rRNA by their ID; a line whose name can't be
    read is left out.  The length is the end of the ``region`` line.  Features lie by genome, so that what is
    keyed by it needs no further shuffle.
    """
    rows = lines.filter(~F.col("value").startswith("#")).select("genome_id", F.split(F.trim("value"), r"\s+").alias("f"))
    kind, notes = F.get("f", 2), F.coalesce(F.get("f", 8), F.lit(""))
    gene = F.when(kind == "CDS", F.regexp_extract(notes, r"Parent=(\w+)", 1)).when(kind == "tRNA", F.regexp_extract(notes, r"ID=(\w+-\w+)", 1)).when(kind == "rRNA", F.regexp_extract(notes, r"ID=(\w+)", 1))
    number = lambda i: F.expr(f"try_cast(get(f, {i}) as int)")
    read = lambda *fields: rows.select("genome_id", F.inline(F.array(F.struct(*fields))))  # noqa: E731  # filters stay behind this, so that a line is split once
    features = read(gene.alias("gene"), number(3).alias("start"), number(4).alias("end"), F.get("f", 6).alias("strand")).filter("gene <> '' and start is not null and end is not null").repartition("genome_id").distinct()
    lengths = read(kind.alias("kind"), number(4).alias("end")).filter("kind = 'region'").groupBy("genome_id").agg(F.max("end").alias("len"))
    return features, lengths


#: Feature keys that a GenBank record gives genes under.
GENBANK_KEYS = ("gene", "tRNA", "rRNA")


def genbank_features(text: str) -> tuple[list[tuple[str, int, int, str]], int | None]:
    """Features (name, start, end, strand) and the length of one GenBank record.

    Locations may go over several lines and be joined or complemented; parts are one row each.
    """
    length = re.search(r"^LOCUS.*?(\d+)\s+bp", text, re.M)
    found: dict[tuple[int, int, str], str] = {}
    blocks = re.split(r"^ {5}(?=\S)", text, flags=re.M)[1:]
    for block in blocks:
        m = re.match(r"(\S+)\s+([^/]*?)(?=^\s*/|\Z)", block, re.S | re.M)
        name = re.search(r'/gene="([^"]+)"', block)
        if not m or m[1] not in GENBANK_KEYS or not name:
            continue
        strand = "-" if "complement" in m[2] else "+"
        for a, b in re.findall(r"<?(\d+)\.\.>?(\d+)", re.sub(r"\s", "", m[2])):
            found[(int(a), int(b), strand)] = name[1]
    return [(n, a, b, s) for (a, b, s), n in sorted(found.items())], int(length[1]) if length else None


def genbank_features_compat(text: str) -> tuple[list[tuple[str, int, int, str]], int | None]:
    """The literal reading: any line with a key's word gives all its integers as pairs, on ``+``, named by the quoted text of the next line, which is used up."""
    length, found = None, {}
    lines = iter(text.split("\n"))
    for line in lines:
        if "LOCUS" in line and (m := re.search(r"(\d+)\sbp", line)):
            length = int(m[1])
        if any(k in line for k in GENBANK_KEYS):
            numbers = [int(x) for x in re.findall(r"\d+", line)]
            after = next(lines, "")
            name = re.search(r'"(.+)"', after)
            if "gene" in after and name:
                for a, b in zip(numbers[::2], numbers[1::2], strict=False):
                    found[(a, b)] = name[1]
    return [(n, a, b, "+") for (a, b), n in sorted(found.items())], length


def parse_genbank(records: DataFrame, compat: bool = False) -> DataFrame:
    """``genome_id``, ``name``, ``start``, ``end``, ``strand``, ``len`` of GenBank ``records`` (genome_id, value), a record a row."""
    read = genbank_features_compat if compat else genbank_features

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for g, text in zip(part["genome_id"], part["value"], strict=True):
                found, length = read(text or "")
                rows += [(g, *f, length) for f in found]
            out = pd.DataFrame(rows, columns=["genome_id", "name", "start", "end", "strand", "len"])
            yield out.astype({"len": "Int32"})

    kind = records.schema["genome_id"].dataType.simpleString()
    return records.select("genome_id", "value").mapInPandas(run, f"genome_id {kind}, name string, start int, end int, strand string, len int")


def read_gff3(spark: SparkSession, path: str, together: bool = False) -> tuple[DataFrame, DataFrame]:
    """Features and lengths of GFF3 files, as ``parse_gff3`` gives them; a genome is known by its file, with ``together`` by the first column."""
    if together:
        return parse_gff3(spark.read.text(path).select(F.regexp_extract("value", r"^\s*(\S+)", 1).alias("genome_id"), "value"))
    return parse_gff3(spark.read.text(path).select(F.col("_metadata.file_path").alias("genome_id"), "value"))


def read_genbank(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """Features of GenBank files, as ``parse_genbank`` gives them; a genome is known by its file and the name in its LOCUS line.

    Files are cut into records at lines of ``//`` by the reader itself, so a large one is read by many tasks.
    """
    records = spark.read.option("lineSep", "\n//").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\\s+", "").alias("value")).filter("value <> ''")
    name = F.regexp_extract("value", r"(?m)^LOCUS\s+(\S+)", 1)
    return parse_genbank(records.select(F.concat_ws("#", "file", name).alias("genome_id"), "value"), compat)


def register_genbank(spark: SparkSession, name: str = "genbank_features") -> None:
    """A table function for SQL: ``SELECT r.id, f.* FROM records r, LATERAL genbank_features(r.value) f``.

    It gives ``record`` (from 0), ``locus``, ``len``, ``name``, ``start``, ``end`` and ``strand`` for each feature of a text of one
    record or several; a null text gives none.
    """

    class Features:
        def eval(self, value: str):
            for i, text in enumerate(x for x in re.split(r"^//.*$", value or "", flags=re.M) if x.strip()):
                found, length = genbank_features(text)
                locus = re.search(r"^LOCUS\s+(\S+)", text, re.M)
                for feature in found:
                    yield (i, locus[1] if locus else None, length, *feature)

    spark.udtf.register(name, F.udtf(Features, returnType="record int, locus string, len int, name string, start int, end int, strand string"))
