"""Feature tables: exon numbers, gaps between features, region extraction."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thylakoid.functions.sequence import exon_gene, exon_number, feature_class, pieces, ref_id, revcomp
from thylakoid.operators.intervals import last_written

#: Rows that a task gathers before it lets go of them.
ROWS_OUT = 100_000
#: Words that mark a line as a region or an intron rather than a gene.
REGION_WORDS = ["IRA", "IRB", "LSC", "SSC", "FULL", "intron"]


def number_exons(df: DataFrame, compat: bool = False) -> DataFrame:
    """``df`` (genome_id, gene, start, end, strand) with ``name``: gene, or gene_exonN where a gene has several.

    Exons count along their strand.  ``compat`` labels all inner exons 2.
    """
    keys = ["genome_id", "gene", "strand"]
    order = Window.partitionBy(*keys).orderBy("start", "end")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    up = F.row_number().over(order)
    number = F.when(F.col("strand") == "-", n - up + 1).otherwise(up)
    if compat:
        number = F.when((number > 1) & (number < n), 2).otherwise(number)
    return df.withColumn("name", F.when(n > 1, F.concat("gene", F.lit("_exon"), number.cast("string"))).otherwise(F.col("gene")))


def exon_bounds(df: DataFrame) -> DataFrame:
    """Lowest start, highest end and number of exons of each gene and strand."""
    return df.groupBy("genome_id", "gene", "strand").agg(F.min("start").alias("gene_start"), F.max("end").alias("gene_end"), F.count(F.lit(1)).alias("n_exons"))


def exon_catalogue(df: DataFrame) -> DataFrame:
    """Distinct exon names of each gene; a feature without an exon number is a gene of its own."""
    gene = F.coalesce(exon_gene(F.col("name")), F.col("name"))
    return df.groupBy("genome_id", gene.alias("gene")).agg(F.count_distinct("name").alias("n_exons"))


def _gap_name(prev: Column, name: Column, sep: str) -> Column:
    """Name of the gap between two features; null between exons of one gene that aren't neighbours."""
    exons = F.contains(prev, F.lit("_exon")) & F.contains(name, F.lit("_exon"))  # most have none
    same = exons & exon_gene(prev).isNotNull() & (exon_gene(prev) == exon_gene(name))
    a, b = exon_number(prev), exon_number(name)
    intron = F.when(F.abs(a - b) == 1, F.concat(exon_gene(name), F.lit("_intron"), F.least(a, b).cast("string")))
    return F.when(same, intron).otherwise(F.concat(prev, F.lit(sep), name))


def fill_gaps(df: DataFrame, lengths: DataFrame, sep: str = "~") -> DataFrame:
    """The gaps between features: introns between neighbouring exons of a gene, intergenic ones elsewhere.

    ``df`` has genome_id, start, end, strand and name; ``lengths`` genome_id and len.  A gap
    reaches from the furthest end so far to the next start, is named by the feature before it (the
    last to have begun) and the one after, and lies on ``+``; empty gaps are left out.  The first
    and last are named by ``Start`` and ``End``.
    """
    order = Window.partitionBy("genome_id").orderBy("start", "end", "strand", "name")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select("genome_id", "start", "end", "strand", "name").withColumn("_prev", F.lag("name").over(order)).withColumn("_until", F.max("end").over(earlier)).withColumn("_last", F.lead("name").over(order).isNull()).withColumn("_all", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    name = F.when(F.col("_prev").isNull(), F.concat(F.lit(f"Start{sep}"), "name")).otherwise(_gap_name(F.col("_prev"), F.col("name"), sep))
    inner = rows.select("genome_id", (F.coalesce("_until", F.lit(0)) + 1).alias("start"), (F.col("start") - 1).alias("end"), F.lit("+").alias("strand"), name.alias("name"))
    ends = rows.filter("_last").join(lengths, "genome_id").select("genome_id", (F.col("_all") + 1).alias("start"), F.col("len").alias("end"), F.lit("+").alias("strand"), F.concat("name", F.lit(f"{sep}End")).alias("name"))
    return inner.unionByName(ends).filter("start <= end and name is not null")


def with_gaps(df: DataFrame, lengths: DataFrame, sep: str = "~") -> DataFrame:
    """``df`` (genome_id, start, end, strand, name) with the gaps that ``fill_gaps`` gives, in one pass over each genome.

    Of rows of one place, start, end and strand, the last name stays, as ``last_written`` by name gives it.
    ``lengths`` has one row a genome at most.
    """
    order = Window.partitionBy("genome_id").orderBy("start", "end", "strand", "name")
    place = F.struct("start", "end", "strand")
    rows = df.withColumn("_next", F.lead(place).over(order)).filter(~F.col("_next").eqNullSafe(place)).drop("_next")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_n", F.row_number().over(order)).withColumn("_prev", F.lag("name").over(order)).withColumn("_all", F.max("end").over(upto)).withColumn("_until", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_after", F.lead(F.lit(1)).over(order))
    name = F.when(F.col("_n") == 1, F.concat(F.lit(f"Start{sep}"), "name")).otherwise(_gap_name(F.col("_prev"), F.col("name"), sep))
    rows = rows.join(lengths.select("genome_id", "len"), "genome_id", "left").withColumn("_gap", name)

    def span(start: Column, end: Column, strand: Column, name: Column, kept: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), strand.alias("strand"), name.alias("name"), kept.alias("_kept"))

    start, end, first, plus = F.col("start"), F.col("end"), F.coalesce("_until", F.lit(0)) + 1, F.lit("+")
    own = span(start, end, F.col("strand"), F.col("name"), F.lit(True))
    inner = span(first, start - 1, plus, F.col("_gap"), (first <= start - 1) & F.col("_gap").isNotNull())
    last = span(F.col("_all") + 1, F.col("len"), plus, F.concat("name", F.lit(f"{sep}End")), F.col("_after").isNull() & (F.col("_all") + 1 <= F.col("len")) & F.col("name").isNotNull())
    return rows.select("genome_id", F.inline(F.array(own, inner, last))).filter("_kept").drop("_kept")


def _literal_gaps(rows: Iterator[tuple], sep: str) -> dict[tuple[int, int], str]:
    """The gaps, by bounds, among the ``rows`` (genome_id, start, end, name, len) of one genome in order."""
    out: dict[tuple[int, int], str] = {}
    prev, until, length = None, 0, None
    for _, start, end, name, length in rows:
        if prev is None:
            out[(1, start - 1)] = f"Start{sep}{name}"
        elif start - until > 0:
            if "exon" in prev and "exon" in name and prev.rsplit("_exon", 1)[0] == name.rsplit("_exon", 1)[0]:
                pair = {prev.rsplit("_exon", 1)[1][:1], name.rsplit("_exon", 1)[1][:1]}
                if pair not in ({"1", "2"}, {"2", "3"}):
                    continue
                gap = name.rsplit("_exon", 1)[0] + ("_intron1" if pair == {"1", "2"} else "_intron2")
            else:
                gap = f"{prev}{sep}{name}"
            out[(until + 1, start - 1)] = gap
        prev, until = name, end
    out[(until + 1, int(length))] = f"{prev}{sep}End"
    return out


def fill_gaps_compat(df: DataFrame, lengths: DataFrame, sep: str = "~") -> DataFrame:
    """Gaps by the literal rules: empty gaps are written, the end may move back, and two exons of a gene that aren't neighbours are passed over without moving on.

    Genomes are read one after the other from sorted partitions: a call for each of them took longer than its rows.
    """
    names = ["genome_id", "start", "end", "strand", "name"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        rows = itertools.chain.from_iterable(part.itertuples(index=False, name=None) for part in parts)
        for genome, of in itertools.groupby(rows, key=lambda r: r[0]):
            found += [(genome, a, b, "+", name) for (a, b), name in _literal_gaps(of, sep).items()]
            if len(found) > ROWS_OUT:
                yield pd.DataFrame(found, columns=names)
                found = []
        yield pd.DataFrame(found, columns=names)

    rows = df.select("genome_id", F.col("start").cast("int"), F.col("end").cast("int"), "strand", "name").join(lengths.select("genome_id", F.col("len").cast("int")), "genome_id")
    rows = rows.repartition("genome_id").sortWithinPartitions("genome_id", "start", "end", F.asc_nulls_last("strand"), "name")
    return rows.select("genome_id", "start", "end", "name", "len").mapInPandas(run, f"genome_id {df.schema['genome_id'].dataType.simpleString()}, start int, end int, strand string, name string")


def is_region(name: Column, line: Column | None = None) -> Column:
    """Whether a feature of a guide's table is a gene, tRNA or rRNA to be extracted."""
    line = name if line is None else line
    words = F.lit(False)
    for w in REGION_WORDS:
        words |= F.contains(line, F.lit(w))
    plain = ~F.contains(name, F.lit("-")) & ~F.contains(name, F.lit("~")) & ~words
    return plain | name.rlike(r"^trn\w+-\w\w\w(_exon\d)?$")


def sliced(spans: DataFrame, seqs: DataFrame, key: str, start: Column, end: Column) -> DataFrame:
    """``spans`` with ``seq``: the slice from ``start`` to ``end`` (1-based, inclusive) of the sequence of its ``key``.

    ``seqs`` has one row (key, seq) for each key.  The spans of a sequence are gathered and cut in
    one go, so a sequence is moved once and not once for each span.
    """
    columns = spans.columns
    rows = spans.groupBy(F.col(key).alias("_of")).agg(F.collect_list(F.struct(F.struct(*columns).alias("row"), F.struct(start.alias("start"), end.alias("end")).alias("span"))).alias("_g"))
    rows = rows.join(seqs.select(F.col(key).alias("_to"), "seq"), F.col("_of") == F.col("_to"))
    rows = rows.select("_g", pieces(F.col("seq"), F.transform("_g", lambda x: x["span"])).alias("_cut"))
    return rows.select(F.explode(F.arrays_zip(F.transform("_g", lambda x: x["row"]).alias("row"), F.col("_cut").alias("cut"))).alias("x")).select("x.row.*", F.col("x.cut").alias("seq"))


def extract_regions(features: DataFrame, guides: DataFrame, order: list[str]) -> DataFrame:
    """``ref_id``, ``feature``, ``guide_no``, ``class``, ``seq`` of the features of guide genomes.

    ``features`` has guide_no, name, start, end, strand and the columns of ``order``, by which the
    last of several features of one name counts; ``guides`` has guide_no and seq.
    """
    rows = last_written(features.filter(is_region(F.col("name"))), ["guide_no", "name"], order)
    rows = sliced(rows.select("guide_no", "name", "start", "end", "strand"), guides, "guide_no", F.col("start"), F.greatest("start", F.lit(1)) + F.col("end") - F.col("start"))
    return rows.select(
        ref_id(F.col("name"), F.col("guide_no")).alias("ref_id"), F.col("name").alias("feature"), "guide_no", feature_class(F.col("name")).alias("class"), F.when(F.col("strand") == "-", revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("seq")
    )


def short_exons(refs: DataFrame) -> DataFrame:
    """``refs`` with ``short``: genes under 25 and RNAs under 26 nucleotides, which are located by exact search."""
    return refs.withColumn("short", F.when(F.col("class") == "gene", F.length("seq") < 25).otherwise(F.length("seq") < 26))
