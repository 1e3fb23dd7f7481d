"""Similarity-search hits: filters, pairs, coverage, scores, best references, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thylakoid.functions.sequence import frame_protein, hit_strand, kmer_score_rna, kmer_scores, kmer_scores_legacy, exon_number, revcomp, six_frames, strip_guide
from thylakoid.operators.features import sliced
from thylakoid.operators.intervals import union_length
from thylakoid.operators.motifs import both_strands, find_motifs

#: Least score of a protein, part of an RNA's length, E-value, and part of a reference that hits cover.
PROTEIN_LEAST, RNA_LENGTH, EVALUE, COVERAGE = 0.70, 0.97, 0.1, 0.9


def filter_hits(hits: DataFrame, identity: float = 0.5, evalue: float | None = EVALUE, reverse_only: str | None = "rpl16") -> DataFrame:
    """Hits without introns, under-identical ones, or references that only lie on the reverse strand hit forward."""
    kept = ~F.contains(F.col("qseqid"), F.lit("intron")) & ~F.contains(F.col("sseqid"), F.lit("intron")) & (F.col("pident") >= identity)
    if evalue is not None:
        kept &= F.col("evalue") <= evalue
    if reverse_only:
        kept &= ~(F.contains(F.col("sseqid"), F.lit(reverse_only)) & ~F.contains(F.col("qseqid"), F.lit("-r")))
    return hits.filter(kept)


def hit_pairs(hits: DataFrame) -> DataFrame:
    """Distinct (query, subject) pairs with the number of their hits."""
    return hits.groupBy("qseqid", "sseqid").agg(F.count(F.lit(1)).alias("n_hsps"))


def hsp_coverage(hits: DataFrame, refs: DataFrame) -> DataFrame:
    """Subject positions that the hits of a pair cover, and their part of the reference's length."""
    spans = hits.select("qseqid", "sseqid", F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end"))
    covered = union_length(spans, ["qseqid", "sseqid"])
    return covered.join(refs.select(F.col("ref_id").alias("sseqid"), F.length("seq").alias("ref_len")), "sseqid").withColumn("fraction", F.col("covered").cast("double") / F.col("ref_len"))


def covered_pairs(hits: DataFrame, refs: DataFrame, least: float = COVERAGE) -> DataFrame:
    """Pairs whose hits together cover ``least`` of the reference or more."""
    return hsp_coverage(hits, refs).filter(F.col("fraction") >= least)


def coverage_tier(ref_len: Column, long_least: float = 0.20) -> Column:
    """Least coverage by the older rules: lower for longer references (``long_least`` was 0.05 in one version)."""
    return F.when(ref_len > 4500, long_least).when(ref_len > 1400, 0.30).otherwise(0.65)


def tiered_pairs(hits: DataFrame, refs: DataFrame, long_least: float = 0.20) -> DataFrame:
    """Best hit fraction of each (reference, query) that reaches its tier."""
    joined = hits.join(refs.select(F.col("ref_id").alias("sseqid"), F.length("seq").alias("ref_len")), "sseqid")
    joined = joined.withColumn("fraction", (F.abs(F.col("send") - F.col("sstart")) + 1).cast("double") / F.col("ref_len"))
    best = joined.groupBy("sseqid", "qseqid", "ref_len").agg(F.max("fraction").alias("fraction"))
    return best.filter(F.col("fraction") >= coverage_tier(F.col("ref_len"), long_least))


def score_pairs(pairs: DataFrame, orfs: DataFrame, refs: DataFrame, legacy: bool = False, compat: bool = False) -> DataFrame:
    """``pairs`` (qseqid, sseqid) with ``score``: the best of six frames of the query against the reference's protein.

    Each sequence is translated once, before the join.
    """
    queries = orfs.select(F.col("orf_id").alias("qseqid"), six_frames(F.col("seq")).alias("_frames"))
    proteins = refs.select(F.col("ref_id").alias("sseqid"), F.coalesce(frame_protein(F.col("seq"), compat), F.lit("")).alias("_ref"))
    score = kmer_scores_legacy if legacy else kmer_scores
    best = F.array_max(score(F.transform("_frames", lambda p: F.coalesce(p, F.lit(""))), F.col("_ref")))
    return pairs.join(queries, "qseqid").join(proteins, "sseqid").withColumn("score", best).drop("_frames", "_ref")


def best_reference(scored: DataFrame, least: float = PROTEIN_LEAST) -> DataFrame:
    """Of each query the reference with the highest score of at least ``least``, the smallest name of equals."""
    rank = F.row_number().over(Window.partitionBy("qseqid").orderBy(F.desc("score"), "sseqid"))
    return scored.filter(F.col("score") >= least).withColumn("_rank", rank).filter("_rank = 1").select(F.col("qseqid").alias("orf_id"), F.col("sseqid").alias("ref_id"), "score")


def best_rna_hits(hits: DataFrame, queries: DataFrame, refs: DataFrame, compat: bool = False) -> DataFrame:
    """Of each RNA in each genome the hit whose slice of the query scores best against its reference.

    ``hits`` also has ``line_no``.  The slice is the hit's query range, complemented if the hit is
    on ``-``.  Equal scores: the first line.  ``compat``: no sequences were loaded, so the first
    line of each RNA wins.
    """
    named = hits.withColumn("short_name", strip_guide(F.col("sseqid")))
    if compat:
        scored = named.withColumn("score", F.lit(0.0))
    else:
        scored = sliced(named, queries, "qseqid", F.least("qstart", "qend"), F.greatest("qstart", "qend")).withColumnRenamed("seq", "_q")
        scored = scored.join(refs.select(F.col("ref_id").alias("sseqid"), F.col("seq").alias("_r")), "sseqid")
        piece = F.col("_q")
        strand = hit_strand(F.col("qstart"), F.col("qend"), F.col("sstart"), F.col("send"))
        scored = scored.withColumn("score", kmer_score_rna(F.when(strand == "-", revcomp(piece)).otherwise(piece), F.col("_r"))).drop("_q", "_r")
    rank = F.row_number().over(Window.partitionBy("qseqid", "short_name").orderBy(F.desc_nulls_last("score"), "line_no"))
    return scored.withColumn("_rank", rank).filter("_rank = 1").select("short_name", F.col("qseqid").alias("query_id"), F.col("sseqid").alias("ref_id"), "score")


def rna_candidates(hits: DataFrame, best: DataFrame, refs: DataFrame, least: float = RNA_LENGTH) -> DataFrame:
    """Hits of the best references that cover nearly all of them, numbered by genome in line order.

    ``orf_id`` is ``orfRNA{n}``, with ``-r`` where the subject runs backwards.
    """
    rows = hits.join(best.select(F.col("query_id").alias("qseqid"), F.col("ref_id").alias("sseqid")).distinct(), ["qseqid", "sseqid"], "left_semi")
    rows = rows.join(refs.select(F.col("ref_id").alias("sseqid"), F.length("seq").alias("_len")), "sseqid")
    rows = rows.filter((F.abs(F.col("send") - F.col("sstart")) + 1).cast("double") / F.col("_len") >= least)
    n = F.row_number().over(Window.partitionBy("qseqid").orderBy("line_no"))
    orf = F.concat(F.lit("orfRNA"), n.cast("string"), F.when(F.col("send") < F.col("sstart"), "-r").otherwise(""))
    return rows.select("qseqid", F.col("sseqid").alias("ref_id"), orf.alias("orf_id"), F.col("qstart").alias("start"), F.col("qend").alias("end"))


def locate_short_exons(shorts: DataFrame, candidates: DataFrame, genomes: DataFrame, compat: bool = False) -> DataFrame:
    """First exons too short for a search, found by exact matching nearest to their second exon.

    ``shorts`` has ref_id, feature, guide_no and seq; ``candidates`` genome_id, ref_id, orf_id,
    start0 and end0.  Only a second exon with one candidate in the genome is an anchor: its end on
    the reverse strand, its start on the other.  Of equally near places the first counts.  All exons are
    looked for in one pass over the genomes, and only their places meet the anchors.  Returns
    genome_id, ref_id, orf_id, start and end, 1-based.  ``compat`` never finds position 0, and takes
    the last place on the reverse strand.
    """
    gene = F.regexp_extract("feature", r"^(.+)_exon\d+", 1)
    first = shorts.filter(exon_number(F.col("feature")) == 1).select(
        F.col("ref_id"), F.col("seq").alias("_seq"), F.concat(gene, F.lit("_exon2XXX"), F.col("guide_no").cast("string")).alias("_next")
    )
    alone = candidates.groupBy("genome_id", F.col("ref_id").alias("_next")).agg(F.count(F.lit(1)).alias("_n"), F.first("orf_id").alias("_orf"), F.first("start0").alias("_s"), F.first("end0").alias("_e")).filter("_n = 1")
    back = F.col("_orf").endswith("-r")
    rows = first.join(alone, "_next").withColumn("_back", back).withColumn("_motif", F.when(back, revcomp(F.col("_seq"))).otherwise(F.col("_seq")))
    places = find_motifs(genomes, both_strands(first.select(F.col("_seq").alias("motif"))))
    rows = rows.join(places.select(F.col("genome_id"), F.col("motif").alias("_motif"), F.col("places").alias("_at")), ["genome_id", "_motif"])
    rows = rows.withColumn("_at", F.filter("_at", lambda p: p > 0)) if compat else rows
    near = F.array_min(F.transform("_at", lambda p: F.struct(F.abs(p - F.when(F.col("_back"), F.col("_e")).otherwise(F.col("_s"))).alias("d"), p.alias("p"))))["p"]
    place = F.when(F.col("_back"), F.element_at("_at", -1)).otherwise(near) if compat else near
    rows = rows.filter(F.size("_at") > 0).withColumn("_p", place)
    n = F.row_number().over(Window.partitionBy("genome_id").orderBy("ref_id"))
    return rows.select("genome_id", "ref_id", F.concat(F.lit("orfx"), n.cast("string"), F.when(F.col("_back"), "-r").otherwise("")).alias("orf_id"), (F.col("_p") + 1).alias("start"), (F.col("_p") + F.length("_seq")).alias("end"))
