"""The whole annotation, and the import of annotations.

The annotation makes durable cuts while its plan is built: where the plan branches, so that
nothing is computed twice.  Genomes are annotated side by side: every join and window is keyed by the genome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from thylakoid.functions.sequence import exon_gene, exon_number, strip_guide
from thylakoid.operators import align, features, gapped, hits, intervals, orf, refine, repeats
from thylakoid.plans.cuts import cut


def best_orfs(orfs: DataFrame, scored: DataFrame, least: float = hits.PROTEIN_LEAST) -> DataFrame:
    """Assignments: the best reference of each frame, and of frames of a reference that overlap the best.

    ``orfs`` has genome_id, orf_id (unique over genomes), start0 and end0; ``scored`` qseqid, sseqid and score.
    """
    best = hits.best_reference(scored, least)
    placed = best.join(orfs.select("genome_id", "orf_id", F.col("start0").alias("start"), F.col("end0").alias("end")), "orf_id")
    return intervals.best_of_islands(placed, ["genome_id", "ref_id"], "score", "orf_id")


def refine_candidates(candidates: DataFrame, orfs: DataFrame, refs: DataFrame, catalogue: DataFrame, compat: bool = False) -> DataFrame:
    """Features (genome_id, start, end, strand, name) of protein candidates.

    Exon 1 and genes are refined at their start, the last exon of a gene at its end, others in the
    middle; ``catalogue`` has the number of exons of each gene.
    """
    rows = candidates.select("genome_id", "ref_id", "orf_id", "start", "end").join(orfs.select("orf_id", F.col("seq").alias("_orf")), "orf_id").join(refs.select("ref_id", "feature", F.col("seq").alias("_ref")), "ref_id")
    number, gene = exon_number(F.col("feature")), exon_gene(F.col("feature"))
    rows = rows.withColumn("gene", gene).withColumn("number", number).join(catalogue, ["genome_id", "gene"], "left")
    variant = F.when(F.col("number").isNull() | (F.col("number") == 1), "start").when(F.col("number") == F.col("n_exons"), "end").otherwise("mid")
    restore = F.when(F.col("number").isNull(), 0).otherwise(F.length("_ref") % 3)
    found = rows.withColumn("r", refine.refine_exon(F.col("_orf"), F.col("start"), F.col("end"), F.col("_ref"), restore, variant, compat))
    return found.filter("r.start is not null").select("genome_id", "r.start", "r.end", "r.strand", F.col("ref_id").alias("name"))


def annotate(genomes: DataFrame, refs: DataFrame, compat: bool = False, rna_hits: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Feature table (genome_id, name, start, end, strand, sort_key) of ``genomes`` (genome_id, seq).

    ``refs`` has ref_id, feature, guide_no, class and seq.  Hits come from the built-in search
    unless a table of an external one is given: ``rna_hits`` (query: the genome's id as text) and
    ``pairs`` (qseqid: ``{genome}:{frame}``).
    """
    seqs = genomes.select(F.col("genome_id").cast("string").alias("qseqid"), "seq")
    refs = cut(features.short_exons(refs))
    genes, rnas = refs.filter("class = 'gene' and not short"), refs.filter("class <> 'gene'")

    if rna_hits is None:
        rna_hits = gapped.gapped_search(seqs, rnas).withColumn("line_no", F.row_number().over(Window.partitionBy("qseqid").orderBy("sseqid", "qstart", "qend", "sstart")))
    rna_hits = cut(hits.filter_hits(rna_hits, reverse_only=None))
    best_rna = hits.best_rna_hits(rna_hits, seqs, rnas, compat)
    rna = hits.rna_candidates(rna_hits, best_rna, rnas).join(genomes.select("genome_id", F.col("genome_id").cast("string").alias("qseqid")), "qseqid")
    rna = rna.select("genome_id", "ref_id", "orf_id", "start", "end")

    if pairs is None:  # the few frames that score come with their places
        scored = align.frame_scores(genomes, genes, hits.PROTEIN_LEAST, compat=compat, places=True)
    else:
        orfs = orf.find_orfs(genomes, compat=compat, sequences=True)
        orfs = cut(orfs.withColumn("orf_id", F.concat_ws(":", F.col("genome_id").cast("string"), "orf_id")))
        scored = hits.score_pairs(pairs, orfs, genes, compat=compat)
    scored = scored.filter(~(F.contains(F.col("sseqid"), F.lit("rpl16")) & ~F.contains(F.col("qseqid"), F.lit("-r"))))
    if pairs is None:
        scored = cut(scored)
        orfs = scored.select("genome_id", F.col("qseqid").alias("orf_id"), "start0", "end0", "seq").distinct()
    proteins = best_orfs(orfs, scored).select("genome_id", "ref_id", "orf_id", "start", "end")
    cleaned = intervals.clean_overlaps(cut(proteins.withColumn("rna", F.lit(False)).unionByName(rna.withColumn("rna", F.lit(True)))), ["genome_id", "ref_id"], length=F.when(F.col("rna"), 0).otherwise(F.col("end") - F.col("start")) if compat else None, compat=compat)
    cleaned = cut(cleaned)

    anchors = cleaned.select("genome_id", "ref_id", "orf_id", F.col("start").alias("start0"), F.col("end").alias("end0"))
    found_short = cut(hits.locate_short_exons(refs.filter("short"), anchors, genomes, compat))
    named = cleaned.select("genome_id", "ref_id").unionByName(found_short.select("genome_id", "ref_id"))
    catalogue = features.exon_catalogue(named.select("genome_id", strip_guide(F.col("ref_id")).alias("name")))

    strand = F.when(F.col("orf_id").endswith("-r"), "-").otherwise("+")
    verbatim = cleaned.filter("rna").select("genome_id", "ref_id", "orf_id", "start", "end").unionByName(found_short)
    verbatim = verbatim.select("genome_id", F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end"), strand.alias("strand"), F.col("ref_id").alias("name"))
    refined = refine_candidates(cleaned.filter("not rna"), orfs, refs, catalogue, compat)
    every = verbatim.unionByName(refined).withColumn("name", strip_guide(F.col("name"))).filter("start <= end")
    every = cut(intervals.last_written(every, ["genome_id", "start", "end", "strand"], ["name"]))
    every = intervals.drop_contained(every, ["genome_id"]).select("genome_id", "start", "end", "strand", "name")
    lengths = genomes.select("genome_id", F.length("seq").alias("len"))
    gaps = features.fill_gaps_compat(every, lengths) if compat else features.fill_gaps(every, lengths)
    table = every.unionByName(gaps.select(every.columns)).withColumn("sort_key", F.lit(0))
    regions = repeats.find_regions(genomes)
    place = F.create_map(*[F.lit(x) for pair in zip(("LSC", "IRB", "SSC", "IRA", "FULL"), range(1, 6), strict=True) for x in pair])
    return table.unionByName(regions.withColumn("sort_key", place[F.col("name")]).select(table.columns)).select("genome_id", "name", "start", "end", "strand", "sort_key")


def import_gff3(found: DataFrame, lengths: DataFrame, compat: bool = False) -> DataFrame:
    """Feature table of parsed GFF3 features: exons numbered, gaps filled."""
    named = features.number_exons(found, compat).select("genome_id", "start", "end", "strand", "name")
    if not compat:
        return features.with_gaps(named, lengths)
    named = cut(intervals.last_written(named, ["genome_id", "start", "end", "strand"], ["name"]))
    return named.unionByName(features.fill_gaps_compat(named, lengths).select(named.columns))


def import_genbank(found: DataFrame, compat: bool = False) -> DataFrame:
    """Feature table of parsed GenBank features; gaps are named with ``-``."""
    named = found.select("genome_id", "start", "end", "strand", "name")
    lengths = found.filter("len is not null").groupBy("genome_id").agg(F.max("len").alias("len"))
    gaps = features.fill_gaps_compat(named, lengths, "-") if compat else features.fill_gaps(named, lengths, "-")
    return named.unionByName(gaps.select(named.columns))
