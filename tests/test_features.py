import random

import pytest
from pyspark.sql import functions as F

from thylakoid.operators import align, features, hits, intervals
from thylakoid.plans import annotate
from thylakoid.sources import readers, writers

SPAN = "genome_id long, start int, end int, strand string, name string"


def spans(spark, rows):
    return spark.createDataFrame([(1, a, b, "+", n) for a, b, n in rows], SPAN)


def lengths(spark, n):
    return spark.createDataFrame([(1, n)], "genome_id long, len int")


def names(df):
    return sorted((r.start, r.end, r.name) for r in df.collect())


def test_containment(spark):
    rows = spans(spark, [(1, 10, "a"), (3, 8, "b"), (1, 12, "c"), (11, 20, "d"), (5, 12, "e")])
    assert names(intervals.drop_contained(rows, ["genome_id"])) == [(1, 12, "c"), (11, 20, "d")]


def test_gaps(spark):
    rows = spans(spark, [(10, 20, "A"), (31, 40, "g_exon1"), (51, 60, "g_exon2"), (58, 70, "B")])
    expected = [(1, 9, "Start~A"), (21, 30, "A~g_exon1"), (41, 50, "g_intron1"), (71, 100, "B~End")]
    assert names(features.fill_gaps(rows, lengths(spark, 100))) == expected
    assert names(features.fill_gaps_compat(rows, lengths(spark, 100))) == expected


def test_empty_gaps(spark):
    rows = spans(spark, [(1, 20, "A"), (21, 30, "B")])
    assert names(features.fill_gaps(rows, lengths(spark, 30))) == []
    assert names(features.fill_gaps_compat(rows, lengths(spark, 30))) == [(1, 0, "Start~A"), (21, 20, "A~B"), (31, 30, "B~End")]


@pytest.mark.parametrize(("strand", "order"), [("+", [1, 2, 3]), ("-", [3, 2, 1])])
def test_exon_numbers(spark, strand, order):
    rows = spark.createDataFrame([(1, "g", a, b, strand) for a, b in ((10, 20), (30, 40), (50, 60))], "genome_id long, gene string, start int, end int, strand string")
    assert [r.name for r in features.number_exons(rows).orderBy("start").collect()] == [f"g_exon{n}" for n in order]
    one = rows.filter("start = 10")
    assert features.number_exons(one).first()["name"] == "g"


def test_regions(spark):
    names = ["psbA", "trnK-UUU", "trnK-UUU_exon1", "trnK-UUU_intron1", "psbA~trnH", "psbA-matK", "IRA", "rpl16_intron1"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in rows.filter(features.is_region(F.col("n"))).collect()] == names[:3]
    table = spark.createDataFrame([(1, "psbA", 2, 4, "-", 1), (1, "psbA", 1, 3, "-", 2)], "guide_no int, name string, start int, end int, strand string, k int")
    guide = spark.createDataFrame([(1, "AACGT")], "guide_no int, seq string")
    found = features.extract_regions(table, guide, ["k"]).collect()
    assert [(r.ref_id, r["class"], r.seq) for r in found] == [("psbAXXX1", "gene", "GTT")]


def test_short_flags(spark):
    rows = spark.createDataFrame([(c, "A" * n) for c, n in (("gene", 24), ("gene", 25), ("tRNA", 25), ("tRNA", 26))], "class string, seq string")
    assert [r.short for r in features.short_exons(rows).collect()] == [True, False, True, False]


def test_locus_and_overlaps(spark):
    rows = spark.createDataFrame([(1, "r", "orfA", 0, 50, 0.8), (1, "r", "orfB", 40, 90, 0.9), (1, "r", "orfC", 200, 250, 0.7)], "genome_id long, ref_id string, orf_id string, start int, end int, score double")
    assert sorted(r.orf_id for r in intervals.best_of_islands(rows, ["genome_id", "ref_id"], "score", "orf_id").collect()) == ["orfB", "orfC"]
    rows = spark.createDataFrame([(1, "r", "orf1", 0, 99), (1, "r", "orf2", 50, 120), (1, "r", "orf3", 500, 599)], "genome_id long, ref_id string, orf_id string, start int, end int")
    for compat in (False, True):
        assert sorted(r.orf_id for r in intervals.clean_overlaps(rows, ["genome_id", "ref_id"], compat=compat).collect()) == ["orf1", "orf3"]


def test_hits(spark):
    refs = spark.createDataFrame([("trnA-UGCXXX1", "tRNA", "A" * 100)], "ref_id string, class string, seq string")
    found = spark.createDataFrame([("1", "trnA-UGCXXX1", 5, 101, 1, 97, 1), ("1", "trnA-UGCXXX1", 5, 100, 1, 96, 2), ("1", "trnA-UGCXXX1", 5, 104, 100, 1, 3)], "qseqid string, sseqid string, qstart int, qend int, sstart int, send int, line_no long")
    best = hits.best_rna_hits(found, found, refs, True)
    kept = hits.rna_candidates(found, best, refs).collect()
    assert sorted((r.orf_id, r.start, r.end) for r in kept) == [("orfRNA1", 5, 101), ("orfRNA2-r", 5, 104)]


def test_search_finds_both_strands(spark):
    gene = "ATGGCTGCAAAACGTTGGCATCTGGAAAGC"
    back = gene[::-1].translate(str.maketrans("ACGT", "TGCA"))
    genome = spark.createDataFrame([("g", "CCCCC" + gene + "TTTT" + back)], "qseqid string, seq string")
    refs = spark.createDataFrame([("r", gene)], "ref_id string, seq string")
    assert sorted((r.qstart, r.qend, r.sstart, r.send) for r in align.search(genome, refs, 12, 10.0).collect()) == [(6, 35, 1, 30), (40, 69, 30, 1)]


def test_files_round_trip(spark, tmp_path):
    fasta = spark.createDataFrame([("a", "ACGT"), ("b x", "GG")], "id string, seq string")
    writers.write_fasta(fasta, f"file://{tmp_path}/f")
    assert sorted(map(tuple, readers.read_fasta(spark, f"file://{tmp_path}/f").collect())) == [("a", "ACGT"), ("b x", "GG")]
    (tmp_path / "g.fsa").write_text(">x\nAC\nGT\n>y\nTT\n>x\nCC\n")
    assert dict(map(tuple, readers.read_fasta(spark, f"file://{tmp_path}/g.fsa").collect())) == {"x": "ACGTCC", "y": "TT"}
    assert readers.read_genome(spark, f"file://{tmp_path}/g.fsa").first()["seq"] == "ACGTTTCC"
    (tmp_path / "c.txt").write_text("orf1\t3-26\nbad line\n")
    assert list(map(tuple, readers.read_orf_coordinates(spark, f"file://{tmp_path}/c.txt").collect())) == [("orf1", 3, 26)]
    (tmp_path / "v.vt").write_text("psbA 1  10 +\nx\n")
    assert [(r.name, r.end) for r in readers.read_features(spark, f"file://{tmp_path}/v.vt").collect()] == [("psbA", 10)]
    (tmp_path / "b.txt").write_text("orf1\trXXX1\t0.83q\norf2\tg_intronXXX1\t1q\n")
    assert list(map(tuple, readers.read_assignments(spark, f"file://{tmp_path}/b.txt").collect())) == [("orf1", "rXXX1", 0.83)]
    assert [(r.guide_no, r.guide) for r in readers.guide_list(spark, "a,b").collect()] == [(1, "a"), (2, "b")]


def test_imports(spark):
    lines = ["##gff", "s x region 1 100 . + . ID=r", "s x CDS 10 20 . + 0 ID=c;Parent=g", "s x CDS 31 40 . + 0 ID=c;Parent=g", "s x tRNA 50 60 . - . ID=trnA-UGC", "s x CDS 70 80 . + 0 ID=c"]
    table = annotate.import_gff3(*readers.parse_gff3(spark.createDataFrame([(1, x) for x in lines], "genome_id long, value string")))
    assert names(table) == [(1, 9, "Start~g_exon1"), (10, 20, "g_exon1"), (21, 30, "g_intron1"), (31, 40, "g_exon2"), (41, 49, "g_exon2~trnA-UGC"), (50, 60, "trnA-UGC"), (61, 100, "trnA-UGC~End")]
    text = 'LOCUS  X  100 bp\n     gene            complement(join(10..20,\n                     31..40))\n                     /gene="g"\n     CDS             1..3\n                     /gene="h"\n'
    assert readers.genbank_features(text) == ([("g", 10, 20, "-"), ("g", 31, 40, "-")], 100)
    assert readers.genbank_features_compat('LOCUS 100 bp\n     gene  10..20\n  /gene="g"\n') == ([("g", 10, 20, "+")], 100)


def test_annotation_of_a_small_genome(spark):
    gene = "ATGGCTGCAAAACGTTGGCATCTGGAAAGCGATTTCCGTAACTGGTAA"
    trna = "GGGCGAATAGCTCAGTTGGTAGAGCACGCCCTTGATAAGGGCGTGAGG"
    genome = "CCGGTTAACC" * 3 + gene + "TTGACCGGAT" * 3 + trna + "CAGT" * 10
    genomes = spark.createDataFrame([(1, genome)], "genome_id long, seq string")
    refs = spark.createDataFrame([("psbAXXX1", "psbA", 1, "gene", gene), ("trnI-GAUXXX1", "trnI-GAU", 1, "tRNA", trna)], "ref_id string, feature string, guide_no int, class string, seq string")
    found = {(r.name, r.start, r.end, r.strand) for r in annotate.annotate(genomes, refs).collect()}
    assert ("psbA", 31, 78, "+") in found
    assert ("trnI-GAU", 109, 156, "+") in found
    assert ("FULL", 1, len(genome), "+") in found
    assert ("Start~psbA", 1, 30, "+") in found and ("psbA~trnI-GAU", 79, 108, "+") in found


def test_literal_gaps_of_many_genomes_are_read_in_one_pass(spark):
    rows = [(g, s, s + 4, "+", n) for g in range(50) for s, n in ((10 + g, "A"), (20 + g, "B"))]
    table = spark.createDataFrame(rows, "genome_id long, start int, end int, strand string, name string")
    found = features.fill_gaps_compat(table, spark.createDataFrame([(g, 100) for g in range(50)], "genome_id long, len int"))
    want = [(g, *x) for g in range(50) for x in ((1, 9 + g, "Start~A"), (15 + g, 19 + g, "A~B"), (25 + g, 100, "B~End"))]
    assert sorted((r.genome_id, r.start, r.end, r.name) for r in found.collect()) == sorted(want)
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()  # no call for each genome
    assert features.fill_gaps_compat(table.limit(0), spark.createDataFrame([(1, 100)], "genome_id long, len int")).collect() == []


def test_features_and_gaps_in_one_pass_are_those_of_two(spark):
    pick = random.Random(5)
    rows = [(pick.choice([1, 2, 3, None]), s := pick.randrange(1, 200), s + pick.randrange(-1, 40), pick.choice(["+", "-", None]), pick.choice(["a", "b", "g_exon1", "g_exon2", "g_exon3", "h_exon1"])) for _ in range(160)]
    rows += [(4, 10, 20, "+", "a"), (4, 10, 20, "+", "a"), (4, 10, 20, "+", "c"), (5, 1, 9, "+", "a")]
    table = spark.createDataFrame(rows, "genome_id long, start int, end int, strand string, name string")
    lengths = spark.createDataFrame([(1, 300), (2, 150), (4, 20), (5, None), (6, 10)], "genome_id long, len int")
    named = intervals.last_written(table, ["genome_id", "start", "end", "strand"], ["name"])
    want = named.unionByName(features.fill_gaps(named, lengths).select(named.columns))
    got = features.with_gaps(table, lengths)
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert got.columns == named.columns and order(got) == order(want) and got.count() > named.count()


def test_a_gff_line_is_split_once_and_genomes_are_moved_once(spark):
    found, lengths = readers.parse_gff3(spark.createDataFrame([(1, "s x CDS 10 20 . + 0 ID=c;Parent=g")], "genome_id long, value string"))
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert plan(found).count("split(") == 1 and plan(lengths).count("split(") == 1
    whole = annotate.import_gff3(found, lengths)._jdf.queryExecution().executedPlan().toString()
    assert whole.count("REPARTITION_BY_COL") == 1 and whole.count("ENSURE_REQUIREMENTS") <= 1
