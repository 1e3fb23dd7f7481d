import random

import pytest
from pyspark.sql import functions as F

from thylakoid import queries
from thylakoid.functions import sequence
from thylakoid.functions.sequence import code
from thylakoid.operators import align, motifs, orf
from thylakoid.plans import inputs

REFS = "ref_id string, feature string, guide_no int, class string, seq string"


@pytest.fixture
def given(spark, monkeypatch):
    def put(genomes, refs):
        monkeypatch.setattr(inputs, "genomes", lambda *_: spark.createDataFrame(genomes, "genome_id long, seq string"))
        monkeypatch.setattr(inputs, "references", lambda *_: spark.createDataFrame(refs, REFS))

    return put


def test_find_all_searches_every_genome(spark, given):
    motif, short = "ACGTTGCAACGG", "TTGCAAC"
    genomes = [(1, "AA" + motif), (2, motif + "C" + motif), (7, "ACGT"), (53, "G" * 30), (54, ""), (55, None), (None, motif), (99, "TTGCAACTTGCAAC")]
    refs = [("a", "a", 1, "tRNA", motif), ("f", "f", 1, "gene", motif), ("g", "g", 1, "gene", motif + "TTTT"), ("b", "b", 1, "tRNA", short), ("c", "c", 2, "tRNA", "A" * 12), ("d", "d", 1, "gene", "G" * 12), ("e", "e", 1, "tRNA", "")]
    given(genomes, refs)
    want = {(g, r, tuple(i for i in range(len(s)) if s.startswith(m, i))) for g, s in genomes if s for r, _, _, _, m in refs if m and m in s}
    got = [(r.genome_id, r.ref_id, tuple(r.places)) for r in queries.find_all(spark, "").collect()]
    assert len(got) == len(set(got)) == len(want) and set(got) == want
    first = {(g, r): next((i for i in at if i >= 100), -1) for g, r, at in want}
    assert {(r.genome_id, r.ref_id): r.place for r in queries.first_places(spark, "").collect()} == first
    several = motifs.find_motifs(inputs.genomes(), inputs.references().select(F.col("seq").alias("motif")), limit=8).collect()  # a block for nearly each motif
    assert {(r.genome_id, r.motif, tuple(r.places)) for r in several} == {(g, {x[0]: x[4] for x in refs}[r], at) for g, r, at in want}
    assert motifs.find_motifs(inputs.genomes().limit(0), inputs.references().select(F.col("seq").alias("motif"))).collect() == []
    assert motifs.find_motifs(inputs.genomes(), inputs.references().limit(0).select(F.col("seq").alias("motif"))).collect() == []


def protein_words(dna):
    back = dna[::-1].translate(str.maketrans("ACGT", "TGCA"))
    frames = ["".join(code().get(s[i : i + 3], "X") for i in range(k, len(s) - 2, 3)) for s in (dna, back) for k in range(3)]
    return {w for f in frames for i in range(len(f) - 4) if "X" not in (w := f[i : i + 5])}


def test_protein_pairs_of_short_frames_and_short_words(spark, given):
    rng = random.Random(3)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared = "ATGAAATGGTGCCATGAC"  # six residues
    genomes = [(1, "TAA" + shared + "GGTTAA"), (2, make(300)), (3, make(90) + shared + make(90)), (4, "")]
    refs = [(f"r{i}", "f", 1, kind, s) for i, (kind, s) in enumerate([("gene", "CC" + shared + "CCC"), ("gene", make(120)), ("gene", make(400)), ("tRNA", shared)])]
    given(genomes, refs)
    frames = orf.find_orfs(inputs.genomes()).collect()
    want = {(f"{f.genome_id}:{f.orf_id}", r[0]) for f in frames for r in refs if r[3] == "gene" and protein_words(dict(genomes)[f.genome_id][f.start0 : f.end0 + 1]) & protein_words(r[4])}
    got = [tuple(r) for r in queries.protein_pairs(spark, "").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(q.startswith("1:") and r == "r0" for q, r in got)
    joined = align.frame_pairs(inputs.genomes(), inputs.references().filter("class = 'gene'"), limit=200)  # in several blocks
    assert {tuple(r) for r in joined.collect()} == want


def test_short_genomes_have_regions(spark, given):
    rng = random.Random(6)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    given([(1, make(240)), (2, make(100)), (3, make(12)), (4, "A"), (5, ""), (6, None)], [])
    got = {}
    for r in queries.ir_regions(spark, "").collect():
        got.setdefault(r.genome_id, set()).add(r.name)
    whole = {"IRB", "SSC", "IRA", "FULL"}  # the repeat begins the genome, so LSC is empty
    assert got == {1: whole, 2: whole, 3: {"FULL"}, 4: {"FULL"}}


def test_genbank_texts_are_bounded_and_records_numbered_through_their_file(spark, monkeypatch):
    ids = [0, 50, 100, 5000, 5050, 7, 57, 20_007, 1_000_007]
    rows = [(g, 10 * g % 90 + 1, 10 * g % 90 + 5, "+", f"g{g}", "g", 1.0, g) for g in ids]
    columns = "genome_id long, start int, end int, strand string, name string, gene string, score double, load_order long"
    monkeypatch.setattr(inputs, "features", lambda *_: spark.createDataFrame(rows, columns))
    texts = queries._genbank_texts(spark, "", 2).collect()
    assert max(t.value.count("LOCUS") for t in texts) == 2 and sum(t.value.count("LOCUS") for t in texts) == len(ids)
    want = {(g % 50, sorted(i for i in ids if i % 50 == g % 50).index(g), f"g{g}") for g in ids}
    monkeypatch.setattr(queries, "_genbank_texts", lambda *_, texts=queries._genbank_texts: texts(*_, 2))
    assert {(r.file, r.record, r.name) for r in queries.genbank_sql(spark, "").collect()} == want


def test_scores_of_first_frames_are_those_of_each_pair(spark, given):
    rng = random.Random(8)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared = make(60)
    genomes = [(i, make(rng.randrange(40)) + shared[rng.randrange(9) :] + make(90) + "N" + shared[:40]) for i in range(6)] + [(7, None), (8, "ACGT")]
    refs = [(f"r{i}", "f", 1, "gene", make(i) + shared + make(20 * i)) for i in range(4)]
    given(genomes, refs)
    frames = orf.find_orfs(inputs.genomes(), sequences=True).select(F.concat_ws(":", F.col("genome_id").cast("string"), "orf_id").alias("qseqid"), F.col("seq").alias("o"))
    pairs = queries.protein_pairs(spark, "").join(frames, "qseqid").join(inputs.references().select(F.col("ref_id").alias("sseqid"), F.col("seq").alias("p")), "sseqid")
    pairs = pairs.select("qseqid", "sseqid", sequence.translate_dna(F.col("o")).alias("o"), sequence.translate_dna(F.col("p")).alias("p"))
    for query, score in ((queries.score_protein, sequence.kmer_score), (queries.score_protein_legacy, sequence.kmer_score_legacy)):
        want = pairs.select("qseqid", "sseqid", score(F.col("o"), F.col("p")).alias("score")).collect()
        found = query(spark, "")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want)) and len(want) > 20
        assert len({r.score for r in want}) > 5
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()  # no pair is moved with its sequences


def test_nested_frames_make_no_pairs(spark):
    rng = random.Random(9)
    rows = [(g, f"orf{i}{'-r' * (i % 2)}", s, s + n, n + 1) for g in (1, 2, None) for i in range(60) for s, n in [(rng.randrange(150), rng.randrange(6, 50))]]
    frames = spark.createDataFrame(rows, "genome_id long, orf_id string, start0 int, end0 int, nt int").withColumn("more", F.lit("x"))

    def nested(g, name, a, b, nt):
        over = {x for h, o, s, e, n in rows if h == g and (n > nt or n == nt and o < name) for x in range(max(a, s), min(b, e) + 1)}
        return g is not None and len(over) / max(b - a, 1) >= 0.9

    kept = orf.nested_filter(frames, 0.9)
    assert sorted((str(r.genome_id), r.orf_id) for r in kept.collect()) == sorted((str(r[0]), r[1]) for r in rows if not nested(*r))
    assert kept.columns == frames.columns and "Join" not in kept._jdf.queryExecution().executedPlan().toString()
    assert orf.nested_filter(frames.limit(0), 0.9).collect() == []


def test_queries_bound_batches_and_joined_partitions(spark, given):
    names = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    given([(1, "ACGT")], [])
    for name in names:
        spark.conf.unset(name)
    queries.QUERIES["revcomp"](spark, "")
    assert [int(spark.conf.get(name)) for name in names] == [8 << 20, 16 << 20, 1024]
    try:
        spark.conf.set(names[1], "1m")
        queries.QUERIES["revcomp"](spark, "")
        assert spark.conf.get(names[1]) == "1m"  # a session's own choice stays
    finally:
        for name in names:
            spark.conf.unset(name)
