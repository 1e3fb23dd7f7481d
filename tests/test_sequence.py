import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thylakoid.functions import sequence as seq
from thylakoid.operators import orf, refine, repeats

G30 = "TAAATGGCTGCAAAACGTTGGCATTAGCCC"


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expression.alias("x")).first()["x"]


def test_revcomp(spark):
    assert one(spark, seq.revcomp(F.col("s")), s="ACGTNRacgt") == "acgtRNACGT"


def test_translation(spark):
    assert one(spark, seq.translate_dna(F.col("s")), s="GCNCTNNNNatg") == "AXXX"
    assert one(spark, seq.translate_dna(F.col("s")), s="AC") is None
    assert one(spark, seq.six_frames(F.col("s")), s=G30)[:3] == ["_MAAKRWH_P", "KWLQNVGIS", "NGCKTLALA"]


def test_scores(spark):
    score = lambda a, b: one(spark, seq.kmer_score(F.col("a"), F.col("b")), a=a, b=b)
    assert score("MAAKRWH_", "MAAKRWH_") == 0.75
    assert score("MAAKRQH_", "MAAKRWH_") == 0.375
    assert score("MA", "MAAKRWH_") == 0.0
    assert score("MAAKRWH_", "") is None
    assert one(spark, seq.kmer_score_rna(F.col("a"), F.col("b")), a="GGGCGAATAGCTCAGTTGG", b="GGGCGAATAGCTCAGTTGGTAG") == 1.0


@pytest.mark.parametrize(("ends", "strand"), [((10, 50, 1, 41), "+"), ((10, 50, 41, 1), "-"), ((50, 10, 41, 1), "+"), ((10, 10, 1, 41), "-")])
def test_hit_strand(spark, ends, strand):
    assert one(spark, seq.hit_strand(*[F.lit(x) for x in ends])) == strand


def test_names(spark):
    assert one(spark, seq.strip_guide(F.lit("rps12_exon1XXX2"))) == "rps12_exon1"
    assert one(spark, seq.exon_number(F.lit("rps12_exon12XXX2"))) == 12
    assert one(spark, seq.find_all(F.lit("AAAA"), F.lit("AA"))) == [0, 1, 2]
    assert one(spark, seq.find_all(F.lit("AAAA"), F.lit("AA"), False)) == [1, 2]
    assert one(spark, seq.index_of(F.lit("ABCABC"), F.lit("C"), 3)) == 5
    assert one(spark, seq.index_of(F.lit("ABC"), F.lit(""), 0)) == -1


def test_orfs_of_the_fixture(spark):
    genomes = spark.createDataFrame([(1, G30)], "genome_id long, seq string")
    found = lambda compat: {(r.orf_id, r.start0, r.end0) for r in orf.find_orfs(genomes, compat=compat).collect()}
    literal = {("orf1", 3, 26), ("orf2", 1, 27), ("orf1-r", 0, 29), ("orf2-r", 2, 22)}
    assert found(True) == literal
    assert found(False) == literal | {("orf3", 2, 28), ("orf3-r", 1, 27)}


def brute_orfs(text):
    out, number = [], 0
    for frame in range(3):
        begin, j = None, frame
        while j <= len(text):
            amino = refine.CODE.get(text[j : j + 3]) if j + 3 <= len(text) else None
            if amino is None or amino == "_":
                end = j + 2 if amino else j - 1
                if begin is not None and end - begin + 1 > 18:
                    number += 1
                    out.append((f"orf{number}", begin, end))
                begin = None
            elif begin is None:
                begin = j
            j += 3
    return out


def test_orfs_against_a_state_machine(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGTACGTACGTNa") for _ in range(rng.randrange(0, 400))) for _ in range(60)]
    genomes = spark.createDataFrame(list(enumerate(texts)), "genome_id long, seq string")
    rows = orf.find_orfs(genomes).filter("strand = '+'").collect()
    for i, text in enumerate(texts):
        assert sorted((r.orf_id, r.start0, r.end0) for r in rows if r.genome_id == i) == sorted(brute_orfs(text))


@settings(max_examples=40, deadline=None)
@given(st.text("ACGT", min_size=20, max_size=60), st.text("ACGT", min_size=30, max_size=80), st.text("ACGT", min_size=5, max_size=40))
def test_regions_tile_the_genome(repeat, lsc, ssc):
    rc = repeat[::-1].translate(str.maketrans("ACGT", "TGCA"))
    regions = repeats.inverted_repeat(lsc + repeat + ssc + rc)
    assert regions[-1][0] == "FULL"
    place = 0
    for _, start, end in regions[:-1]:
        assert start == place + 1 and end >= start - 1
        place = end
    assert place in (0, len(lsc + repeat + ssc + rc))


def test_walks_over_packed_words_and_texts_agree(monkeypatch):
    rng = random.Random(9)
    for letters in ("ACGT", "ACGTN", "ACGTRYKMSWBDHVN"):
        for _ in range(60):
            half = "".join(rng.choice(letters) for _ in range(rng.randrange(25, 6000 if letters == "ACGT" else 200)))
            genome = "".join(rng.choice(letters) for _ in range(30)) + half + "".join(rng.choice(letters) for _ in range(rng.randrange(5, 60))) + half[::-1].translate(str.maketrans("ACGT", "TGCA"))
            packed = repeats.inverted_repeat(genome)
            with monkeypatch.context() as m:
                m.setattr(repeats, "_packed", lambda *_: None)
                assert repeats.inverted_repeat(genome) == packed
            assert len(packed) == 5 or "Y" in letters


def test_no_repeat_gives_full_only():
    assert repeats.inverted_repeat("A" * 50) == [("FULL", 1, 50)]
    assert repeats.inverted_repeat("ACG") == [("FULL", 1, 3)]


GENE = "ATGGCTGCAAAACGTTGGCATCTGGAAAGCTAA"


def test_refinement_finds_the_gene():
    left, right = "CCCGGG", "GGGCCC"
    assert refine.refine(left + GENE, 100, 100 + len(left + GENE) - 1, GENE, 0, "start") == (107, 100 + len(left + GENE), "+")
    rc = (left + GENE)[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert refine.refine(rc, 100, 100 + len(rc) - 1, GENE, 0, "start") == (101, 100 + len(GENE), "-")
    assert refine.refine("CCCGGGCCCGGGAAATTTCCC" + right, 0, 26, GENE, 0, "start") is None


def test_start_codons(spark):
    assert one(spark, seq.match_start(F.lit("CATGATGCCC"), F.lit(2))) == 4
    assert one(spark, seq.match_start(F.lit("CATGATGCCC"), F.lit(1))) == 1
    assert one(spark, seq.alt_start(F.lit("CGTGGTG"), F.lit(1), F.lit("GTGAAA"))) == 1
    assert one(spark, seq.match_start(F.lit("CCCCCC"), F.lit(2))) == -1


def test_bounded_anchors():
    assert refine.near_start("MMMM", "WWWWWW") is None
    assert refine.match_end("MAAKRWH", "QQQQ", 0) == 0
