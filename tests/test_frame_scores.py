"""Scores of frames that are counted in blocks of genomes, against every pair scored by itself."""

import random

import pytest

from thylakoid.functions.sequence import code
from thylakoid.operators import align, orf

rng = random.Random(17)
CODE = code()
SENSE = [c for c, a in CODE.items() if a != "_" and "N" not in c]


def protein(dna, phase=0):
    return "".join(CODE.get(dna[i : i + 3], "X") for i in range(phase, len(dna) - 2, 3))


def sides(dna):
    return [protein(s, k) for s in (dna, dna[::-1].translate(str.maketrans("ACGT", "TGCA"))) for k in range(3)]


def windows(p, n):
    return {p[i : i + n] for i in range(len(p) - n + 1) if n == 3 or "X" not in p[i : i + n]}


def plain(frames, refs, k):
    """Score of each frame and reference that share a word of ``k`` residues: the best of six proteins."""
    out = {}
    for name, dna in frames:
        for ref, seq in refs:
            held, words = windows(protein(seq), 3), set().union(*[windows(p, k) for p in sides(seq)])
            if words & set().union(*[windows(p, k) for p in sides(dna)]):
                out[(name, ref)] = max(sum(p[i : i + 3] in held for i in range(len(p) - 2)) for p in sides(dna)) / len(protein(seq))
    return out


@pytest.mark.parametrize("letters, dense", [(1 << 16, 1 << 22), (1 << 16, 1), (1, 1 << 22)])
def test_blocks_of_genomes_score_as_pairs_do(spark, monkeypatch, letters, dense):
    monkeypatch.setattr(align, "LETTERS", letters)
    monkeypatch.setattr(align, "DENSE", dense)
    refs = [(f"r{i}", "ATG" + "".join(rng.choice(SENSE) for _ in range(rng.randrange(5, 30)))) for i in range(12)]
    genomes = []
    for i in range(40):
        part = rng.choice(refs)[1]
        parts = ["".join(rng.choice("ACGTN" if i % 7 == 0 else "ACGT") for _ in range(rng.randrange(0, 90))), part[rng.randrange(6) :], part[: rng.randrange(len(part))]]
        genomes.append((i, "".join(parts[: 1 + i % 3])))
    table = spark.createDataFrame([*genomes, (40, None), (41, ""), (42, "ACG")], "genome_id long, seq string").coalesce(1)
    frames = [(f"{f.genome_id}:{f.orf_id}", f.seq) for f in orf.find_orfs(table, sequences=True).collect()]
    known = spark.createDataFrame(refs, "ref_id string, seq string")
    got = align.frame_scores(table, known, k=4).collect()
    want = plain(frames, refs, 4)
    assert want and {(r.qseqid, r.sseqid): r.score for r in got} == want and len(got) == len(want)
    best = align.frame_scores(table, known, least=0.4, k=4).collect()
    assert {tuple(r) for r in best} == {tuple(r) for r in got if r.score >= 0.4} and 0 < len(best) < len(got)


def test_pairs_come_with_the_places_of_their_frames(spark):
    refs = [(f"r{i}", "ATG" + "".join(rng.choice(SENSE) for _ in range(20))) for i in range(4)]
    genomes = [(i if i else None, "TAA" + refs[i % 4][1] + "".join(rng.choice("ACGTé") for _ in range(40)) + refs[-1][1]) for i in range(12)]
    table = spark.createDataFrame(genomes, "genome_id long, seq string").coalesce(1)
    frames = {(f.genome_id, f"{'' if f.genome_id is None else f'{f.genome_id}:'}{f.orf_id}", f.start0, f.end0, f.seq) for f in orf.find_orfs(table, sequences=True).collect()}
    known = spark.createDataFrame(refs, "ref_id string, seq string")
    placed = align.frame_scores(table, known, least=0.7, places=True)
    got = placed.collect()
    assert placed.schema["genome_id"].dataType == table.schema["genome_id"].dataType and len({r.genome_id for r in got}) == 12
    assert {(r.genome_id, r.qseqid, r.start0, r.end0, r.seq) for r in got} <= frames
    assert sorted((r.qseqid, r.sseqid, r.score) for r in got) == sorted(tuple(r) for r in align.frame_scores(table, known, least=0.7).collect())


def test_only_frames_that_may_reach_the_least_score_are_looked_at(spark, monkeypatch):
    refs = [(f"r{i}", "ATG" + "".join(rng.choice(SENSE) for _ in range(rng.randrange(20, 50)))) for i in range(70)]
    long = [(f"s{i}", "ATG" + "".join(rng.choice(SENSE) for _ in range(300 + i))) for i in range(2)]  # more windows than a lane counts
    genomes = [(i, "".join(rng.choice("ACGT") for _ in range(900))) for i in range(20)] + [(20 + i, "TAA" + seq[3 * (i % 4) :]) for i, (_, seq) in enumerate(refs[:9] + long)]
    genomes += [(50, long[0][1][::-1].translate(str.maketrans("ACGT", "TGCA"))), (51, long[1][1][:600] + refs[0][1]), (52, "ATGGCA" * 90)]
    table = spark.createDataFrame(genomes[16:], "genome_id long, seq string").coalesce(1)
    frames = [(f"{f.genome_id}:{f.orf_id}", f.seq) for f in orf.find_orfs(table, sequences=True).collect()]
    every = refs + long + [("a", "ATGGCA" * 8), ("none", "AT")]
    want = {pair: score for pair, score in plain(frames, every[:-1], 5).items() if score >= 0.7}
    got = align.frame_scores(table, spark.createDataFrame(every, "ref_id string, seq string"), least=0.7).collect()
    assert {(r.qseqid, r.sseqid): r.score for r in got} == want and len(got) == len(want) >= 14

    looked = []
    cut_words = align.protein_words
    monkeypatch.setattr(align, "protein_words", lambda amino, k, *wanted: looked.append(int(wanted[0].sum()) if wanted and wanted[0] is not None else len(amino)) or cut_words(amino, k, *wanted))
    held = align.References.of(spark.createDataFrame([(a, b, protein(b)) for a, b in refs], "ref_id string, seq string, protein string").toArrow(), 5)
    block = align.Block.of_genomes([align.as_bytes(seq) for _, seq in genomes[:20]])
    looked.clear()
    align._pairs_of(block, held, 5, False, 0.7, "six", align._known(held, 5))
    assert len(looked) == 2 and sum(looked) < len(block.of) / 10
