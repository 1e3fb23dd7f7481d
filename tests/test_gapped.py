"""The search with gaps against the full matrix."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thylakoid.operators import gapped
from thylakoid.plans import annotate

rng = random.Random(17)


def made(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def edited(s, rate, gaps):
    """Other bases at ``rate``, and ``gaps`` places where one to four bases are put in or left out."""
    out = [rng.choice("ACGT") if rng.random() < rate else c for c in s]
    for i in sorted(rng.sample(range(25, len(s) - 25), gaps), reverse=True):
        n = rng.randrange(1, 5)
        out[i : i + rng.choice([0, n])] = [] if rng.random() < 0.5 else list(made(n))
    return "".join(out)


def full(query, subject):
    """Best local score with affine gaps, cell by cell."""
    nothing = -(10**9)
    n, best = len(query), 0
    above, down = [0] * (n + 1), [nothing] * (n + 1)
    for s in subject:
        row, flat = [0] * (n + 1), nothing
        for j in range(1, n + 1):
            down[j] = max(above[j] - gapped.OPEN, down[j]) - gapped.EXTEND
            flat = max(row[j - 1] - gapped.OPEN, flat) - gapped.EXTEND
            row[j] = max(0, above[j - 1] + (gapped.MATCH if s == query[j - 1] and s in "ACGT" else gapped.MISMATCH), down[j], flat)
            best = max(best, row[j])
        above = row
    return best


def codes(s):
    return gapped.CODE[np.frombuffer(s.encode(), dtype=np.uint8)]


def test_bands_that_hold_the_matrix_give_its_score():
    pairs = []
    for _ in range(60):
        a, b = made(rng.randrange(1, 40)), made(rng.randrange(1, 30))
        pairs.append((a, b + a[5:12] + made(2) + a[12:22] if rng.random() < 0.5 else b))
    sizes = np.array([(len(a), len(b)) for a, b in pairs])
    begins = np.cumsum(sizes, axis=0) - sizes
    bands = gapped.Bands(begins[:, 0], sizes[:, 0], begins[:, 1], sizes[:, 1], -sizes[:, 1], sizes.sum(axis=1))
    found = gapped.align_bands(codes("".join(a for a, _ in pairs)), codes("".join(b for _, b in pairs)), bands, np.zeros(60))
    assert any(f and f[7] for f in found)
    for (a, b), fit in zip(pairs, found, strict=True):
        score, q0, q1, s0, s1, columns, same, gaps = fit or (0,) * 8
        assert score == full(a, b)
        if score:
            alone = 2 * columns - (q1 - q0 + 1) - (s1 - s0 + 1)
            assert score == gapped.MATCH * same + gapped.MISMATCH * (columns - same - alone) - gapped.OPEN * gaps - gapped.EXTEND * alone
            assert full(a[q0 : q1 + 1], b[s0 : s1 + 1]) == score


@pytest.mark.parametrize("limit", [10**6, 700])
def test_planted_copies_have_the_full_score(spark, limit):
    refs = {f"r{i}": made(n) for i, n in enumerate((90, 160, 240))} | {"e": "", "z": None, "n": "ACGTN" * 4}
    genomes, planted = {}, {}
    for g in range(24):
        ref, turned = f"r{g % 3}", g % 2
        copy = edited(refs[ref], 0.05, g % 4)
        genomes[g] = made(rng.randrange(0, 150)) + (back(copy) if turned else copy) + made(rng.randrange(0, 150))
        planted[g] = (ref, turned)
    genomes |= {50: "", 51: None, 52: made(2000), 53: refs["r0"] + made(50) + refs["r0"]}
    table = spark.createDataFrame(list(genomes.items()), "qseqid long, seq string").repartition(3)
    hits = gapped.gapped_search(table, spark.createDataFrame(list(refs.items()), "ref_id string, seq string"), limit=limit).collect()
    space = sum(len(r or "") for r in refs.values())
    best = {}
    for h in hits:
        score = gapped.MATCH * round(h.pident * h.length / 100)
        alone = 2 * h.length - (h.qend - h.qstart + 1) - (abs(h.send - h.sstart) + 1)
        score += gapped.MISMATCH * h.mismatch - gapped.OPEN * h.gapopen - gapped.EXTEND * alone
        assert np.isclose(h.evalue, gapped.K * len(genomes[h.qseqid]) * space * np.exp(-gapped.LAMBDA * score)) and h.evalue <= 0.1
        low, high = sorted((h.sstart, h.send))
        subject = refs[h.sseqid][low - 1 : high]
        assert full(genomes[h.qseqid][h.qstart - 1 : h.qend], back(subject) if h.sstart > h.send else subject) == score
        best[h.qseqid, h.sseqid, h.sstart > h.send] = max(score, best.get((h.qseqid, h.sseqid, h.sstart > h.send), 0))
    for g, (ref, turned) in planted.items():
        assert best[g, ref, bool(turned)] == full(genomes[g], back(refs[ref]) if turned else refs[ref])
    assert any(h.gapopen == 2 for h in hits) and {h.gapopen > 0 for h in hits} == {True, False}
    assert sum(h.qseqid == 53 and h.sseqid == "r0" for h in hits) == 2 and not [h for h in hits if h.qseqid in (50, 51)]


def test_an_rna_with_a_gap_is_annotated(spark):
    trna = "GGGCGAATAGCTCAGTTGGTAGAGCACGCCCTTGATAAGGGCGTGAGGTCACAGGTTCAAGTCCTGTCTCGCCCACCA"
    copy = trna[:30] + "T" + trna[30:]
    genomes = spark.createDataFrame([(1, made(300) + back(copy) + made(200))], "genome_id long, seq string")
    refs = spark.createDataFrame([("trnI-GAUXXX1", "trnI-GAU", 1, "tRNA", trna)], "ref_id string, feature string, guide_no int, class string, seq string")
    rows = annotate.annotate(genomes, refs).filter(F.col("name").startswith("trn") & ~F.contains("name", F.lit("~"))).collect()
    assert {(r.name, r.start, r.end, r.strand) for r in rows} == {("trnI-GAU", 301, 300 + len(copy), "-")}
