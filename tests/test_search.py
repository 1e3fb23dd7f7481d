"""The search against every pair laid side by side on every diagonal."""

import random

import numpy as np
from pyspark.sql import functions as F

from thylakoid.operators import align
from thylakoid.plans import annotate

rng = random.Random(5)
K = 8


def made(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def mutated(s, places):
    return "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i in places else c for i, c in enumerate(s))


def grow(a, b, at, way, drop):
    """How many letters beyond a seed lie in the best extension, one letter after the other."""
    score = best = kept = n = 0
    while 0 <= at < len(a):
        score += 1 if a[at] == b[at] and a[at] in "ACGT" else -2
        n += 1
        at += way
        if best - score > drop:
            break
        if score > best:
            best, kept = score, n
    return kept


def plain_hits(query, subject, k=K, drop=align.DROP):
    found = set()
    for d in range(-len(subject) + 1, len(query)):
        low, high = max(0, d), min(len(query), len(subject) + d)
        a, b = query[low:high], subject[low - d : high - d]
        spans, i = [], 0
        while i < len(a):
            j = i
            while j < len(a) and a[j] == b[j] and a[j] in "ACGT":
                j += 1
            if j - i >= k:
                spans.append((i - grow(a, b, i - 1, -1, drop), j - 1 + grow(a, b, j, 1, drop)))
            i = max(j, i + 1)
        cover = set()
        for x, y in spans:
            cover |= set(range(x, y + 1))
        for x in sorted(cover):
            if x - 1 not in cover or not any(s <= x - 1 and x <= e for s, e in spans):
                y = x
                while y + 1 in cover and any(s <= y and y + 1 <= e for s, e in spans):
                    y += 1
                off = sum(a[t] != b[t] or a[t] not in "ACGT" for t in range(x, y + 1))
                found.add((low + x, low + y, low + x - d, low + y - d, off))
    return found


def test_hits_against_all_diagonals(spark):
    refs = {"r0": made(60), "r1": made(45), "r2": "", "r3": "ACGT" * 8, "r4": None}
    queries = {
        "q0": made(50) + mutated(refs["r0"], {10, 31}) + made(40), "q1": back(mutated(refs["r1"], {20})) + made(30) + refs["r0"][:12], "q2": "", "q3": None, "q4": made(200), "q5": refs["r1"].replace("A", "N", 1) + "ACGTACGTACGTNACGT",
        "q6": refs["r0"] + refs["r0"] + back(refs["r0"]),
    }
    got = align.search(spark.createDataFrame(list(queries.items()), "qseqid string, seq string"), spark.createDataFrame(list(refs.items()), "ref_id string, seq string"), K, 1e9).collect()
    want = set()
    for q, query in queries.items():
        for r, ref in refs.items():
            if query and ref:
                want |= {(q, r, x + 1, y + 1, s + 1, e + 1, off) for x, y, s, e, off in plain_hits(query, ref)}
                want |= {(q, r, x + 1, y + 1, len(ref) - s, len(ref) - e, off) for x, y, s, e, off in plain_hits(query, back(ref))}
    assert {(h.qseqid, h.sseqid, h.qstart, h.qend, h.sstart, h.send, h.mismatch) for h in got} == want and len(got) == len(want)
    assert any(h.mismatch == 2 and h.length == 60 for h in got)
    for h in got:
        assert h.pident == 100 * (h.length - h.mismatch) / h.length
        assert np.isclose(h.evalue, 0.621 * len(queries[h.qseqid]) * len(refs[h.sseqid]) * np.exp(-1.33 * (h.length - 3 * h.mismatch)))
    few = align.search(spark.createDataFrame(list(queries.items()), "qseqid string, seq string"), spark.createDataFrame(list(refs.items()), "ref_id string, seq string"), K, 1e-9).collect()
    assert {tuple(h) for h in few} == {tuple(h) for h in got if h.evalue <= 1e-9}


def test_empty_tables(spark):
    some = spark.createDataFrame([("a", made(100))], "qseqid string, seq string")
    refs = some.withColumnRenamed("qseqid", "ref_id")
    assert align.search(some.limit(0), refs).count() == 0 and align.search(some, refs.limit(0)).count() == 0 and align.search(some, refs).count() == 1


def test_a_diverged_rna_is_annotated(spark):
    trna = "GGGCGAATAGCTCAGTTGGTAGAGCACGCCCTTGATAAGGGCGTGAGGTCACAGGTTCAAGTCCTGTCTCGCCCACCA"
    genome = made(300) + back(mutated(trna, {25, 52})) + made(200)
    genomes = spark.createDataFrame([(1, genome)], "genome_id long, seq string")
    refs = spark.createDataFrame([("trnI-GAUXXX1", "trnI-GAU", 1, "tRNA", trna)], "ref_id string, feature string, guide_no int, class string, seq string")
    found = {(r.name, r.start, r.end, r.strand) for r in annotate.annotate(genomes, refs).filter(F.col("name").startswith("trn") & ~F.contains("name", F.lit("~"))).collect()}
    assert found == {("trnI-GAU", 301, 300 + len(trna), "-")}
