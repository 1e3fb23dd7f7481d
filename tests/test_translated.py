"""The translated search against every frame of every pair, laid side by side on every diagonal."""

import math
import random

import numpy as np
import pytest

from thylakoid import queries
from thylakoid.functions.sequence import code
from thylakoid.operators import orf, translated
from thylakoid.plans import annotate

rng = random.Random(11)
CODE = code()
SENSE = [c for c, a in CODE.items() if a != "_" and "N" not in c]
BY_RESIDUE = {}
for c in SENSE:
    BY_RESIDUE.setdefault(CODE[c], []).append(c)


def score(a, b):
    return int(translated.SCORES[translated.CODE[ord(a)], translated.CODE[ord(b)]])


def made(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def gene(n):
    return "ATG" + "".join(rng.choice(SENSE) for _ in range(n)) + "TAA"


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def diverged(dna, identity):
    """Another gene whose residues are the same at about that rate; others are like them rather than not."""
    out = []
    for i in range(0, len(dna), 3):
        a = CODE[dna[i : i + 3]]
        if a != "_" and rng.random() > identity:
            weights = [0 if b == a else math.exp(translated.LAMBDA * score(a, b)) for b in translated.RESIDUES]
            a = rng.choices(translated.RESIDUES, weights)[0]
        out.append(rng.choice(BY_RESIDUE[a]) if a != "_" else "TAA")
    return "".join(out)


def frames_of(seq):
    """(reversed, phase, protein, places of each residue's bases on the sequence)."""
    for turned, s in ((False, seq), (True, back(seq))):
        for phase in range(3):
            at = range(phase, len(s) - 2, 3)
            yield turned, phase, "".join(CODE.get(s[i : i + 3], "X") for i in at), [(len(s) - 1 - i, len(s) - 3 - i) if turned else (i, i + 2) for i in at]


def grow(q, s, i, j, way, drop):
    total = best = kept = k = 0
    while 0 <= i + way * (k + 1) < len(q) and 0 <= j + way * (k + 1) < len(s):
        k += 1
        total += score(q[i + way * k], s[j + way * k])
        if total > best:
            best, kept = total, k
        if best - total > drop:
            break
    return best, kept


def plain(query, subject, space, evalue, least, drop):
    """Hits of one frame's slice in one reference."""
    w, found = translated.WORD, []
    for _, _, q, at in frames_of(query):
        for _, _, s, to in frames_of(subject):
            for d in range(-len(s) + 1, len(q)):
                hits = [i for i in range(max(0, d), min(len(q), len(s) + d) - w + 1) if not set(q[i : i + w] + s[i - d : i - d + w]) & {"_", "X"} and sum(score(a, b) for a, b in zip(q[i : i + w], s[i - d : i - d + w], strict=True)) >= least]
                lane = []
                for i in hits:
                    if any(w <= i - h <= translated.WINDOW for h in hits):
                        left, l = grow(q, s, i, i - d, -1, drop)
                        right, r = grow(q, s, i + w - 1, i + w - 1 - d, 1, drop)
                        total = sum(score(a, b) for a, b in zip(q[i : i + w], s[i - d : i - d + w], strict=True)) + left + right
                        e = translated.K * (len(query) // 3) * space * math.exp(-translated.LAMBDA * total)
                        if e <= evalue:
                            lane.append((-total, i - l, i + w - 1 + r, e))
                taken = []
                for total, x, y, e in sorted(set(lane)):
                    if all(y < u or v < x for u, v in taken):
                        taken.append((x, y))
                        same = sum(a == b for a, b in zip(q[x : y + 1], s[x - d : y + 1 - d], strict=True))
                        found.append((y - x + 1, y - x + 1 - same, at[x][0] + 1, at[y][1] + 1, to[x - d][0] + 1, to[y - d][1] + 1, round(math.log10(e), 6), -total))
    return found


@pytest.mark.parametrize("limit", [10**6, 300])
def test_hits_against_all_diagonals(spark, limit):
    genes = [gene(n) for n in (14, 25, 40)]
    genomes = {1: made(40) + diverged(genes[0], 0.8) + made(30), 2: made(20) + back(diverged(genes[1], 0.7)) + made(25), 3: "", 4: None, 5: made(120), 6: diverged(genes[2], 0.6) + "NNN" + genes[0][9:45], 7: "ACGTNACGTAC"}
    refs = {"r0": genes[0], "r1": back(genes[1]) + "A", "r2": genes[2], "r3": "", "r4": None, "r5": "AC", None: genes[0][3:]}
    space, evalue, least = sum(len(r or "") // 3 for r in refs.values()), 0.5, 16
    table = spark.createDataFrame(list(genomes.items()), "genome_id long, seq string").repartition(2)
    got = translated.translated_search(table, spark.createDataFrame(list(refs.items()), "ref_id string, seq string"), evalue, least, limit=limit).collect()
    want = []
    for f in orf.find_orfs(table, sequences=True).collect():
        for name, ref in refs.items():
            want += [(f"{f.genome_id}:{f.orf_id}", name, *row[:-1]) for row in plain(f.seq, ref or "", space, evalue, least, translated.DROP)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((h.qseqid, h.sseqid, h.length, h.mismatch, h.qstart, h.qend, h.sstart, h.send, round(math.log10(h.evalue), 6)) for h in got), key=key) == sorted(want, key=key)
    assert {h.sseqid for h in got} == {"r0", "r1", "r2", None} and all(h.gapopen == 0 and h.pident == 100 * (h.length - h.mismatch) / h.length for h in got)
    assert any(h.qstart > h.qend for h in got) and any(h.sstart > h.send for h in got)


def test_diverged_genes_are_found(spark):
    genes = [gene(rng.choice([60, 100, 200])) for _ in range(12)]
    planted = [(i, made(60) + "TAA" + diverged(g, identity) + made(60)) for identity in (0.8, 0.7, 0.6) for i, g in enumerate(genes)]
    rows = [(k, text) for k, (_, text) in enumerate(planted)]
    hits = translated.translated_search(spark.createDataFrame(rows, "genome_id long, seq string"), spark.createDataFrame([(str(i), g) for i, g in enumerate(genes)], "ref_id string, seq string")).collect()
    found = {(int(h.qseqid.split(":")[0]), int(h.sseqid)) for h in hits}
    assert sum((k, i) in found for k, (i, _) in enumerate(planted)) >= 0.97 * len(planted)
    assert len(found) < 1.3 * len(planted)


def test_annotation_takes_its_pairs(spark):
    genes = {n: gene(60) for n in ("psbA", "rbcL")}
    genomes = spark.createDataFrame([(1, "TAACTAGTTAG" + made(60) + "TAACTAGTTAGTTAA" + genes["psbA"] + "CTAGCTAACTAA" + made(50) + back(genes["rbcL"]) + made(70))], "genome_id long, seq string")
    refs = spark.createDataFrame([(f"{n}XXX1", n, 1, "gene", s) for n, s in genes.items()], "ref_id string, feature string, guide_no int, class string, seq string")
    pairs = translated.translated_search(genomes, refs).select("qseqid", "sseqid").distinct()
    own, given = (sorted(map(tuple, annotate.annotate(genomes, refs, pairs=p).collect())) for p in (None, pairs))
    assert own == given and {r[1] for r in own} >= set(genes)


def test_the_matrix_is_symmetric():
    assert (translated.SCORES == translated.SCORES.T).all() and np.diag(translated.SCORES)[:20].min() == 4
    words, near = translated.neighbours(np.array([0, 12345]), 14)
    for i, w in enumerate((0, 12345)):
        letters = [w // 20**k % 20 for k in (3, 2, 1, 0)]
        want = {v for v in range(20**4) if sum(translated.SCORES[a, v // 20**k % 20] for a, k in zip(letters, (3, 2, 1, 0), strict=True)) >= 14}
        assert set(near[words == i].tolist()) == want


def test_pairs_search_once(spark, monkeypatch):
    refs = [(f"r{i}", f"r{i}", 1, "gene", gene(50)) for i in range(3)]
    genomes = [(i, made(60) + refs[i % 3][4] + made(40)) for i in range(9)]
    monkeypatch.setattr(queries.inputs, "genomes", lambda *_: spark.createDataFrame(genomes, "genome_id long, seq string").coalesce(1))
    monkeypatch.setattr(queries.inputs, "references", lambda *_: spark.createDataFrame(refs, "ref_id string, feature string, guide_no int, class string, seq string"))
    got = queries.translated_pairs(spark, "")
    assert "PythonMapInArrow" not in got._jdf.queryExecution().logical().toString() and "MapInArrow" not in got._jdf.queryExecution().logical().toString()
    found = {}
    for h in translated.translated_search(queries.inputs.genomes(), queries.inputs.references()).collect():
        if h.pident >= 0.5 and h.evalue <= 0.1:
            found.setdefault((h.qseqid, h.sseqid), []).append(set(range(min(h.sstart, h.send), max(h.sstart, h.send) + 1)))
    assert found and {(r.qseqid, r.sseqid): (r.n_hsps, r.covered) for r in got.collect()} == {k: (len(v), len(set().union(*v))) for k, v in found.items()}
