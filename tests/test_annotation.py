"""The whole annotation over genomes with planted genes: what was planted is found in its place, and the table has no holes."""

import random

from thylakoid.functions.sequence import code
from thylakoid.plans import annotate

rng = random.Random(13)
SENSE = [c for c, a in code().items() if a != "_" and "N" not in c]
REFS = "ref_id string, feature string, guide_no int, class string, seq string"


def made(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def gene(n):
    return "ATG" + "".join(rng.choice(SENSE) for _ in range(n)) + "TAA"


def edited(s, n):
    out = list(s)
    for i in rng.sample(range(20, len(s) - 20), n):
        out[i] = {"A": "G", "G": "A", "C": "T", "T": "C"}[out[i]]
    return "".join(out)


GENES = {"psbA": gene(70), "rbcL": gene(90), "atpB": gene(60)}
RNAS = {"trnI-GAU": made(76), "trnV-GAC": made(72), "rrn16": made(300)}
REFERENCES = [(f"{n}XXX1", n, 1, "gene", s) for n, s in GENES.items()] + [(f"{n}XXX1", n, 1, "rRNA" if n.startswith("rrn") else "tRNA", s) for n, s in RNAS.items()]
# a diverged copy of a reference of a second guide scores below the exact one
REFERENCES += [("psbAXXX2", "psbA", 2, "gene", "".join(rng.choice("ACGT") if rng.random() < 0.2 else c for c in GENES["psbA"])), ("rrn16XXX2", "rrn16", 2, "rRNA", edited(RNAS["rrn16"], 30))]


def planted(names):
    """A genome with these features, complemented where the name has a minus, and where each lies (1-based)."""
    text, found = "TAACTAGTTAG" + made(150), set()
    for name in names:
        bare = name.lstrip("-")
        body = GENES.get(bare) or edited(RNAS[bare], 1 if len(RNAS[bare]) < 200 else 4)
        body = back(body) if name.startswith("-") else body
        text += "TAACTAGTTAGTTAACTAACTAG"  # stops in all frames of both strands
        found.add((bare, len(text) + 1, len(text) + len(body), "-" if name.startswith("-") else "+"))
        text += body + "CTAGCTAACTAATTAGTTAGCTA" + made(rng.randrange(40, 200))
    return text, found


def test_planted_features_are_annotated(spark):
    layouts = [["psbA", "trnI-GAU", "-rbcL", "rrn16"], ["-trnV-GAC", "atpB", "-psbA"], ["-rrn16", "rbcL", "trnV-GAC", "-atpB", "-trnI-GAU"], []]
    genomes = [(i, *planted(names)) for i, names in enumerate(layouts)]
    table = spark.createDataFrame([(i, text) for i, text, _ in genomes] + [(9, ""), (10, None)], "genome_id long, seq string")
    rows = annotate.annotate(table, spark.createDataFrame(REFERENCES, REFS)).collect()
    names = set(GENES) | set(RNAS)
    for i, text, want in genomes:
        mine = [r for r in rows if r.genome_id == i]
        assert {(r.name, r.start, r.end, r.strand) for r in mine if r.name in names} >= want, i
        assert [(r.start, r.end) for r in mine if r.name == "FULL"] == [(1, len(text))]
        covered = set()
        for r in mine:
            if r.sort_key == 0:
                assert 1 <= r.start <= r.end <= len(text)
                covered |= set(range(r.start, r.end + 1))
        assert not want or covered == set(range(1, len(text) + 1))
        spans = [(r.start, r.end) for r in mine if r.sort_key == 0 and "~" not in r.name]
        assert len(spans) == len(set(spans)) and not any(a <= x and y <= b and (a, b) != (x, y) for a, b in spans for x, y in spans)
    assert not [r for r in rows if r.genome_id in (9, 10) and r.name in names]


def test_tables_of_an_external_search_are_taken(spark):
    text, want = planted(["psbA", "trnI-GAU"])
    genomes = spark.createDataFrame([(1, text)], "genome_id long, seq string")
    refs = spark.createDataFrame(REFERENCES, REFS)
    place = {n: (a, b) for n, a, b, _ in want}
    hits = [("1", "trnI-GAUXXX1", 98.7, 76, 1, 0, *place["trnI-GAU"], 1, 76, 1e-30, 130.0, 1)]
    schema = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, line_no long"
    from thylakoid.operators import orf

    frame = next(r for r in orf.find_orfs(genomes).collect() if (r.start0 + 1, r.end0 + 1) == place["psbA"] or (r.strand == "+" and r.start0 < place["psbA"][0] <= r.end0 and r.end0 + 1 == place["psbA"][1]))
    pairs = spark.createDataFrame([(f"1:{frame.orf_id}", "psbAXXX1"), (f"1:{frame.orf_id}", "psbAXXX2")], "qseqid string, sseqid string")
    rows = annotate.annotate(genomes, refs, rna_hits=spark.createDataFrame(hits, schema), pairs=pairs).collect()
    assert {(r.name, r.start, r.end, r.strand) for r in rows if r.name in ("psbA", "trnI-GAU")} == want
