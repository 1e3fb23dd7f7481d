"""Nucleotide and protein expressions over columns.

All but translation and exact search are Catalyst expressions.  Positions in arguments and results are 0-based, as in open reading
frames; Spark's own 1-based positions stay inside.  Long sequences are cut once by a regular
expression instead of by repeated ``substring``, which would walk from the start each time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amino acids of the standard code for codons in the order TTT, TTC, TTA, TTG, TCT ... GGG; a stop is ``_``.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY__CC_WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Codons with an unknown third base that are read as one amino acid.
FOURFOLD = {"ACN": "T", "CCN": "P", "CGN": "R", "GCN": "A", "GGN": "G", "GTN": "V", "TCN": "S"}
STOP, UNKNOWN = "_", "X"


def revcomp(seq: Column) -> Column:
    """Reverse complement; letters other than ACGTacgt stay as they are."""
    return F.reverse(F.translate(seq, "ATCGatcg", "TAGCtagc"))


def code() -> dict[str, str]:
    """Amino acid of each codon."""
    at = [(a, b, c) for a in range(4) for b in range(4) for c in range(4)]
    return {BASES[a] + BASES[b] + BASES[c]: AMINO_ACIDS[16 * a + 4 * b + c] for a, b, c in at} | FOURFOLD


DIGIT = np.full(256, 5, dtype=np.uint8)
DIGIT[list(b"TCAGN")] = np.arange(5)
#: Amino acid of each codon of three digits, the first of weight 36.
CODON = np.full(216, ord(UNKNOWN), dtype=np.uint8)
for _codon, _amino in code().items():
    CODON[DIGIT[list(_codon.encode())].astype(np.int64) @ np.array([36, 6, 1])] = ord(_amino)
#: What complements each byte.
COMPLEMENT = np.arange(256, dtype=np.uint8)
COMPLEMENT[list(b"ATCGatcg")] = list(b"TAGCtagc")


def as_bytes(text: str | None) -> np.ndarray:
    """Letters of a sequence as bytes, one each; others than ASCII are unknown."""
    return np.frombuffer((text or "").encode("ascii", "replace"), dtype=np.uint8)


def amino_acids(letters: np.ndarray) -> np.ndarray:
    """Amino acid (as a byte) of the codon at each place, of all three frames in turn."""
    d = DIGIT[letters]
    return CODON[36 * d[:-2] + 6 * d[1:-1] + d[2:]]  # 215 at most, so bytes do


def translate_dna(seq: Column, frame: int = 0) -> Column:
    """Protein of one frame; unknown codons give ``X``; null if there is no whole codon.

    An Arrow-backed function that looks up all codons of a sequence at once.  As expressions, a
    lambda for each codon took some hundred times longer, and a chain of 71 replacements was slow
    to plan.
    """

    def one(text: str | None) -> str | None:
        return amino_acids(as_bytes(text))[frame::3].tobytes().decode() if text is not None and len(text) >= frame + 3 else None

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([one(t) for t in texts.to_pylist()], pa.string())

    return run(seq)


def six_frames(seq: Column) -> Column:
    """Proteins of offsets 0, 1, 2 of the sequence and then of its reverse complement."""
    back = revcomp(seq)
    return F.array(*[translate_dna(s, k) for s in (seq, back) for k in range(3)])


def pieces(seq: Column, spans: Column) -> Column:
    """The pieces of a sequence at an array of (start, end), 1-based and inclusive; a start before 1 is 1, a null span null.

    An Arrow-backed function: each ``substring`` would walk the sequence from the start.
    """

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([[None if t is None or x is None else t[max(x["start"], 1) - 1 : max(x["end"], 0)] for x in xs] for t, xs in zip(texts, spans, strict=True)])

    return run(seq, spans)


def index_of(text: Column, part: Column, start: Column | int = 0) -> Column:
    """First 0-based position of ``part`` at or after ``start``; -1 if there is none or ``part`` is empty."""
    start = F.greatest(F.lit(0), start if isinstance(start, Column) else F.lit(start))
    rest = F.substring(text, start + 1, F.length(text))
    at = F.call_function("instr", rest, part)
    return F.when((at > 0) & (F.length(part) > 0), at - 1 + start).otherwise(-1)


def find_all(text: Column, part: Column, zero: bool = True) -> Column:
    """All 0-based positions of ``part``, overlapping ones as well; without position 0 if not ``zero``.

    An Arrow-backed function: as an expression each position would cost a walk from the start.
    """

    def places(text: str | None, part: str | None) -> list[int]:
        found, at = [], (text or "").find(part) if part else -1
        while at >= 0:
            found.append(at)
            at = text.find(part, at + 1)
        return found if zero or found[:1] != [0] else found[1:]

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([places(t, p) for t, p in zip(texts, parts, strict=True)])

    return run(text, part)


def reference_frame(seq: Column, compat: bool = False) -> Column:
    """Frame (0, 1, 2) in which a reference is read.

    The frame with the longest stretch before a stop, a stop-free one before all others, the
    first of equals.  ``compat``: frame 0 if it has no stop; else the last of frames 1 and 2
    whose first stop comes after that of frame 0.
    """
    at = [F.call_function("instr", F.coalesce(translate_dna(seq, k), F.lit("")), F.lit(STOP)) - 1 for k in range(3)]
    if compat:
        return F.when(at[0] == -1, 0).when(at[2] > at[0], 2).when(at[1] > at[0], 1).otherwise(0)
    free = [F.when(a == -1, F.length(seq) + F.lit(1)).otherwise(a) for a in at]
    return F.when((free[0] >= free[1]) & (free[0] >= free[2]), 0).when(free[1] >= free[2], 1).otherwise(2)


def frame_protein(seq: Column, compat: bool = False) -> Column:
    """Protein of the reference frame."""
    frame = reference_frame(seq, compat)
    return F.when(frame == 0, translate_dna(seq)).when(frame == 1, translate_dna(seq, 1)).otherwise(translate_dna(seq, 2))


def windows(text: str, width: int, step: int) -> list[str]:
    """Windows of ``width`` at 0, ``step``, 2 ``step`` ... that lie within the text."""
    return [text[i : i + width] for i in range(0, len(text) - width + 1, step)]


def _found(texts: Column, other: Column, width: int, step: int) -> Column:
    """Of each of an array of texts, how many of its windows occur in ``other``; null for a null.

    An Arrow-backed function: the words of a text that many others are compared with are made into
    a set once in a batch.  As expressions each window cost a walk from the start and a search.
    """

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series, others: pd.Series) -> pd.Series:
        known: dict[str, set[str]] = {}
        out = []
        for row, other in zip(texts, others, strict=True):
            if row is None or other is None:
                out.append(None)
                continue
            if other not in known:
                known[other] = set(windows(other, width, 1))
            words = known[other]
            out.append([None if t is None else sum(w in words for w in windows(t, width, step)) for t in row])
        return pd.Series(out)

    return run(texts, other)


def kmer_scores(orfs: Column, ref: Column) -> Column:
    """Of each of an array of proteins its overlapping 3-residue windows found in ``ref``, by the length of ``ref``; may exceed 1; null if ``ref`` is empty."""
    return F.when(F.length(ref) > 0, F.transform(_found(orfs, ref, 3, 1), lambda n: n.cast("double") / F.length(ref)))


def kmer_scores_legacy(orfs: Column, ref: Column) -> Column:
    """Of each of an array of proteins the part of its non-overlapping 3-residue windows found in ``ref``, times the ratio of lengths."""
    several = F.transform(orfs, lambda o: F.floor(F.length(o) / 3))
    score = F.zip_with(F.arrays_zip(_found(orfs, ref, 3, 3).alias("n"), several.alias("m")), orfs, lambda x, o: F.when(x["m"] > 0, x["n"].cast("double") / x["m"] * (F.length(o).cast("double") / F.length(ref))))
    return F.when(F.length(ref) > 0, score)


def kmer_score(orf: Column, ref: Column) -> Column:
    """``kmer_scores`` of one protein."""
    return kmer_scores(F.array(orf), ref)[0]


def kmer_score_legacy(orf: Column, ref: Column) -> Column:
    """``kmer_scores_legacy`` of one protein."""
    return kmer_scores_legacy(F.array(orf), ref)[0]


def kmer_score_rna(query: Column, ref: Column) -> Column:
    """Part of the non-overlapping 6-base windows of ``ref`` found in ``query``; null if there is none."""
    return F.when(F.length(ref) >= 6, _found(F.array(ref), query, 6, 6)[0].cast("double") / F.floor(F.length(ref) / 6))


def best_frames(gene: Column, proteins: Column) -> Column:
    """Struct (fwd, fwd_frame, rev, rev_frame): how much of the gene's 3-residue windows each of six proteins holds, the lower frame of equals."""
    held = lambda i: _found(F.array(gene), F.coalesce(F.get(proteins, i), F.lit("")), 3, 3)[0]
    scores = F.array(*[F.when(F.length(gene) >= 3, held(i).cast("double") / F.floor(F.length(gene) / 3)) for i in range(6)])
    side = lambda a: F.slice(scores, a, 3)
    top = lambda a: F.array_max(side(a))
    return F.struct(
        top(1).alias("fwd"), (F.array_position(side(1), top(1)) - 1).cast("int").alias("fwd_frame"), top(4).alias("rev"), (F.array_position(side(4), top(4)) - 1).cast("int").alias("rev_frame")
    )


def _last_at(seq: Column, part: Column, below: Column) -> Column:
    """Last 0-based position of a 3-base ``part`` below a bound, else -1."""
    most = F.least(below, F.length(seq) - 2)
    places = F.when((most > 0) & (F.length(part) == 3), F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.array_max(F.filter(places, lambda i: F.substring(seq, i + 1, F.lit(3)) == part)), F.lit(-1))


def match_start(seq: Column, nearstart: Column) -> Column:
    """Last ATG, in any frame, before three times ``nearstart``; else -1."""
    return _last_at(seq, F.lit("ATG"), nearstart * 3)


def alt_start(seq: Column, nearstart: Column, gene: Column) -> Column:
    """Last copy of the gene's own first codon up to three times ``nearstart``; else -1."""
    return _last_at(seq, F.substring(gene, 1, 3), nearstart * 3 + 1)


# --- identifiers ---


def ref_id(feature: Column, guide: Column) -> Column:
    return F.concat(feature, F.lit("XXX"), guide.cast("string"))


def strip_guide(ref: Column) -> Column:
    """What stands before the first ``XXX``; the whole if there is none."""
    return F.substring_index(ref, "XXX", 1)


def exon_gene(name: Column) -> Column:
    """Gene of an exon's name, or null."""
    found = F.regexp_extract(name, r"^(.+)_exon\d+", 1)
    return F.when(found != "", found)


def exon_number(name: Column) -> Column:
    """Number of an exon's name, or null."""
    found = F.regexp_extract(name, r"_exon(\d+)", 1)
    return F.when(found != "", found.cast("int"))


def feature_class(name: Column) -> Column:
    """``tRNA``, ``rRNA`` or ``gene``."""
    return F.when(F.contains(name, F.lit("trn")), "tRNA").when(F.contains(name, F.lit("rrn")), "rRNA").otherwise("gene")


def hit_strand(qstart: Column, qend: Column, sstart: Column, send: Column) -> Column:
    """``+`` if query and subject run the same way; equal ends count as ``-``."""
    return F.when(((qend > qstart) & (send > sstart)) | ((qend < qstart) & (send < sstart)), "+").otherwise("-")
