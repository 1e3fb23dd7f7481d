"""The inverted repeat of a circular genome and the regions that it bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 20
_COMPLEMENT = str.maketrans("ATCGatcg", "TAGCtagc")


def _packed(seq: str, rc: str, seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Each run of ``seed`` letters of both strands as a number; None if so many letters are in use that it wouldn't fit."""
    letters, digit = np.unique(np.frombuffer((seq + rc).encode("utf-32-le"), dtype=np.uint32), return_inverse=True)
    bits = max(1, (len(letters) - 1).bit_length())
    if bits * seed > 62:
        return None
    word = np.zeros(len(digit) - seed + 1, dtype=np.int64)
    for i in range(seed):
        word = (word << bits) | digit[i : i + len(word)]
    n = len(seq) - seed + 1
    return word[:n], word[len(seq) : len(seq) + n]


def _walk(seq: str, rc: str, start: int, seed: int, stride: int = 4096) -> int:
    """How many steps on from ``start`` the next ``seed`` letters lie on the other strand."""
    words = _packed(seq, rc, seed)
    if words is None:
        places, at = {rc[i : i + seed] for i in range(len(seq) - seed + 1)}, start
        while at + seed < len(seq) and seq[at + 1 : at + 1 + seed] in places:
            at += 1
        return at - start
    ahead, places = words[0][start + 1 :], np.sort(words[1])
    for lo in range(0, len(ahead), stride):
        part = ahead[lo : lo + stride]
        held = places[np.minimum(np.searchsorted(places, part), len(places) - 1)] == part
        if not held.all():
            return lo + int(held.argmin())
    return len(ahead)


def inverted_repeat(seq: str, seed: int = SEED) -> list[tuple[str, int, int]]:
    """Regions (name, start, end), 1-based, of one genome.

    The complement of the last ``seed`` bases begins the first repeat (IRB).  It is walked as long
    as the complement of the next ``seed`` bases occurs in the genome; complemented, the last such
    place begins the second repeat (IRA).  A genome without the repeat, or where the places are out
    of order, has FULL only.
    """
    full = ("FULL", 1, len(seq))
    rc = seq[::-1].translate(_COMPLEMENT)
    start = seq.find(rc[:seed]) if len(seq) >= 2 * seed else -1
    if start < 0:
        return [full]
    at = start + _walk(seq, rc, start, seed)
    second = seq.find(seq[at : at + seed][::-1].translate(_COMPLEMENT))
    if second < at + seed:
        return [full]
    return [("LSC", 1, start), ("IRB", start + 1, at + seed), ("SSC", at + seed + 1, second), ("IRA", second + 1, len(seq)), full]


def find_regions(genomes: DataFrame) -> DataFrame:
    """``genome_id``, ``name``, ``start``, ``end``, ``strand`` of the regions of each genome.

    A region that is empty is left out.  One genome is one row to one task: the walk looks up
    packed words of the complement, sorted once.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(g, *r, "+") for g, s in zip(part["genome_id"], part["seq"], strict=True) if s for r in inverted_repeat(s) if r[1] <= r[2]]
            yield pd.DataFrame(rows, columns=["genome_id", "name", "start", "end", "strand"])

    kind = genomes.schema["genome_id"].dataType.simpleString()
    return genomes.select("genome_id", F.coalesce("seq", F.lit("")).alias("seq")).mapInPandas(run, f"genome_id {kind}, name string, start int, end int, strand string")
