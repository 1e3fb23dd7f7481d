"""Exact search of many motifs at once: an automaton of all of them reads each genome once."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.functions.sequence import revcomp
from thylakoid.plans.cuts import cut

#: Letters of motifs that an automaton is made of at once; it takes some hundred bytes for each.
LETTERS = 500_000

_made: dict[int, object] = {}


def _automaton(motifs: tuple[str, ...]):
    """The automaton of some motifs (Aho and Corasick, 1975), made once in a process; a motif's value is its number."""
    import ahocorasick

    name = hash(motifs)
    if name not in _made:
        found = ahocorasick.Automaton()
        for i, motif in enumerate(motifs):
            found.add_word(motif, i)
        found.make_automaton()
        _made.clear()
        _made[name] = found
    return _made[name]


def places_of(text: str, motifs: tuple[str, ...]) -> dict[int, list[int]]:
    """By number of the motif its 0-based places in a text, in order, overlapping ones as well."""
    found: dict[int, list[int]] = {}
    for end, i in _automaton(motifs).iter(text):
        found.setdefault(i, []).append(end - len(motifs[i]) + 1)
    return found


def find_motifs(genomes: DataFrame, motifs: DataFrame, limit: int = LETTERS) -> DataFrame:
    """``genome_id``, ``motif`` and ``places`` (0-based, in order, overlapping ones as well) of each of ``motifs`` (motif) that a genome has.

    Motifs are told apart by their letters; null and empty ones are nowhere.  They go to the tasks in
    blocks of some ``limit`` letters, and each genome is read once for a block; nothing but the places
    leaves a task.  A motif longer than ``limit`` is a block's own.
    """
    kind = genomes.schema["genome_id"].dataType.simpleString()
    held = cut(motifs.filter("motif <> ''").select("motif").distinct())
    blocks = max(1, -(-(held.agg(F.sum(F.length("motif"))).first()[0] or 0) // max(1, limit)))

    def scan(block: tuple[str, ...]) -> DataFrame:
        shared = genomes.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, number, places = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for motif, at in sorted(places_of(text, shared.value).items()) if text and shared.value else ():
                        row.append(i)
                        number.append(motif)
                        places.append(at)
                ends = np.cumsum([0, *map(len, places)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*[np.array(p, dtype=np.int32) for p in places], np.zeros(0, dtype=np.int32)])))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array([shared.value[m] for m in number], pa.string()), lists], ["genome_id", "motif", "places"])

        return genomes.select("genome_id", "seq").mapInArrow(run, f"genome_id {kind}, motif string, places array<int>")

    parts = [tuple(sorted(r.motif for r in held.filter(F.pmod(F.xxhash64("motif"), F.lit(blocks)) == b).collect())) for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, [scan(p) for p in parts])


def both_strands(motifs: DataFrame) -> DataFrame:
    """``motifs`` (motif) and their complements."""
    return motifs.select("motif").unionByName(motifs.select(revcomp(F.col("motif")).alias("motif")))


def first_at(places, start: int):
    """The first of ordered ``places`` at or after ``start``, or -1."""
    return F.coalesce(F.array_min(F.filter(places, lambda p: p >= start)), F.lit(-1))
