"""Open reading frames in six frames, without a shuffle.

Each genome is one row; its codons are looked up at once, and runs lie between stops and unknown
codons.  Only runs that are long enough leave the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.functions.sequence import COMPLEMENT, STOP, UNKNOWN, amino_acids, as_bytes
from thylakoid.operators.features import sliced

#: An open reading frame has more nucleotides than this, its stop included.
MORE_THAN = 18
#: Rows that a task gathers before it lets go of them.
ROWS_OUT = 100_000


def runs(letters: np.ndarray, longer: int, compat: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frame, start and end (0-based, inclusive) of the runs of one strand, by frame and start."""
    every = amino_acids(letters)
    width = -(-len(every) // 3) + 1
    rows = np.full((3, width), ord(UNKNOWN), dtype=np.uint8)  # a frame each, with what is in no run behind it
    for frame in range(3):
        rows[frame, : len(every[frame::3])] = every[frame::3]
    amino = rows.ravel()
    coding = np.concatenate([[False], (amino != ord(STOP)) & (amino != ord(UNKNOWN))])
    edge = np.flatnonzero(coding[1:] != coding[:-1])
    first, last = edge[0::2], edge[1::2]  # last: after the run
    until = last + (amino[last] == ord(STOP))
    kept = (until - first) * 3 > longer
    if compat and (len(letters) - 2) % 3 != 2:
        kept &= last < 2 * width + len(every[2::3])
    first, until = first[kept], until[kept]
    frame = first // width
    return tuple(x.astype(np.int32) for x in (frame, (first - frame * width) * 3 + frame, (until - frame * width) * 3 + frame - 1))


def find_orfs(genomes: DataFrame, longer: int = MORE_THAN, compat: bool = False, sequences: bool = False, by_id: bool = False) -> DataFrame:
    """``genome_id``, ``orf_id``, ``strand``, ``frame``, ``start0``, ``end0``, ``nt`` of ``genomes`` (genome_id, seq), with ``seq`` if ``sequences``.

    A run of coding codons needs no start codon and takes the stop that ends it along; a codon
    that isn't in the code ends it too.  Runs are numbered by frame and start for each strand;
    those of the reverse strand get ``-r`` and forward coordinates, and keep the frame of their
    own strand; their ``seq`` is the forward slice as well.  ``compat`` drops a run that is still
    open at the end of frame 2.  With ``by_id`` a genome's rows come in order of their ids as text.
    """
    kind = genomes.schema["genome_id"].dataType.simpleString()
    names = ["genome_id", "orf_id", "strand", "frame", "start0", "end0", "nt", *(["seq"] if sequences else [])]

    def rows(batch: pa.RecordBatch, row: list, cells: list[list], seqs: list[str]) -> pa.RecordBatch:
        texts = [pa.array([x for part in c for x in part], pa.string()) for c in cells[:2]]
        numbers = [pa.array(np.concatenate(c).astype(np.int32)) for c in cells[2:]]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(row))), *texts, *numbers, *([pa.array(seqs, pa.string())] if sequences else [])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cells, seqs, waiting = [], [[] for _ in range(6)], [], 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                letters = as_bytes(text)
                if len(letters) < 3:
                    continue
                sides = []
                for strand, side in (("+", letters), ("-", COMPLEMENT[letters[::-1]])):
                    frame, start, end = runs(side, longer, compat)
                    mark = "-r" if strand == "-" else ""
                    low, high = (len(letters) - 1 - end, len(letters) - 1 - start) if mark else (start, end)
                    sides.append(([f"orf{n}{mark}" for n in range(1, len(frame) + 1)], [strand] * len(frame), frame, low, high, end - start + 1))
                if by_id:
                    ids, strands = ([*x, *y] for x, y in zip(sides[0][:2], sides[1][:2], strict=True))
                    order = sorted(range(len(ids)), key=ids.__getitem__)
                    sides = [([ids[j] for j in order], [strands[j] for j in order], *[np.concatenate(x)[np.array(order, dtype=np.int64)] for x in zip(sides[0][2:], sides[1][2:], strict=True)])]
                for side in sides:
                    row.append(np.full(len(side[0]), i))
                    for cell, value in zip(cells, side, strict=True):
                        cell.append(value)
                    if sequences:
                        seqs += [text[a : b + 1] for a, b in zip(side[3].tolist(), side[4].tolist(), strict=True)]
                    waiting += len(side[0])
                if waiting > ROWS_OUT:
                    yield rows(batch, row, cells, seqs)
                    row, cells, seqs, waiting = [], [[] for _ in range(6)], [], 0
            if row:
                yield rows(batch, row, cells, seqs)

    schema = f"genome_id {kind}, orf_id string, strand string, frame int, start0 int, end0 int, nt int" + (", seq string" if sequences else "")
    return genomes.select("genome_id", "seq").mapInArrow(run, schema)


def orf_sequences(orfs: DataFrame, genomes: DataFrame) -> DataFrame:
    """``orfs`` with ``seq``: the forward slice, for reverse ones as well.  Frames just found have it from ``find_orfs``."""
    return sliced(orfs, genomes, "genome_id", F.col("start0") + 1, F.col("end0") + 1)


def orf_summary(orfs: DataFrame) -> DataFrame:
    """Number of open reading frames and the longest of each genome and strand."""
    return orfs.groupBy("genome_id", "strand").agg(F.count(F.lit(1)).alias("n_orfs"), F.max("nt").alias("longest"), F.sum("nt").cast("long").alias("total_nt"))


def nested_filter(orfs: DataFrame, max_cover: float | None = None) -> DataFrame:
    """Drop frames that longer ones of the genome cover to ``max_cover`` or more; None keeps all.

    What covers a frame is the union of the longer frames that overlap it (ties: by orf_id), and
    the fraction is of end minus start.  A genome's frames are read longest first, and the places
    that they cover are marked, so no pairs are made.
    """
    if max_cover is None:
        return orfs
    names = orfs.columns
    genome, low, high = (names.index(c) for c in ("genome_id", "start0", "end0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, bytearray()  # the places that the genome's longer frames cover
        for batch in batches:
            kept = []
            for g, a, b in zip(*(batch.column(c).to_pylist() for c in (genome, low, high)), strict=True):
                if g is None:
                    kept.append(True)
                    continue
                if g != of:
                    of, held = g, bytearray()
                if len(held) <= b:
                    held.extend(bytes(b + 1 - len(held)))
                kept.append(held.count(1, a, b + 1) / max(b - a, 1) < max_cover)
                held[a : b + 1] = b"\1" * (b + 1 - a)
            yield batch.filter(pa.array(kept, pa.bool_()))

    rows = orfs.repartition("genome_id").sortWithinPartitions("genome_id", F.desc("nt"), "orf_id")
    return rows.mapInArrow(run, orfs.schema)
