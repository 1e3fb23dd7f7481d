"""A nucleotide search with gaps: seeds of ``SEED`` equal bases, ungapped extension, then alignment in a band.

Genomes are read once, in blocks, against both strands of the references.  A seed is extended along
its diagonal until the score falls ``DROP`` below its best; one that reaches ``TRIGGER`` is an anchor.
Anchors of a reference whose diagonals lie within ``BAND`` of each other are aligned together, with
affine gaps, by dynamic programming over the diagonals around them; the trace gives the gaps.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.functions.sequence import COMPLEMENT, as_bytes
from thylakoid.operators.align import SENT_WORDS
from thylakoid.operators.translated import extend
from thylakoid.plans.cuts import cut

#: Scores of equal and other bases, costs of a gap and of each base of it, and the parameters of such scores, with gaps and without.
MATCH, MISMATCH, OPEN, EXTEND = 2, -3, 5, 2
LAMBDA, K = 0.625, 0.41
PLAIN_LAMBDA, PLAIN_K = 0.634, 0.408
#: Bases of a seed, how far an ungapped score may fall, bits that make it an anchor, and diagonals between anchors, and beyond them.
SEED, DROP, TRIGGER, BAND = 11, 20, 27.0, 16
EVALUE = 0.1
#: Letters of genomes that are searched at once, and cells of bands that are laid out at once.
LETTERS, CELLS = 200_000, 2_000_000

_UNKNOWN, _WALL = 4, 5
CODE = np.full(256, _UNKNOWN, dtype=np.uint8)
CODE[list(b"ACGT")] = np.arange(4)
SCORES = np.full((6, 6), MISMATCH, dtype=np.int32)
SCORES[np.arange(4), np.arange(4)] = MATCH
SCORES[_WALL, :] = SCORES[:, _WALL] = -10000


def words(codes: np.ndarray, k: int) -> np.ndarray:
    """Each run of ``k`` bases as a number; -1 where one is not of ACGT."""
    n = max(0, len(codes) - k + 1)
    word, sound = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for i in range(k):
        word = word * 4 + codes[i : i + n]
        sound &= codes[i : i + n] < 4
    return np.where(sound, word, -1)


class Subjects(NamedTuple):
    """Both strands of references, a wall after each: where a stretch begins, its reference, strand and length; and places by word."""

    names: pa.Array
    codes: np.ndarray
    start: np.ndarray
    ref: np.ndarray
    back: np.ndarray
    size: np.ndarray
    known: np.ndarray
    first: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, refs: pa.Table, k: int) -> Subjects:
        parts, ref, back = [], [], []
        for i, seq in enumerate(refs.column(1).to_pylist()):
            letters = as_bytes(seq)
            for turned in (False, True):
                if len(letters):
                    parts += [CODE[COMPLEMENT[letters[::-1]] if turned else letters], np.full(1, _WALL, dtype=np.uint8)]
                    ref.append(i)
                    back.append(turned)
        codes = np.concatenate([np.zeros(0, dtype=np.uint8), *parts])
        size = np.array([len(p) for p in parts[::2]], dtype=np.int64)
        word = words(codes, k)
        places = np.flatnonzero(word >= 0)
        places = places[np.argsort(word[places], kind="stable")]
        known, first = np.unique(word[places], return_index=True)
        return cls(refs.column(0).combine_chunks(), codes, np.cumsum(size + 1) - size - 1, np.array(ref, dtype=np.int64), np.array(back, dtype=bool), size, known, np.append(first, len(places)), places)


class Bands(NamedTuple):
    """Of alignments: where the query and the subject begin among their codes and how long they are, and the lowest diagonal (query minus subject) and their number."""

    query: np.ndarray
    query_size: np.ndarray
    subject: np.ndarray
    size: np.ndarray
    low: np.ndarray
    width: np.ndarray

    def taken(self, which: np.ndarray) -> Bands:
        return Bands(*[x[which] for x in self])


_NOTHING = -(10**6)


def align_bands(queries: np.ndarray, subjects: np.ndarray, bands: Bands, least: np.ndarray) -> list[tuple[int, int, int, int, int, int, int, int] | None]:
    """The best local alignment on the diagonals of each band, all bands row by row together; None below ``least``.

    An alignment is its score, first and last base of the query and of the subject, columns, equal ones and gaps.
    Of equally good ends the first in the subject counts, then in the query; equal bases go before gaps.
    """
    count, rows, width = len(bands.size), int(bands.size.max()), int(bands.width.max())
    inside = np.arange(width)
    whole, down, flat = np.zeros((rows + 1, count, width), dtype=np.int32), np.full((rows + 1, count, width), _NOTHING, dtype=np.int32), np.full((rows + 1, count, width), _NOTHING, dtype=np.int32)
    step = np.full((rows, count, width), -10000, dtype=np.int32)
    ramp = (EXTEND * inside).astype(np.int32)
    within = inside[None, :] < bands.width[:, None]
    for i in range(1, rows + 1):
        at = i - 1 + bands.low[:, None] + inside[None, :]
        ok = within & (at >= 0) & (at < bands.query_size[:, None]) & (i <= bands.size)[:, None]
        base = subjects[np.where(i <= bands.size, bands.subject + i - 1, 0)]
        step[i - 1] = np.where(ok, SCORES[base[:, None], queries[np.where(ok, bands.query[:, None] + at, 0)]], -10000)
        # a base of the subject alone comes from the diagonal beside
        np.maximum(whole[i - 1, :, 1:] - (OPEN + EXTEND), down[i - 1, :, 1:] - EXTEND, out=down[i, :, :-1])
        best = np.maximum(np.maximum(whole[i - 1] + step[i - 1], down[i]), 0)
        reach = np.maximum.accumulate(best + ramp, axis=1) - ramp
        flat[i, :, 1:] = reach[:, :-1] - (OPEN + EXTEND)
        whole[i] = np.where(ok, np.maximum(best, flat[i]), 0)
    top = whole.max(axis=(0, 2))
    return [trace(whole[:, k], down[:, k], flat[:, k], step[:, k], int(bands.low[k])) if top[k] >= max(1, least[k]) else None for k in range(count)]


def trace(whole: np.ndarray, down: np.ndarray, flat: np.ndarray, step: np.ndarray, low: int) -> tuple[int, int, int, int, int, int, int, int]:
    """The alignment that ends in the best cell of a band, back to where it begins."""
    i, c = (int(x) for x in np.unravel_index(int(whole.argmax()), whole.shape))
    score, end, state = int(whole[i, c]), (i - 1, i - 1 + low + c), "whole"
    columns = same = gaps = 0
    first = end
    while True:
        if state == "whole":
            value = whole[i, c]
            if value == 0:
                return score, first[1], end[1], first[0], end[0], columns, same, gaps
            if value == whole[i - 1, c] + step[i - 1, c]:
                first = (i - 1, i - 1 + low + c)
                columns, same, i = columns + 1, same + int(step[i - 1, c] == MATCH), i - 1
            else:
                state, gaps = ("down" if value == down[i, c] else "flat"), gaps + 1
        elif state == "down":
            opened = down[i, c] == whole[i - 1, c + 1] - OPEN - EXTEND
            columns, i, c, state = columns + 1, i - 1, c + 1, "whole" if opened else "down"
        else:
            opened = flat[i, c] == whole[i, c - 1] - OPEN - EXTEND
            columns, c, state = columns + 1, c - 1, "whole" if opened else "flat"


def anchors(codes: np.ndarray, refs: Subjects, k: int, trigger: float, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and subject place of the seeds of a block of genomes whose ungapped extension reaches ``trigger`` bits, one for each stretch of a diagonal."""
    word = words(codes, k)
    at = np.flatnonzero(word >= 0)
    slot = np.minimum(np.searchsorted(refs.known, word[at]), len(refs.known) - 1)
    at, slot = at[refs.known[slot] == word[at]], slot[refs.known[slot] == word[at]]
    times = refs.first[slot + 1] - refs.first[slot]
    ends = np.cumsum(times)
    place = refs.place[np.arange(ends[-1] if len(ends) else 0) + np.repeat(refs.first[slot] - (ends - times), times)]
    at = np.repeat(at, times)
    order = np.lexsort((at, at - place))
    at, place = at[order], place[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at - place) != 0) | (np.diff(at) > 1)  # seeds that follow each other base by base are one stretch
    at, place = at[new], place[new]
    far = np.full(len(at), 1 << 30)
    left, _ = extend(codes, refs.codes, at, place, 1, np.minimum(far, at), -1, drop, SCORES)
    right, _ = extend(codes, refs.codes, at + k - 1, place + k - 1, 1, np.minimum(far, len(codes) - at - k), 1, drop, SCORES)
    bits = (PLAIN_LAMBDA * (k * MATCH + left + right) - math.log(PLAIN_K)) / math.log(2)
    return at[bits >= trigger], place[bits >= trigger]


def block_hits(genomes: list[np.ndarray], refs: Subjects, space: int, k: int, evalue: float, trigger: float, band: int) -> list[tuple]:
    """Genome, stretch, score, E-value and alignment of each hit in some genomes; hits that lie within better ones of their stretch are left out."""
    codes = np.concatenate([np.full(1, _WALL, dtype=np.uint8), *[x for g in genomes for x in (CODE[g], np.full(1, _WALL, dtype=np.uint8))]])
    size = np.array([len(g) for g in genomes], dtype=np.int64)
    base = np.cumsum(size + 1) - size
    at, place = anchors(codes, refs, k, trigger, DROP)
    if not len(at):
        return []
    genome, stretch = np.searchsorted(base, at, side="right") - 1, np.searchsorted(refs.start, place, side="right") - 1
    diagonal = (at - base[genome]) - (place - refs.start[stretch])
    order = np.lexsort((diagonal, stretch, genome))
    genome, stretch, diagonal = genome[order], stretch[order], diagonal[order]
    new = np.ones(len(genome), dtype=bool)
    new[1:] = (np.diff(genome) != 0) | (np.diff(stretch) != 0) | (np.diff(diagonal) > band)
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], len(genome)) - 1
    genome, stretch, low, high = genome[begins], stretch[begins], diagonal[begins] - band, diagonal[last] + band
    start = np.maximum(low, 0)
    bands = Bands(base[genome] + start, np.minimum(size[genome], refs.size[stretch] + high) - start, refs.start[stretch], refs.size[stretch], low - start, high - low + 1)
    # the score that the E-value asks for
    least = np.ceil(np.log(K * size[genome] * float(space) / evalue) / LAMBDA - 1e-9)
    found: list[tuple] = []
    order = np.lexsort((bands.size, bands.width))
    cells = (bands.size * bands.width)[order]
    at = 0
    while at < len(order):
        # bands of like size are aligned together
        many = max(1, int(np.searchsorted(np.maximum.accumulate(cells[at:]) * np.arange(1, len(cells) - at + 1), CELLS, side="right")))
        which = order[at : at + many]
        for k, fit in zip(which.tolist(), align_bands(codes, refs.codes, bands.taken(which), least[which]), strict=True):
            if fit is not None:
                g = int(genome[k])
                found.append((g, int(stretch[k]), fit[0], K * float(size[g]) * space * math.exp(-LAMBDA * fit[0]), fit[1] + int(start[k]), fit[2] + int(start[k]), *fit[3:]))
        at += many
    kept: list[tuple] = []
    for hit in sorted(found, key=lambda h: (h[0], h[1], -h[2], h[4])):
        rivals = (o for o in reversed(kept) if o[:2] == hit[:2])
        if not any(o[4] <= hit[4] and hit[5] <= o[5] and o[6] <= hit[6] and hit[7] <= o[7] for o in rivals):
            kept.append(hit)
    return kept


_COLUMNS = ["qseqid", "sseqid", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bitscore"]


def gapped_search(queries: DataFrame, subjects: DataFrame, k: int = SEED, evalue: float = EVALUE, trigger: float = TRIGGER, band: int = BAND, limit: int = SENT_WORDS) -> DataFrame:
    """Hits of ``subjects`` (ref_id, seq) in ``queries`` (qseqid, seq): the 12 tabular columns, gaps among them.

    ``length`` counts the columns of the alignment, ``mismatch`` those of two bases that differ, and
    ``gapopen`` the gaps.  Bases are counted from 1; on the minus strand sstart is after send.  The E-value is
    for the query and all subjects together.  Bases other than ACGT equal none.  Null and empty
    sequences have no hits, and rows that repeat are searched each.

    Subjects go to the tasks in blocks of some ``limit`` bases, and each query is read once for a
    block; nothing but the hits leaves a task.
    """
    kinds = queries.schema["qseqid"].dataType.simpleString(), subjects.schema["ref_id"].dataType.simpleString()
    held = cut(subjects.select("ref_id", "seq"))
    space = held.agg(F.sum(F.length("seq"))).first()[0] or 0
    blocks = max(1, -(-2 * space // max(1, limit)))

    def scan(block: Subjects) -> DataFrame:
        shared = queries.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            refs: Subjects = shared.value

            def searched(names: pa.Array, row: list[int], genomes: list[np.ndarray]) -> pa.RecordBatch:
                hits = block_hits(genomes, refs, space, k, evalue, trigger, band) if genomes and len(refs.known) else []
                g, r, score, e, q0, q1, s0, s1, columns, same, gaps = ([h[i] for h in hits] for i in range(11))
                stretch = np.array(r, dtype=np.int64)
                n, back = refs.size[stretch], refs.back[stretch]
                s0, s1, columns, same, score = (np.array(x, dtype=np.int64) for x in (s0, s1, columns, same, score))
                q0, q1 = np.array(q0, dtype=np.int64), np.array(q1, dtype=np.int64)
                alone = 2 * columns - (q1 - q0 + 1) - (s1 - s0 + 1)  # columns of a single base
                numbers = [columns, columns - same - alone, np.array(gaps, dtype=np.int64), q0 + 1, q1 + 1, np.where(back, n - s0, s0 + 1), np.where(back, n - s1, s1 + 1)]
                return pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array([row[i] for i in g], pa.int64())), refs.names.take(pa.array(refs.ref[stretch])), pa.array(100.0 * same / np.maximum(columns, 1)), *[pa.array(x.astype(np.int32)) for x in numbers],
                        pa.array(e, pa.float64()), pa.array((LAMBDA * score - math.log(K)) / math.log(2)),
                    ],
                    _COLUMNS,
                )

            for batch in batches:
                row, genomes, waiting = [], [], 0
                for i, text in enumerate(batch.column(1).to_pylist()):
                    if text:
                        row.append(i)
                        genomes.append(as_bytes(text))
                        waiting += len(text)
                    if waiting >= LETTERS:
                        yield searched(batch.column(0), row, genomes)
                        row, genomes, waiting = [], [], 0
                yield searched(batch.column(0), row, genomes)

        schema = f"qseqid {kinds[0]}, sseqid {kinds[1]}, pident double, " + ", ".join(f"{c} int" for c in _COLUMNS[3:10]) + ", evalue double, bitscore double"
        return queries.select("qseqid", "seq").mapInArrow(run, schema)

    parts = [Subjects.of(held.filter(F.pmod(F.xxhash64("ref_id", "seq"), F.lit(blocks)) == b).toArrow(), k) for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, [scan(p) for p in parts])
