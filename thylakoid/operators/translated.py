"""A translated search: frames of genomes against references, both read in all six frames.

Words of ``WORD`` residues meet those that score ``NEIGHBOUR`` or more with them by a substitution
matrix.  Two such hits on one diagonal, apart but within ``WINDOW`` residues, are a seed; it is
extended both ways, without gaps, until the score falls ``DROP`` below its best.  A genome is
translated once, and a seed belongs to every frame of it that holds both words; extensions end where
the frame does.  The E-value is that of Karlin and Altschul (1990).
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

from thylakoid.functions.sequence import COMPLEMENT, STOP, UNKNOWN, amino_acids, as_bytes
from thylakoid.operators.align import SENT_WORDS
from thylakoid.operators.orf import MORE_THAN, runs
from thylakoid.plans.cuts import cut

#: BLOSUM62 (Henikoff and Henikoff, 1992), each residue's row up to itself, and its parameters of ungapped scores.
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """4
-1 5
-2 0 6
-2 -2 1 6
0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4"""
LAMBDA, K = 0.3176, 0.134
#: Residues of a word, what a neighbour of it scores at least, how far two hits may be apart, and how far a score may fall.
WORD, NEIGHBOUR, WINDOW, DROP = 4, 18, 40, 16
EVALUE = 0.1
#: Letters of genomes that are searched at once; a longer genome is searched by itself.
LETTERS = 50_000

#: Codes of residues: those of the matrix, a stop, an unknown one, and what lies between sequences.
_STOP, _UNKNOWN, _WALL = 20, 21, 22
CODE = np.full(256, _UNKNOWN, dtype=np.uint8)
CODE[list(RESIDUES.encode())] = np.arange(20)
CODE[ord(STOP)], CODE[ord(UNKNOWN)] = _STOP, _UNKNOWN


def matrix() -> np.ndarray:
    """Scores by code; a stop scores -4 with all but itself, unknown residues -1, and nothing goes beyond a wall."""
    scores = np.full((23, 23), -1, dtype=np.int32)
    for i, row in enumerate(BLOSUM62.splitlines()):
        scores[i, : i + 1] = scores[: i + 1, i] = [int(x) for x in row.split()]
    scores[_STOP, :], scores[:, _STOP] = -4, -4
    scores[_STOP, _STOP] = 1
    scores[_WALL, :], scores[:, _WALL] = -10000, -10000
    return scores


SCORES = matrix()


def words(codes: np.ndarray, step: int) -> np.ndarray:
    """Each run of ``WORD`` residues ``step`` places apart as a number; -1 where one is no residue of the matrix."""
    n = max(0, len(codes) - step * (WORD - 1))
    word, sound = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for i in range(WORD):
        part = codes[step * i : step * i + n]
        word = word * 20 + part
        sound &= part < 20
    return np.where(sound, word, -1)


def neighbours(word: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``word`` (its number in the list) the words that score ``least`` or more with it.

    Halves are scored first: what the one can't make up for is not tried.
    """
    half = 20 ** (WORD // 2)
    pairs = np.arange(half)
    scores = SCORES[np.add.outer(np.zeros(half, dtype=np.int64), pairs // 20), (pairs // 20)[:, None]] + SCORES[np.add.outer(np.zeros(half, dtype=np.int64), pairs % 20), (pairs % 20)[:, None]]
    most = scores.max(axis=1)
    number, found = [], []
    for i, w in enumerate(word.tolist()):
        x, y = divmod(w, half)
        left, right = np.flatnonzero(scores[x] >= least - most[y]), np.flatnonzero(scores[y] >= least - most[x])
        a, b = np.nonzero(scores[x][left][:, None] + scores[y][right][None, :] >= least)
        found.append(left[a] * half + right[b])
        number.append(np.full(len(a), i))
    return np.concatenate([*number, np.zeros(0, dtype=np.int64)]), np.concatenate([*found, np.zeros(0, dtype=np.int64)])


class Subjects(NamedTuple):
    """References in all six frames, one after the other with walls between, and by word the places that it is a neighbour of."""

    names: pa.Array
    codes: np.ndarray
    start: np.ndarray
    stretch: np.ndarray
    length: np.ndarray
    first: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, refs: pa.Table, least: int) -> Subjects:
        """``stretch`` has the reference, strand and phase of what begins at each of ``start``."""
        names, parts, start, stretch, length, at = refs.column(0).combine_chunks(), [], [], [], [], 0
        wall = np.full(WINDOW + WORD, _WALL, dtype=np.uint8)
        for i, seq in enumerate(refs.column(1).to_pylist()):
            letters = as_bytes(seq)
            length.append(len(letters))
            for back in (0, 1):
                if len(letters) >= 3:
                    amino = CODE[amino_acids(COMPLEMENT[letters[::-1]] if back else letters)]
                    for phase in range(3):
                        parts += [amino[phase::3], wall]
                        start.append(at)
                        stretch.append((i, back, phase))
                        at += len(parts[-2]) + len(wall)
        codes = np.concatenate([wall[:0], *parts])
        word = words(codes, 1)
        known, which = np.unique(word[word >= 0], return_inverse=True)
        owner, near = neighbours(known, least)
        places = np.flatnonzero(word >= 0)[np.argsort(which, kind="stable")]
        begins = np.searchsorted(np.sort(which), np.arange(len(known) + 1))
        order = np.argsort(near, kind="stable")
        owner, near = owner[order], near[order]
        times = begins[owner + 1] - begins[owner]
        spread = _ranges(begins[owner], times)
        total = np.concatenate([[0], np.cumsum(times)])
        first = total[np.searchsorted(near, np.arange(20**WORD + 1))]
        return cls(names, codes, np.array(start, dtype=np.int64), np.array(stretch, dtype=np.int64).reshape(-1, 3), np.array(length, dtype=np.int64), first, places[spread].astype(np.int32))


def _ranges(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    ends = np.cumsum(times)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - times), times)


class Seeds(NamedTuple):
    """Of a genome: strand, phase, residue of the earlier and of the later word on that strand, and the later one's place among the subjects."""

    back: np.ndarray
    phase: np.ndarray
    before: np.ndarray
    at: np.ndarray
    place: np.ndarray


def find_seeds(sides: list[np.ndarray], refs: Subjects) -> Seeds:
    """All second hits: words with another hit on their diagonal, apart and within the window before them; the nearest counts."""
    wide = max(len(s) for s in sides) // 3 + 2 * WINDOW
    keys = []
    for back, codes in enumerate(sides):
        word = words(codes, 3)
        at = np.flatnonzero(word >= 0)
        times = refs.first[word[at] + 1] - refs.first[word[at]]
        place = refs.place[_ranges(refs.first[word[at]], times)].astype(np.int64)
        at = np.repeat(at, times)
        keys.append(((back * 3 + at % 3) * (wide + len(refs.codes)) + at // 3 - place + len(refs.codes)) * wide + at // 3)
    key = np.sort(np.concatenate(keys))  # a key has the diagonal and the residue, and so the place
    # most hits are alone on their diagonal
    near = np.zeros(len(key), dtype=bool)
    if len(key) > 1:
        near[1:] = np.diff(key) <= WINDOW
        near[:-1] |= near[1:].copy()
    key = key[near]
    partner = np.searchsorted(key, key - WORD, side="right") - 1
    good = (partner >= 0) & (key - key[np.maximum(partner, 0)] <= WINDOW)
    key, gap = key[good], (key - key[np.maximum(partner, 0)])[good]
    lane, diagonal = np.divmod(key // wide, wide + len(refs.codes))
    return Seeds(lane // 3, lane % 3, key % wide - gap, key % wide, key % wide - diagonal + len(refs.codes))


def extend(query: np.ndarray, subject: np.ndarray, at: np.ndarray, place: np.ndarray, step: int, limit: np.ndarray, way: int, drop: int, scores: np.ndarray = SCORES) -> tuple[np.ndarray, np.ndarray]:
    """Best gain and its number of residues beyond ``at`` and ``place`` one way; at most ``limit`` residues."""
    n = len(at)
    score, best, reach = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    going, k = np.flatnonzero(limit > 0), 0
    while len(going):
        k += 1
        spot = place[going] + way * k
        spot = np.where((spot >= 0) & (spot < len(subject)), spot, -1)  # the last is a wall
        score[going] += scores[query[at[going] + way * k * step], subject[spot]]
        up = score[going] > best[going]
        best[going[up]], reach[going[up]] = score[going[up]], k
        going = going[(best[going] - score[going] <= drop) & (k < limit[going])]
    return best, reach


HIT = "qseqid string, sseqid {kind}, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
_COLUMNS = [c.split()[0] for c in HIT.split(", ")]


class Hits(NamedTuple):
    """Genome (its number), frame (its number and strand), and a hit in it: reference, residues, equal ones, bases from 0, score, E-value."""

    genome: np.ndarray
    number: np.ndarray
    minus: np.ndarray
    ref: np.ndarray
    length: np.ndarray
    same: np.ndarray
    qstart: np.ndarray
    qend: np.ndarray
    sstart: np.ndarray
    send: np.ndarray
    score: np.ndarray
    evalue: np.ndarray


class Laid(NamedTuple):
    """Genomes one after the other, each from a multiple of three on: both strands, where each begins and how long it is."""

    strands: list[np.ndarray]
    base: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, genomes: list[np.ndarray]) -> Laid:
        size = np.array([len(g) for g in genomes], dtype=np.int64)
        room = (size // 3 + 1 + WINDOW + WORD) * 3
        base = np.cumsum(room) - room
        strands = [np.zeros(int(room.sum()), dtype=np.uint8) for _ in range(2)]  # what lies between is in no codon
        for at, letters in zip(base.tolist(), genomes, strict=True):
            strands[0][at : at + len(letters)] = letters
            strands[1][at : at + len(letters)] = COMPLEMENT[letters[::-1]]
        return cls(strands, base, size)

    def of_place(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, place, side="right") - 1

    def turned(self, genome: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A place on one strand of a genome, as it is on the other."""
        return 2 * self.base[genome] + self.size[genome] - 1 - place

    def frames(self, minus: int, compat: bool) -> tuple[np.ndarray, ...]:
        """Genome, number, frame, and forward first and last base of the frames of one strand, by frame and first base."""
        strand = self.strands[minus]
        if compat:  # what a genome's end cuts off counts
            parts = [runs(strand[at : at + n], MORE_THAN, True) for at, n in zip(self.base.tolist(), self.size.tolist(), strict=True) if n >= 3]
            at = np.repeat(self.base[self.size >= 3], [len(p[0]) for p in parts])
            frame, start, end = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]).astype(np.int64) for x in (zip(*parts, strict=True) if parts else [[], [], []]))
            start, end = start + at, end + at
        else:
            frame, start, end = (x.astype(np.int64) for x in runs(strand, MORE_THAN, False))
        genome = self.of_place(start)
        order = np.lexsort((start, frame, genome))
        frame, start, end, genome = frame[order], start[order], end[order], genome[order]
        first = np.searchsorted(genome, np.arange(len(self.base)))
        number = np.arange(len(genome)) - first[genome]
        low, high = (self.turned(genome, end), self.turned(genome, start)) if minus else (start, end)
        order = np.lexsort((low, frame))
        return genome[order], number[order], frame[order], low[order], high[order]


def block_hits(genomes: list[np.ndarray], refs: Subjects, space: int, evalue: float, drop: int, compat: bool) -> Hits | None:
    """The hits of all frames of some genomes; ``space`` is the number of residues of all references."""
    laid = Laid.of(genomes)
    sides = [CODE[amino_acids(s)] for s in laid.strands]
    seeds = find_seeds(sides, refs)
    if not len(seeds.at):
        return None
    # both words, in bases of the forward strand
    low, high = 3 * seeds.before + seeds.phase, 3 * (seeds.at + WORD) + seeds.phase - 1
    of = laid.of_place(low)
    low, high = np.where(seeds.back == 1, laid.turned(of, high), low), np.where(seeds.back == 1, laid.turned(of, low), high)
    rows = []
    for minus in (0, 1):
        genome, number, frame, a, b = laid.frames(minus, compat)
        for f in range(3):
            x, y = np.searchsorted(frame, [f, f + 1])
            if x < y:
                i = np.searchsorted(a[x:y], low, side="right") - 1 + x
                held = np.flatnonzero((i >= x) & (b[np.maximum(i, x)] >= high))
                rows.append((held, number[i[held]], np.full(len(held), minus), a[i[held]], b[i[held]]))
    if not rows:
        return None
    seed, number, minus, a, b = (np.concatenate(x) for x in zip(*rows, strict=True))
    genome, back, phase, at, place = of[seed], seeds.back[seed], seeds.phase[seed], seeds.at[seed], seeds.place[seed]
    # residues of the frame before the word and after it, on the strand of the seed
    begins, ends = np.where(back == 1, laid.turned(genome, b), a), np.where(back == 1, laid.turned(genome, a), b)
    spot = 3 * at + phase
    query = np.concatenate(sides)
    shifted = spot + back * len(sides[0])
    word = sum(SCORES[query[shifted + 3 * i], refs.codes[place + i]] for i in range(WORD)).astype(np.int64)
    gain_left, left = extend(query, refs.codes, shifted, place, 3, (spot - begins) // 3, -1, drop)
    gain_right, right = extend(query, refs.codes, shifted + 3 * (WORD - 1), place + WORD - 1, 3, (ends - spot + 1) // 3 - WORD, 1, drop)
    score, first, size = word + gain_left + gain_right, place - left, left + right + WORD
    e = K * ((b - a + 1) // 3) * float(space) * np.exp(-LAMBDA * score)
    good = np.flatnonzero(e <= evalue)
    if not len(good):
        return None
    # of hits that overlap on a diagonal of a frame the best stays, then the first
    lane = np.stack([genome, number, minus, back, phase, at - place])[:, good]
    order = np.lexsort((first[good], -score[good], *lane[::-1]))
    good, lane = good[order], lane[:, order]
    new = np.concatenate([[True], (lane[:, 1:] != lane[:, :-1]).any(axis=0)])
    alone = new & np.append(new[1:], True)
    kept, taken = good[alone].tolist(), []
    for g, fresh in zip(good[~alone].tolist(), new[~alone].tolist(), strict=True):
        taken = [] if fresh else taken
        x, y = first[g], first[g] + size[g]
        if all(y <= u or v <= x for u, v in taken):
            taken.append((x, y))
            kept.append(g)
    g = np.array(kept)
    start, length = spot[g] - 3 * left[g], size[g]
    inside = _ranges(np.zeros(len(g), dtype=np.int64), length)
    each = np.repeat(np.arange(len(g)), length)
    equal = np.bincount(each, weights=query[(shifted[g] - 3 * left[g])[each] + 3 * inside] == refs.codes[first[g][each] + inside], minlength=len(g)).astype(np.int64)
    q0, q1 = start - begins[g], start + 3 * length - 1 - begins[g]  # on the strand of the hit, within the frame
    wide, stretch = (b - a + 1)[g], np.searchsorted(refs.start, place[g], side="right") - 1
    ref, turned, s0 = refs.stretch[stretch, 0], refs.stretch[stretch, 1] == 1, 3 * (first[g] - refs.start[stretch]) + refs.stretch[stretch, 2]
    s1, m, flip = s0 + 3 * length - 1, refs.length[ref], back[g] == 1
    return Hits(genome[g], number[g], minus[g], ref, length, equal, np.where(flip, wide - 1 - q0, q0), np.where(flip, wide - 1 - q1, q1), np.where(turned, m - 1 - s0, s0), np.where(turned, m - 1 - s1, s1), score[g], e[g])


def translated_search(genomes: DataFrame, refs: DataFrame, evalue: float = EVALUE, least: int = NEIGHBOUR, drop: int = DROP, limit: int = SENT_WORDS, compat: bool = False) -> DataFrame:
    """Hits of the frames of ``genomes`` (genome_id, seq) in ``refs`` (ref_id, seq): the 12 tabular columns.

    ``qseqid`` is ``{genome}:{frame}``, as in ``align.frame_scores``.  Bases are counted from 1 within the frame's
    forward slice and within the reference; a hit on the other strand of either runs backwards there.
    ``length`` and ``mismatch`` count residues, and there are no gaps.  The lengths of the E-value are the residues
    of the frame and of all references together.  Null and short sequences have no hits.

    References go to the tasks in blocks of some ``limit`` residues, and each genome is read once for a block;
    nothing but the hits leaves a task.
    """
    kind = refs.schema["ref_id"].dataType.simpleString()
    held = cut(refs.select("ref_id", "seq"))
    space, letters = held.agg(F.sum(F.floor(F.length("seq") / 3)), F.sum(F.length("seq"))).first()
    blocks = max(1, -(-2 * (letters or 0) // max(1, limit)))

    def scan(block: Subjects) -> DataFrame:
        shared = genomes.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            refs = shared.value
            names: list[str | None] = []
            waiting: list[np.ndarray] = []

            def flush() -> pa.RecordBatch:
                hits = block_hits(waiting, refs, space, evalue, drop, compat) if waiting and len(refs.codes) else None
                hits = hits or Hits(*[np.zeros(0, dtype=np.int64)] * len(Hits._fields))
                heads = ["" if name is None else f"{name}:" for name in names]
                frames = [f"{heads[g]}orf{n + 1}{'-r' if minus else ''}" for g, n, minus in zip(hits.genome.tolist(), hits.number.tolist(), hits.minus.tolist(), strict=True)]
                whole = [hits.length, hits.length - hits.same, np.zeros(len(hits.ref)), *[x + 1 for x in (hits.qstart, hits.qend, hits.sstart, hits.send)]]
                columns = [pa.array(100.0 * hits.same / np.maximum(hits.length, 1)), *[pa.array(x.astype(np.int32)) for x in whole], pa.array(hits.evalue.astype(np.float64)), pa.array((LAMBDA * hits.score - math.log(K)) / math.log(2))]
                names.clear()
                waiting.clear()
                return pa.RecordBatch.from_arrays([pa.array(frames, pa.string()), refs.names.take(pa.array(hits.ref)), *columns], _COLUMNS)

            for batch in batches:
                for genome, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if text is not None and len(text) > MORE_THAN:
                        names.append(genome)
                        waiting.append(as_bytes(text))
                        if sum(map(len, waiting)) >= LETTERS:
                            yield flush()
            yield flush()

        return genomes.select(F.col("genome_id").cast("string").alias("genome_id"), "seq").mapInArrow(run, HIT.format(kind=kind))

    parts = [Subjects.of(held.filter(F.pmod(F.xxhash64("ref_id", "seq"), F.lit(blocks)) == b).toArrow(), least) for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, [scan(p) for p in parts])
