"""A seed-and-extend similarity search that writes hits in the 12 tabular columns.

It stands in for an external search tool.  Words of ``k`` letters are packed into numbers; those
of the queries that the subjects can't have never leave the task that cuts them, and the others
meet the subjects' in an equi-join.  Seeds are extended along their diagonal, over mismatches, until
the score falls too far below its best, and the E-value is that of Karlin and Altschul (1990).
Hits have no gaps.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.functions.sequence import COMPLEMENT, STOP, amino_acids, as_bytes, frame_protein, revcomp, translate_dna
from thylakoid.operators.orf import MORE_THAN, ROWS_OUT, runs
from thylakoid.plans.cuts import cut

#: Parameters of the extreme-value distribution for match 1, mismatch -2, ungapped.
LAMBDA, K = 1.33, 0.621
MATCH, MISMATCH = 1, -2
#: Letters of a seed, and how far a score may fall below its best before an extension ends.
SEED, DROP = 16, 10
#: Words of references, with the references that have them, that are sent to every task at once (some 30 MB).
SENT_WORDS = 2_000_000
#: Bits (as a power of two) of the bitmap that keeps out words that the other side doesn't have.
BITS = 20

_BASE = np.full(256, 4, dtype=np.uint8)
_BASE[list(b"ACGT")] = np.arange(4)
_RESIDUE = np.zeros(256, dtype=np.int64)
_RESIDUE[list(b"ACDEFGHIKLMNPQRSTVWY" + STOP.encode())] = np.arange(1, 22)


def _slots(text: str | None, k: int) -> np.ndarray:
    """The bit of each k-mer of a sequence."""
    letters = np.frombuffer((text or "").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    total = np.zeros(max(0, len(letters) - k + 1), dtype=np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + letters[i : i + len(total)]
    return ((total * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


def kmers_among(df: DataFrame, key: str, seq: str, k: int, others: DataFrame) -> DataFrame:
    """``key``, ``kmer`` of the distinct k-mers of each row that ``others`` (kmer) may have: all that it has, and few more."""

    @F.pandas_udf("long")
    def slot(words: pd.Series) -> pd.Series:
        return words.map(lambda w: int(_slots(w, k)[0]))

    have = np.zeros(1 << BITS, dtype=bool)
    have[[r[0] for r in others.select(slot("kmer")).distinct().collect()]] = True  # 2^20 rows at most
    shared = df.sparkSession.sparkContext.broadcast(have)

    @F.pandas_udf("array<string>")
    def taken(texts: pd.Series) -> pd.Series:
        return pd.Series([list({t[i : i + k] for i in np.flatnonzero(shared.value[_slots(t, k)])}) for t in texts])

    return df.select(key, F.explode(taken(seq)).alias("kmer"))


def dna_words(letters: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and packed word of each run of ``k`` bases; letters other than ACGT are in none."""
    digit = _BASE[letters].astype(np.int64)
    n = max(0, len(digit) - k + 1)
    word, sound = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for i in range(k):
        word = word * 4 + digit[i : i + n]
        sound &= digit[i : i + n] < 4
    at = np.flatnonzero(sound)
    return at, word[at]


def protein_words(amino: np.ndarray, k: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Place, in bases, and packed word of each run of ``k`` residues in any frame, of the residue at each place, from ``wanted`` places on; unknown residues are in none."""
    n = max(0, len(amino) - 3 * (k - 1))
    if wanted is not None:
        at = np.flatnonzero(wanted[:n])
        residue = _RESIDUE[amino[at[:, None] + 3 * np.arange(k)]]
        held = (residue > 0).all(axis=1)
        return at[held], residue[held] @ 22 ** np.arange(k - 1, -1, -1)
    residue = _RESIDUE[amino]
    word, sound = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for i in range(k):
        word = word * 22 + residue[3 * i : 3 * i + n]
        sound &= residue[3 * i : 3 * i + n] > 0
    at = np.flatnonzero(sound)
    return at, word[at]


def _bit(words: np.ndarray) -> np.ndarray:
    return ((words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def _words_of(df: DataFrame, key: str, cut_words, k: int, have: np.ndarray | None = None, both: bool = False, span: int | None = None) -> DataFrame:
    """``key``, ``pos``, ``back`` and ``word`` of the sequences of ``df`` (key, seq), of those in the bitmap ``have``; with ``both`` of either strand.

    Places on the other strand are those of the complement, or with ``span``, the bases of a word,
    of the sequence itself.
    """
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(have)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            row, pos, back, word = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                letters = as_bytes(text)
                for reverse in (False, True) if both else (False,):
                    at, found = cut_words(COMPLEMENT[letters[::-1]] if reverse else letters, k)
                    if bits is not None:
                        kept = bits[_bit(found)]
                        at, found = at[kept], found[kept]
                    row.append(np.full(len(at), i))
                    pos.append(len(letters) - span - at if reverse and span else at)
                    back.append(np.full(len(at), reverse))
                    word.append(found)
            if row:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(row))), pa.array(np.concatenate(pos).astype(np.int32)), pa.array(np.concatenate(back)), pa.array(np.concatenate(word))], [key, "pos", "back", "word"]
                )

    return df.select(key, "seq").mapInArrow(run, f"`{key}` {kind}, pos int, back boolean, word long")


def _bitmap(words: DataFrame) -> np.ndarray:
    """The bits of ``words`` (word): of fixed size, whatever their number."""

    @F.pandas_udf("long")
    def bit(words: pd.Series) -> pd.Series:
        return pd.Series(_bit(words.to_numpy()))

    have = np.zeros(1 << BITS, dtype=bool)
    have[[r[0] for r in words.select(bit("word")).distinct().collect()]] = True  # 2^20 rows at most
    return have


def _small(words: DataFrame, limit: int = 500_000) -> DataFrame:
    """A durable table of words, to be broadcast if it is small."""
    return F.broadcast(words) if words.count() <= limit else words


def extend(a: np.ndarray, b: np.ndarray, k: int, drop: int = DROP) -> list[tuple[int, int, int]]:
    """Hits (start, end, mismatches) of two sequences of equal length laid side by side; end inclusive.

    Each stretch of ``k`` equal bases or more is extended both ways, up to where the score is best
    before it falls more than ``drop`` below its best; hits that overlap are one.
    """
    same = (a == b) & (_BASE[a] < 4)
    edge = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    step = np.where(same, MATCH, MISMATCH)

    def gained(steps: np.ndarray) -> int:
        if not len(steps):
            return 0
        score = np.cumsum(steps)
        fallen = np.maximum(np.maximum.accumulate(score), 0) - score > drop
        reach = int(fallen.argmax()) if fallen.any() else len(score)
        best = int(score[:reach].argmax()) if reach else 0
        return best + 1 if reach and score[best] > 0 else 0

    spans = [(x - gained(step[:x][::-1]), y + gained(step[y + 1 :])) for x, y in zip(first.tolist(), last.tolist(), strict=True) if y - x + 1 >= k]
    hits: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if hits and low <= hits[-1][1]:
            low, high = hits[-1][0], max(high, hits.pop()[1])
        hits.append((low, high))
    return [(x, y, int((~same[x : y + 1]).sum())) for x, y in hits]


def search(queries: DataFrame, subjects: DataFrame, k: int = SEED, evalue: float = 0.1, drop: int = DROP) -> DataFrame:
    """Hits of ``subjects`` (ref_id, seq) in ``queries`` (qseqid, seq), with unique ids: the 12 columns, 1-based.

    On the minus strand sstart is after send.  Every ungapped alignment with ``k`` equal bases in a
    row is found, mismatches and all; bases other than ACGT never match.  The diagonals of a query
    are gathered and extended in one go, so a query is moved once.
    """
    seeds = _words_of(subjects.withColumnRenamed("ref_id", "_ref"), "_ref", dna_words, k, both=True)
    seeds = cut(seeds.withColumnRenamed("pos", "_at"))
    found = _words_of(queries, "qseqid", dna_words, k, _bitmap(seeds)).drop("back")
    near = found.join(_small(seeds), "word").select("qseqid", "_ref", "back", (F.col("pos") - F.col("_at")).alias("diagonal")).distinct()
    sides = subjects.select(F.col("ref_id").alias("_ref"), F.lit(False).alias("back"), "seq").unionByName(subjects.select(F.col("ref_id").alias("_ref"), F.lit(True).alias("back"), revcomp(F.col("seq")).alias("seq")))
    lanes = near.groupBy("qseqid", "_ref", "back").agg(F.collect_list("diagonal").alias("diagonals")).join(sides, ["_ref", "back"])
    lanes = lanes.groupBy(F.col("qseqid").alias("_q")).agg(F.collect_list(F.struct(F.col("_ref").alias("ref"), "back", "diagonals", "seq")).alias("lanes"))

    @F.pandas_udf("array<struct<lane:int,q0:int,q1:int,s0:int,s1:int,mismatch:int>>")
    def laid(texts: pd.Series, lanes: pd.Series) -> pd.Series:
        out = []
        for text, sides in zip(texts, lanes, strict=True):
            query, rows = as_bytes(text), []
            for i, side in enumerate(sides):
                subject = as_bytes(side["seq"])
                for d in side["diagonals"]:
                    low, high = max(0, d), min(len(query), len(subject) + d)
                    for x, y, off in extend(query[low:high], subject[low - d : high - d], k, drop):
                        rows.append({"lane": i, "q0": low + x, "q1": low + y, "s0": low + x - d, "s1": low + y - d, "mismatch": off})
            out.append(rows)
        return pd.Series(out)

    rows = lanes.join(queries.select("qseqid", "seq"), F.col("_q") == F.col("qseqid")).select("qseqid", F.length("seq").cast("double").alias("_m"), "lanes", F.explode(laid("seq", "lanes")).alias("h"))
    rows = rows.select("qseqid", "_m", F.col("lanes")[F.col("h.lane")].alias("_l"), "h.*").select("*", F.length("_l.seq").alias("_n"))
    length = F.col("q1") - F.col("q0") + 1
    score = length * MATCH + F.col("mismatch") * (MISMATCH - MATCH)
    at = lambda p: F.when(F.col("_l.back"), F.col("_n") - p).otherwise(p + 1).cast("int")
    e = F.lit(K) * F.col("_m") * F.col("_n") * F.exp(-LAMBDA * score)
    return rows.select(
        "qseqid", F.col("_l.ref").alias("sseqid"), (F.lit(100.0) * (length - F.col("mismatch")) / length).alias("pident"), length.cast("int").alias("length"), F.col("mismatch"), F.lit(0).alias("gapopen"),
        (F.col("q0") + 1).cast("int").alias("qstart"), (F.col("q1") + 1).cast("int").alias("qend"), at(F.col("s0")).alias("sstart"), at(F.col("s1")).alias("send"),
        e.alias("evalue"), ((LAMBDA * score - math.log(K)) / math.log(2)).alias("bitscore"),
    ).filter(F.col("evalue") <= evalue)


class References(NamedTuple):
    """References that are sent to every task: their words, each with the references that have it, and by reference the windows of its protein.

    References of like length share a lane, a byte of some numbers; ``lanes`` has of each window a one
    in those of the references that have it.
    """

    names: pa.Array
    words: np.ndarray
    first: np.ndarray
    ref: np.ndarray
    lengths: np.ndarray
    window_first: np.ndarray
    window_ref: np.ndarray
    lane: np.ndarray
    lanes: np.ndarray

    @classmethod
    def of(cls, refs: pa.Table, k: int) -> References:
        """Of a table of names, sequences and proteins."""
        names = refs.column(0).combine_chunks()
        word, owner, window, by = [], [], [], []
        for i, (seq, protein) in enumerate(zip(refs.column(1).to_pylist(), refs.column(2).to_pylist(), strict=True)):
            letters = as_bytes(seq)
            found = np.unique(np.concatenate([protein_words(amino_acids(side), k)[1] for side in (letters, COMPLEMENT[letters[::-1]])])) if len(letters) >= 3 else np.zeros(0, dtype=np.int64)
            word.append(found)
            owner.append(np.full(len(found), i))
            found = np.unique(_windows(as_bytes(protein), 1))
            window.append(found)
            by.append(np.full(len(found), i))
        word, owner, window, by = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]) for x in (word, owner, window, by))
        order = np.argsort(word, kind="stable")
        known, first = np.unique(word[order], return_index=True)
        lengths = np.array([len(x or "") for x in refs.column(2).to_pylist()], dtype=np.int64)
        lane = np.zeros(len(names), dtype=np.int64)
        numbers = min(LANES, max(1, -(-len(names) // 64)))
        lane[np.argsort(lengths, kind="stable")] = np.arange(len(names)) * 8 * numbers // max(1, len(names))
        lanes = np.zeros((WINDOWS, 8 * numbers), dtype=np.uint8)
        lanes[window, lane[by]] = 1
        return cls(names, known, np.append(first, len(order)), owner[order], lengths, np.searchsorted(np.sort(window), np.arange(WINDOWS + 1)), by[np.argsort(window, kind="stable")], lane, lanes.view(np.uint64))


#: Windows of three residues, of five bits each.
WINDOWS = 1 << 15
#: Letters of genomes that are scored at once, entries of a table of frames and references, and words that are marked each.
LETTERS, DENSE, MARKED = 1 << 16, 1 << 22, 1 << 23
#: Numbers of eight lanes that references are dealt into at most, and the most that a lane counts.
LANES, FULL = 4, 255
#: How far apart the windows are that are counted, by the rules that read a frame from its first base only.
PERIODS = {"first": 3, "legacy": 9}


def _windows(residues: np.ndarray, step: int) -> np.ndarray:
    """Each residue with the two that follow it ``step`` places apart, as a number; unknown ones and stops are letters like others."""
    r = residues.astype(np.int64) & 31
    return (r[: -2 * step] << 10) | (r[step:-step] << 5) | r[2 * step :] if len(r) > 2 * step else r[:0]


class Block(NamedTuple):
    """Genomes one after the other, each from a multiple of three on: where each begins, how long it is, the genome of each place and its bases from there on, and both strands with their residues."""

    base: np.ndarray
    size: np.ndarray
    of: np.ndarray
    left: np.ndarray
    strands: list[np.ndarray]
    amino: list[np.ndarray]

    @classmethod
    def of_genomes(cls, genomes: list[np.ndarray]) -> Block:
        size = np.array([len(g) for g in genomes], dtype=np.int64)
        room = (size // 3 + 2) * 3
        base = np.cumsum(room) - room
        strands = [np.zeros(int(room.sum()), dtype=np.uint8) for _ in range(2)]  # what lies between is in no codon
        for at, letters in zip(base.tolist(), genomes, strict=True):
            strands[0][at : at + len(letters)] = letters
            strands[1][at : at + len(letters)] = COMPLEMENT[letters[::-1]]
        of = np.repeat(np.arange(len(genomes)), room)
        return cls(base, size, of, (base + size)[of] - np.arange(len(of)), strands, [amino_acids(x) for x in strands])

    def turned(self, place: np.ndarray, width: int = 1) -> np.ndarray:
        """Where what begins at a place on one strand and is ``width`` long begins on the other."""
        return self.base[self.of[place]] + self.left[place] - width


class Frames(NamedTuple):
    """Frames by genome, strand and number: these three, the first and last base on the forward strand, and the track, strand and phase, whose frames don't meet."""

    genome: np.ndarray
    back: np.ndarray
    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    track: np.ndarray


def _frames_of(block: Block, compat: bool) -> Frames:
    sides = []
    for back in (0, 1):
        frame, start, end = (x.astype(np.int64) for x in runs(block.strands[back], MORE_THAN, False))
        genome = block.of[start]
        if compat:  # a run that is still open at the end of frame 2 is dropped
            after = block.left[end] - 1
            kept = (frame != 2) | ((block.size[genome] - 2) % 3 == 2) | (after >= 3) | (block.amino[back][end - 2] == ord(STOP))
            frame, start, end, genome = frame[kept], start[kept], end[kept], genome[kept]
        low, high = (block.turned(end), block.turned(start)) if back else (start, end)
        order = np.argsort(genome, kind="stable")
        number = np.arange(len(genome)) - np.searchsorted(genome[order], np.arange(len(block.base)))[genome[order]]
        sides.append((genome[order], np.full(len(genome), back), number, low[order], high[order], 3 * back + frame[order]))
    every = [np.concatenate(x) for x in zip(*sides, strict=True)]
    order = np.argsort(every[0], kind="stable")
    return Frames(*[x[order] for x in every])


def _holders(frames: Frames, track: int, width: int, places: int) -> np.ndarray:
    """At each place the frame of a track that holds ``width`` bases from there on; the number of frames where none does."""
    which = np.flatnonzero((frames.track == track) & (frames.high - frames.low + 1 >= width))
    which = which[np.argsort(frames.low[which])]
    low, after = frames.low[which], frames.high[which] - width + 2
    value, times = np.full(2 * len(which) + 1, len(frames.low)), np.zeros(2 * len(which) + 1, dtype=np.int64)
    value[1::2], times[1::2] = which, after - low
    times[0::2] = np.append(low, places) - np.append(0, after)
    return np.repeat(value, times)


def _spans(block: Block, frames: Frames, back: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last base of frames on a strand, whichever they are read on."""
    return (block.turned(frames.high), block.turned(frames.low)) if back else (frames.low, frames.high)


def _covered(block: Block, frames: Frames, back: int) -> np.ndarray:
    """Which places of a strand lie in a frame."""
    low, high = _spans(block, frames, back)
    places = len(block.of)
    return np.cumsum(np.bincount(low, minlength=places + 1) - np.bincount(high + 1, minlength=places + 1))[:places] > 0


def _bounds(block: Block, frames: Frames, refs: References) -> np.ndarray:
    """By frame and lane: how many windows of the best of the frame's six proteins any reference of the lane has, or ``FULL`` if more.

    Eight lanes are added up as one number along a phase, and a frame's are the difference of two such
    sums: no lane of it overflows in frames of no more windows than a lane counts, and longer ones are taken as full.
    """
    best = np.zeros((len(frames.low), 8 * refs.lanes.shape[1]), dtype=np.uint8)
    for back in (0, 1):
        window = _windows(block.amino[back], 3)
        low, high = _spans(block, frames, back)
        for number in range(refs.lanes.shape[1]):
            sums = np.zeros(len(block.of) + 3, dtype=np.uint64)  # of the windows of a phase before a place
            sums[3 : 3 + len(window)] = refs.lanes[:, number][window]
            sums[3 : 3 + len(window)][block.left[: len(window)] < 9] = 0
            sums = sums.reshape(-1, 3).cumsum(axis=0, dtype=np.uint64).ravel()
            for phase in range(3):
                times = np.maximum(0, (high - low - phase - 5) // 3)
                found = (sums[np.minimum(low + phase + 3 * times, len(sums) - 1)] - sums[np.minimum(low + phase, len(sums) - 1)]) * (times > 0)
                part = best[:, 8 * number : 8 * number + 8]
                np.maximum(part, found.view(np.uint8).reshape(-1, 8), out=part)
    best[(frames.high - frames.low + 1) // 3 - 2 > FULL] = FULL
    return best


def _windows_in(block: Block, back: int, refs: References, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Forward place and reference of each window of nine bases of a strand that a reference's protein has, from the ``wanted`` places of the strand on."""
    amino = block.amino[back]
    at = np.flatnonzero(block.left >= 9 if wanted is None else wanted & (block.left >= 9))
    window = _windows(amino, 3)[at]
    place = block.turned(at, 9) if back else at
    first = refs.window_first[window]
    spot, times = _ranges(first, refs.window_first[window + 1])
    return np.repeat(place, times), refs.window_ref[spot]


def _words_in(block: Block, back: int, refs: References, k: int, known: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Forward place and reference of each word of a strand, from the ``wanted`` places on, that a reference has, in any frame of either; ``known`` marks the words that any has."""
    at, word = protein_words(block.amino[back], k, wanted)
    held = known[word] if len(known) > 1 else np.ones(len(word), dtype=bool)
    at, word = at[held], word[held]
    slot = np.minimum(np.searchsorted(refs.words, word), len(refs.words) - 1)
    held = refs.words[slot] == word
    at, slot = at[held], slot[held]
    spot, times = _ranges(refs.first[slot], refs.first[slot + 1])
    return np.repeat(block.turned(at, 3 * k) if back else at, times), refs.ref[spot]


def _known(refs: References, k: int) -> np.ndarray:
    """A mark for each word that any reference has, if words are short enough for that."""
    known = np.zeros(22**k if 22**k <= MARKED else 1, dtype=bool)
    if len(known) > 1:
        known[refs.words] = True
    return known


def _pairs_of(block: Block, refs: References, k: int, compat: bool, least: float | None, rule: str | None, known: np.ndarray) -> tuple[Frames, np.ndarray, np.ndarray, np.ndarray | None]:
    """Frames of a block, of the length that ``least`` asks for, and of its pairs the frame, the reference and the score by the ``rule``.

    A place lies in one frame of each of six tracks at most, so a word or a window is met with its
    frames by looking these up, and the windows of pairs are counted; no pair is looked at by itself.
    With ``least`` (and "six") only frames are looked at that have the windows which some reference of a lane asks for.
    """
    frames, n, places, wanted = _frames_of(block, compat), len(refs.names), len(block.of), [None, None]
    if least is not None:
        long = (frames.high - frames.low + 1) // 3 - 2 >= least * refs.lengths.min() - 1e-9
        frames = Frames(*[x[long] for x in frames])
    if least is not None and rule == "six":
        need = np.full(8 * refs.lanes.shape[1], np.inf)  # what the shortest reference of a lane asks for
        np.minimum.at(need, refs.lane, np.where(refs.lengths > 0, least * refs.lengths - 1e-9, np.inf))
        near = (_bounds(block, frames, refs) >= np.where(need < np.inf, np.minimum(need, FULL), np.inf)).any(axis=1)
        frames = Frames(*[x[near] for x in frames])
        wanted = [_covered(block, frames, back) for back in (0, 1)]
    residues = (frames.high - frames.low + 1) // 3
    dense = (len(residues) + 1) * n <= DENSE
    marked, keys = np.zeros((len(residues) + 1) * n if dense else 0, dtype=bool), []
    words = [np.concatenate(x) for x in zip(*[_words_in(block, back, refs, k, known, wanted[back]) for back in (0, 1)], strict=True)]
    for track in range(6):
        key = _holders(frames, track, 3 * k, places)[words[0]] * n + words[1]
        if dense:
            marked[key] = True
        else:
            keys.append(np.unique(key))
    pairs = np.flatnonzero(marked) if dense else np.unique(np.concatenate(keys))
    pairs = pairs[: np.searchsorted(pairs, len(residues) * n)]
    if least is not None:
        pairs = pairs[residues[pairs // n] - 2 >= least * refs.lengths[pairs % n] - 1e-9]
    frame, ref = pairs // n, pairs % n
    if not rule or not len(pairs):
        return frames, frame, ref, np.zeros(0) if rule else None
    if least is not None:
        some = Frames(*[x[np.unique(frame)] for x in frames])
        wanted = [_covered(block, some, back) for back in (0, 1)]
    period = PERIODS.get(rule)
    number = np.full(len(marked), -1, dtype=np.int32)
    if dense:
        number[pairs] = np.arange(len(pairs), dtype=np.int32)
    windows, sides = [_windows_in(block, back, refs, wanted[back]) for back in ((0,) if period else (0, 1))], 1 if period else 6
    phases, many = [(3 * back + place % 3).astype(np.int8) for back, (place, _) in enumerate(windows)], np.zeros(len(pairs) * sides, dtype=np.int64)
    for track in range(6):
        begins = _holders(frames, track, 9, places) * n
        for (place, of), phase in zip(windows, phases, strict=True):
            key = begins[place]
            key += of
            if dense:
                which = number[key]
                met = np.flatnonzero(which >= 0)
            else:
                which = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                met = np.flatnonzero(pairs[which] == key)
            which = which[met].astype(np.int64)
            if period:
                which = which[(place[met] - frames.low[frame[which]]) % period == 0]
            else:
                which *= 6
                which += phase[met]
            many += np.bincount(which, minlength=len(many))
    if rule == "legacy":
        size = residues[frame]
        score = many / (size // 3) * (size / refs.lengths[ref])
    else:
        score = many.reshape(-1, sides).max(axis=1) / refs.lengths[ref]
    if least is not None:
        good = score >= least
        frame, ref, score = frame[good], ref[good], score[good]
    return frames, frame, ref, score


def _reference_blocks(refs: DataFrame, k: int, limit: int, protein: Column) -> list[References]:
    """All references, in as many blocks as keep one to some ``limit`` words."""
    held = cut(refs.select("ref_id", "seq", F.coalesce(protein, F.lit("")).alias("protein")))
    words = held.agg(F.sum(F.greatest(F.length("seq") - 3 * k + 1, F.lit(0)) * 2)).first()[0] or 0
    blocks = max(1, -(-words // max(1, limit)))
    return [References.of(held.filter(F.pmod(F.xxhash64("ref_id", "seq"), F.lit(blocks)) == b).toArrow(), k) for b in range(blocks)]


def frame_scores(genomes: DataFrame, refs: DataFrame, least: float | None = None, k: int = 5, limit: int = SENT_WORDS, compat: bool = False, rule: str | None = "six", places: bool = False) -> DataFrame:
    """``qseqid``, ``sseqid`` and ``score`` of the frames of ``genomes`` and the references that share a k-residue word with them, of any frame of either.

    ``score`` is that of ``hits.score_pairs``: the best of a frame's six proteins, how many of its
    windows of three residues the reference's protein has, by the protein's length.  qseqid is
    ``{genome}:{frame}``.  By the ``rule`` "first" the slice is read from its first base only, and so is
    the reference; "legacy" is the same by windows that don't overlap, as ``kmer_score_legacy`` counts; None gives
    no score.  With ``least`` (and "six") only pairs that reach it are made: a frame that has fewer
    windows than that isn't looked at.  No pair is scored by itself: genomes are read in blocks, and the
    windows that references have are counted for the frames that hold them.

    With ``places`` also genome_id, start0, end0 and ``seq`` of the frame, as ``orf.find_orfs`` gives them, so
    that the few frames that have a pair needn't be looked for among all.

    References are sent to the tasks in blocks of some ``limit`` words, so nothing but the pairs
    leaves a task, however many references there are.  Null and empty sequences have no pairs; null
    names are names like others.
    """
    kind = refs.schema["ref_id"].dataType.simpleString()
    own = genomes.schema["genome_id"].dataType.simpleString()
    out = ["qseqid", "sseqid", *(["score"] if rule else []), *(["genome_id", "start0", "end0", "seq"] if places else [])]

    def scan(block: References) -> DataFrame:
        shared = genomes.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            refs = shared.value
            known = _known(refs, k)
            names: list[str | None] = []
            waiting: list[np.ndarray] = []
            wholes: list[tuple] = []
            letters = LETTERS * WINDOWS // (WINDOWS + 2 * len(refs.window_ref))  # so that a block's windows are bounded

            def flush() -> Iterator[pa.RecordBatch]:
                block = Block.of_genomes(waiting)
                frames, frame, ref, score = _pairs_of(block, refs, k, compat, least, rule, known)
                new = np.flatnonzero(np.append(True, frame[1:] != frame[:-1])[: len(frame)])  # pairs are in order of their frames
                heads = ["" if x is None else f"{x}:" for x in names]
                one = [frames.genome[frame[new]], frames.number[frame[new]], frames.back[frame[new]]]
                named = pa.array([f"{heads[g]}orf{i + 1}{'-r' if back else ''}" for g, i, back in zip(*[x.tolist() for x in one], strict=True)], pa.string())
                which = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(frame))))
                spans = []
                if places:
                    begins = block.base[one[0]]
                    low, high = frames.low[frame[new]] - begins, frames.high[frame[new]] - begins
                    seqs = [wholes[g][1][a : b + 1] for g, a, b in zip(one[0].tolist(), low.tolist(), high.tolist(), strict=True)]
                    spans = [pa.array([wholes[g][0] for g in one[0].tolist()], batch.column(2).type), pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(seqs, pa.string())]
                for x in range(0, len(frame), ROWS_OUT):
                    part = slice(x, x + ROWS_OUT)
                    yield pa.RecordBatch.from_arrays([named.take(pa.array(which[part])), refs.names.take(pa.array(ref[part])), *([pa.array(score[part])] if rule else []), *[s.take(pa.array(which[part])) for s in spans]], out)

            for batch in batches:
                for i in range(batch.num_rows if len(refs.words) else 0):
                    whole = batch.column(1)[i].as_py()
                    text = as_bytes(whole)
                    if len(text) < 3 * k:
                        continue
                    if waiting and held + len(text) > letters:
                        yield from flush()
                        for x in (names, waiting, wholes):
                            x.clear()
                    held = (held if waiting else 0) + len(text)
                    names.append(batch.column(0)[i].as_py())
                    waiting.append(text)
                    if places:
                        wholes.append((batch.column(2)[i].as_py(), whole))
            if waiting:
                yield from flush()

        rows = genomes.select(F.col("genome_id").cast("string").alias("name"), "seq", *(["genome_id"] if places else []))
        return rows.mapInArrow(run, f"qseqid string, sseqid {kind}" + (", score double" if rule else "") + (f", genome_id {own}, start0 int, end0 int, seq string" if places else ""))

    protein = translate_dna(F.col("seq")) if rule in PERIODS else frame_protein(F.col("seq"), compat)
    every = [scan(block) for block in _reference_blocks(refs, k, limit, protein)]
    return functools.reduce(DataFrame.unionByName, every)


def frame_pairs(genomes: DataFrame, refs: DataFrame, k: int = 5, limit: int = SENT_WORDS, compat: bool = False) -> DataFrame:
    """``frame_scores`` without the scores: distinct pairs, for genomes and references of unique names."""
    return frame_scores(genomes, refs, None, k, limit, compat, None)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each ``low`` up to its ``high``, one range after the other, and how many each has."""
    times = high - low
    return np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum()), times
