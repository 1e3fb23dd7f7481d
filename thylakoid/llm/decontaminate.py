"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are lower-cased and freed of ASCII punctuation.  The benchmark is the query set: it goes to the
tasks in blocks of INDEX_WORDS words, so a document meets the items that it shares an n-gram with
where it is read, and nothing is shuffled, however frequent an n-gram is.  A seed counts only for an
item of which the document has a rare word too: an alignment that reaches the score matches so many
of the item's words that one of the rarest, as many as it can miss and one more, is among them.  That spares
passages that share nothing but common phrases, and loses no alignment.  The item is then aligned with
what lies around the seeds, as far as it could reach, which finds edited copies too; only pairs that
provably can't reach the score are spared the alignment.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import BROADCAST_ROWS, bounded_batches, durable
from thylakoid.llm.textkit import LOWER, NOT_PUNCTUATION, U64, Words, blocks, combine, compact, find_words, hash_spans, ngrams

#: Words of a seed.
SEED = 3
#: Words of a block of the benchmark that is sent to every task (some 40 MB).
INDEX_WORDS = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Part of an item's own score that an alignment must reach.
LEAST = 0.5


def _words(column: pa.Array) -> Iterator[tuple[int, Words, np.ndarray]]:
    for block in blocks(column):
        data, offsets = compact(block.data, block.offsets, NOT_PUNCTUATION, LOWER)
        words = find_words(data, offsets)
        yield block.hi - block.lo, words, hash_spans(data, words.start, words.end)


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Best local score of two word sequences, and the words of each (from 0) up to which it reaches."""
    ramp = np.arange(len(b) + 1) * -GAP
    above = np.zeros(len(b) + 1, dtype=np.int64)
    best = (0, 0, 0)
    for i, x in enumerate(a):
        row = np.zeros(len(b) + 1, dtype=np.int64)
        np.maximum(above[:-1] + np.where(b == x, MATCH, MISMATCH), above[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), i + 1, top)
        above = row
    return best


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int, int]:
    """Score, and the aligned word ranges of the item and of the text."""
    score, i, j = smith_waterman(item, text)
    _, back_i, back_j = smith_waterman(item[:i][::-1], text[:j][::-1])
    return score, i - back_i, i, j - back_j, j


def reach(n: int, least: float) -> int:
    """Words of a text that an alignment of ``least`` with an item of ``n`` words may span."""
    return n + math.floor(MATCH * n * (1 - least) / min(-MISMATCH, -GAP) + 1e-9)


def reachable(item: np.ndarray, text: np.ndarray, least: float) -> bool:
    """False only if no alignment can reach ``least``.

    Each edit costs one at least, so an alignment that reaches it spans at most as many words of
    the text as the item and the edits that it can afford have, and its matches lie among them.
    """
    need, span = math.ceil(least * len(item) - 1e-9), reach(len(item), least)
    shared = np.concatenate([[0], np.cumsum(np.isin(text, item))])
    return int((shared[span:] - shared[:-span]).max() if len(text) > span else shared[-1]) >= need


def benchmark_words(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """``item`` and ``words`` (32-bit hashes) of each benchmark row with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, words, hashes in _words(batch.column(1)):
                found += [hashes[words.first[i] : words.first[i + 1]].view(np.int64) for i in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tolist() for x in found], pa.list_(pa.int64()))], ["item", "words"])

    taken = benchmark.select(F.col(key).alias("item"), F.col(text).alias("text"))
    return taken.mapInArrow(run, f"item {taken.schema['item'].dataType.simpleString()}, words array<long>").filter("size(words) > 0")


def _runs(owner: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal values begin and end."""
    cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])).tolist() if len(owner) else []
    return cut, [*cut[1:], len(owner)] if cut else []


def best_alignment(item: np.ndarray, text: np.ndarray, spots: np.ndarray, least: float) -> tuple[int, int, int, int, int]:
    """The best alignment of an item around its seeds in a text, of equals the first: score, item range, text range.

    Seeds that one alignment could hold are looked at together.
    """
    margin = reach(len(item), least)
    spots = np.sort(spots)
    lo, hi = np.maximum(spots - margin, 0), np.minimum(spots + margin, len(text))
    cut = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    best = (0, 0, 0, 0, 0)
    for x, y in zip(cut.tolist(), [*cut[1:].tolist(), len(spots)], strict=True):
        begins, around = int(lo[x]), text[lo[x] : hi[y - 1]]
        if reachable(item, around, least):
            score, i0, i1, t0, t1 = align(item, around)
            if score > best[0]:
                best = (score, i0, i1, begins + t0, begins + t1)
    return best


def rare_words(words: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Words of which an alignment of ``least`` matches one, and the item of each: an item's rarest in ``words``, as many as such an alignment can miss and one more."""
    often = Counter(w for item in words for w in np.unique(item).tolist())
    found, owner = [], []
    for i, item in enumerate(words):
        known, times = np.unique(item, return_counts=True)
        order = np.argsort([often[w] for w in known.tolist()], kind="stable")
        can_miss = len(item) - max(1, math.ceil(least * len(item) - 1e-9))
        taken = np.searchsorted(np.cumsum(times[order]), can_miss, side="right") + 1
        found.append(known[order[:taken]])
        owner.append(np.full(len(found[-1]), i))
    return np.concatenate([*found, np.zeros(0, dtype=U64)]), np.concatenate([*owner, np.zeros(0, dtype=np.int64)])


class Postings(NamedTuple):
    """Hashes in order, each with the items that hold it."""

    known: np.ndarray
    first: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, item: np.ndarray) -> Postings:
        by = np.lexsort((item, hashes))
        known, first = np.unique(hashes[by], return_index=True)
        return cls(known, np.append(first, len(hashes)), item[by])

    def met(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each of ``hashes`` that is known, its number, once for each item that holds it, and the item."""
        if not len(self.known) or not len(hashes):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        at = np.flatnonzero(self.known[place] == hashes)
        place = place[at]
        times = self.first[place + 1] - self.first[place]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at, times), self.item[np.repeat(self.first[place], times) + within]


class Index(NamedTuple):
    """A block of the benchmark: postings of its n-grams, of each of ``lengths`` words, and of its rare words, and the items' words (32-bit hashes)."""

    grams: Postings
    rare: Postings
    refs: np.ndarray
    words: list[np.ndarray]
    lengths: list[int]

    @classmethod
    def of(cls, items: pa.Table, n: int, least: float) -> Index:
        """Of a table of ``ref`` and ``words``; an item of fewer than ``n`` words is one n-gram."""
        order = np.argsort(items.column("ref").to_numpy())
        words = [np.asarray(w.values).view(U64) for w in items.column("words").take(pa.array(order))]
        grams = [np.unique(combine(w, min(n, len(w)))) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(g) for g in grams])
        return cls(Postings.of(np.concatenate([*grams, np.zeros(0, dtype=U64)]), owner), Postings.of(*rare_words(words, least)), items.column("ref").to_numpy()[order], [w.view(np.int64).astype(np.int32) for w in words], sorted({min(n, len(w)) for w in words}))


FIT = ["score", "item_start", "item_end", "doc_start", "doc_end"]


def find_pairs(words: Words, hashes: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, item and first word of each seed of a block, in this order: n-grams that count."""
    spots, items = [], []
    for length in index.lengths:
        runs, at = ngrams(words, hashes, length)
        place, item = index.grams.met(runs)
        spots.append(at[place])
        items.append(item)
    spot, item = np.concatenate([*spots, np.zeros(0, dtype=np.int64)]), np.concatenate([*items, np.zeros(0, dtype=np.int64)])
    owner = words.doc[spot]
    # rare words are looked up in texts that have seeds
    seeded = np.zeros(len(words.first), dtype=bool)
    seeded[owner] = True
    inside = np.flatnonzero(seeded[words.doc])
    at, of = index.rare.met(hashes[inside])
    good = np.isin(owner * len(index.words) + item, words.doc[inside[at]] * len(index.words) + of)
    spot, item, owner = spot[good], item[good], owner[good]
    order = np.lexsort((spot, item, owner))
    return owner[order], item[order], spot[order]


def align_in_place(docs: DataFrame, key: str, text: str, index: Index, least: float) -> DataFrame:
    """``doc``, ``ref``, ``n`` (the item's words) and the alignment for each document and item of a block of the benchmark: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            at_row, doc, rows = 0, [], []
            for n, words, hashes in _words(batch.column(1)):
                owner, item, spot = find_pairs(words, hashes, index)
                for x, y in zip(*_runs(owner * len(index.words) + item), strict=True):
                    first, end, one = words.first[owner[x]], words.first[owner[x] + 1], index.words[item[x]]
                    fit = best_alignment(one, hashes[first:end].view(np.int64).astype(np.int32), spot[x:y] - first, least)
                    if fit[0] >= least * MATCH * len(one):
                        doc.append(at_row + int(owner[x]))
                        rows.append((int(index.refs[item[x]]), len(one), *fit))
                at_row += n
            if doc:
                columns = [pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i] for r in rows], pa.int32()) for i in range(1, 7)]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *columns], ["doc", "ref", "n", *FIT])

    taken = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    return taken.mapInArrow(run, f"doc {taken.schema['doc'].dataType.simpleString()}, ref long, n int, " + ", ".join(f"{c} int" for c in FIT))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", n: int = SEED, least: float = LEAST) -> DataFrame:
    """A row for each document and the item that it holds a copy of.

    ``similarity`` is the alignment's score by the item's own, ``score``; ``doc_start``,
    ``doc_end``, ``item_start`` and ``item_end`` tell the aligned words (from 0, end exclusive).
    Of several copies of an item in a document the best counts, then the first.  Null and empty
    texts and items match nothing, and rows that repeat a document give one row for an item.  An
    item of fewer than ``n`` words is its own seed.  Null keys are keys like others.  Other columns
    aren't read.
    """
    bounded_batches(docs.sparkSession)
    items = durable(benchmark_words(benchmark, item_key, item_text).withColumn("ref", F.xxhash64("item", "words")).dropDuplicates(["ref"]))
    n_words, n_items = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-n_words // INDEX_WORDS))
    found = []
    for part in range(parts):
        index = Index.of(items.filter(F.pmod(F.col("ref"), F.lit(parts)) == part).select("ref", "words").toArrow(), n, least)
        if len(index.words) or part == parts - 1 and not found:
            found.append(align_in_place(docs, key, text, index, least))
    wide = functools.reduce(DataFrame.unionByName, found)
    names = items.select("ref", "item")
    names = F.broadcast(names) if n_items <= BROADCAST_ROWS else names
    wide = wide.withColumn("similarity", F.col("score") / (MATCH * F.col("n"))).filter(F.col("similarity") >= least)
    wide = wide.join(names, "ref")
    # several texts of one key, and several items
    rest = ["similarity", *FIT]
    best = wide.groupBy("doc", "item").agg(F.max_by(F.struct(*rest), F.struct("score", -F.col("doc_start"), -F.col("doc_end"), -F.col("item_start"))).alias("best"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item_key), *[F.col(f"best.{c}").alias(c) for c in ["similarity", "score", "doc_start", "doc_end", "item_start", "item_end"]])
