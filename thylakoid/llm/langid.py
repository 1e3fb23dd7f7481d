"""Language identification: words first, then shorter and shorter character n-grams.

A text's words are runs of letters and marks, lower-cased.  A word of the model's table counts by
its log frequency in each language.  A word that isn't there falls back to the longest n-grams, of
``ORDERS`` characters with a space at each end of the word, of which the table has any: their mean
log frequency is the word's.  A text's language has the highest sum over its words and the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import bounded_batches, durable, fresh
from thylakoid.llm.textkit import U64, as_long, blocks, combine, find_words, hash_spans, mix

#: Rows that the model is fitted on at most: those whose key's hash is smallest.
FIT_ROWS = 20_000
#: Characters of an n-gram, the longest first; 0 stands for whole words.
ORDERS = (4, 3, 2, 1)
#: Words, and n-grams of each order, that the model has at most; the rarer ones are left to the fallback.
WORDS, GRAMS = 200_000, 100_000
#: Times that a word must occur to be known, and what is added to each count.
LEAST, ADDED = 2, 0.1
UNDETERMINED = "und"


class Text(NamedTuple):
    """The distinct words of a block, and its words in order: which of them, and in which text."""

    names: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    word: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def _texts(column: pa.Array) -> Iterator[tuple[int, Text]]:
    """For each block its number of texts and its words."""
    letters = pc.replace_substring_regex(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), r"[^\p{L}\p{M}]+", " ")
    for block in blocks(letters):
        words = find_words(block.data, block.offsets)
        names, at, word = np.unique(hash_spans(block.data, words.start, words.end), return_index=True, return_inverse=True)
        yield block.hi - block.lo, Text(names, words.start[at], words.end[at], block.data, word, words.doc, words.first)


def _grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order the hashes of the n-grams of words, a space at each end, and the number of the word of each."""
    if not len(start):
        return
    size = end - start + 1
    ends = np.cumsum(size)
    raw = np.full(ends[-1] + 1, 0x20, dtype=np.uint8)  # a space before each word and after the last
    place = np.repeat(start - (ends - size) - 1, size) + np.arange(ends[-1])
    inside = np.ones(ends[-1], dtype=bool)
    inside[ends - size] = False
    raw[:-1][inside] = data[place[inside]]
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(U64)
    space = points == U64(0x20)
    owner = np.cumsum(space) - 1  # the space after a word is the next one's; the n-gram's first character tells the word
    hashed = mix(points + U64(0x51))
    spaces = np.concatenate([[0], np.cumsum(space)])
    for n in ORDERS:
        if len(points) < n:
            continue
        at = np.arange(len(points) - n + 1)
        within = spaces[at + n] - spaces[at]
        # spaces stand at the ends of an n-gram alone, and no n-gram is a space
        sound = (within == space[at].astype(np.int64) + (space[at + n - 1] if n > 1 else 0)) & ((n > 1) | ~space[at])
        if n == 2:
            sound &= ~(space[at] & space[at + 1])
        at = at[sound]
        yield n, combine(hashed, n)[at], owner[at]


def _counts(codes: dict[str, int]):
    """Of texts and languages: how often each language has each word and n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.array([codes[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for block, (n, text) in _numbered(_texts(batch.column(0))):
                lang = code[block : block + n][text.doc]
                pairs, times = np.unique(lang * len(text.names) + text.word, return_counts=True)
                sides = [(0, text.names[pairs % len(text.names)], pairs // len(text.names), times)] if len(pairs) else []
                for order, gram, owner in _grams(text.data, text.start, text.end):
                    names, which = np.unique(gram, return_inverse=True)
                    for c in np.unique(lang):
                        often = np.bincount(text.word[lang == c], minlength=len(text.names))
                        total = np.bincount(which, weights=often[owner], minlength=len(names)).astype(np.int64)
                        has = np.flatnonzero(total)
                        sides.append((order, names[has], np.full(len(has), c), total[has]))
                for order, names, lang, total in sides:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), order, dtype=np.int32)), as_long(names), pa.array(lang.astype(np.int32)), pa.array(total)], ["n", "gram", "lang", "times"])

    return run


def _numbered(parts: Iterator[tuple[int, Text]]) -> Iterator[tuple[int, tuple[int, Text]]]:
    """Each part with how many texts come before it."""
    at = 0
    for n, text in parts:
        yield at, (n, text)
        at += n


class Model(NamedTuple):
    """Languages in order, the logarithm of their prior, and by order sorted names with a log frequency in each language."""

    langs: list[str]
    prior: np.ndarray
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    def looked_up(self, n: int, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table of order ``n``, and whether the name is there."""
        known = self.tables[n][0]
        if not len(known):
            return np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=bool)
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        return at, known[at] == names

    def word_logs(self, text: Text) -> np.ndarray:
        """Log frequencies of each distinct word of a block; of a word that nothing is known of, 0 in all languages."""
        at, known = self.looked_up(0, text.names)
        logs = np.zeros((len(text.names), len(self.langs)))
        logs[known] = self.tables[0][1][at[known]]
        open_words = np.flatnonzero(~known)
        done = np.zeros(len(open_words), dtype=bool)
        for n, gram, owner in _grams(text.data, text.start[open_words], text.end[open_words]):
            at, known = self.looked_up(n, gram)
            known &= ~done[owner]
            at, owner = at[known], owner[known]
            many = np.bincount(owner, minlength=len(open_words))
            has = np.flatnonzero(many)
            for c in range(len(self.langs)):
                total = np.bincount(owner, weights=self.tables[n][1][at, c], minlength=len(open_words))
                logs[open_words[has], c] = total[has] / many[has]
            done[has] = True
        return logs

    def judge(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        sums, counts = [np.zeros((0, len(self.langs)))], [np.zeros(0)]
        for n, text in _texts(column):
            logs, total = self.word_logs(text), np.zeros((len(text.doc) + 1, len(self.langs)))
            np.cumsum(logs[text.word], axis=0, out=total[1:])
            sums.append(total[text.first[1:]] - total[text.first[:-1]])
            counts.append(np.diff(text.first))
        lettered = pc.match_substring_regex(column.cast(pa.large_string()).fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
        if not self.langs:
            return [UNDETERMINED] * len(column), np.zeros(len(column))
        total = np.concatenate(sums) + self.prior
        best = total.argmax(axis=1)
        # neighbouring words tell much the same, so a text of n words counts as its square root
        apart = (total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(np.concatenate(counts), 1))[:, None]
        score = 1 / np.exp(apart).sum(axis=1)
        return [self.langs[i] if ok else UNDETERMINED for i, ok in zip(best, lettered, strict=True)], np.where(lettered, score, 0.0)


def fit(docs: DataFrame, train: Column, key: str, text: str, lang: str, limit: int) -> Model:
    """A model of at most ``limit`` rows of ``docs`` with ``train`` and a language; equal texts of a language count once."""
    named = docs.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text")).filter("train and lang is not null and text is not null")
    few = durable(named.select("key", "lang").distinct().orderBy(F.xxhash64("key"), "key", "lang").limit(limit))
    rows = named.join(F.broadcast(few.withColumnRenamed("key", "_key").withColumnRenamed("lang", "_lang")), F.col("key").eqNullSafe(F.col("_key")) & (F.col("lang") == F.col("_lang")))
    rows = durable(rows.select("text", "lang").dropDuplicates())
    shares = sorted(map(tuple, rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()))  # no more than there are rows of the sample
    langs = [x for x, _ in shares]
    prior = np.log(np.array([n for _, n in shares], dtype=float) / max(1, sum(n for _, n in shares)))
    counts = rows.mapInArrow(_counts({x: i for i, x in enumerate(langs)}), "n int, gram long, lang int, times long").groupBy("n", "gram", "lang").agg(F.sum("times").alias("times"))
    whole = durable(counts.groupBy("n", "gram").agg(F.sum("times").alias("total"), F.collect_list(F.struct("lang", "times")).alias("by")))
    tables = {}
    for n in (0, *ORDERS):
        most = WORDS if n == 0 else GRAMS
        held = whole.filter((F.col("n") == n) & (F.col("total") >= (LEAST if n == 0 else 1))).orderBy(F.desc("total"), "gram").limit(most).select("gram", F.col("by.lang").alias("lang"), F.col("by.times").alias("times")).toArrow()
        gram = held.column("gram").to_numpy().view(U64)
        table = np.zeros((len(gram), len(langs)))
        for side in [held.select(["lang", "times"]).combine_chunks()] if len(gram) else []:
            lists, times = side.column("lang").combine_chunks(), side.column("times").combine_chunks()
            row = np.repeat(np.arange(len(gram)), np.diff(lists.offsets.to_numpy()))
            table[row, lists.flatten().to_numpy()] = times.flatten().to_numpy()
        order = np.argsort(gram)
        logs = np.log(table + ADDED) - np.log(table.sum(axis=0) + ADDED * max(1, len(gram)))
        tables[n] = (gram[order], logs[order])
    return Model(langs, prior, tables)


def identify(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", limit: int = FIT_ROWS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learned from ``lang`` of rows with ``train`` (null: not).

    ``lang_pred`` is a language of those rows, the first in order of equals, or ``und`` where the
    text is null or has no letter, or where nothing is learned; ``score``, from 0 to 1, is 0 for
    ``und``.  A prediction follows from the text alone.  The model is fitted on ``limit`` rows at
    most and is of bounded size; every whole text is judged in one pass without a shuffle.  Equal
    texts are judged alike, rows that repeat are all returned, null keys are keys like others, and an empty table
    stays empty.  Columns named ``lang_pred`` and ``score`` are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(fit(docs, train, key, text, lang, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score = shared.value.judge(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(score)], [*batch.schema.names[:-1], "lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    taken = docs.select(*kept, F.col(text).alias(fresh(docs, "text")))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])
    return taken.mapInArrow(run, f"{fields}lang_pred string, score double")
