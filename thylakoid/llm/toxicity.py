"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates over the words of a whole text: of words of a lexicon that is learned from
labelled texts, in tiers by how strongly a word tells toxic texts; of such words near a second
person; of capitals and punctuation; and of obfuscated lexicon words, that is, words that are in
the lexicon only after look-alike digits and signs are read as letters and other signs are left
out.  Where the text is from, its language and its key are never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.boosting import fit, probabilities
from thylakoid.llm.common import bounded_batches, durable, fresh
from thylakoid.llm.textkit import IS_SPACE, LOWER, NOT_PUNCTUATION, U64, as_long, blocks, combine, compact, find_words, hash_spans, ngrams

#: Labelled rows that the model is fitted on at most: those whose key's hash is smallest.
FIT_ROWS = 20_000
#: Words that the lexicon has at most, and labelled texts with the word, for a word to be in it.
LEXICON, LEAST_TEXTS = 400, 5
#: Second-person words of the four languages, and signs read as letters.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted vosotros".split()
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
NEAR = 5
FEATURES = [
    "strong", "medium", "weak", "strong_count", "any_count", "peak", "near_you", "you", "capitals", "punctuation", "shouting", "obfuscated", "obfuscated_count", "signs_inside", "distinct", "length",
]

_READ = LOWER.copy()
for _sign, _letter in LOOK_ALIKE.items():
    _READ[ord(_sign)] = ord(_letter)
_KEEP = NOT_PUNCTUATION.copy()
_KEEP[[ord(c) for c in LOOK_ALIKE]] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SIGN = ~NOT_PUNCTUATION


def _hash_list(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
    return hash_spans(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends)


_YOU = np.unique(_hash_list(SECOND_PERSON))


def _views(block):
    """Words of a block, each as written (punctuation trimmed) and as read; by word: text, both hashes."""
    data, offsets = block.data, block.offsets
    words = find_words(data, offsets)
    total = np.zeros(len(data) + 1, dtype=np.int64)

    def hashed(keep: np.ndarray, becomes: np.ndarray) -> np.ndarray:
        np.cumsum(keep[data], out=total[1:])
        small, _ = compact(data, offsets, keep, becomes)
        return hash_spans(small, total[words.start], total[words.end])

    return words, hashed(NOT_PUNCTUATION, LOWER), hashed(_KEEP, _READ)


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def features(column: pa.Array, lexicon: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text; ``lexicon`` has sorted word hashes and ``weight`` their log-odds."""
    out = []
    lexicon = lexicon if len(lexicon) else np.zeros(1, dtype=U64)
    weight = weight if len(weight) else np.zeros(1)
    for block in blocks(column):
        words, plain, read = _views(block)
        n = np.diff(words.first)
        per = 1.0 / np.maximum(n, 1)

        def looked_up(hashes: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
            return np.where(lexicon[at] == hashes, weight[at], 0.0)

        told, hidden = looked_up(plain), looked_up(read)
        hidden = np.where(told > 0, 0.0, hidden)
        value = np.maximum(told, hidden)
        you = np.isin(plain, _YOU)
        hit = value > 0
        beside = np.zeros(len(hit), dtype=bool)
        for shift in range(1, NEAR + 1):
            same = words.doc[shift:] == words.doc[:-shift]
            beside[shift:] |= you[:-shift] & same
            beside[:-shift] |= you[shift:] & same
        capitals = np.zeros(len(block.data) + 1)
        np.cumsum(_CAPITAL[block.data], out=capitals[1:])
        signs = np.zeros(len(block.data) + 1)
        np.cumsum(_SIGN[block.data], out=signs[1:])
        letters = np.zeros(len(block.data) + 1)
        np.cumsum(~IS_SPACE[block.data], out=letters[1:])
        per_char = lambda s: (s[block.offsets[1:]] - s[block.offsets[:-1]]) / np.maximum(letters[block.offsets[1:]] - letters[block.offsets[:-1]], 1)
        width = words.end - words.start
        loud = (capitals[words.end] - capitals[words.start] == width) & (width > 1)
        inside = signs[np.maximum(words.end - 1, words.start)] - signs[np.minimum(words.start + 1, words.end)] > 0
        peak = np.zeros(len(n))
        np.maximum.at(peak, words.doc, value)
        distinct = np.zeros(len(n))
        pairs = np.unique(np.stack([words.doc[hit], np.searchsorted(lexicon, np.where(told > 0, plain, read)[hit])], axis=1), axis=0)
        distinct += np.bincount(pairs[:, 0], minlength=len(n))
        rows = [
            _sums(value >= 3, words.first) * per, _sums((value >= 1.5) & (value < 3), words.first) * per, _sums(hit & (value < 1.5), words.first) * per,
            _sums(value >= 3, words.first), _sums(hit, words.first), peak, _sums(hit & beside, words.first) * per, _sums(you, words.first) * per,
            per_char(capitals), per_char(signs), _sums(loud, words.first) * per, _sums(hidden > 0, words.first) * per, _sums(hidden > 0, words.first),
            _sums(inside, words.first) * per, distinct, np.log1p(n),
        ]
        out.append(np.stack(rows, axis=1))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def sketches(text: pa.Array) -> pa.Array:
    """The smallest hash of a text's five-word runs, which near copies mostly share; of fewer words, of all."""
    out = []
    for block in blocks(text):
        words, plain, _ = _views(block)
        runs, at = ngrams(words, plain, 5)
        cut = np.searchsorted(at, words.first)
        for i in range(block.hi - block.lo):
            own = runs[cut[i] : cut[i + 1]]
            whole = plain[words.first[i] : words.first[i + 1]]
            out.append(own.min() if len(own) else combine(whole, len(whole))[0] if len(whole) else U64(0))
    return as_long(np.array(out, dtype=U64))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        parts = []
        for block in blocks(batch.column(0)):
            words, plain, read = _views(block)
            doc = np.concatenate([words.doc, words.doc]).astype(U64)
            pair = np.unique(np.stack([np.concatenate([plain, read]), doc], axis=1), axis=0)
            toxic = label[block.lo : block.hi][pair[:, 1].astype(np.int64)] == 1
            parts.append((pair[:, 0], toxic))
        if parts:
            word, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            toxic = np.concatenate([p[1] for p in parts])
            yield pa.RecordBatch.from_arrays([as_long(word), pa.array(np.bincount(at[toxic], minlength=len(word))), pa.array(np.bincount(at[~toxic], minlength=len(word)))], ["word", "toxic", "clean"])


def fitting_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, limit: int) -> DataFrame:
    """``text``, ``label`` and ``apart`` of at most ``limit`` labelled texts; a label of a key with several is their largest.

    Copies and near copies count once: otherwise every word of a toxic text that occurs many times
    would seem to tell toxic texts.
    """
    few = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("label"))
    few = durable(few.orderBy(F.xxhash64("_key"), "_key").limit(limit))
    sketch = F.arrow_udf(sketches, "long")
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(few), F.col("_id") == F.col("_key"))
    rows = rows.select("_key", F.coalesce("text", F.lit("")).alias("text"), "label", sketch(F.coalesce("text", F.lit(""))).alias("sketch"))
    rows = rows.groupBy("sketch").agg(F.min(F.struct("_key", "text", "label")).alias("r")).select("r.*")
    return rows.select("text", "label", (F.pmod(F.xxhash64(F.lit(5), "_key"), F.lit(4)) == 0).alias("apart"))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", limit: int = FIT_ROWS) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, learned from ``labels`` (key, label).

    The lexicon and the trees are fitted on at most ``limit`` labelled rows, three in four for the
    lexicon and the trees and one for the calibration, which so sees features of texts that are new; scoring reads every whole text in one pass without a
    shuffle.  Null and empty texts have the features of no words and so a score like any other; without any
    usable label all scores are alike.  Equal rows score alike; an empty table stays empty.  A
    column named ``score`` is replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = durable(fitting_rows(docs, labels, key, text, label, limit))
    n_toxic, n_clean = rows.filter(~F.col("apart")).agg(F.coalesce(F.sum("label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("label")), F.lit(0))).first()
    words = rows.filter(~F.col("apart")).select("text", "label").mapInArrow(_word_counts, "word long, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    a, b = (F.col("toxic") + 0.5) / (n_toxic + 1), (F.col("clean") + 0.5) / (n_clean + 1)
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    words = words.withColumn("odds", F.log(a) - F.log(b)).withColumn("sure", F.col("odds") / spread)
    found = words.filter((F.col("toxic") >= LEAST_TEXTS) & (F.col("sure") >= 3)).orderBy(F.desc("sure"), "word").limit(LEXICON).select("word", "odds").collect()
    lexicon = np.array([r.word for r in found], dtype=np.int64).view(U64)
    order = np.argsort(lexicon)
    lexicon, weight = lexicon[order], np.array([r.odds for r in found])[order]

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(0), lexicon, weight)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "label", "apart"])

    sample = rows.mapInArrow(sampled, "x array<double>, label int, apart boolean").collect()  # at most ``limit`` rows of 16 numbers
    sample.sort(key=lambda r: (r.apart, r.label, r.x))
    x = np.array([r.x for r in sample]).reshape(len(sample), len(FEATURES))
    shared = spark.sparkContext.broadcast((fit(x, np.array([r.label for r in sample], dtype=float), np.array([r.apart for r in sample], dtype=bool)), lexicon, weight))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lexicon, weight = shared.value
        for batch in batches:
            score = probabilities(model, features(batch.column(batch.num_columns - 1), lexicon, weight))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], [*batch.schema.names[:-1], "score"])

    kept = [c for c in docs.columns if c != "score"]
    taken = docs.select(*kept, F.col(text).alias(fresh(docs, "text")))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])
    return taken.mapInArrow(scored, f"{fields}score double")
