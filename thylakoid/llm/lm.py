"""Language-model scoring by deleted interpolation of bigrams.

The probability of a word w after v mixes three maximum-likelihood estimates: c(v,w)/c(v), c(w)/N
and 1/(V+1).  The weights of the mixture depend on how frequent v is: contexts fall into buckets
by powers of two of c(v), and each bucket's weights are learned by expectation-maximisation on
counts that are held out from the training texts, against counts of the rest.  The model then
counts all training texts.

Counts cover every n-gram of every training text, and no table of them is held in one place:

1. Texts are cut into chunks of about ``CHUNK_BYTES``: the words of a chunk, and the numbers of
   its tokens among them.  Held-out texts have chunks of their own.  Chunks are durable.
2. A chunk asks for the counts of its distinct words and word pairs.  Their 64-bit hashes go, with
   the chunk's own counts, to the task of their hash range, which adds up and answers each chunk
   in the order of its question.  A key is in a chunk's question once, so a word that makes up a
   third of all tokens is one entry of each chunk like any other.
3. With the answers a chunk knows all that its scores need.  Held-out chunks give the statistics
   that the weights are learned from; then every chunk scores its texts.

There are as many hash ranges as keep one below ``PART_TOKENS`` tokens, so a task's memory doesn't
grow with the corpus.  Where a chunk's question to a range would have fewer than ``MESSAGE_KEYS``
keys, that is from some ten billion tokens on, questions aren't packed: each key of a chunk is a row, rows are added
up by key and joined back, and the shuffles grow with the tokens alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import bounded_batches, durable
from thylakoid.llm.textkit import LOWER, U64, as_long, blocks, find_words, hash_spans, mix

#: Bytes of text in a chunk, and tokens whose n-grams one task counts; what tasks hold is in proportion.
CHUNK_BYTES, PART_TOKENS = 12 << 20, 3_000_000
#: Keys of a chunk's question to a hash range below which keys go as rows.
MESSAGE_KEYS = 500
#: Rows that a task lets go of at once.
ROWS_OUT = 1 << 17
#: Of the training texts one in HELD has its counts held out for the weights.
HELD = 10
END, START = U64(1), U64(2)
#: Buckets of contexts, and cells of estimates: STEPS to an octave, GRID for those that are 0.
BUCKETS, STEPS, GRID = 48, 2, 96
#: Parts of an octave to which a cell's mean estimate is kept.
FINE = 1 << 10
ROUNDS = 100


class Totals(NamedTuple):
    """Training tokens without and with the held-out texts, distinct ones, and the weights by bucket."""

    n_rest: int
    n_every: int
    n_words: int
    weights: np.ndarray | None


# --- arrays as bytes ---


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: their number and lengths, then their bytes by significance, compressed."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return np.array([len(arrays), *map(len, arrays)], dtype=np.int64).tobytes() + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(raw: bytes, kinds: str) -> list[np.ndarray]:
    """Arrays of types Q, I or B (unsigned, of 8, 4 and 1 bytes)."""
    head = 8 * (len(kinds) + 1)
    sizes = np.frombuffer(raw, dtype=np.int64, count=len(kinds) + 1)[1:].tolist()
    widths = [np.dtype(k).itemsize for k in kinds]
    body = pa.decompress(memoryview(raw)[head:], decompressed_size=sum(n * w for n, w in zip(sizes, widths, strict=True)), codec="zstd")
    body, at, out = np.frombuffer(body, dtype=np.uint8), 0, []
    for n, kind, width in zip(sizes, kinds, widths, strict=True):
        out.append(np.ascontiguousarray(body[at : at + n * width].reshape(width, n).T).reshape(-1).view(kind))
        at += n * width
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the differences between neighbours, which ``np.cumsum`` undoes."""
    out = keys.copy()
    out[1:] -= keys[:-1]
    return out


# --- chunks ---


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each with its end; and the number of tokens of each text."""
    found, counts = [], []
    for block in blocks(column):
        data = LOWER[block.data]
        words = find_words(data, block.offsets)
        found.append(hash_spans(data, words.start, words.end))
        counts.append(np.diff(words.first))
    count = np.concatenate(counts) + 1
    tokens = np.full(count.sum(), END, dtype=U64)
    inside = np.ones(len(tokens), dtype=bool)
    inside[np.cumsum(count) - 1] = False
    tokens[inside] = np.concatenate(found)
    return tokens, count


class Chunk(NamedTuple):
    """Distinct word hashes, most frequent first; the number of each token among them; tokens and training flag of each text."""

    words: np.ndarray
    ids: np.ndarray
    count: np.ndarray
    train: np.ndarray

    @classmethod
    def of(cls, tokens: np.ndarray, count: np.ndarray, train: np.ndarray) -> Chunk:
        words, ids, often = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(words), dtype=np.int64)
        place[order] = np.arange(len(words))
        return cls(words[order], place[ids], count, train)

    @classmethod
    def read(cls, raw: bytes) -> Chunk:
        words, ids, count, train = unpack(raw, "QIIB")
        return cls(words, ids.astype(np.int64), count.astype(np.int64), train.astype(bool))

    def packed(self) -> bytes:
        return pack(self.words, self.ids.astype(np.uint32), self.count.astype(np.uint32), self.train.astype(np.uint8))

    def pairs(self) -> np.ndarray:
        """For each token a number that tells the word before it and itself; a text's beginning is a word before."""
        before = np.empty(len(self.ids), dtype=np.int64)
        before[1:] = self.ids[:-1]
        before[np.cumsum(self.count) - self.count] = len(self.words)
        return before * len(self.words) + self.ids

    def pair_keys(self, pairs: np.ndarray) -> np.ndarray:
        """Hashes of distinct pairs; 64 bits, as those of words."""
        before = np.append(self.words, START)[pairs // len(self.words)]
        return mix(before * U64(0x9E3779B97F4A7C15) + mix(self.words[pairs % len(self.words)] + U64(0xD6E8FEB86659FD93)))


CHUNKS = "chunk long, held boolean, n_tokens long, n_train long, payload binary"


def _cut_chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        waiting: dict[bool, list] = {False: [], True: []}

        def chunk(held: bool) -> pa.RecordBatch:
            nonlocal made
            names, tokens, count, train, _ = zip(*waiting[held], strict=True)
            waiting[held] = []
            found = Chunk.of(np.concatenate(tokens), np.concatenate(count), np.concatenate(train))
            keys = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in names])
            made += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + made - 1], pa.int64()), pa.array([held]), pa.array([len(found.ids)], pa.int64()), pa.array([int(found.count[found.train].sum())], pa.int64()), pa.array([found.packed()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                ],
                ["chunk", "held", "n_tokens", "n_train", "payload", "keys"],
            )

        for batch in batches:
            train, apart = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3))
            for held in (False, True):
                rows = np.flatnonzero(apart == held)
                if len(rows):
                    own = batch.take(pa.array(rows)) if len(rows) < batch.num_rows else batch
                    tokens, count = _tokens(own.column(1))
                    waiting[held].append((own.column(0), tokens, count, train[rows], own.column(1).nbytes))
                    if sum(w[-1] for w in waiting[held]) >= size:
                        yield chunk(held)
        for held in (False, True):
            if waiting[held]:
                yield chunk(held)

    return run


# --- counting ---


MESSAGES = "part long, chunk long, held boolean, payload binary"
ANSWERS = "part long, chunk long, held boolean, n_words long, payload binary"


def _edges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the keys of each part begin among sorted keys, and their number; parts are equal ranges of hashes."""
    bounds = [((p << 32) + parts - 1) // parts << 32 for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, dtype=U64)), [len(keys)]]).astype(np.int64)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def counted(chunk: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chunk's distinct words, and its distinct pairs, as sorted keys, each with its training tokens."""
    trained = np.repeat(chunk.train, chunk.count)
    word_count = np.bincount(chunk.ids[trained], minlength=len(chunk.words))
    pairs = chunk.pairs() * 2 + trained
    pairs.sort()
    first = _distinct(pairs >> 1)
    pair_count = np.add.reduceat(pairs & 1, first)
    sides = []
    for keys, count in ((chunk.words, word_count), (chunk.pair_keys(pairs[first] >> 1), pair_count)):
        order = np.argsort(keys)
        sides.append((keys[order], count[order].astype(np.uint32)))
    return sides


def questions(chunk: Chunk, parts: int) -> Iterator[tuple[int, bytes]]:
    """For each part the chunk's distinct words and pairs there, each with its training tokens."""
    sides = [(keys, count, _edges(keys, parts)) for keys, count in counted(chunk)]
    for p in range(parts):
        cut = [(keys[at[p] : at[p + 1]], count[at[p] : at[p + 1]]) for keys, count, at in sides]
        if any(len(keys) for keys, _ in cut):
            yield p, pack(*[x for keys, count in cut for x in (_steps(keys), count)])


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, held, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                found = list(questions(Chunk.read(raw), parts))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.int64()), pa.array([name] * n, pa.int64()), pa.array([held] * n), pa.array([x for _, x in found], pa.binary())], ["part", "chunk", "held", "payload"]
                )

    return run


def _totals(keys: list[np.ndarray], counts: list[np.ndarray], held: list[bool]) -> tuple[np.ndarray, np.ndarray, int]:
    """For each key of all lists its total, and that of the held-out lists; and how many distinct keys have any."""
    joined, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    apart = np.repeat(held, [len(k) for k in keys])
    if not len(joined):
        return count, count, 0
    order = np.argsort(joined)
    first = _distinct(joined[order])
    group = np.zeros(len(joined), dtype=np.int64)
    group[first[1:]] = 1
    group = np.cumsum(group)
    out = []
    for values in (count, np.where(apart, count, 0)):
        sums = np.add.reduceat(values[order], first)
        spread = np.empty(len(joined), dtype=np.int64)
        spread[order] = sums[group]
        out.append((spread, sums))
    return out[0][0], out[1][0], int((out[0][1] > 0).sum())


def _answer(table: pa.Table) -> pa.Table:
    """The totals of a part's words and pairs, for each chunk in the order in which it asked."""
    part = table.column("part")[0].as_py()
    chunks, held = table.column("chunk").to_pylist(), table.column("held").to_pylist()
    asked = [unpack(x.as_py(), "QIQI") for x in table.column("payload")]
    answers, n_words = [], 0
    for side in (0, 2):
        keys = [np.cumsum(a[side], dtype=U64) for a in asked]
        every, apart, n = _totals(keys, [a[side + 1] for a in asked], held)
        n_words = n_words if side else n
        ends = np.cumsum([len(k) for k in keys])[:-1]
        answers.append((np.split(every.astype(U64), ends), np.split(apart.astype(U64), ends)))
    packed = [pack(*x) for x in zip(*answers[0], *answers[1], strict=True)]
    n = len(chunks)
    return pa.table({
        "part": pa.array([part] * n, pa.int64()), "chunk": pa.array(chunks, pa.int64()), "held": pa.array(held), "n_words": pa.array([n_words] + [0] * (n - 1), pa.int64()), "payload": pa.array(packed, pa.binary()),
    })


def _ask_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct word (side 0) and pair (side 1) of a chunk."""
    for batch in batches:
        for name, held, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            for side, (keys, count) in enumerate(counted(Chunk.read(raw))):
                for at in range(0, len(keys), ROWS_OUT):
                    n = len(keys[at : at + ROWS_OUT])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, side, dtype=np.int32)), as_long(keys[at : at + ROWS_OUT]), pa.array(np.full(n, name)), pa.array(np.full(n, held)), pa.array(count[at : at + ROWS_OUT].astype(np.int64))],
                        ["side", "key", "chunk", "held", "times"],
                    )


def _packed_rows(table: pa.Table) -> pa.Table:
    """The answers to a chunk, whose keys came as rows, as one message."""
    side, key = table.column("side").to_numpy(), table.column("key").to_numpy().view(U64)
    order = np.lexsort((key, side))
    cut = int((side == 0).sum())
    every, apart = (table.column(c).to_numpy()[order].astype(U64) for c in ("every", "apart"))
    payload = pack(every[:cut], apart[:cut], every[cut:], apart[cut:])
    return pa.table({"part": pa.array([0], pa.int64()), "chunk": table.column("chunk").slice(0, 1), "held": table.column("held").slice(0, 1), "n_words": pa.array([0], pa.int64()), "payload": pa.array([payload], pa.binary())})


def answer_rows(chunks: DataFrame) -> tuple[DataFrame, int]:
    """Durable answers to all chunks, and how many distinct words are in training texts, by rows: shuffles that grow with the keys alone."""
    asked = chunks.select("chunk", "held", "payload").mapInArrow(_ask_rows, "side int, key long, chunk long, held boolean, times long")
    totals = durable(asked.groupBy("side", "key").agg(F.sum("times").alias("every"), F.sum(F.when(F.col("held"), F.col("times")).otherwise(0)).alias("apart")))
    answers = asked.drop("times").join(totals, ["side", "key"]).groupBy("chunk").applyInArrow(_packed_rows, ANSWERS)
    return durable(answers), totals.filter("side = 0 and every > 0").count()


# --- what a chunk does with the answers ---


class Answered(NamedTuple):
    """A chunk's tokens in order of their pairs: the order, where each pair begins, and the counts that it needs."""

    order: np.ndarray
    first: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    context: np.ndarray


def answered(chunk: Chunk, answers: list[bytes], held: bool) -> tuple[np.ndarray, Answered]:
    """Counts of the chunk's words, and of its pairs: of all training texts, or of those not held out."""
    given = [unpack(x, "QQQQ") for x in answers]
    totals = []
    for every, apart in ((0, 1), (2, 3)):
        total = np.concatenate([g[every] for g in given]).astype(np.int64)
        totals.append(total - np.concatenate([g[apart] for g in given]).astype(np.int64) if held else total)
    words = np.empty(len(chunk.words), dtype=np.int64)
    words[np.argsort(chunk.words)] = totals[0]
    pairs = chunk.pairs()
    order = np.argsort(pairs)
    pairs = pairs[order]
    first = _distinct(pairs)
    pairs = pairs[first]
    found = np.empty(len(pairs), dtype=np.int64)
    found[np.argsort(chunk.pair_keys(pairs))] = totals[1]
    ends = words[np.flatnonzero(chunk.words == END)[0]]  # as many texts begin as end
    context = np.append(words, ends)[pairs // len(chunk.words)]
    return words, Answered(order, first, words[pairs % len(chunk.words)], found, context)


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for a context that doesn't occur, else 1 and the power of two."""
    return np.where(count > 0, np.minimum(1 + np.log2(np.maximum(count, 1)).astype(np.int64), BUCKETS - 1), 0)


def statistics(totals: Totals, found: Answered, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cells of (bucket, pair estimate, word estimate), their held-out tokens, and these times the estimates' -log2."""
    sides, fine = [bucket(found.context)], []
    for p in (found.pair / np.maximum(found.context, 1), found.word / max(totals.n_rest, 1)):
        depth = -np.log2(np.where(p > 0, p, 1.0))
        sides.append(np.where(p > 0, np.minimum((depth * STEPS).astype(np.int64), GRID - 1), GRID))
        fine.append(np.rint(depth * FINE).astype(np.int64))
    names, at = np.unique((sides[0] * (GRID + 1) + sides[1]) * (GRID + 1) + sides[2], return_inverse=True)
    sums = [np.zeros(len(names), dtype=np.int64) for _ in range(3)]
    for total, values in zip(sums, (times, times * fine[0], times * fine[1]), strict=True):
        np.add.at(total, at, values)
    return names, *sums


def learn_weights(cells: np.ndarray, mass: np.ndarray, depth: np.ndarray, floor: float) -> np.ndarray:
    """Weights (pair, word, floor) of each bucket by EM over cells, their held-out tokens and mean -log2 estimates."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = [0, 0.5, 0.5]
    at = cells // (GRID + 1) ** 2
    absent = np.stack([cells // (GRID + 1) % (GRID + 1), cells % (GRID + 1)], axis=1) == GRID
    p = np.concatenate([np.where(absent, 0.0, 2.0**-depth), np.full((len(cells), 1), floor)], axis=1)
    for _ in range(ROUNDS):
        part = weights[at] * p
        part *= (mass / part.sum(axis=1))[:, None]
        new = np.stack([np.bincount(at, weights=part[:, i], minlength=BUCKETS) for i in range(3)], axis=1) + 1.0
        new[0, 0] = 0
        weights = new / new.sum(axis=1, keepdims=True)
    return weights


CELLS = "cell long, mass long, pair long, word long"


def _opened(table: pa.Table) -> tuple[Chunk, list[bytes], int]:
    """The chunk of a group, the answers to it in order of their parts, and the row that the chunk is in."""
    parts = np.array(table.column("part").to_pylist(), dtype=np.int64)
    order = np.argsort(parts)
    payload = table.column("payload")
    return Chunk.read(payload[int(order[0])].as_py()), [payload[int(i)].as_py() for i in order[1:]], int(order[0])


def _weigh(totals: Totals):
    def run(table: pa.Table) -> pa.Table:
        chunk, answers, _ = _opened(table)
        _, found = answered(chunk, answers, held=True)
        times = np.diff(np.append(found.first, len(found.order)))
        return pa.table(dict(zip(("cell", "mass", "pair", "word"), map(pa.array, statistics(totals, found, times)), strict=True)))

    return run


def _score(shared):
    def run(table: pa.Table) -> pa.Table:
        totals: Totals = shared.value
        chunk, answers, row = _opened(table)
        words, found = answered(chunk, answers, held=False)
        n = len(chunk.count)
        text = np.repeat(np.arange(n), chunk.count)
        weights = totals.weights[bucket(found.context)]
        logs = np.log10(weights[:, 0] * found.pair / np.maximum(found.context, 1) + weights[:, 1] * found.word / max(totals.n_every, 1) + weights[:, 2] / (totals.n_words + 1))
        logs = np.repeat(logs, np.diff(np.append(found.first, len(found.order))))
        spread = np.empty(len(logs))
        spread[found.order] = logs  # back in the order of the text, so that equal texts add up alike
        base = np.log10((words + 0.1) / (totals.n_every + 0.1 * (totals.n_words + 1)))
        keys = table.column("keys").combine_chunks()
        return pa.table({
            "key": keys.slice(row, 1).flatten(), "train": pa.array(chunk.train), "n_tokens": pa.array(chunk.count), "n_known": pa.array(np.bincount(text, weights=words[chunk.ids] > 0, minlength=n).astype(np.int64)),
            "base_score": pa.array(np.bincount(text, weights=base[chunk.ids], minlength=n)), "score": pa.array(np.bincount(text, weights=spread, minlength=n)),
        })

    return run


def score_texts(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, part_tokens: int = PART_TOKENS, message_keys: int = MESSAGE_KEYS) -> DataFrame:
    """Each row's ``key``, ``train`` flag, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then the text's end.
    ``train`` tells which rows the model may learn from (null: not).  ``base_score`` is the log10
    probability by single words with 0.1 added to each count; ``score`` is the model's.  ``n_known``
    counts tokens that occur in training.  Null texts count as empty.  Repeated rows are texts
    like others: each is counted and scored.  Without training rows all words are unknown; an
    empty table gives an empty one.  Other columns aren't read.

    The driver gets one table of statistics, of a fixed number of cells at most: estimates are
    grouped by half octaves down to 2^-48, and a cell keeps its mean to a thousandth of an octave.
    Texts longer than ``chunk_bytes`` are chunks of their own.  Questions go packed by hash ranges of ``part_tokens`` tokens
    where a chunk has ``message_keys`` tokens or more for each range, and as rows beyond; the results are the same.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    train = F.coalesce(train, F.lit(False))
    held = train & (F.pmod(F.xxhash64(F.lit(3), key, text), F.lit(HELD)) == 0)
    taken = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), train.alias("train"), held.alias("held"))
    kind = taken.schema["key"].dataType.simpleString()
    chunks = durable(taken.mapInArrow(_cut_chunks(chunk_bytes), f"{CHUNKS}, keys array<{kind}>"))
    n_tokens, n_every, n_held, n_chunks = (x or 0 for x in chunks.agg(F.sum("n_tokens"), F.sum("n_train"), F.sum(F.when(F.col("held"), F.col("n_train"))), F.count(F.lit(1))).first())
    parts = max(1, -(-n_tokens // part_tokens))

    if parts * message_keys * n_chunks <= max(n_tokens, message_keys * n_chunks):
        asked = chunks.select("chunk", "held", "payload").mapInArrow(_ask(parts), MESSAGES)
        answers = durable(asked.groupBy("part").applyInArrow(_answer, ANSWERS))
        n_words = answers.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    else:
        answers, n_words = answer_rows(chunks)
    totals = Totals(n_every - n_held, n_every, n_words, None)

    none = F.lit(None).cast(f"array<{kind}>").alias("keys")
    rows = chunks.select("chunk", F.lit(-1).cast("long").alias("part"), "held", "payload", "keys").unionByName(answers.select("chunk", "part", "held", "payload", none))
    cells = rows.filter("held").drop("held", "keys").groupBy("chunk").applyInArrow(_weigh(totals), CELLS)
    cells = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("mass", "pair", "word")]).orderBy("cell").collect()  # BUCKETS * (GRID + 1)^2 at most
    cell, mass, pair, word = (np.array([r[i] for r in cells], dtype=np.int64) for i in range(4))
    depth = np.stack([pair, word], axis=1) / FINE / np.maximum(mass, 1)[:, None]
    weights = learn_weights(cell, mass.astype(np.float64), depth, 1 / (n_words + 1))
    shared = spark.sparkContext.broadcast(totals._replace(weights=weights))

    scored = rows.drop("held").groupBy("chunk").applyInArrow(_score(shared), f"key {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("key").alias(key), "train", "n_tokens", "n_known", F.lit(n_every).cast("long").alias("train_tokens"), "base_score", "score")
