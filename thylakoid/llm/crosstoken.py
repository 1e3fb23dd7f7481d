"""Alignment of the tokens of two tokenizers, with segments tokenized once.

A text, with a space before it, is split before runs of white space that begin with a space:
neither vocabulary merges across such a place, which ``may_split`` makes sure of, so a segment's
tokens are those that it has within any text.

1. Texts are cut into chunks: the distinct segments of each, and the numbers of its texts'
   segments among them.
2. Segments that a chunk has several times meet by their hash, so that each distinct one of the
   corpus is tokenized by both and aligned once: tokens that end at the same byte close a group, and
   all pairs of tokens of a group are links.  Its groups go back to every chunk that has it.  What a
   chunk has once is tokenized there, once: sending it both ways costs more than tokenizing it.
3. A chunk tells how many of its texts hold each pair of ids linked, and these counts are added up.
4. Chunks look the counts of their pairs up and compose their texts.

No task gets more than a chunk and what its distinct segments have.  Chunks lie in Parquet in the
shared folder until the rows are done; they are about as large as the texts' own Parquet.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import BROADCAST_ROWS, bounded_batches, durable, remove, shared_folder
from thylakoid.llm.lm import pack, unpack
from thylakoid.llm.textkit import U64, as_long, blocks, hash_spans

#: Where the vocabularies lie here: a byte-level one, and one of pieces that adds a space of its own.
BYTE_LEVEL, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a chunk, and segments that are aligned at once.
CHUNK_BYTES, SEGMENTS = 6 << 20, 20_000
#: Bytes of segments that are encoded as one text.
JOINED = 4096
#: Segments whose pairs are counted at once.
LOOKED_AT = 200_000
#: Links of a group that are laid out one by one; larger groups are counted by id first.
LAID_OUT = 256
SPACE = "▁"


def may_split(spec: dict, pieces: list[str], probe: list[str]) -> bool:
    """Whether neither vocabulary can merge across the beginning of a run of white space that starts with a space.

    The byte-level one cuts a text into pretokens first, of which none has white space behind
    other letters.  The other one merges pieces into pieces, and has none with a space behind
    another letter; nor does it change spaces, as ``probe``, the pieces of ``a  b ``, tells.
    """
    cut = spec.get("pre_tokenizer") or {}
    bytes_apart = spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
    return bool(bytes_apart and apart and "".join(probe) == f"{SPACE}a{SPACE}{SPACE}b{SPACE}")


class Vocabularies:
    """Both tokenizers, what their ids stand for, and whether texts may be split."""

    def __init__(self, first: bytes, second: bytes) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(first)
        self.first = Tokenizer.from_str(first.decode())
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        vocab = self.first.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)  # a letter for each byte
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.piece = [bytes([int(p[3:-1], 16)]) if self.second.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.piece_width = np.array([len(p) for p in self.piece], dtype=np.int64)
        self.names = [[str(i) for i in range(n)] for n in (len(self.width), len(pieces))]
        self.splits = may_split(spec, pieces, self.second.encode("a  b ", out_type=str))


_loaded: dict[tuple[int, int], Vocabularies] = {}


def loaded(files: tuple[bytes, bytes]) -> Vocabularies:
    """The vocabularies of two files, made once in a process."""
    name = hash(files[0]), hash(files[1])
    if name not in _loaded:
        _loaded[name] = Vocabularies(*files)
    return _loaded[name]


# --- segments ---


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of ``count`` from each ``first``."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def split(data: np.ndarray, offsets: np.ndarray, splits: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts with a space before each, and where their segments begin and end, and how many each text has.

    An empty text has none.  A segment begins with a space; the one that ends a text is no segment by
    itself, for a tokenizer that adds a space gets nothing of it.
    """
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    data = np.insert(data, offsets[:-1][full], 0x20)
    first = offsets[:-1][full] + np.arange(len(full))
    ends = first + sizes[full] + 1
    start = first
    if splits and len(data):
        at = np.flatnonzero(data == 0x20)
        at = at[at > 0]
        one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
        apart = (one > 0x20) & (one != 0x7F)
        # white space of more bytes, and a few others of the same first bytes
        apart &= ~((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
        apart &= ~((three == 0xE2) & ((two == 0x80) | (two == 0x81))) & ~((three == 0xE1) & ((two == 0x9A) | (two == 0xA0))) & ~((three == 0xE3) & (two == 0x80))
        at = at[apart]
        start = np.union1d(np.setdiff1d(at, ends - 1, assume_unique=True), first)
    owner = np.searchsorted(first, start, side="right") - 1
    counts = np.zeros(len(sizes), dtype=np.int64)
    counts[full] = np.bincount(owner, minlength=len(full))
    stop = np.append(start[1:], ends[-1]) if len(start) else start
    return data, start, stop, counts


class Chunk(NamedTuple):
    """The number of each segment among the chunk's distinct ones, the most frequent first, and how many segments each text has."""

    ids: np.ndarray
    counts: np.ndarray

    @classmethod
    def read(cls, raw: bytes) -> Chunk:
        ids, counts = unpack(raw, "II")
        return cls(ids.astype(np.int64), counts.astype(np.int64))

    def packed(self) -> bytes:
        return pack(self.ids.astype(np.uint32), self.counts.astype(np.uint32))

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def pack_texts(texts: list[bytes]) -> bytes:
    """Texts as one compressed run of bytes, with their lengths."""
    return pack(np.array([len(t) for t in texts], dtype=np.uint32), np.frombuffer(b"".join(texts), dtype=np.uint8))


def pack_spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    """The same of spans of bytes."""
    return pack((stop - start).astype(np.uint32), data[_ragged(start, stop - start)])


def unpack_texts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins, and the end of the last; and all bytes."""
    lengths, data = unpack(raw, "IB")
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), data


def _cut_chunks(shared, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = loaded(shared.value).splits
        task, made = TaskContext.get().partitionId(), 0
        keys, parts, waiting = [], [], 0

        def chunk() -> pa.RecordBatch:
            nonlocal made, waiting
            data, start, stop, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, at, ids, often = np.unique(hash_spans(data, start, stop), return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            names = pa.concat_arrays(keys)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + made], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), pa.array([Chunk(place[ids], counts).packed()], pa.binary()),
                    *[pa.array([pack_spans(data, start[x], stop[x])], pa.binary()) for x in np.split(at[order], [int((often > 1).sum())])],
                ],
                ["chunk", "keys", "payload", "texts", "once"],
            )
            made, waiting = made + 1, 0
            keys.clear()
            parts.clear()
            return row

        for batch in batches:
            for block in blocks(batch.column(1)):
                data, start, stop, count = split(block.data, block.offsets, splits)
                keys.append(batch.column(0).slice(block.lo, block.hi - block.lo))
                parts.append((data, start + waiting, stop + waiting, count))
                waiting += len(data)
                if waiting >= size:
                    yield chunk()
        if keys:
            yield chunk()

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chunks: the hash, the number and the text of each segment that occurs several times."""
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ends, data = unpack_texts(raw.as_py())
            for lo in range(0, len(ends) - 1, SEGMENTS):
                cut = ends[lo : lo + SEGMENTS + 1]
                part = np.ascontiguousarray(data[cut[0] : cut[-1]])
                at = cut - cut[0]
                n = len(at) - 1
                texts = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([as_long(hash_spans(part, at[:-1], at[1:])), pa.array(np.full(n, chunk)), pa.array(np.arange(lo, lo + n, dtype=np.int32)), texts], ["h", "chunk", "number", "t"])


# --- alignment ---

def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


class Tokens(NamedTuple):
    """Ids of all segments one after the other, and how many each segment has."""

    ids: np.ndarray
    count: np.ndarray


def _links(group: np.ndarray, a: np.ndarray, b: np.ndarray, first_a: np.ndarray, n_a: np.ndarray, first_b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair of ids (as one number) and times of the links of each group, distinct by group for large ones."""
    small = np.flatnonzero(n_a * n_b <= LAID_OUT)
    links = (n_a * n_b)[small]
    within = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
    wide = np.repeat(n_b[small], links)
    left, right = a[np.repeat(first_a[small], links) + within // wide], b[np.repeat(first_b[small], links) + within % wide]
    sides = [(np.repeat(group[small], links), (left << 32) | right, np.ones(len(left), dtype=np.int64))]
    for g in np.flatnonzero(n_a * n_b > LAID_OUT).tolist():
        (x, m), (y, n) = (np.unique(ids[f[g] : f[g] + k[g]], return_counts=True) for ids, f, k in ((a, first_a, n_a), (b, first_b, n_b)))
        sides.append((np.full(len(x) * len(y), group[g]), ((x[:, None] << 32) | y[None, :]).ravel(), (m[:, None] * n[None, :]).ravel()))
    return tuple(np.concatenate(s) for s in zip(*sides, strict=True))


def _encoded(texts: list[str], tools: Vocabularies) -> tuple[list[list[int]], list[list[int]], list[bool]]:
    """Ids of either vocabulary for each of texts that begin with a space, and whether both give the text back."""
    encode = getattr(tools.first, "encode_batch_fast", tools.first.encode_batch)
    firsts = [e.ids for e in encode(texts, add_special_tokens=False)]
    seconds = tools.second.encode([t[1:] for t in texts], num_threads=1)
    raw = [t.encode() for t in texts]
    return firsts, seconds, [b"".join([tools.piece[i] for i in ids]) == s and int(tools.width[other].sum()) == len(s) for ids, other, s in zip(seconds, firsts, raw, strict=True)]


def tokens_of(segments: list[bytes], tools: Vocabularies) -> tuple[Tokens, Tokens]:
    """The tokens of segments that begin with a space; none where a vocabulary doesn't give one back.

    Where texts may be split they may be joined as well: so segments are encoded some ``JOINED`` bytes
    at a time, but for those that end in white space.  Where that doesn't give the bytes back, or a
    token crosses an end, each is encoded by itself.
    """
    texts = [s.decode() for s in segments]
    runs: list[list[int]] = []
    room = 0
    for i, t in enumerate(texts):
        if not tools.splits or t[-1].isspace() or t[-1] == "\u180e":
            runs.append([i])
            room = 0
        else:
            if room <= 0:
                runs.append([])
                room = JOINED
            runs[-1].append(i)
            room -= len(segments[i])
    firsts, seconds, sound = _encoded(["".join([texts[i] for i in run]) for run in runs], tools)
    parts: list[list] = [[], []]  # tokens of each run and how many each segment has, of either
    order = []
    for run, x, y, ok in zip(runs, firsts, seconds, sound, strict=True):
        order += run
        ends = np.cumsum([len(segments[i]) for i in run])
        found = [(np.array(ids, dtype=np.int64), np.cumsum(width[ids])) for ids, width in ((x, tools.width), (y, tools.piece_width))]
        at = [np.searchsorted(until, ends, side="right") for _, until in found]
        if ok and all((until[i - 1] == ends).all() for (_, until), i in zip(found, at, strict=True)):
            for side, (ids, _), i in zip(parts, found, at, strict=True):
                side.append((ids, np.diff(i, prepend=0)))
        else:
            alone = _encoded([texts[i] for i in run], tools)
            for side, lists in zip(parts, alone[:2], strict=True):
                lists = [ids if good else [] for ids, good in zip(lists, alone[2], strict=True)]
                side.append((np.fromiter(itertools.chain.from_iterable(lists), dtype=np.int64), np.array([len(ids) for ids in lists], dtype=np.int64)))
    assert order == list(range(len(segments)))
    return tuple(Tokens(*[np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (zip(*side, strict=True) if side else ([], []))]) for side in parts)


def align(segments: list[bytes], tools: Vocabularies) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each of segments that begin with a space; empty where a vocabulary doesn't give it back."""
    a, b = tokens_of(segments, tools)
    # sound segments lie one after the other, as bytes; what both end closes a group
    end_a, end_b = np.cumsum(tools.width[a.ids]), np.cumsum(tools.piece_width[b.ids])
    closed = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(closed, end_a), np.searchsorted(closed, end_b)
    first_a, first_b = _firsts(group_a), _firsts(group_b)
    n_a, n_b = np.diff(np.append(first_a, len(group_a))), np.diff(np.append(first_b, len(group_b)))
    left, right = ([names[i] for i in ids.tolist()] for names, ids in zip(tools.names, (a.ids, b.ids), strict=True))
    spelled = [
        f"{left[x]}|{right[y]}" if k == m == 1 else ",".join(left[x : x + k]) + "|" + ",".join(right[y : y + m])
        for x, k, y, m in zip(first_a.tolist(), n_a.tolist(), first_b.tolist(), n_b.tolist(), strict=True)
    ]
    owner = np.repeat(np.arange(len(segments)), a.count)[first_a]
    at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(segments)))]).tolist()
    return [";".join(spelled[x:y]).encode() for x, y in itertools.pairwise(at)]


def _align(shared):
    """Of rows in order of ``h``: the groups of each row's segment; equal segments are aligned once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, last, held = loaded(shared.value), None, b""
        for batch in batches:
            for at in range(0, batch.num_rows, SEGMENTS):
                part = batch.slice(at, SEGMENTS)
                names = part.column(0).to_numpy()
                first = _firsts(names)
                known = int(names[0] == last)  # the last one of the rows before
                found = [held] * known + align(part.column(3).take(pa.array(first[known:])).to_pylist(), tools)
                last, held = names[-1], found[-1]
                which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(names))))
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(found, pa.binary()).take(pa.array(which))], ["chunk", "number", "groups"])

    return run


# --- what a chunk does with its segments' groups ---


class Linked(NamedTuple):
    """By segment: whether it is sound, its tokens of either, groups and links; and its distinct pairs of ids, with where they begin, and their times."""

    sound: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    first: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def read_groups(ends: np.ndarray, data: np.ndarray) -> Linked:
    """The links of segments, from the bytes of their groups: all numbers are read at once."""
    n, sizes = len(ends) - 1, np.diff(ends)
    full = np.flatnonzero(sizes)
    data = np.insert(data, ends[1:][full], ord(";"))
    stop = np.flatnonzero((data < ord("0")) | (data > ord("9")))
    start = np.concatenate([[0], stop[:-1] + 1])
    value = np.zeros(len(stop), dtype=np.int64)
    for k in range(int((stop - start).max()) if len(stop) else 0):
        inside = start + k < stop
        value[inside] = value[inside] * 10 + (data[start[inside] + k] - ord("0"))
    mark = data[stop]
    closed = np.cumsum(mark == ord(";")) - (mark == ord(";"))  # groups before each number
    second = (np.cumsum(mark == ord("|")) - (mark == ord("|"))) > closed
    ids, group = [value[~second], value[second]], [closed[~second], closed[second]]
    firsts = [_firsts(g) for g in group]
    counts = [np.diff(np.append(f, len(g))) for f, g in zip(firsts, group, strict=True)]
    closes = stop[mark == ord(";")]
    owner = full[np.searchsorted((ends[1:][full] + np.arange(len(full))), closes)] if len(closes) else closes
    of, pair, times = _links(np.arange(len(closes)), ids[0], ids[1], firsts[0], counts[0], firsts[1], counts[1])
    order = np.lexsort((pair, owner[of]))
    of, pair, times = owner[of][order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (pair[1:] != pair[:-1])])) if len(of) else of
    times = np.add.reduceat(times, first) if len(first) else times
    per = lambda weights: np.bincount(owner, weights=weights, minlength=n).astype(np.int64)
    return Linked(sizes > 0, per(counts[0]), per(counts[1]), np.bincount(owner, minlength=n), per(counts[0] * counts[1]), np.concatenate([[0], np.cumsum(np.bincount(of[first], minlength=n))]), pair[first], times)


def _good(chunk: Chunk, sound: np.ndarray) -> np.ndarray:
    """The texts that have tokens: of segments that are all sound, of one at least."""
    broken = np.bincount(chunk.doc(), weights=~sound[chunk.ids], minlength=len(chunk.counts))
    return (chunk.counts > 0) & (broken == 0)


LINKED = "chunk long, payload binary, groups binary, pairs array<long>, times array<long>"


def _count_pairs(chunk: Chunk, linked: Linked) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of ids, and how many of the chunk's texts that have tokens hold each; some texts at a time."""
    pairs, local = np.unique(linked.pair, return_inverse=True)
    times, n, m = np.zeros(len(pairs), dtype=np.int64), max(1, len(linked.sound)), max(1, len(pairs))
    good, ends = _good(chunk, linked.sound), np.concatenate([[0], np.cumsum(chunk.counts)])
    lo = 0
    while lo < len(chunk.counts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + LOOKED_AT, side="right")) - 1)
        doc = np.repeat(np.arange(hi - lo), chunk.counts[lo:hi])
        held = np.unique(doc * n + chunk.ids[ends[lo] : ends[hi]])
        doc, segment = held // n, held % n
        kept = good[lo:hi][doc]
        doc, segment = doc[kept], segment[kept]
        many = np.diff(linked.first)[segment]
        each = np.unique(np.repeat(doc, many) * m + local[_ragged(linked.first[:-1][segment], many)])
        times += np.bincount(each % m, minlength=m)[: len(pairs)]
        lo = hi
    return pairs[times > 0], times[times > 0]


def _gather(shared):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        """A chunk with its segments' groups, and how many of its texts hold each pair of ids."""
        tools = loaded(shared.value)
        chunk = Chunk.read(chunks.column("payload")[0].as_py())
        groups = answers.column("groups").take(pa.array(np.argsort(answers.column("number").to_numpy()))).to_pylist()
        ends, data = unpack_texts(chunks.column("once")[0].as_py())
        for lo in range(0, len(ends) - 1, SEGMENTS):
            cut = ends[lo : lo + SEGMENTS + 1]
            raw = data[cut[0] : cut[-1]].tobytes()
            groups += align([raw[x:y] for x, y in itertools.pairwise((cut - cut[0]).tolist())], tools)
        assert len(groups) == (chunk.ids.max() + 1 if len(chunk.ids) else 0)
        raw = pack_texts(groups)
        del groups
        pairs, times = _count_pairs(chunk, read_groups(*unpack_texts(raw)))
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int64)))
        return pa.table({"chunk": chunks.column("of"), "keys": chunks.column("keys"), "payload": chunks.column("payload"), "groups": pa.array([raw], pa.binary()), "pairs": one(pairs), "times": one(times)})

    return run


SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Counts(NamedTuple):
    """Pairs of ids in order, how many texts hold each, and whether none of the same first id has more."""

    pair: np.ndarray
    n: np.ndarray
    best: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Counts:
        pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pair)
        return cls(pair[order], n[order], best[order])


def compose(keys: pa.Array, payload: bytes, groups: bytes, counts: Counts) -> pa.Table:
    """The sums and the digest of each text of a chunk."""
    chunk, (ends, data) = Chunk.read(payload), unpack_texts(groups)
    linked = read_groups(ends, data)
    n, good = len(chunk.counts), _good(chunk, linked.sound)
    at = np.minimum(np.searchsorted(counts.pair, linked.pair), max(0, len(counts.pair) - 1))
    # a pair that only texts without tokens hold has no count, and no sum asks for it
    known = counts.pair[at] == linked.pair if len(counts.pair) else np.zeros(len(linked.pair), dtype=bool)
    much, best = (np.where(known, x[at] if len(counts.pair) else 0, 0) * linked.times for x in (counts.n, counts.best))

    def by_segment(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[linked.first[1:]] - total[linked.first[:-1]]

    columns = dict(zip(SUMS, (linked.n_a, linked.n_b, linked.n_groups, linked.n_links, by_segment(best), by_segment(much)), strict=True))
    until = np.concatenate([[0], np.cumsum(chunk.counts)])
    out = {}
    for c, values in columns.items():
        total = np.concatenate([[0], np.cumsum(values[chunk.ids], dtype=np.int64)])
        out[c] = pa.array(np.where(good, total[until[1:]] - total[until[:-1]], 0))
    digest, raw = [""] * n, data.tobytes()
    spelled = [raw[x:y] for x, y in itertools.pairwise(ends.tolist())]
    for i in np.flatnonzero(good).tolist():
        digest[i] = hashlib.sha256(b";".join([spelled[j] for j in chunk.ids[until[i] : until[i + 1]].tolist()])).hexdigest()
    return pa.table({"key": keys, **out, "groups_sha256": pa.array(digest, pa.string())})


def _compose_sent(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from compose(batch.column(0).slice(i, 1).flatten(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), shared.value).to_batches()

    return run


def _compose_joined(chunks: pa.Table, counts: pa.Table) -> pa.Table:
    return compose(chunks.column("keys").combine_chunks().flatten(), chunks.column("payload")[0].as_py(), chunks.column("groups")[0].as_py(), Counts.of(counts))


def align_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", first: str = BYTE_LEVEL, second: str = PIECES, chunk_bytes: int = CHUNK_BYTES, sent: int = BROADCAST_ROWS) -> DataFrame:
    """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of each row.

    ``first`` encodes the text with a space before it, ``second`` the text, to which it adds one; no
    special tokens, and their strings in a text are plain text.  Places where tokens of both end cut
    them into groups; links are all pairs of a token of either within a group.  A pair of ids counts
    the rows of the table that hold it linked.  ``n_best`` counts a row's links whose pair counts most among those
    of its first id, ties included; ``count_sum`` adds the counts up over its links.  The digest is
    that of ``a1,a2|b1;a3|b2,b3``, ids by group.  A text that is null or empty, or that either
    vocabulary doesn't give back byte by byte, has no tokens: its numbers are 0 and its digest is empty.
    Rows that repeat are rows like others, null keys as well; an empty table gives an empty one; other
    columns aren't read.  The driver reads both files, whose sizes are fixed, and sends them out; it sends the
    counts of up to ``sent`` distinct pairs, and beyond that chunks get those of their pairs by a join.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    files = []
    for path in (first, second):
        with open(path, "rb") as file:
            files.append(file.read())
    shared = spark.sparkContext.broadcast(tuple(files))
    folder = f"{shared_folder(spark)}/crosstoken-{uuid.uuid4().hex}"
    taken = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = taken.schema["key"].dataType.simpleString()
    taken.mapInArrow(_cut_chunks(shared, chunk_bytes), f"chunk long, keys array<{kind}>, payload binary, texts binary, once binary").write.parquet(f"{folder}/chunks", compression="none")  # packed already
    chunks = spark.read.parquet(f"{folder}/chunks")
    segments = chunks.select("chunk", "texts").mapInArrow(_segments, "h long, chunk long, number int, t binary")
    answers = segments.repartition("h").sortWithinPartitions("h").mapInArrow(_align(shared), "chunk long, number int, groups binary")
    gathered = chunks.select(F.col("chunk").alias("of"), "keys", "payload", "once").groupBy("of").cogroup(answers.groupBy("chunk")).applyInArrow(_gather(shared), f"keys array<{kind}>, {LINKED}")
    gathered.write.parquet(f"{folder}/linked")
    remove(spark, f"{folder}/chunks")
    linked = spark.read.parquet(f"{folder}/linked")

    asked = linked.select("chunk", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("chunk", F.col("p.pairs").alias("pair"), "p.times")
    counts = durable(asked.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("a", F.shiftright("pair", 32)))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of the vocabulary at most
    counts = durable(counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    schema = f"key {kind}, " + ", ".join(f"{c} long" for c in SUMS) + ", groups_sha256 string"
    if counts.count() <= sent:
        known = spark.sparkContext.broadcast(Counts.of(counts.toArrow()))
        rows = linked.select("keys", "payload", "groups").mapInArrow(_compose_sent(known), schema)
    else:
        found = asked.select("chunk", "pair").join(counts, "pair")
        rows = linked.select(F.col("chunk").alias("of"), "keys", "payload", "groups").groupBy("of").cogroup(found.groupBy("chunk")).applyInArrow(_compose_joined, schema)
    rows = durable(rows)
    remove(spark, folder)
    return rows.withColumnRenamed("key", key)
