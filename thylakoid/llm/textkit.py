"""Columnar text work shared by the operators of this subpackage.

A block of texts is handled as one byte buffer: words are found, lower-cased and hashed for
all its documents at once, with numpy, so no Python code runs per word.  A word is
``[^\\x20\\x09-\\x0D]+``; those separators are ASCII, so UTF-8 bytes can be split directly.
Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.  A longer document is a block of its own.
BLOCK_BYTES = 1 << 20

U64 = np.uint64
def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose every output bit depends on every input bit."""
    x = np.asarray(x, dtype=U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Masks of the first 0 to 8 bytes of a number, and what tells a first number from others.
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=U64)
_PLACE = U64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

class Block(NamedTuple):
    """Texts ``lo`` to ``hi`` of a column: their bytes, and where each of them begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Byte range of each word of a block, and the text (from 0) that it belongs to."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # word number at which each text begins, and the total


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, at, raw = column.buffers()
    at = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield Block(lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Where the words are; no word reaches from one text into the next."""
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    edges = edges[edges > 0] - 1
    ends[edges] = inside[edges]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets)
    return Words(start, end, doc, first)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range.

    A range is read as numbers of eight bytes each, the last filled up with zeros.  Each number is
    mixed with its place before they are added up with the length, so that no arrangement of equal
    pieces cancels out, as it does in a polynomial modulo 2^64.
    """
    size = end - start
    padded = np.concatenate([np.ascontiguousarray(data), np.zeros(8, dtype=np.uint8)])
    numbers = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    sums = mix((numbers[start] & _FIRST_BYTES[np.minimum(size, 8)]) + _PLACE)
    long = np.flatnonzero(size > 8)
    if len(long):
        pieces = (size[long] - 1) >> 3  # beyond the first
        first = np.cumsum(pieces) - pieces
        place = np.arange(pieces.sum()) - np.repeat(first, pieces) + 1
        at = np.repeat(start[long], pieces) + 8 * place
        left = np.repeat(end[long], pieces) - at
        values = mix((numbers[at] & _FIRST_BYTES[np.minimum(left, 8)]) + (mix(place.astype(U64)) + U64(1)) * _PLACE)
        sums[long] += np.add.reduceat(values, first)
    return mix(sums + size.astype(U64) * U64(0xD6E8FEB86659FD93))


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` neighbours; the result is n - 1 shorter."""
    total = np.zeros(max(0, len(hashes) - n + 1), dtype=U64)
    for i, factor in enumerate(mix(np.arange(1, n + 1, dtype=U64)) | U64(1)):
        total += hashes[i : len(hashes) - n + 1 + i] * factor
    return mix(total + U64(n))


def ngrams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs that lie within one text, and the number of the first word of each."""
    if len(hashes) < n:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    runs = combine(hashes, n)
    at = np.flatnonzero(words.doc[: len(runs)] == words.doc[n - 1 :])
    return runs[at], at


def as_long(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's longs."""
    return pa.array(np.ascontiguousarray(values, dtype=U64).view(np.int64))


#: Bytes that letters and digits of any language are made of, and the separators.
NOT_PUNCTUATION = np.ones(256, dtype=bool)
NOT_PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = False


def compact(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray, becomes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buffer without the bytes that ``keep`` (by byte) leaves out, the others mapped by ``becomes``."""
    kept = keep[data]
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(kept, out=total[1:])
    return becomes[data[kept]], total[offsets]
