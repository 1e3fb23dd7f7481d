"""Token counts by section: offset-mapped attribution.

A document is encoded once, as a whole.  A byte-level vocabulary gives back the text byte by
byte, so the lengths of the tokens are their spans; these are joined with the sections' spans by
binary search, and a token that crosses a boundary goes to one section by a stated rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import bounded_batches

#: The pattern that cuts a text for this vocabulary, and where its file lies here.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: ``most``: the section with most of the token's bytes, the first of equals.  ``start``: the one with its first byte.
RULES = ("most", "start")

_encoders: dict[int, tuple] = {}


def encoder(raw: bytes, pattern: str):
    """The encoder of a rank file, made once in a process, and the byte length of each of its ids."""
    import tiktoken

    name = hash((raw, pattern))
    if name not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for word, i in ranks.items():
            lengths[i] = len(word)
        _encoders[name] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encoders[name]


def line_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, each with its line break; an empty text has none."""
    data = np.frombuffer(text, dtype=np.uint8)
    start = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
    start = start[start < len(data)]
    return start, np.append(start[1:], len(data)) if len(start) else start


def attribute(ends: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section (-1: none) of each token, and whether it crosses a boundary.

    ``ends`` are the tokens' ends; sections are sorted, don't overlap and may leave gaps.
    """
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    if not len(start):
        return np.full(len(ends), -1), np.zeros(len(ends), dtype=bool)
    first = np.searchsorted(start, begins, side="right") - 1
    last = np.searchsorted(start, ends, side="left") - 1
    overlap = np.minimum(ends, stop[first]) - begins
    overlap = np.where(first >= 0, np.maximum(overlap, 0), 0)
    crosses = (last > first) | ((overlap > 0) & (overlap < ends - begins)) | ((first < 0) & (last >= 0))
    owner = np.where(overlap > 0, first, -1)
    if rule == "most":
        for t in np.flatnonzero(last > first):
            inside = np.arange(max(0, first[t]), last[t] + 1)
            share = np.minimum(ends[t], stop[inside]) - np.maximum(begins[t], start[inside])
            owner[t] = inside[int(share.argmax())] if share.max() > 0 else -1
    return owner, crosses


def section_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", spans: str | None = None, vocabulary: str = VOCABULARY, pattern: str = PATTERN, rule: str = "most") -> DataFrame:
    """``key``, ``section``, ``start_byte``, ``end_byte``, ``n_tokens``, ``n_crossing``, ``n_document`` for each section.

    ``spans`` names a column of array<struct<start,end>> in bytes of the UTF-8 text, sorted and
    without overlaps; without it the sections are the lines.  ``n_crossing`` counts those of the
    section's tokens that cross its boundary, ``n_document`` the tokens of the whole text.  Tokens
    that no section holds, by ``rule``, are counted in ``n_document`` alone.  A null or empty text
    has no lines, so no rows; with ``spans`` its sections have no tokens.  Equal rows give their
    rows each.  Special tokens' strings are ordinary text.  The driver reads the vocabulary, whose
    size is fixed, and sends it to the executors; there is no shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    names = ["section", "start_byte", "end_byte", "n_tokens", "n_crossing", "n_document"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, lengths = encoder(shared.value, pattern)
        for batch in batches:
            rows, cells = [], [[] for _ in names]
            for i, body in enumerate(batch.column(1)):
                body = body.as_py() or ""
                raw = body.encode()
                if spans is None:
                    start, stop = line_spans(raw)
                else:
                    given = batch.column(2)[i].as_py() or []
                    start, stop = (np.array([s[k] for s in given], dtype=np.int64) for k in ("start", "end"))
                if not len(start):
                    continue
                ends = np.cumsum(lengths[np.asarray(coder.encode_ordinary(body), dtype=np.int64)]) if body else np.zeros(0, dtype=np.int64)
                owner, crosses = attribute(ends, start, stop, rule)
                rows.append(np.full(len(start), i))
                held = owner >= 0
                for cell, value in zip(
                    cells,
                    [np.arange(len(start)), start, stop, np.bincount(owner[held], minlength=len(start)), np.bincount(owner[held & crosses], minlength=len(start)), np.full(len(start), len(ends))],
                    strict=True,
                ):
                    cell.append(value)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(rows))), *[pa.array(np.concatenate(c).astype(np.int64)) for c in cells]], ["key", *names]
                )

    taken = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *([F.col(spans).alias("spans")] if spans else []))
    schema = f"key {taken.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)
    return taken.mapInArrow(run, schema).withColumnRenamed("key", key)
