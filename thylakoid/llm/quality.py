"""Quality rules of documents and of their hosts.

Each document is measured by itself; failures of each rule are summed by host; a host's failure
rate is shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts; and the
verdict on the host is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import bounded_batches, durable, row_hash, skewed_join
from thylakoid.llm.textkit import U64, IS_SPACE, blocks, find_words, hash_spans, mix, ngrams

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: A host is rejected if the shrunk rate of one of its rules is at least this: of its documents three in
#: five or more then fail, so that more bad ones go than good ones, with a margin for the rate's error.
HOST_LIMIT = 0.6

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _keyed(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(hashes + doc.astype(U64) * U64(0x9E3779B97F4A7C15))


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of every text of a column."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in MEASURES}
    for block in blocks(column):
        data, offsets, n = block.data, block.offsets, block.hi - block.lo
        words = find_words(data, offsets)
        hashes = hash_spans(data, words.start, words.end)
        out["n_words"].append(np.diff(words.first))
        out["word_chars"].append(_per_text(~IS_SPACE[data] & ((data & 0xC0) != 0x80), offsets))
        out["n_symbols"].append(_per_text(_IS_SYMBOL[data], offsets))

        breaks = np.flatnonzero(data == 10)
        start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        start = start[start < len(data)]
        doc = np.searchsorted(offsets, start, side="right") - 1
        end = np.searchsorted(breaks, start)
        end = np.minimum(np.append(breaks, len(data))[end], offsets[doc + 1])
        full = np.searchsorted(words.start, start) < np.searchsorted(words.start, end)
        start, end, doc = start[full], end[full], doc[full]
        _, first = np.unique(_keyed(hash_spans(data, start, end), doc), return_index=True)
        out["n_dup_lines"].append(np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n))

        runs, at = ngrams(words, hashes, 3)
        _, inverse, counts = np.unique(_keyed(runs, words.doc[at]), return_inverse=True, return_counts=True)
        again = at[counts[inverse] > 1] if len(at) else at
        covered = np.zeros(len(hashes), dtype=bool)
        for i in range(3):
            covered[again + i] = True
        out["n_repeat_words"].append(np.bincount(words.doc[covered], minlength=n))
    return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, dtype=np.int64) for k, v in out.items()}


def measure_documents(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with the measures of its text (null: none), whole texts, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(found[k]) for k in MEASURES]], [*batch.schema.names[:-1], *MEASURES])

    bounded_batches(docs.sparkSession)
    taken = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1])
    return taken.mapInArrow(run, ", ".join([*([schema] if schema else []), *[f"{k} long" for k in MEASURES]]))


def rule_failures() -> dict[str, Column]:
    """Rules of a single document, over its measures, that are counted for its host."""
    words = F.col("n_words")
    return {
        "short": words < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 5 * F.col("n_symbols") > 4 * words,
        "lines": 5 * F.col("n_dup_lines") > words,
    }


def judge_hosts(measured: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """``host_key``, ``host_kept`` and ``n`` (its documents) for each host.

    For each rule the hosts' failure rates have mean m and variance v, each host weighing the
    same; the prior is the beta distribution with these moments, its strength m(1-m)/v - 1 held
    between 2 and 1000 documents, so a host of few documents stays near the rate of all hosts.
    """
    rules = rule_failures()
    hosts = measured.groupBy(F.col(host).alias("host_key")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(v.cast("long")).alias(k) for k, v in rules.items()]
    )
    prior = hosts.agg(*[f(F.col(k) / F.col("n")).alias(f"{s}_{k}") for k in rules for f, s in ((F.avg, "m"), (F.var_pop, "v"))]).first()
    kept = F.lit(True)
    for k in rules:
        m, v = prior[f"m_{k}"] or 0.0, prior[f"v_{k}"] or 0.0
        strength = min(1000.0, max(2.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
        kept &= (F.col(k) + F.lit(m * strength)) / (F.col("n") + F.lit(strength)) < limit
    return hosts.select("host_key", kept.alias("host_kept"), "n")


def base_failed() -> Column:
    """The rules that reject a document by itself."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge_documents(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", limit: float = HOST_LIMIT) -> DataFrame:
    """``key``, the measures, ``base_failed`` and ``kept`` of each row.

    A null text has no words and fails.  A null host is a host of its own.  No task gets all documents of
    a host that has very many.  Equal rows are judged
    alike and all returned.  An empty table gives an empty one.  Other columns are not read.
    """
    measured = durable(measure_documents(docs.select(F.col(key).alias("_key"), F.col(host).alias("_host"), F.col(text).alias("_body")), ["_key", "_host"], "_body"))
    hosts = judge_hosts(measured, "_host", limit)
    hosts = durable(hosts.select(row_hash(hosts, ["host_key"]).alias("_of"), "host_kept", "n"))
    n_hosts, total = hosts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return skewed_join(measured.withColumn("_of", row_hash(measured, ["_host"])), hosts, "_of", "n", total, n_hosts).select(
        F.col("_key").alias(key), *MEASURES, base_failed().alias("base_failed"), (~base_failed() & F.col("host_kept")).alias("kept")
    )
