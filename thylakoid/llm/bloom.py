"""A Bloom filter of 64-bit hashes, small enough to be sent to every task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.textkit import U64, as_long, mix

#: Bits for each hash, probes, and sizes (as powers of two) that a filter keeps to: 16 MB at most.
BITS, PROBES, SMALLEST, LARGEST = 32, 4, 16, 27


def probes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits, one row for each probe, of hashes in a filter of 2^size bits."""
    spread = mix(hashes)
    step = mix(spread + U64(1)) | U64(1)
    return np.stack([((spread + U64(i) * step) >> U64(64 - size)).astype(np.int64) for i in range(PROBES)])


def build(hashes: DataFrame, column: str, n: int | None = None) -> np.ndarray:
    """A filter of a long column of ``n`` distinct values (counted if not given), as 64-bit cells.

    It doesn't outgrow 2^LARGEST bits: of very many hashes it holds all as well, and lets more
    others pass.
    """
    n = hashes.select(column).distinct().count() if n is None else n
    size = min(max(SMALLEST, (BITS * n).bit_length()), LARGEST)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.unique(probes(batch.column(0).to_numpy().view(U64), size))
            cell, first = np.unique(bit >> 6, return_index=True)
            ored = np.bitwise_or.reduceat(U64(1) << (bit & 63).astype(U64), first) if len(bit) else np.zeros(0, dtype=U64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), as_long(ored)], ["cell", "bits"])

    found = hashes.select(column).mapInArrow(cells, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), dtype=U64)
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(U64)
    return out


def may_hold(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that the filter was not made of."""
    size = (len(cells) * 64).bit_length() - 1
    ok = np.ones(len(hashes), dtype=bool)
    for bit in probes(hashes, size):
        ok &= (cells[bit >> 6] >> (bit & 63).astype(U64)) & U64(1) == 1
    return ok
