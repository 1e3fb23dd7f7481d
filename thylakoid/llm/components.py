"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import durable, skewed_join

#: Edges (of two numbers) that one task may contract by itself.
FEW_EDGES = 200_000


class Forest:
    """Union-find over 0 to n - 1 that tells which unions were new; a root is the smallest of its tree."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges (u, v): each node that isn't the smallest of its component, and the smallest."""
    sides = [np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in zip(*[(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches], strict=True)] or [np.zeros(0, dtype=np.int64)] * 2
    names, ends = np.unique(np.concatenate(sides), return_inverse=True)
    forest = Forest(len(names))
    for x, y in zip(ends[: len(sides[0])].tolist(), ends[len(sides[0]) :].tolist(), strict=True):
        forest.join(x, y)
    roots = np.array([forest.root(x) for x in range(len(names))], dtype=np.int64)
    away = np.flatnonzero(roots != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[away]), pa.array(names[roots[away]])], ["node", "root"])


def _least(edges: DataFrame, total: int) -> DataFrame:
    """``edges`` (u, v), of which there are ``total`` at most, with ``m``, the least of u and its neighbours; no task gets all edges of a hub."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    return skewed_join(edges, least, "u", "n", total)


def components(edges: DataFrame, few: int | None = None) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for each node of ``edges`` (a, b), durable.

    Each round points neighbours at the smallest node nearby and takes a logarithm of the rounds
    that plain label passing would.  Rounds are durable, and nothing but a checksum reaches the
    driver.  No more than ``few`` distinct edges are contracted in a single task.  Nodes without an
    edge to another node aren't returned.
    """
    few = FEW_EDGES if few is None else few
    stars = durable(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    checksum = F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))
    sums = stars.agg(*checksum).first()
    if sums[0] <= few:
        return durable(stars.coalesce(1).mapInArrow(contract, "node long, root long"))
    while True:
        total = 2 * sums[0]
        large = _least(stars.union(stars.select("v", "u")), total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least(large, total)
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        stars, seen = durable(small.filter("u <> v").distinct()), sums
        sums = stars.agg(*checksum).first()
        if sums == seen:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
