"""What several operators of this subpackage need: durable cuts, sized joins, running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, VariantType

from thylakoid.plans.cuts import bounded_batches
from thylakoid.plans.cuts import cut as durable
from thylakoid.plans.cuts import let_go, remove, shared_folder

__all__ = ["BROADCAST_ROWS", "bounded_batches", "cumulative", "durable", "fresh", "let_go", "remove", "repeated", "row_hash", "shared_folder", "sized_join", "skewed_join", "table"]

#: Rows of at most a few dozen bytes that may be broadcast (some 30 MB).
BROADCAST_ROWS = 500_000
#: Rows of one key from which on it may be frequent, and frequent keys that there may be.
OFTEN, FREQUENT_KEYS = 100, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it a name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name


def _spelled(value: Column, kind: DataType) -> Column:
    """A column of any type as one that ``to_json`` tells apart: text in place of atoms, entries in order of their keys in place of maps."""
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _spelled(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_spelled(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]))
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.to_json(F.struct(_spelled(e["key"], kind.keyType).alias("k"), _spelled(e["value"], kind.valueType).alias("v")), {"ignoreNullFields": "false"}))
        return F.array_sort(entries)
    if isinstance(kind, BinaryType):
        return F.hex(value)
    return F.to_json(value) if isinstance(kind, VariantType) else value.cast("string")


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A 64-bit hash of a row, or of ``columns``: equal for rows that are equal in them, nulls in their places.

    Spark's own hash passes over nulls and bounds within arrays and structs, and has none of maps
    and variants; so columns of these types are spelled out as text first.
    """
    parts = []
    for field in df.schema.fields:
        if columns is None or field.name in columns:
            value = F.col(f"`{field.name}`")
            if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
                value = F.to_json(F.struct(_spelled(value, field.dataType).alias("f")), {"ignoreNullFields": "false"})
            parts += [F.col(f"`{field.name}`").isNull(), value]
    return F.xxhash64(*parts)


def repeated(df: DataFrame, times: str, name: str) -> DataFrame:
    """Each row as often as ``times`` (1 or more) says, numbered from 0 in ``name``; no array grows with the number itself."""
    step, block = 1 << 12, fresh(df, "block")
    df = df.withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(step).cast("long"))))
    return df.withColumn(name, F.explode(F.sequence(F.col(block), F.least(F.col(block) + step, F.col(times)) - 1))).drop(block)


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``right``, a durable table of narrow rows: broadcast up to ``limit`` rows, else shuffled."""
    return left.join(F.broadcast(right) if right.count() <= limit else right, on, how)


def skewed_join(left: DataFrame, right: DataFrame, on: str, times: str, total: int, rows: int | None = None, often: int = OFTEN, limit: int = FREQUENT_KEYS, how: str = "inner") -> DataFrame:
    """Join (inner or left) with ``right``, a table of one narrow row for each value of ``on``, not null.

    ``times`` is a column of ``right``, dropped here: how many of the ``total`` rows of ``left``
    have the value.  Rows of frequent values stay where they are: those values are broadcast, and
    there can't be more than ``limit`` of them.  The others are joined as Spark sees fit; all are
    broadcast if ``right`` is known to have no more than ``limit`` ``rows``.
    """
    if rows is not None and rows <= limit:
        return left.join(F.broadcast(right.drop(times)), on, how)
    often = max(often, total // limit + 1)
    hot = F.broadcast(right.filter(F.col(times) >= often).drop(times))
    rare = right.filter(F.col(times) < often).drop(times)
    return left.join(hot, on).unionByName(left.join(hot.select(on), on, "left_anti").join(rare, on, how))


def cumulative(df: DataFrame, group: list[str], order: list[str], value: Column, name: str, bins: int = 1024) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the same group.

    No task gets a whole group: rows are dealt into ``bins`` bins of each group by a hash of
    ``order``, ordered by bin and then by ``order``; a table of bin totals gives where each bin
    begins.  It has ``bins`` rows for a group at most.  ``order`` must tell rows apart, save
    for equal ones.
    """
    rows = df.withColumn("_bin", F.pmod(F.xxhash64(F.lit(7), *order), F.lit(bins)).cast("int")).withColumn("_value", value)
    totals = rows.groupBy(*group, "_bin").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_bin").alias("_g_bin"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_g_before"))
    inside = Window.partitionBy(*group, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(name, F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = (F.col("_bin") == F.col("_g_bin"))
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return rows.join(totals, same).withColumn(name, F.col(name) + F.col("_g_before")).drop("_bin", "_value", "_g_bin", "_g_before", *[f"_g_{c}" for c in group])
