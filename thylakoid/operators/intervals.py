"""Interval algebra by windows: islands, unions, depth, containment, overlaps.

Every window is partitioned by the caller's keys; none compares all intervals with all.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], touching: bool = False, start: str = "start", end: str = "end") -> DataFrame:
    """Add ``island``, numbered from 1 within ``keys``: intervals that overlap, directly or through others.

    With ``touching`` an interval that begins right after another joins it as well.
    """
    order = Window.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(seen.isNull() | (F.col(start) > (seen + 1 if touching else seen)), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def union_length(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """``keys`` and ``covered``, the number of positions in the union of the closed intervals."""
    merged = islands(df, keys, True, start, end).groupBy(*keys, "island").agg(F.min(start).alias("_s"), F.max(end).alias("_e"))
    return merged.groupBy(*keys).agg(F.sum(F.col("_e") - F.col("_s") + 1).cast("long").alias("covered"))


def depth(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """``keys``, ``start``, ``end``, ``depth`` of maximal stretches with one number of intervals, where it isn't 0."""
    edges = df.select(*keys, F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("step")), F.struct((F.col(end) + 1).alias("pos"), F.lit(-1).alias("step")))).alias("e"))
    edges = edges.groupBy(*keys, F.col("e.pos").alias("start")).agg(F.sum("e.step").alias("step")).filter("step <> 0")
    order = Window.partitionBy(*keys).orderBy("start")
    edges = edges.withColumn("depth", F.sum("step").over(order).cast("int")).withColumn("end", F.lead("start").over(order) - 1)
    return edges.filter("depth > 0").select(*keys, "start", "end", "depth")


def depth_members(df: DataFrame, keys: list[str], name: str, start: str = "start", end: str = "end") -> DataFrame:
    """The stretches of ``depth`` cut where their intervals change, with ``members``: the sorted distinct names of those that cover them.

    Each interval is put on the stretches between neighbouring bounds that it covers, so rows are
    as many as the lists' entries.
    """
    bounds = df.select(*keys, F.explode(F.array(F.col(start), F.col(end) + 1)).alias("start")).distinct()
    order = Window.partitionBy(*keys).orderBy("start")
    cells = bounds.withColumn("end", F.lead("start").over(order) - 1).withColumn("_n", F.row_number().over(order)).filter("end is not null")
    edge = lambda c, n: cells.select(*keys, F.col(c).alias(f"_{n}"), F.col("_n").alias(f"_{n}_n"))
    spans = df.select(*keys, F.col(start).alias("_a"), F.col(end).alias("_b"), F.col(name).alias("_name")).join(edge("start", "a"), [*keys, "_a"]).join(edge("end", "b"), [*keys, "_b"])
    held = spans.select(*keys, "_name", F.explode(F.sequence("_a_n", "_b_n")).alias("_n")).groupBy(*keys, "_n").agg(F.array_sort(F.collect_set("_name")).alias("members"))
    return cells.join(held, [*keys, "_n"]).select(*keys, "start", "end", "members")


def last_written(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, null keys among them; an aggregation, so copies go before the shuffle."""
    rank = F.struct(*[x for c in order for x in (F.col(c).isNotNull(), F.col(c))])
    last = df.groupBy(*key).agg(F.max_by(F.struct(*[c for c in df.columns if c not in key] or [F.lit(0).alias("_none")]), rank).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col("_last")[c].alias(c) for c in df.columns])


def drop_contained(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Rows whose interval lies in no other, larger interval; all rows of equal intervals share their fate."""
    spans = df.select(*keys, start, end).distinct()
    seen = F.max(end).over(Window.partitionBy(*keys).orderBy(start, F.desc(end)).rowsBetween(Window.unboundedPreceding, -1))
    kept = spans.withColumn("_seen", seen).filter(F.col("_seen").isNull() | (F.col("_seen") < F.col(end))).drop("_seen")
    return df.join(kept, [*keys, start, end], "left_semi")


def best_of_islands(df: DataFrame, keys: list[str], score: str, name: str, start: str = "start", end: str = "end") -> DataFrame:
    """Of each island the row with the highest score, the smallest ``name`` of equals."""
    rank = F.row_number().over(Window.partitionBy(*keys, "island").orderBy(F.desc(score), name))
    return islands(df, keys, False, start, end).withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "island")


def _strictly_overlap(a: tuple, b: tuple) -> bool:
    inside = a[0] < b[0] and b[1] < a[1] or b[0] < a[0] and a[1] < b[1]
    partly = a[0] < b[0] < a[1] < b[1] or b[0] < a[0] < b[1] < a[1]
    return inside or partly


def _longest_first(rows: list[tuple]) -> list[int]:
    """Greedy: longest first, then by name; bounds that touch or coincide don't exclude each other."""
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][3], rows[i][2]))
    kept: list[int] = []
    for i in order:
        if not any(_strictly_overlap(rows[i], rows[j]) for j in kept):
            kept.append(i)
    return kept


def _in_name_order(rows: list[tuple]) -> list[int]:
    """One after another by name against those kept so far; the longer stays, and of equals the later one unless the kept one begins first without holding it."""
    kept: list[int] = []
    dropped: set[int] = set()
    for i in sorted(range(len(rows)), key=lambda i: rows[i][2]):
        add = not kept
        for j in list(kept):
            if not _strictly_overlap(rows[j], rows[i]):
                add = True
                continue
            (s, e, _, old), (cs, ce, _, new) = rows[j], rows[i]
            left = s < cs and e < ce
            if old > new or left and old == new:
                dropped.add(i)
            else:
                kept.remove(j)
                dropped.add(j)
                add = True
        if add:
            kept.append(i)
    return [i for i in range(len(rows)) if i not in dropped]


def clean_overlaps(df: DataFrame, keys: list[str], name: str = "orf_id", length: Column | None = None, compat: bool = False) -> DataFrame:
    """Candidates of one reference that don't strictly overlap a longer one of it; copies elsewhere stay.

    ``length`` is by default end minus start.  ``compat`` goes through them in order of their names.
    Islands can't affect each other; those of a single candidate stay in the JVM, and the others, a
    handful of candidates each, go to Python many at a time.
    """
    rows = islands(df.withColumn("_length", length if length is not None else F.abs(F.col("end") - F.col("start"))), keys)
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "island")))
    choose, columns = _in_name_order if compat else _longest_first, df.columns

    @F.pandas_udf("array<int>")
    def pick(groups: pd.Series) -> pd.Series:
        return pd.Series([sorted(choose([(r["start"], r["end"], r["name"], r["length"]) for r in g])) for g in groups])

    alone = rows.filter("_n = 1").select(columns)
    span = F.struct("start", "end", F.col(name).alias("name"), F.col("_length").alias("length"))
    groups = rows.filter("_n > 1").groupBy(*keys, "island").agg(F.collect_list(F.struct(span.alias("span"), F.struct(*columns).alias("row"))).alias("g"))
    groups = groups.withColumn("kept", pick(F.transform("g", lambda r: r["span"])))
    kept = groups.select(F.explode(F.transform("kept", lambda i: F.get("g", i)["row"])).alias("r")).select("r.*")
    return alone.unionByName(kept)


def binned_overlap_join(a: DataFrame, b: DataFrame, keys: list[str], width: int, how: str = "inner") -> DataFrame:
    """Pairs of rows with equal keys and overlapping closed intervals (start, end), columns of ``b`` prefixed ``b_``.

    Both sides are put into the bins that they touch, so the range condition becomes an equi-join;
    a pair is taken in the first bin that it shares.
    """
    bins = lambda s, e: F.explode(F.sequence(F.floor(s / width), F.floor(e / width)))
    left = a.withColumn("_bin", bins(F.col("start"), F.col("end")))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]).withColumn("b__bin", bins(F.col("b_start"), F.col("b_end")))
    on = (F.col("_bin") == F.col("b__bin")) & (F.col("start") <= F.col("b_end")) & (F.col("b_start") <= F.col("end")) & (F.floor(F.greatest("start", "b_start") / width) == F.col("_bin"))
    for k in keys:
        on &= F.col(k) == F.col(f"b_{k}")
    return left.join(right, on, how).drop("_bin", "b__bin")
