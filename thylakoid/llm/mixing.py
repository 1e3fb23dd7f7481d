"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens to the power of an exponent, normalised.  Exponent 1
keeps the shares, 0 makes sources equal.  The exponent is found by bisection, as the smallest that
keeps the entropy at most at a target and the repetition of each source within a limit.  The
weights are then realised as blocks of a token budget: each source is gone through in a random
permutation for each epoch, and gives each block its weight's part of the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from thylakoid.llm.common import cumulative, durable, fresh, repeated, row_hash, sized_join, skewed_join

#: Bisections that one pass over the table of sources evaluates.
DEPTH, PASSES = 5, 6


def token_count(text: Column) -> Column:
    """Words of a text, and one for its end; a null text has its end only."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def fit_exponent(shares: DataFrame, entropy: float | None = None, repetition: float | None = None, budget_ratio: float | None = None) -> float:
    """The smallest exponent from 0 to 1 for which entropy and repetition are within their limits.

    ``shares`` has ``p``, the share of each source.  ``entropy`` is a fraction of the logarithm of
    the number of sources.  ``budget_ratio`` is the budget by the corpus's tokens, or None for the
    smallest budget that uses every document once.  Both measures fall as the exponent rises, so
    it can be bisected; each pass evaluates 2^DEPTH - 1 exponents in one aggregation, and the
    table of sources is never collected.  Limits that no exponent meets give 1, which comes nearest
    to an entropy; with a budget too large for the corpus, sources then repeat beyond the limit.
    """
    n, least, most = shares.agg(F.count(F.lit(1)), F.min("p"), F.max("p")).first()
    if not n or n == 1:
        return 1.0
    low, high = 0.0, 1.0
    steps = 1 << DEPTH

    def within(a: float, z: float, s: float) -> bool:
        times = (most / least) ** (1 - a) if budget_ratio is None else budget_ratio * least ** (a - 1) / z
        return (entropy is None or math.log(z) - a * s / z <= entropy * math.log(n) + 1e-12) and (repetition is None or times <= repetition)

    for k in range(PASSES):
        tried = [low + (high - low) * i / steps for i in range(0 if k == 0 else 1, steps)]
        sums = shares.agg(*[f for i, a in enumerate(tried) for f in (F.sum(F.pow("p", F.lit(a))).alias(f"z{i}"), F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"s{i}"))]).first()
        good = [a for i, a in enumerate(tried) if within(a, sums[f"z{i}"], sums[f"s{i}"])]
        if k == 0 and good and good[0] == 0.0:
            return 0.0
        bad = [a for a in tried if not good or a < good[0]]
        low, high = (bad[-1] if bad else low), (good[0] if good else high)
    return high


def source_weights(tokens: DataFrame, entropy: float | None, repetition: float | None, budget: int | None) -> tuple[DataFrame, float]:
    """``_source``, ``tokens``, ``rows``, ``weight`` and ``quota`` (tokens to take) of each source; and the exponent.

    ``tokens`` has ``_source`` and ``_tokens``, of at least 1 in each row.
    """
    totals = durable(tokens.groupBy("_source").agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")))
    whole = totals.agg(F.sum("tokens")).first()[0] or 1
    shares = totals.withColumn("p", F.col("tokens") / F.lit(float(whole)))
    exponent = fit_exponent(shares, entropy, repetition, None if budget is None else budget / whole)
    z, most = shares.agg(F.sum(F.pow("p", F.lit(exponent))), F.max("p")).first()
    aim = float(budget) if budget is not None else whole * (z or 1.0) * (most or 1.0) ** (1 - exponent)
    weight = F.pow("p", F.lit(exponent)) / F.lit(z or 1.0)
    quota = F.ceil(weight * aim - F.lit(1e-6)).cast("long")
    return shares.select("_source", "tokens", "rows", weight.alias("weight"), quota.alias("quota")), exponent


def mixing_plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", *, ident: Column | None = None, entropy: float | None = None, repetition: float | None = 2.0, budget: int | None = None, block_tokens: int = 1 << 20, seed: int = 1) -> DataFrame:
    """A row for each use of a document: ``key``, ``source``, ``n_tokens``, ``epoch``, ``block``, ``slot``.

    A document is used in an epoch if it begins within what is left of its source's quota, so a
    source exceeds its quota by less than a document.  Without ``budget`` every document is used
    at least once.  ``slot`` orders a block at random, from 0.  Null sources are a source of their
    own; null texts count one token; equal rows are used apart from each other; an empty table
    gives an empty one.  Rows also have ``_ident``, which is ``ident`` or a hash of key, source and text.
    """
    ident = ident if ident is not None else row_hash(docs, [key, source, text])
    rows = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), token_count(F.col(text)).alias("_tokens"), ident.alias("_ident"))
    rows = durable(rows.groupBy("_key", "_source", "_tokens", "_ident").agg(F.count(F.lit(1)).alias("_n")))
    weights, _ = source_weights(rows.select("_source", (F.col("_tokens") * F.col("_n")).alias("_tokens")), entropy, repetition, budget)
    weights = durable(weights.withColumn("_of", row_hash(weights, ["_source"])).drop("_source"))
    n_sources, total = weights.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    joined = skewed_join(rows.withColumn("_of", row_hash(rows, ["_source"])), weights, "_of", "rows", total, n_sources)
    uses = repeated(joined, "_n", "copy").withColumn("_epochs", F.floor((F.col("quota") - 1) / F.col("tokens")) + 1)
    uses = repeated(uses.filter("_epochs > 0"), "_epochs", "epoch")
    uses = uses.withColumn("_at", F.xxhash64(F.lit(seed), "epoch", "_ident", "copy"))
    uses = cumulative(uses, ["_source", "epoch"], ["_at", "_ident", "copy"], F.col("_tokens"), "_before")
    uses = uses.withColumn("_before", F.col("_before") + F.col("epoch") * F.col("tokens")).filter("_before < quota")
    uses = uses.withColumn("block", F.floor(F.col("_before") / (F.col("weight") * block_tokens)).cast("long"))
    inside = Window.partitionBy("block").orderBy("_at", "_ident", "copy")
    return uses.select(
        F.col("_key").alias(key), F.col("_source").alias(source), F.col("_tokens").alias("n_tokens"), "epoch", "block", (F.row_number().over(inside) - 1).cast("long").alias("slot"), "_ident"
    )


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixing_plan`` uses it.

    Rows that differ in any column are rows of their own; only rows that are equal throughout
    stand for each other, and only those are shuffled.
    """
    ident, uses, use = fresh(docs, "ident"), fresh(docs, "uses"), fresh(docs, "use")
    plan = mixing_plan(docs, key, source, text, ident=row_hash(docs), **how)
    counts = durable(plan.groupBy(F.col("_ident").alias(ident)).agg(F.count(F.lit(1)).alias(uses)))
    rows = docs.withColumn(ident, row_hash(docs))
    again = durable(rows.groupBy(ident).agg(F.count(F.lit(1)).alias(use)).filter(F.col(use) > 1).select(ident))
    if again.take(1):
        rows = sized_join(rows, again, [ident], "left_anti").unionByName(sized_join(rows, again, [ident], "left_semi").dropDuplicates([ident]))
    return repeated(sized_join(rows, counts, [ident], "inner"), uses, use).select(docs.columns)
