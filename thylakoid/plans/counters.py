"""What a run left out and found, counted while it runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Counts on plans, taken by the job that runs them anyway; ``found`` has them after it."""

    def __init__(self) -> None:
        self.observed: dict[str, Observation] = {}

    def on(self, df: DataFrame, step: str, **conditions: Column) -> DataFrame:
        """``df``, whose rows are counted as ``{step}_rows``, and as ``{step}_{name}`` where a condition holds."""
        self.observed[step] = Observation(step)
        counts = [F.sum(F.when(c, 1).otherwise(0)).alias(f"{step}_{name}") for name, c in conditions.items()]
        return df.observe(self.observed[step], F.count(F.lit(1)).alias(f"{step}_rows"), *counts)

    def found(self) -> dict[str, int]:
        """All counts; waits for the job that takes them."""
        return {name: n or 0 for observation in self.observed.values() for name, n in observation.get.items()}
