"""Per-step counters (G7): emitted / acked / failed rows per step.

Each counter is a ``count`` aggregate over one branch of the plan; the
union runs as one Spark job and returns one small row per (step, status).
In streaming the same counts come from ``DataFrame.observe`` on the batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_as(df: DataFrame, step: str, status: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit(step).alias("step"), F.lit(status).alias("status"), "n")


def step_counters(parts) -> DataFrame:
    """``parts``: iterable of ``(step, status, df)``."""
    return reduce(lambda a, b: a.unionByName(b), [count_as(df, s, st) for s, st, df in parts])
