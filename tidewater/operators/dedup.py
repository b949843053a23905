"""Distinct keys and last-write-wins.

Both are aggregates, so Spark combines map-side before the shuffle: a key
that owns a third of the rows reaches the exchange as one row per input
partition, not as a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The distinct non-null keys of a batch."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.select(*keys).where(cond).distinct()


def last_of_repeated(df: DataFrame, repeated: DataFrame, key: str, order) -> DataFrame:
    """:func:`last_by_key` for a key that seldom repeats: ``repeated`` holds
    every key that may.  All other rows stay where they are."""
    few = repeated.select(F.col(key).alias("__repeated")).distinct()
    same = F.col(key) == F.col("__repeated")
    return (df.join(few, same, "left_anti")
            .unionByName(last_by_key(df.join(few, same, "left_semi"), key, order)))


def last_by_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the greatest by ``order`` (e.g. ``["ts", "id"]``).

    ``max_by`` over a struct of all other columns is a partial aggregate;
    a row-number window would sort a hot key's rows in one task.  The order
    must be total within a key (add the event id) for a deterministic pick.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
                .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]),
                              F.struct(*[F.col(f"`{c}`") for c in order])).alias("__last")))
    return picked.select(*keys, *[F.col(f"__last.`{c}`").alias(c) for c in rest]).select(*df.columns)
