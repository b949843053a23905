"""Relational sinks: insert (K1) and check-then-write upsert (K2).

Sinks are pure ``(target, batch) -> new_target`` functions; a stream appends
what they give for a batch's keys to a table of
:mod:`tidewater.sinks.appended`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import last_by_key
from tidewater.operators.merge import matched_keys

# Status written by the insert statement of the commission sink.
INSERTED_STATUS = 1

# Positional binding of the commission sink: output column -> target column.
COMMISSION_BINDING = [
    ("order_type", "order_type"),
    ("commission_amount", "amount"),
    ("buy_account", "buy_account"),
    ("gorder_benefit_user", "benefit_user_account"),
    ("pay_amount", "sales_amount"),
    ("pay_success_time", "event_time"),
    ("gorder_id", "gorder_id"),
    ("order_id", "order_id"),
]
UPDATED_COLUMNS = ["order_type", "amount", "buy_account", "benefit_user_account",
                   "sales_amount", "event_time"]


def insert_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """K1: append (missing columns null)."""
    return target.unionByName(batch.select(*[c for c in batch.columns if c in target.columns]),
                              allowMissingColumns=True)


def bind_positional(df: DataFrame, binding=COMMISSION_BINDING) -> DataFrame:
    """Rename output columns to target columns by position (unknown -> null)."""
    have = set(df.columns)
    return df.select(*[(F.col(src) if src in have else F.lit(None)).alias(dst) for src, dst in binding])


def upsert(target: DataFrame, batch: DataFrame, check_key: str, update_keys,
           update_columns, insert_defaults: dict, order=None):
    """K2: check by ``check_key``; exists -> UPDATE ``update_columns`` where
    all ``update_keys`` match; else INSERT with ``insert_defaults``.

    Returns ``(new_target, lost)``.  ``lost`` are batch rows whose check key
    exists only under other update keys: the reference's UPDATE hits zero
    rows and the row vanishes; here it is reported instead.  Columns not in
    ``update_columns`` (e.g. ``status``) keep their value on update.  When
    ``order`` is given, repeated rows of a batch act as if written one by one
    in that order (ties by the update keys): of equal update keys the last one
    counts (G4), and of a new check key under several update keys the first
    one is inserted and the others are lost.  Otherwise the batch must already
    be unique per check key.
    """
    update_keys = [update_keys] if isinstance(update_keys, str) else list(update_keys)
    if order:
        # who comes first is decided before repeated rows are folded
        began = batch.groupBy(*update_keys).agg(F.min(F.struct(*order)).alias("__began"))
        batch = last_by_key(batch, update_keys, order)
    b = batch.select(*[F.col(c).alias(f"__b_{c}") for c in batch.columns])
    cond = None
    for k in update_keys:
        c = F.col(k) == F.col(f"__b_{k}")
        cond = c if cond is None else cond & c
    merged = target.join(b, cond, "left")
    hit = F.col(f"__b_{update_keys[0]}").isNotNull()
    updated = merged.select(*[
        F.when(hit, F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c) if c in update_columns
        else F.col(c) for c in target.columns])

    # Only target keys that occur in the batch are collected: the shuffle is
    # bounded by the batch, not by the target.
    target_keys = matched_keys(target, [(check_key, check_key)], batch)
    new_rows = batch.join(target_keys, check_key, "left_anti")
    late = None
    if order:
        first = (began.groupBy(check_key).agg(F.min_by(F.struct(*update_keys), F.struct("__began", *update_keys)).alias("__first"))
                 .select(*[F.col(f"__first.{k}").alias(k) for k in update_keys]))
        late = new_rows.join(first, update_keys, "left_anti")
        new_rows = new_rows.join(first, update_keys, "left_semi")
    inserts = new_rows.select(*[
        F.col(c) if c in batch.columns else
        (F.lit(insert_defaults[c]) if c in insert_defaults else F.lit(None)).cast(t).alias(c)
        for c, t in target.dtypes])
    existing = batch.join(target_keys, check_key, "left_semi")
    both = matched_keys(target, [(k, k) for k in update_keys], batch)
    lost = existing.join(both, update_keys, "left_anti")
    if late is not None:
        lost = lost.unionByName(late)
    return updated.unionByName(inserts), lost


def upsert_actions(target: DataFrame, batch: DataFrame, check_key: str, update_keys) -> DataFrame:
    """K2 decision per batch row: ``update`` (both keys match), ``lost``
    (check key exists under other update keys) or ``insert``."""
    update_keys = [update_keys] if isinstance(update_keys, str) else list(update_keys)
    cols = list(dict.fromkeys(update_keys + [check_key]))
    exists = matched_keys(target, [(check_key, check_key)], batch).withColumn("__exists", F.lit(True))
    match = matched_keys(target, [(k, k) for k in update_keys], batch).withColumn("__match", F.lit(True))
    j = batch.select(*cols).join(exists, check_key, "left").join(match, update_keys, "left")
    action = (F.when(F.col("__match"), F.lit("update"))
               .when(F.col("__exists"), F.lit("lost")).otherwise(F.lit("insert")))
    return j.select(*cols, action.alias("action"))


def upsert_commission(target: DataFrame, batch: DataFrame, order=None):
    """K2 as configured for the commission events: check by ``order_id``,
    update where ``gorder_id`` and ``order_id`` match, insert with status 1."""
    return upsert(target, batch, "order_id", ["gorder_id", "order_id"], UPDATED_COLUMNS,
                  {"status": INSERTED_STATUS}, order=order)
