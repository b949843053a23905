"""Change-queue source: bounded scan, claim, strip, requeue.

The reference polls ``SELECT ... LIMIT n`` without ORDER BY, deletes the
claimed rows one by one *before* processing and re-inserts the message key
when a row fails.  Here the queue is an append-only table:

* a poll is ``orderBy(order).limit(n)`` -> TakeOrderedAndProject, i.e. a
  per-partition top-n and one merge of at most ``n * partitions`` rows;
* a claim is the poll plus the queue minus the claimed delete keys.  The
  limit tells the planner that the key set has at most ``n`` rows, so it
  broadcasts a small one of its own accord and does not shuffle the queue;
* in streaming, progress is the checkpoint, so nothing is deleted and no
  row is lost between claim and work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per poll of the shipped chains.
POLL_ROWS_ORDER_SEARCH = 1000
POLL_ROWS_COMMISSION = 2


def poll(queue: DataFrame, n: int, order_by=("id",)) -> DataFrame:
    """The first ``n`` queue rows in a total order (deterministic)."""
    return queue.orderBy(*order_by).limit(n)


def claim(queue: DataFrame, n: int, delete_key: str = "id", order_by=("id",), payload_key: str = "gorder_id"):
    """Claim ``n`` rows; returns ``(claimed, remaining)``.

    ``claimed`` has the delete key stripped unless it is also the
    ``payload_key``.  ``remaining`` is the queue after the claim's deletes: with
    the payload key as the delete key every row of a claimed checkout goes,
    even rows that were not claimed.  Null delete keys delete nothing.
    """
    polled = poll(queue, n, order_by)
    keys = polled.select(delete_key).where(F.col(delete_key).isNotNull()).distinct()
    remaining = queue.join(keys, delete_key, "left_anti")
    claimed = polled if delete_key == payload_key else polled.drop(delete_key)
    return claimed, remaining


def requeue(queue: DataFrame, failed: DataFrame, key: str = "gorder_id",
            now=None, attempt_tag: str = "retry") -> DataFrame:
    """Append failed message keys to the queue as new rows.

    New ids are a hash of (tag, key): deterministic across task retries and
    replays, no global counter.  ``now`` is the requeue time (defaults to
    the current timestamp; tests pass a literal).
    """
    ts = F.current_timestamp().cast("timestamp_ntz") if now is None else F.lit(now).cast("timestamp_ntz")
    back = (failed.select(key).where(F.col(key).isNotNull()).distinct()
            .select(F.xxhash64(F.lit(attempt_tag), F.col(key)).alias("id"),
                    F.col(key), ts.alias("create_time"),
                    F.lit("requeue").alias("event_type")))
    return queue.unionByName(back, allowMissingColumns=True)
