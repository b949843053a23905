"""Tables bucketed by their lookup key.

A lookup hashes its key; a table that is stored in buckets of that hash, sorted
by it, joins a batch without an exchange or sort of its own: only the batch is
dealt, to as many partitions as there are buckets.  The bucket number is the
table's own (kept with its definition), so several tables of one key and number
join each other where they lie.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidewater.session import STAGE_CODEC, freed_shuffles

#: Buckets of one table; a power of two per few hundred MB of it is usual.
BUCKETS = 32
#: Buckets that a task keeps open; the rows of more are sorted.
OPEN_BUCKETS = 64


def store_bucketed(df: DataFrame, key: str, path: str, name: str | None = None, buckets: int = BUCKETS, deal: bool = True,
                   sort: bool = True) -> DataFrame:
    """Write ``df`` in buckets of ``key`` under ``path`` as table ``name`` (a
    new name by default) and read it.  ``deal`` false: its rows are dealt by
    the key already and stay in their tasks.  ``sort`` false, for wide rows: a
    task's buckets are written side by side, in no order within."""
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    out = ((df.repartition(buckets, key) if deal else df).write.mode("overwrite").option("path", path)
           .option("compression", STAGE_CODEC).bucketBy(buckets, key))
    with freed_shuffles(df.sparkSession, 0 if sort else OPEN_BUCKETS, sorted_groups=not sort):
        (out.sortBy(key) if sort else out).saveAsTable(name)
    return df.sparkSession.table(name)
