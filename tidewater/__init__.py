"""tidewater: change-driven enrichment on Spark.

A queue of changed keys is read as a batch or a stream, the keys are looked
up in dimension and fact tables with left joins in which the incoming row
wins, order documents are built flat and nested last, and target tables are
upserted, partially updated, replaced by group or pruned.  Every operator is
a ``DataFrame -> DataFrame`` function; sinks are ``(target, batch) -> target``
functions plus a versioned writer for ``foreachBatch``.
"""

from tidewater.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
