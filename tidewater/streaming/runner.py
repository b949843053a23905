"""Structured Streaming driver for the jobs (S5, S6, K14, section 2.8).

The queue is a file stream (parquet files appended to a folder).  Each
micro-batch runs a job's batch function inside ``foreachBatch``:

* the static tables are re-read inside the batch, so every batch sees
  fresh lookups (the reference re-queries per row);
* the batch's rows are appended to an
  :class:`~tidewater.sinks.appended.AppendedTable`; readers resolve each
  group to its latest batch.  A replay overwrites its own rows, so output is
  effectively-once on top of the checkpoint's at-least-once input, and no
  batch rewrites what it does not hold;
* failing keys are written to a dead-letter folder (one sub-folder per
  batch id, overwritten on replay) and, until they have failed
  ``max_attempts`` times, to a :class:`~tidewater.streaming.retries.RetryTable`,
  which appends them to the queue folder when they are due (S4);
* the target merges its log once enough batches wait, so that what a batch
  reads stays flat;
* per-batch counters (G7): queue rows come from an ``Observation``, rows
  written and dead-lettered from the footers of the written files, input rows
  and trigger time from a ``StreamingQueryListener`` (:class:`ProgressLog`).

Triggers: ``processingTime`` (the reference polls every second) or
``availableNow`` for tests and catch-up runs.  ``max_files`` or ``max_bytes``
bounds a micro-batch (back-pressure, S6).
"""

from __future__ import annotations

import os
import time
from collections import deque

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewater.plans import jobs
from tidewater.session import checkpoint_root, materialize, prepare_session, stage_scope
from tidewater.sinks.appended import MERGE_AFTER, AppendedTable
from tidewater.sinks.table import upsert_commission
from tidewater.sources import roles
from tidewater.streaming.retries import BACKOFF, MAX_ATTEMPTS, REQUEUE, RetryTable, attempts_of

# Fixed value: the reference polls the queue once per second.
POLL_INTERVAL = "1 second"

# Queue files per micro-batch unless the caller says otherwise.
MAX_FILES = 64
# Batches whose counters the driver keeps; a job never ends.
KEPT_BATCHES = 1000


def queue_stream(spark: SparkSession, folder: str, schema, file_glob: str | None = None,
                 max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Queue rows as a stream, in the queue role's column names.  A micro-batch
    is bounded by ``max_bytes`` if given (one file at least), else by files."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    elif max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    raw = reader.parquet(folder)
    return raw.select(F.col("event_id").alias("id"), F.col("user_id").alias("gorder_id"),
                      F.col("ts").alias("create_time"), "event_type", "value", "props")


class ProgressLog(StreamingQueryListener):
    """G7 from the query side: input rows and trigger duration per
    micro-batch, as reported by the streaming engine."""

    def __init__(self, query_name: str):
        super().__init__()
        self.query_name = query_name
        self.batches: deque[dict] = deque(maxlen=KEPT_BATCHES)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.name == self.query_name:
            self.batches.append({"batch_id": p.batchId, "input_rows": p.numInputRows,
                                 "trigger_ms": p.durationMs.get("triggerExecution")})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


class QueueJobStream:
    """A job as a streaming query: queue folder -> appended target.

    Subclasses say how a micro-batch is enriched (:meth:`enrich`), what rows
    it appends (:meth:`to_append`), what the target starts as
    (:meth:`initial_state`) and which columns a batch replaces as a group.
    ``then`` is called with the batch's rows after they are written, the next
    step of a chain (K14).
    """

    name = "queue-job"
    group_cols: tuple[str, ...] = ("gorder_id",)
    #: Keys whose older rows a batch hides, and what decides a row's bucket.
    identities: tuple[tuple[str, ...], ...] | None = None
    routed_by: tuple[str, ...] | None = None

    def __init__(self, spark: SparkSession, sf_dir: str, queue_folder: str, work_root: str | None = None,
                 file_glob: str | None = None, max_files: int | None = MAX_FILES,
                 requeue_folder: str | None = None, then=None, buckets: int | None = None,
                 max_bytes: int | None = None, max_attempts: int = MAX_ATTEMPTS, backoff: float = BACKOFF,
                 merge_after: int = MERGE_AFTER):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir
        self.queue_folder = queue_folder
        self.file_glob = file_glob
        self.max_files, self.max_bytes = max_files, max_bytes
        root = work_root or checkpoint_root(spark, f"{self.name}-stream")
        self.then = then
        self.index = AppendedTable(spark, os.path.join(root, "index"), self.group_cols, os.path.join(root, "epoch"),
                                   self.identities, self.routed_by, buckets, merge_after)
        self.retries = None if requeue_folder is None else RetryTable(
            spark, os.path.join(root, "retries"), requeue_folder, max_attempts, backoff)
        self.max_attempts = max_attempts
        self.dead_root = os.path.join(root, "dead-letter")
        self.checkpoint = os.path.join(root, "checkpoint")
        self.counters: deque[dict] = deque(maxlen=KEPT_BATCHES)

    # -- job specifics -----------------------------------------------------
    def initial_state(self) -> DataFrame:
        raise NotImplementedError

    def enrich(self, batch: DataFrame):
        """``(rows for the sink, dead-letter rows with gorder_id, dl_reason)``."""
        raise NotImplementedError

    def to_append(self, rows: DataFrame, batch_id: int):
        """``(rows to append, rows that the sink could not place or None)``."""
        return rows, None

    # -- micro-batch -------------------------------------------------------
    def process(self, batch: DataFrame, batch_id: int) -> None:
        with stage_scope(self.spark):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        # Queue rows are observed on their way in; what was written is
        # counted from the files' footers (a plan that turns out to be empty
        # drops an observation).
        seen_in = Observation(f"{self.name}-in-{batch_id}")
        self.index.initialize(self.initial_state)
        batch = materialize(batch.observe(seen_in, F.count(F.lit(1)).alias("n")), f"{self.name}-queue")
        tries = (batch.where(F.col("event_type") == REQUEUE).groupBy("gorder_id")
                 .agg(F.max(attempts_of()).alias("attempts")))
        rows, dead = self.enrich(batch)
        rows, lost = self.to_append(materialize(rows, f"{self.name}-batch"), batch_id)
        dead = dead.select("gorder_id", "dl_reason")
        if lost is not None:
            dead = dead.unionByName(lost.select("gorder_id", F.lit("lost update").alias("dl_reason")))
        # Dead-letter and requeue first, the batch's rows last; every write
        # overwrites what an earlier try of the same batch left.
        dead_path = os.path.join(self.dead_root, f"epoch={self.index.epoch}", f"batch={batch_id}")
        dead = dead.join(tries, "gorder_id", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1)
        # a lost update cannot succeed later
        retried = (F.col("dl_reason") != "lost update") & (F.col("attempts") < self.max_attempts)
        dead = dead.withColumn("final", ~retried if self.retries is not None else F.lit(True))
        dead.write.mode("overwrite").parquet(dead_path)
        n_dead = self.spark.read.parquet(dead_path).count()
        if self.retries is not None:
            self.retries.record(self.index.epoch, batch_id, self.spark.read.parquet(dead_path).where("not final"))
        self.index.append(batch_id, rows)
        self.index.maintain()
        if self.retries is not None:
            self.retries.release()
        if self.then is not None:
            self.then(rows, batch_id)
        self.counters.append({"batch_id": batch_id, "queue_rows": seen_in.get["n"],
                              "emitted": self.index.appended(batch_id), "dead": n_dead})

    def run(self, available_now: bool = True, timeout: float | None = None):
        schema = self.spark.read.parquet(
            os.path.join(self.queue_folder, self.file_glob) if self.file_glob else self.queue_folder).schema
        stream = queue_stream(self.spark, self.queue_folder, schema, self.file_glob, self.max_files, self.max_bytes)
        query_name = f"{self.name}-{os.path.basename(self.checkpoint.rstrip('/'))}-{id(self)}"
        self.progress = ProgressLog(query_name)
        self.spark.streams.addListener(self.progress)
        writer = (stream.writeStream.foreachBatch(self.process).queryName(query_name)
                  .option("checkpointLocation", self.checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
            processingTime=POLL_INTERVAL)
        q = writer.start()
        if available_now:
            q.awaitTermination(timeout)
            # Listener events arrive asynchronously: let the log catch up
            # with the processed batches (bounded wait), then detach.
            for _ in range(50):
                if len(self.progress.batches) >= len(self.counters):
                    break
                time.sleep(0.1)
            self.spark.streams.removeListener(self.progress)
        return q

    def serve(self, query, poll: float = 1.0) -> None:
        """Wait for a running query, releasing retries as they fall due also
        while no other queue file arrives."""
        while not query.awaitTermination(poll):
            if self.retries is not None:
                self.retries.release()

    def result(self) -> DataFrame:
        self.index.initialize(self.initial_state)
        return self.index.read()


class OrderSearchStream(QueueJobStream):
    """Order documents, each claimed checkout's group replaced (K9)."""

    name = "order-search"
    group_cols = ("shop_id", "gorder_id")
    identities = (("shop_id", "gorder_id"), ("shop_id", "doc_id"))
    routed_by = ("shop_id",)

    def initial_state(self) -> DataFrame:
        return jobs.order_index_as_of(self.spark, self.sf_dir)

    def enrich(self, batch: DataFrame):
        return jobs.order_document_batch(self.spark, self.sf_dir, batch)


class CommissionStream(QueueJobStream):
    """Commission events upserted (K2) by order id, the check key; a lost
    cross-checkout update is dead-lettered (not requeued: a retry cannot
    succeed)."""

    name = "commission"
    group_cols = ("order_id",)

    def initial_state(self) -> DataFrame:
        return roles.commission_target(self.spark, self.sf_dir)

    def enrich(self, batch: DataFrame):
        rows, dead = jobs.commission_batch(batch, roles.gorders(self.spark, self.sf_dir),
                                           roles.orders(self.spark, self.sf_dir))
        return rows, dead

    def to_append(self, rows: DataFrame, batch_id: int):
        # the state of the batch's orders alone, as it was before the batch
        state = materialize(self.index.read((self.index.epoch, batch_id), only=rows), "commission-state")
        return upsert_commission(state, rows, order=jobs.COMMISSION_ORDER)


class ItemIndexStream(QueueJobStream):
    """Item documents indexed by item id (K3)."""

    name = "item-index"
    group_cols = ("doc_id",)

    def initial_state(self) -> DataFrame:
        before, _ = jobs.item_index_batch(self.spark, self.sf_dir,
                                          roles.gorders(self.spark, self.sf_dir).select("gorder_id"),
                                          orders_before=roles.INDEX_AS_OF, rebuild=True)
        return before

    def enrich(self, batch: DataFrame):
        return jobs.item_index_batch(self.spark, self.sf_dir, batch)
