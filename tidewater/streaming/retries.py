"""Retries of failed keys (S4): a due-time table keyed by (epoch, batch), with
attempts and back-off.

A failed key is written to the partition (epoch, batch, attempts) of the retry
table; a replay of the batch overwrites that partition with the same rows.  It
is due at once after its first failure, as in the reference, then after
``backoff`` seconds, twice that, and so on.  :meth:`RetryTable.release` appends
due keys to the queue folder under names made of (epoch, batch, attempts,
part), each a fixed share of the keys by hash: a file that is there already is
left alone, so neither a replay nor a crash between files queues a key twice.
The queue row carries the number of attempts; a key that has failed
``max_attempts`` times is not retried any more.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Failures after which a key stays dead-lettered, and seconds before a second retry.
MAX_ATTEMPTS = 5
BACKOFF = 2.0

#: Keys of one released file.
FILE_KEYS = 1_000_000

#: The type of a queue row that asks for another try.
REQUEUE = "requeue"


def attempts_of(event_type: str = "event_type", props: str = "props") -> Column:
    """How often the key of a queue row has failed before."""
    said = F.get_json_object(props, "$.attempts").cast("int")
    return F.when(F.col(event_type) == REQUEUE, F.coalesce(said, F.lit(1))).otherwise(F.lit(0))


def queue_rows(failed: DataFrame, epoch: int, batch_id: int) -> DataFrame:
    """Queue rows for another try of ``(gorder_id, attempts)``.  Their ids come
    from the failing batch, so a replayed batch requeues the same rows."""
    keys = failed.where(F.col("gorder_id").isNotNull()).groupBy("gorder_id").agg(F.max("attempts").alias("attempts"))
    return keys.select(F.xxhash64(F.lit("retry"), F.col("gorder_id"), F.lit(epoch), F.lit(batch_id)).alias("event_id"),
                       F.current_timestamp().cast("timestamp_ntz").alias("ts"), F.col("gorder_id").alias("user_id"),
                       F.lit(REQUEUE).alias("event_type"), F.lit(None).cast("double").alias("value"),
                       F.to_json(F.struct("attempts")).alias("props"))


class RetryTable:
    def __init__(self, spark: SparkSession, root: str, queue_folder: str, max_attempts: int = MAX_ATTEMPTS,
                 backoff: float = BACKOFF):
        self.spark, self.root, self.queue_folder = spark, root.rstrip("/"), queue_folder.rstrip("/")
        self.max_attempts, self.backoff = max_attempts, backoff
        self._one = threading.Lock()

    def record(self, epoch: int, batch_id: int, failed: DataFrame) -> None:
        """Write the keys to try again: ``(gorder_id, attempts)`` with the
        failures so far, this one included."""
        again = failed.where(F.col("gorder_id").isNotNull() & (F.col("attempts") < self.max_attempts))
        (again.select("gorder_id", "attempts").distinct().hint("rebalance").write.mode("overwrite").partitionBy("attempts")
         .parquet(f"{self.root}/epoch={epoch}/batch={batch_id}"))

    def _list(self, path: str) -> list:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = self._fs(p)
        return list(fs.listStatus(p)) if fs.exists(p) else []

    def _fs(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def due_after(self, attempts: int) -> float:
        """Seconds between the failure and the next try."""
        return 0.0 if attempts <= 1 else self.backoff * 2 ** (attempts - 2)

    def waiting(self) -> list[tuple[int, int, int, float]]:
        """(epoch, batch, attempts, due time) of every recorded partition."""
        found = []
        for e in self._list(self.root):
            for b in self._list(e.getPath().toString()):
                parts = {p.getPath().getName(): p for p in self._list(b.getPath().toString())}
                if "_SUCCESS" not in parts:
                    continue
                failed_at = parts["_SUCCESS"].getModificationTime() / 1000
                number = lambda name: int(name.split("=")[1])
                found += [(number(e.getPath().getName()), number(b.getPath().getName()), number(a),
                           failed_at + self.due_after(number(a))) for a in parts if a.startswith("attempts=")]
        return sorted(found)

    def release(self, now: float | None = None) -> int:
        """Append the due keys to the queue folder; the number of files.  The
        stream's batches and :meth:`QueueJobStream.serve` call it from threads
        of their own: one at a time, as each deletes what it has released."""
        with self._one:
            now, files = time.time() if now is None else now, 0
            for epoch, batch_id, attempts, due in self.waiting():
                if due <= now:
                    files += self._release(epoch, batch_id, attempts)
            return files

    def _release(self, epoch: int, batch_id: int, attempts: int) -> int:
        own = f"{self.root}/epoch={epoch}/batch={batch_id}/attempts={attempts}"
        keys = self.spark.read.parquet(own).withColumn("attempts", F.lit(attempts))
        parts = 1 + keys.count() // FILE_KEYS
        rows = queue_rows(keys, epoch, batch_id).withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)))
        made = f"{self.root}/_release/{epoch}-{batch_id}-{attempts}"
        rows.repartition(parts, "part").write.mode("overwrite").partitionBy("part").parquet(made)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs, files = self._fs(path(self.queue_folder)), 0
        fs.mkdirs(path(self.queue_folder))
        for folder in self._list(made):
            for f in self._list(folder.getPath().toString()) if "=" in folder.getPath().getName() else []:
                if f.getPath().getName().startswith("part-"):
                    name = f"retry-{epoch}-{batch_id}-{attempts}-{folder.getPath().getName().split('=')[1]}.parquet"
                    to = path(f"{self.queue_folder}/{name}")
                    files += int(not fs.exists(to) and fs.rename(f.getPath(), to))
        for gone in (made, own):
            self._fs(path(gone)).delete(path(gone), True)
        return files
