"""A streamed target kept by appending: every batch writes only its own rows,
readers resolve the current state.

A batch's rows go to the partition (epoch, batch, bucket) of a log.  The epoch
is the checkpoint's own number, one more than any stored one, drawn once when
the checkpoint is new, so batch ids that start anew with a new checkpoint never
meet older ones, whatever a machine's clock says.  A replay overwrites its own
partitions with the same rows, whatever its age.

What is current.  ``identities`` are lists of key columns (a checkout's
documents, a document id within its routing).  A row is current if, for each of
them, no later batch has rows of the same key: a batch replaces the groups and
the documents that it holds.

Buckets.  Rows are dealt to ``buckets`` folders by a hash of ``bucket_by``
(the routing), which the table stores with its schema; opening it with another
number fails.  A batch's state or one routing value's documents are read from
their buckets alone.

Merging.  After ``merge_after`` batches :meth:`maintain` merges the log into a
segment, together with the last segments while they are at most twice as large
as what is merged so far: there are O(log n) segments, a row is rewritten
O(log n) times, and what a batch has to read stays flat.  A new manifest, the
last thing written, switches every reader, also that of a running stream, to
the merged form; folders go when no manifest of the last two names them.  A
merge without the oldest segment keeps rows that are the latest for any of
their keys, since they still hide older rows.  The latest batch is never
merged: it may be replayed, and what was there before it must stay readable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.places import by_keys
from tidewater.session import STAGE_CODEC, freed_shuffles, stage_scope

ORDER = ("epoch", "batch")
BUCKETS = 16
#: Buckets that a task of the first write keeps open; the rows of more are sorted.
OPEN_BUCKETS = 64
MERGE_AFTER = 8


class AppendedTable:
    def __init__(self, spark: SparkSession, root: str, group_cols: list[str], epoch_path: str,
                 identities: list[list[str]] | None = None, bucket_by: list[str] | None = None,
                 buckets: int | None = None, merge_after: int = MERGE_AFTER):
        self.spark, self.root, self.group_cols = spark, root.rstrip("/"), list(group_cols)
        self.identities = [list(k) for k in identities or [group_cols]]
        self.bucket_by, self._asked, self.merge_after = list(bucket_by or group_cols), buckets, merge_after
        self.epoch_path = epoch_path
        self._epoch: int | None = None
        self._meta = None

    # ------------------------------------------------------------- folders
    def _try(self, path: str) -> DataFrame | None:
        """The table at ``path``, if a write finished there."""
        return self.spark.read.parquet(path) if self._finished(path) else None

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[int]:
        """The numbers ``n`` of the sub-folders ``key=n`` that a write finished."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if "=" in s.getPath().getName())

    def _finished(self, path: str) -> bool:
        fs, p = self._fs(f"{path}/_SUCCESS")
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    # ------------------------------------------------------------ contents
    @property
    def epoch(self) -> int:
        """The checkpoint's number; later checkpoints have greater ones."""
        if self._epoch is None:
            kept = self._try(self.epoch_path)
            if kept is None:
                stored = [*self._names(f"{self.root}/log"), *(m.epoch for m in self._manifest()[1]), 0]
                self.spark.createDataFrame([(max(stored) + 1,)], "epoch long").coalesce(1).write.parquet(self.epoch_path)
                kept = self.spark.read.parquet(self.epoch_path)
            self._epoch = kept.first()[0]
        return self._epoch

    def _open(self) -> bool:
        """Read the stored schema and number of buckets, if there is a table."""
        if self._meta is None:
            kept = self._try(f"{self.root}/meta")
            if kept is None:
                return False
            row = kept.first()
            if self._asked not in (None, row.buckets) or list(row.bucket_by) != self.bucket_by:
                raise ValueError(f"{self.root} holds {row.buckets} buckets by {list(row.bucket_by)}, "
                                 f"not {self._asked} by {self.bucket_by}")
            self._meta = (StructType.fromJson(_json(row.schema)), row.buckets)
        return True

    @property
    def buckets(self) -> int:
        self._open()
        return self._meta[1]

    def bucket(self) -> Column:
        """The bucket of a row, by its ``bucket_by`` columns."""
        own = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in self.bucket_by))
        return F.pmod(F.xxhash64(own), F.lit(self.buckets)).cast("int")

    def initialize(self, state) -> None:
        """Write the first state (a function that gives it) if there is none."""
        if self._open() and self._manifest()[0]:
            return
        # what the first state was made from goes once it is written
        with stage_scope(self.spark):
            self._initialize(state())

    def _initialize(self, rows: DataFrame) -> None:
        if not self._open():
            meta = [(rows.schema.json(), self._asked or BUCKETS, self.bucket_by)]
            self.spark.createDataFrame(meta, "schema string, buckets int, bucket_by array<string>").coalesce(1).write.mode(
                "overwrite").parquet(f"{self.root}/meta")
            self._open()
        # as large as the table: written by the tasks that hold the rows, not exchanged
        n = self._write(rows.withColumns({c: F.lit(0).cast("long") for c in ORDER}), f"{self.root}/segments/segment=0", deal=False)
        self._publish([(0, n)], (0, 0))

    def _write(self, rows: DataFrame, path: str, deal: bool = True) -> int:
        rows = rows.withColumn("bucket", self.bucket())
        with freed_shuffles(self.spark, 0 if deal else OPEN_BUCKETS):
            (rows.hint("rebalance", "bucket") if deal else rows).write.mode("overwrite").partitionBy("bucket").parquet(
                path, compression=STAGE_CODEC)
        return self.spark.read.parquet(path).count() if self._finished(path) and self._names(path) else 0

    def append(self, batch_id: int, rows: DataFrame) -> None:
        """Write (or, on a replay, write again) the batch's rows."""
        self._open()
        held = rows.select(*[F.col(c).cast(f.dataType).alias(c) if (c := f.name) in rows.columns
                             else F.lit(None).cast(f.dataType).alias(c) for f in self._meta[0]])
        with freed_shuffles(self.spark):
            (held.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.root}/log/epoch={self.epoch}/batch={batch_id}", compression=STAGE_CODEC))

    def appended(self, batch_id: int) -> int:
        """How many rows the batch's partition holds (from file footers)."""
        path = f"{self.root}/log/epoch={self.epoch}/batch={batch_id}"
        return self.spark.read.parquet(path).count() if self._names(path) else 0

    def _manifest(self) -> tuple[int, list]:
        """The latest manifest's number (0: none) and rows: live segments with
        their rows, oldest first, and up to which batch they hold the log."""
        for n in reversed(self._names(f"{self.root}/manifests")):
            if self._finished(f"{self.root}/manifests/manifest={n}"):
                return n, self.spark.read.parquet(f"{self.root}/manifests/manifest={n}").orderBy("segment").collect()
        return 0, []

    def _publish(self, segments: list[tuple[int, int]], upto: tuple[int, int]) -> None:
        n = self._manifest()[0] + 1
        rows = [(s, r, *upto) for s, r in segments]
        self.spark.createDataFrame(rows, "segment long, rows long, epoch long, batch long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/manifests/manifest={n}")

    def _log(self) -> DataFrame | None:
        if not self._names(f"{self.root}/log"):
            return None
        kinds = StructType(list(self._meta[0])).add("epoch", "long").add("batch", "long").add("bucket", "integer")
        return self.spark.read.schema(kinds).option("basePath", f"{self.root}/log").parquet(f"{self.root}/log")

    def _segment(self, n: int) -> DataFrame:
        kinds = StructType(list(self._meta[0])).add("epoch", "long").add("batch", "long").add("bucket", "integer")
        path = f"{self.root}/segments/segment={n}"
        return self.spark.read.schema(kinds).option("basePath", path).parquet(path)

    def rows(self, before: tuple[int, int] | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All stored rows with epoch, batch and bucket: of ``before`` only
        older ones, of ``buckets`` only theirs (both prune folders)."""
        return reduce(DataFrame.unionByName, self._parts(before, buckets))

    def _parts(self, before: tuple[int, int] | None = None, buckets: list[int] | None = None) -> list[DataFrame]:
        """:meth:`rows` by segment, oldest first, and the log."""
        self._open()
        _, live = self._manifest()
        parts = [self._segment(m.segment) for m in live]
        log = self._log()
        if log is not None:
            parts.append(log.where(_after((live[-1].epoch, live[-1].batch))) if live else log)
        if buckets is not None:
            parts = [p.where(F.col("bucket").isin(buckets)) for p in parts]
        if before is not None:
            parts = [p.where((F.col("epoch") < before[0]) | ((F.col("epoch") == before[0]) & (F.col("batch") < before[1]))) for p in parts]
        return parts

    def _buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of a batch's rows: at most as many as the table has."""
        return sorted(r[0] for r in keys.select(self.bucket().alias("bucket")).distinct().collect())

    def read(self, before: tuple[int, int] | None = None, only: DataFrame | None = None, routing: dict | None = None) -> DataFrame:
        """The current state.  ``only`` restricts it to a batch's groups, read
        from the batch's buckets; ``routing`` (all of ``bucket_by``) to one
        routing value, read from its bucket."""
        self._open()
        buckets = None
        if routing is not None:
            one = self.spark.createDataFrame([tuple(routing.values())], StructType(
                [f for c in routing for f in self._meta[0] if f.name == c]))
            buckets = self._buckets_of(one)
        elif only is not None:
            buckets = self._buckets_of(only)
        keys = None if only is None else only.select(*self.group_cols).distinct()
        if keys is None and routing is None:
            return self._all(before).drop(*ORDER, "bucket")
        rows = self.rows(before, buckets)
        if keys is not None and self.identities == [self.group_cols]:
            rows = _meet(rows, keys, self.group_cols, "left_semi")
        found = _current(rows, self.identities, all)
        if keys is not None and self.identities != [self.group_cols]:
            found = _meet(found, keys, self.group_cols, "left_semi")
        if routing is not None:
            found = found.where(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in routing.items()]))
        return found.drop(*ORDER, "bucket")

    def _all(self, before: tuple[int, int] | None) -> DataFrame:
        """The whole current state.  Rows of the oldest segment hide no other
        row and are current among themselves: they are filtered where they
        lie, by the keys that later rows have, and only those are exchanged."""
        oldest, *later = self._parts(before)
        if not later:
            return oldest
        later = reduce(DataFrame.unionByName, later)
        kept = by_keys(oldest, [(later.select(*k), k) for k in self.identities], keep=False)
        return kept.unionByName(_current(later, self.identities, all))

    # ------------------------------------------------------------- merging
    def pending(self) -> list[tuple[int, int]]:
        """The log's batches that no segment holds yet."""
        live = self._manifest()[1]
        upto = (live[-1].epoch, live[-1].batch) if live else (-1, -1)
        found = [(e, b) for e in self._names(f"{self.root}/log") for b in self._names(f"{self.root}/log/epoch={e}")
                 if self._finished(f"{self.root}/log/epoch={e}/batch={b}")]
        return [v for v in found if v > upto]

    def maintain(self) -> bool:
        """Merge if ``merge_after`` batches wait besides the latest one; whether
        it did."""
        if len(self.pending()) <= self.merge_after:
            return False
        self.merge()
        return True

    def merge(self, everything: bool = False) -> None:
        """Merge the waiting batches but the latest, and the last segments as
        the rule above says (or all), into one segment."""
        waiting = self.pending()[:-1]
        number, live = self._manifest()
        upto = (live[-1].epoch, live[-1].batch)
        if waiting:
            upto = waiting[-1]
            log = self._log().where(_after((live[-1].epoch, live[-1].batch)) & ~_after(upto))
            n = log.count()
        elif not everything or len(live) < 2:
            return
        parts = [log] if waiting else []
        total, kept = n if waiting else 0, list(live)
        while kept and (everything or kept[-1].rows <= 2 * total):
            total += kept[-1].rows
            parts.append(self._segment(kept.pop().segment))
        rows = _current(reduce(DataFrame.unionByName, parts), self.identities, any if kept else all)
        # a try that failed before its manifest is overwritten by the next
        segment = live[-1].segment + 1
        written = self._write(rows.drop("bucket"), f"{self.root}/segments/segment={segment}")
        old = [self.spark.read.parquet(f"{self.root}/manifests/manifest={number}").collect()] if number else []
        self._publish([*((m.segment, m.rows) for m in kept), (segment, written)], upto)
        self._clean({m.segment for m in old[0]} | {segment} | {m.segment for m in kept}, (live[-1].epoch, live[-1].batch), number)

    def _clean(self, named: set[int], upto: tuple[int, int], number: int) -> None:
        """Delete what neither the latest manifest nor the one before it names."""
        for s in self._names(f"{self.root}/segments"):
            if s not in named:
                self._delete(f"{self.root}/segments/segment={s}")
        for e in self._names(f"{self.root}/log"):
            for b in self._names(f"{self.root}/log/epoch={e}"):
                if (e, b) <= upto:
                    self._delete(f"{self.root}/log/epoch={e}/batch={b}")
        for m in self._names(f"{self.root}/manifests"):
            if m < number:
                self._delete(f"{self.root}/manifests/manifest={m}")

    def compact(self, root: str) -> AppendedTable:
        """The current state as a new table under ``root``."""
        out = AppendedTable(self.spark, root, self.group_cols, self.epoch_path, self.identities, self.bucket_by, self._asked, self.merge_after)
        out.initialize(self.read)
        return out


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def _after(version: tuple[int, int]) -> Column:
    return (F.col("epoch") > version[0]) | ((F.col("epoch") == version[0]) & (F.col("batch") > version[1]))


def _current(rows: DataFrame, identities: list[list[str]], need) -> DataFrame:
    """The rows that are the latest for all (``need`` is ``all``) or ``any`` of
    their keys."""
    marks = []
    for i, cols in enumerate(identities):
        latest = rows.groupBy(*cols).agg(F.max(F.struct(*ORDER)).alias(f"__last{i}"))
        rows = _meet(rows, latest, cols, "inner")
        marks.append(reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__last{i}.{c}") for c in ORDER]))
    keep = reduce((lambda a, b: a & b) if need is all else (lambda a, b: a | b), marks)
    return rows.where(keep).drop(*(f"__last{i}" for i in range(len(identities))))


def _meet(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Join on ``cols``, nulls equal; the left's columns stay."""
    named = right.select(*[F.col(c).alias(f"__g_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in cols])
    return left.join(named, cond, how).drop(*[f"__g_{c}" for c in cols])
