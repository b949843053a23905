"""Session construction and shared-storage locations.

On a cluster the session comes from the launcher; :func:`get_session` only
fills in settings that are unset so tests and the bench get a sane local
session.  ``spark.checkpoint.dir`` names the shared folder for lineage cuts
and streaming checkpoints; it is read from the session and only defaulted
when nothing is configured (tests).
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import threading
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings applied when the caller has not set them.  AQE re-plans joins at
# runtime (broadcast only after measuring the materialised side, skew-split
# of oversized shuffle partitions, coalescing of small ones).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A union of identically partitioned children may report that partitioning;
    # with AQE re-partitioning one child this breaks joins on 4.1 ("Can't zip
    # RDDs with unequal numbers of partitions").  Keep unions unpartitioned.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of unreachable RDDs are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Runtime settings the queries rely on; applied to any session they run in.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.unionOutputPartitioning": "false",
}

# Stage tables and stored targets are written once and read a few times.
STAGE_CODEC = "zstd"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = SparkSession.getActiveSession()
    if spark is not None:
        for k, v in conf.items():
            if spark.conf.isModifiable(k) and not _is_set(spark, k):
                spark.conf.set(k, v)
        for k, v in (extra or {}).items():
            if spark.conf.isModifiable(k):
                spark.conf.set(k, v)
    else:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        # what the launcher set stays
        SparkContext._ensure_initialized()
        given = SparkConf()
        for k, v in ({k: v for k, v in conf.items() if not given.contains(k)} | (extra or {})).items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def _is_set(spark: SparkSession, key: str) -> bool:
    """Whether the session or its launcher set ``key`` (a default is not)."""
    return key in spark.conf.getAll


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` and the checkpoint folder to a session."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, defaulting it only when unset.

    A default is only made up in local mode (tests); on a cluster a
    machine-local folder would split stage tables across executors' disks,
    so an unset ``spark.checkpoint.dir`` is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the cluster's shared storage")
        current = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_root(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if parts else base


def fresh_path(spark: SparkSession, prefix: str) -> str:
    """A new, unused folder name under the shared checkpoint folder."""
    return checkpoint_root(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


class _Stages(threading.local):
    """Stage tables by the thread that wrote them: a streaming batch runs in a
    thread of its own, so a scope never releases another job's stages."""

    def __init__(self):
        self.paths: list[str] = []
        _EVERY.append(self.paths)


_EVERY: list[list[str]] = []
_STAGES = _Stages()


#: Shuffle files go when the query that wrote them ends, not when the driver's
#: collector happens to run.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Files that a task of a partitioned write keeps open instead of sorting its rows.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Lists of many small groups: a hash aggregate gives up after 128 groups and sorts
#: its rows twice; a sorted one sorts them once and hands the order on to a join.
HASHED_LISTS = "spark.sql.execution.useObjectHashAggregateExec"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession, open_files: int = 0, sorted_groups: bool = False):
    """What is written in the block leaves no shuffle files behind.  Only for
    writes: each plans its frame anew, so no later query reads these files.
    ``open_files``: see :data:`OPEN_FILES`; ``sorted_groups``: see :data:`HASHED_LISTS`."""
    asked = {FREE_SHUFFLES: "true"} | ({OPEN_FILES: str(open_files)} if open_files else {})
    asked |= {HASHED_LISTS: "false"} if sorted_groups else {}
    before = {k: spark.conf.getAll.get(k) for k in asked}
    for k, v in asked.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, prefix: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back.

    Cuts the lineage (a later failure recomputes from the written files, not
    from the sources), computes the frame once however often it is read,
    and gives the planner real file sizes for its broadcast decisions.
    """
    spark = df.sparkSession
    path = passing_path(spark, prefix)
    with freed_shuffles(spark):
        df.write.mode("overwrite").parquet(path, compression=STAGE_CODEC)
    return spark.read.schema(df.schema).parquet(path)


def passing_path(spark: SparkSession, prefix: str, name: str | None = None) -> str:
    """A folder under the shared checkpoint folder that goes as stage tables
    do: a new one, or that of ``name``."""
    path = checkpoint_root(spark, f"{prefix}-{name}") if name else fresh_path(spark, prefix)
    if not _EXIT_HOOK:
        _EXIT_HOOK.append(atexit.register(_release_at_exit, spark))
    if path not in _STAGES.paths:
        _STAGES.paths.append(path)
    return path


_EXIT_HOOK: list = []


def _release_at_exit(spark: SparkSession) -> None:
    """Stage tables of a finished process are not read by anyone."""
    try:
        for paths in _EVERY:
            _delete(spark, paths, 0)
    except Exception:  # noqa: BLE001 - the JVM may already be gone
        pass


def release_stages(spark: SparkSession, keep: int = 0) -> int:
    """Delete the stage tables that this thread wrote after the first ``keep``
    ones (call when no DataFrame that reads them is still in use).  Returns
    the number removed."""
    return _delete(spark, _STAGES.paths, keep)


def _delete(spark: SparkSession, paths: list[str], keep: int) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while len(paths) > keep:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


class stage_scope:
    """``with stage_scope(spark): ...`` deletes the stage tables written in
    the block when it exits (e.g. one streaming micro-batch)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.mark = len(_STAGES.paths)
        return self

    def __exit__(self, *exc):
        release_stages(self.spark, keep=self.mark)
        return False
