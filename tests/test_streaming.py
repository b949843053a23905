import datetime as dt
import os


from conftest import SF_CHECK, SF_SMALL, rows
from tidewater.plans import jobs
from tidewater.session import fresh_path
from tidewater.streaming.runner import OrderSearchStream


def test_stream_equals_batch_and_replay_is_noop(spark):
    root = fresh_path(spark, "stream-test")
    queue_dir = os.path.join(root, "queue")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartitionByRange(3, "event_id").write.parquet(queue_dir)
    # a queued checkout that does not exist: fails, is dead-lettered and requeued
    ghost = spark.createDataFrame([(10**9, dt.datetime(2024, 2, 1), 987654321, "view", 1.0, "{}")],
                                  events.schema)
    ghost.write.mode("append").parquet(queue_dir)
    requeue_dir = os.path.join(root, "requeue")

    job = OrderSearchStream(spark, SF_SMALL, queue_dir, work_root=os.path.join(root, "work"),
                            max_files=1, requeue_folder=requeue_dir)
    job.run(available_now=True)
    assert len(job.counters) >= 4                      # one micro-batch per file
    streamed = job.result()
    batch, _ = jobs.job_order_search(spark, SF_SMALL)
    cols = [c for c in batch.columns]
    assert rows(streamed, *cols) == rows(batch, *cols)

    big = max(job.counters, key=lambda c: c["emitted"])["batch_id"]
    own = job.index.rows().where(f"epoch > 0 and batch = {big}")   # a batch holds its rows only
    assert own.count() == job.counters[big]["emitted"]
    dead = spark.read.parquet(os.path.join(root, "work", "dead-letter"))
    assert rows(dead, "gorder_id", "dl_reason") == [(987654321, "missing gorder")]
    assert rows(spark.read.parquet(requeue_dir), "user_id", "event_type") == [(987654321, "requeue")]

    held = job.index.rows().count()
    again = OrderSearchStream(spark, SF_SMALL, queue_dir, work_root=os.path.join(root, "work"),
                              max_files=1, requeue_folder=requeue_dir)
    again.run(available_now=True)
    assert not again.counters and again.index.rows().count() == held


def test_commission_and_item_streams_equal_batch_jobs(spark):
    from tidewater.streaming.runner import CommissionStream, ItemIndexStream

    root = fresh_path(spark, "stream-test-j1j3")
    queue_dir = os.path.join(root, "queue")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartitionByRange(3, "event_id").write.parquet(queue_dir)

    j1 = CommissionStream(spark, SF_SMALL, queue_dir, work_root=os.path.join(root, "j1"), max_files=1)
    j1.run(available_now=True)
    assert len(j1.counters) == 3
    import time
    for _ in range(50):                      # listener events arrive asynchronously
        if sum(b["input_rows"] for b in j1.progress.batches) == 1000:
            break
        time.sleep(0.1)
    assert sum(b["input_rows"] for b in j1.progress.batches) == 1000
    batch_target, _, _ = jobs.job_commission(spark, SF_SMALL)
    assert rows(j1.result(), *batch_target.columns) == rows(batch_target)

    j3 = ItemIndexStream(spark, SF_SMALL, queue_dir, work_root=os.path.join(root, "j3"), max_files=2)
    j3.run(available_now=True)
    batch_index, _ = jobs.job_item_index(spark, SF_SMALL)
    assert rows(j3.result(), *batch_index.columns) == rows(batch_index)


def test_cli_runs_a_job_once(spark, capsys):
    import json

    from tidewater.__main__ import main

    work = fresh_path(spark, "cli-test")
    main(["item-index", "--tables", SF_SMALL, "--queue", SF_SMALL, "--glob", "events.parquet",
          "--work", work, "--once"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["job"] == "item-index" and out["epoch"] > 0
    assert out["batches"][0]["queue_rows"] == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_lost_commission_updates_are_dead_lettered_and_next_step_runs(spark):
    """An order stored under another checkout cannot be updated; the rows
    written go on to the next step (K14)."""
    from pyspark.sql import functions as F

    from tidewater.streaming.runner import CommissionStream

    class Moved(CommissionStream):
        def initial_state(self):
            return super().initial_state().withColumn(
                "gorder_id", F.when(F.col("order_id") % 2 == 0, F.col("gorder_id") + 10**6).otherwise(F.col("gorder_id")))

    root = fresh_path(spark, "lost-test")
    passed = []
    job = Moved(spark, SF_SMALL, SF_SMALL, work_root=root, file_glob="events.parquet",
                then=lambda df, batch_id: passed.append((batch_id, df.count())))
    job.run(available_now=True)
    lost = spark.read.parquet(os.path.join(root, "dead-letter")).where("dl_reason = 'lost update'").count()
    moved = job.result().where("gorder_id >= 1000000").count()
    assert 0 < lost <= moved and job.counters[0]["dead"] >= lost
    assert passed == [(0, job.counters[0]["emitted"])]


def test_two_streams_in_one_session_keep_their_stages(spark):
    import threading

    from tidewater.session import materialize, release_stages, stage_scope

    df = spark.range(5)
    inside, done, seen = threading.Event(), threading.Event(), []

    def other():
        kept = materialize(df, "other")
        inside.set()
        done.wait(30)
        seen.append(kept.count())
        release_stages(spark)

    with stage_scope(spark):
        t = threading.Thread(target=other)
        t.start()
        inside.wait(30)
        materialize(df, "own")
    done.set()
    t.join()
    assert seen == [5]


def test_queue_files_have_several_row_groups(spark, monkeypatch):
    """One file to a batch, many tasks to a file."""
    import pyarrow.parquet as pq

    from tidewater.plans import catalog
    monkeypatch.setattr(catalog, "QUEUE_ROW_GROUP", 1 << 12, raising=False)

    class Queue:
        name = "row-groups"

        def __init__(self, spark, d, folder, work_root, max_files):
            self.folder = folder

        def run(self, available_now):
            pass

        def result(self):
            return spark.read.parquet(self.folder)

    read = catalog._run_stream(Queue, spark, SF_CHECK)
    files = [f.removeprefix("file://") for f in read.inputFiles()]
    assert len(files) == catalog.STREAM_FILES and all(pq.ParquetFile(f).num_row_groups > 1 for f in files)
    assert read.exceptAll(spark.read.parquet(f"{SF_CHECK}/events.parquet")).isEmpty()
    assert read.count() == spark.read.parquet(f"{SF_CHECK}/events.parquet").count()
