"""Retries with attempts and back-off, replays, volume bounds, the poll tick."""

import datetime as dt
import os
import time


from conftest import SF_SMALL, rows
from tidewater.session import fresh_path
from tidewater.streaming.retries import RetryTable, attempts_of
from tidewater.streaming.runner import CommissionStream


def _failed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "gorder_id bigint, attempts int")


def _queued(spark, folder):
    return spark.read.parquet(folder).select("event_id", "user_id", "event_type", attempts_of().alias("attempts"))


def test_due_times_and_attempts(spark):
    root = fresh_path(spark, "retry-test")
    t = RetryTable(spark, f"{root}/retries", f"{root}/queue", max_attempts=3, backoff=60)
    t.record(1, 0, _failed(spark, (7, 1), (8, 1), (9, 2), (10, 3), (None, 1)))
    now = time.time()
    assert [w[:3] for w in t.waiting()] == [(1, 0, 1), (1, 0, 2)]      # a third failure is the last
    assert t.release(now + 1) == 1 and rows(_queued(spark, f"{root}/queue"), "user_id", "attempts") == [(7, 1), (8, 1)]
    assert t.release(now + 30) == 0
    assert t.release(now + 90) == 1 and rows(_queued(spark, f"{root}/queue"), "user_id", "attempts") == [(7, 1), (8, 1), (9, 2)]
    assert t.waiting() == [] and [t.due_after(a) for a in (1, 2, 3, 4)] == [0, 60, 120, 240]


def test_a_replayed_batch_queues_the_same_rows_once(spark):
    root = fresh_path(spark, "retry-replay-test")
    t = RetryTable(spark, f"{root}/retries", f"{root}/queue")
    for _ in range(2):                                   # the first try and its replay
        t.record(4, 2, _failed(spark, (7, 1), (8, 1)))
        t.record(4, 2, _failed(spark, (7, 1), (8, 1)))
        t.release()
    queued = _queued(spark, f"{root}/queue")
    assert rows(queued, "user_id") == [(7,), (8,)] and queued.select("event_id").distinct().count() == 2
    t.record(4, 3, _failed(spark, (7, 1)))               # another batch is another failure
    t.release()
    assert rows(_queued(spark, f"{root}/queue"), "user_id") == [(7,), (7,), (8,)]


def _queue(spark, root, ghosts=(), files=4):
    folder = os.path.join(root, "queue")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.where("event_id < 200").repartitionByRange(files, "event_id").write.parquet(folder)
    if ghosts:
        made = [(10**9 + i, dt.datetime(2024, 2, 1), g, "view", 1.0, "{}") for i, g in enumerate(ghosts)]
        spark.createDataFrame(made, events.schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_a_key_that_keeps_failing_stops(spark):
    root = fresh_path(spark, "retry-stream-test")
    queue = _queue(spark, root, ghosts=(987654321,), files=1)
    for _ in range(5):                                   # each run sees what the one before queued
        job = CommissionStream(spark, SF_SMALL, queue, work_root=f"{root}/work", requeue_folder=queue, max_attempts=3, backoff=0)
        job.run(available_now=True)
    dead = spark.read.parquet(f"{root}/work/dead-letter").where("gorder_id = 987654321")
    assert rows(dead, "attempts", "final") == [(1, False), (2, False), (3, True)]
    assert spark.read.parquet(queue).where("user_id = 987654321").count() == 3 and job.retries.waiting() == []


def test_crash_between_writes_and_replay(spark):
    """A batch that fails after its dead-letter and retries were written runs
    again: same target, same queue."""
    root = fresh_path(spark, "crash-test")
    queue = _queue(spark, root, ghosts=(5, 987654321), files=1)

    class Crashing(CommissionStream):
        crashed = False

        def _process(self, batch, batch_id):
            super()._process(batch, batch_id)
            if batch_id == 0 and not Crashing.crashed:
                Crashing.crashed = True
                raise RuntimeError("lost before the commit")

    def run():
        job = Crashing(spark, SF_SMALL, queue, work_root=f"{root}/work", requeue_folder=f"{root}/requeue", merge_after=1)
        try:
            job.run(available_now=True)
        except Exception as e:  # noqa: BLE001
            assert "lost before the commit" in str(e)
        return job

    run()
    first = rows(_queued(spark, f"{root}/requeue"))
    job = run()
    assert Crashing.crashed and rows(_queued(spark, f"{root}/requeue")) == first == rows(_queued(spark, f"{root}/requeue"))
    clean = CommissionStream(spark, SF_SMALL, queue, work_root=f"{root}/clean")
    clean.run(available_now=True)
    assert rows(job.result()) == rows(clean.result())


def test_micro_batches_by_volume(spark):
    """One large file or several small ones to a batch, by bytes."""
    root = fresh_path(spark, "bytes-test")
    folder = f"{root}/queue"
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.where("event_id < 600").coalesce(1).write.parquet(folder)
    for i in range(6):
        events.where(f"event_id = {700 + i}").coalesce(1).write.mode("append").parquet(folder)
    sizes = sorted(os.path.getsize(f"{folder.removeprefix('file://')}/{f}") for f in os.listdir(folder.removeprefix("file://")) if f.endswith(".parquet"))
    job = CommissionStream(spark, SF_SMALL, folder, work_root=f"{root}/work", max_bytes=3 * sizes[-2] + 10)
    job.run(available_now=True)
    n = [c["queue_rows"] for c in job.counters]
    assert sum(n) == 606 and len(n) >= 3 and max(n) >= 600 and sorted(n)[0] <= 3


def test_the_poll_tick_picks_up_new_files_and_retries(spark):
    """A processingTime run: files that arrive later, then a released retry."""
    root = fresh_path(spark, "tick-test")
    queue = _queue(spark, root, files=1)
    job = CommissionStream(spark, SF_SMALL, queue, work_root=f"{root}/work", requeue_folder=queue, max_attempts=2)
    query = job.run(available_now=False)
    try:
        def until(done, seconds=120):
            end = time.time() + seconds
            while not done() and time.time() < end:
                assert query.exception() is None
                job.retries.release()
                time.sleep(0.5)
            assert done()
        until(lambda: len(job.counters) >= 1)
        events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
        late = spark.createDataFrame([(10**9, dt.datetime(2024, 2, 1), 987654321, "view", 1.0, "{}")], events.schema)
        late.coalesce(1).write.mode("append").parquet(queue)
        until(lambda: sum(c["dead"] for c in job.counters) >= 2)      # it fails, is queued again and fails for good
    finally:
        query.stop()
    dead = spark.read.parquet(f"{root}/work/dead-letter").where("gorder_id = 987654321")
    assert rows(dead, "attempts", "final") == [(1, False), (2, True)]


def test_attempts_are_read_from_requeued_rows_only(spark):
    df = spark.createDataFrame([("view", '{"attempts": 9}'), ("requeue", '{"attempts":2}'), ("requeue", None), ("requeue", "x")],
                               "event_type string, props string")
    assert [r[0] for r in df.select(attempts_of()).collect()] == [0, 2, 1, 1]


def test_two_threads_release_one_after_the_other(spark):
    """A batch's thread and the serving one: neither deletes what the other reads."""
    from concurrent.futures import ThreadPoolExecutor
    root = fresh_path(spark, "release-test")
    table = RetryTable(spark, f"{root}/retries", f"{root}/queue")
    table.record(1, 1, spark.createDataFrame([(7, 1), (8, 1)], "gorder_id long, attempts int"))
    at_work, most, release = [], [], table._release

    def slow(*partition):
        at_work.append(partition)
        most.append(len(at_work))
        time.sleep(1)
        try:
            return release(*partition)
        finally:
            at_work.pop()

    table._release = slow
    with ThreadPoolExecutor(2) as pool:
        files = [f.result() for f in [pool.submit(table.release) for _ in range(2)]]
    assert max(most) == 1 and sorted(files) == [0, 1]
    assert spark.read.parquet(f"{root}/queue").count() == 2
