"""Run a job as a streaming query (the entry for ``spark-submit``).

    python -m tidewater order-search --tables DIR --queue DIR [--glob events.parquet]
        [--work ROOT] [--once] [--max-files N] [--requeue DIR]

``--once`` processes what is in the queue folder now (``availableNow``) and
exits; otherwise the query polls every second until stopped.  The target,
dead-letter set and checkpoint live under ``--work`` (default: a folder
under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json

from tidewater.session import get_session
from tidewater.streaming.runner import CommissionStream, ItemIndexStream, OrderSearchStream

JOBS = {"order-search": OrderSearchStream, "commission": CommissionStream, "item-index": ItemIndexStream}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidewater", description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--tables", required=True, help="folder of the lookup and target tables")
    ap.add_argument("--queue", required=True, help="folder the queue files arrive in")
    ap.add_argument("--glob", default=None, help="only queue files matching this glob")
    ap.add_argument("--work", default=None, help="target, dead-letter and checkpoint root")
    ap.add_argument("--max-files", type=int, default=None, help="files per micro-batch")
    ap.add_argument("--max-bytes", type=int, default=None, help="bytes of queue files per micro-batch")
    ap.add_argument("--requeue", default=None, help="folder failed keys are appended to")
    ap.add_argument("--once", action="store_true", help="process what is there now, then stop")
    a = ap.parse_args(argv)

    spark = get_session(app_name=f"tidewater-{a.job}")
    job = JOBS[a.job](spark, a.tables, a.queue, work_root=a.work, file_glob=a.glob,
                      max_files=a.max_files, max_bytes=a.max_bytes, requeue_folder=a.requeue)
    q = job.run(available_now=a.once)
    if not a.once:
        job.serve(q)
    print(json.dumps({"job": a.job, "batches": list(job.counters),
                      "epoch": job.index.epoch}))


if __name__ == "__main__":
    main()
