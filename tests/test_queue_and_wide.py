import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidewater.sources import queue as sq, widecolumn as sw

Q = "id bigint, gorder_id bigint, create_time timestamp_ntz, event_type string"


def _queue(spark):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(1, 7, t, "a"), (2, 8, t, "a"), (3, 7, t, "b"), (4, None, t, "c"),
                                  (None, 9, t, "d")], Q)


def test_claim_by_id_and_by_key(spark):
    q = _queue(spark)
    # ids sort nulls first: the null-id row is claimed but, having no
    # delete key, stays in the queue
    claimed, remaining = sq.claim(q, 2, "id")
    assert "id" not in claimed.columns
    assert rows(claimed, "gorder_id") == [(7,), (9,)]
    assert rows(remaining, "id") == sorted([(None,), (2,), (3,), (4,)], key=repr)
    claimed, remaining = sq.claim(q, 1, "gorder_id", order_by=(F.col("id").asc_nulls_last(),))
    # every row of the claimed checkout 7 goes, also the unclaimed id 3
    assert rows(remaining, "id") == sorted([(None,), (2,), (4,)], key=repr)


def test_requeue_appends_failed_keys(spark):
    q = _queue(spark)
    failed = spark.createDataFrame([(7,), (7,), (None,)], "gorder_id bigint")
    out = sq.requeue(q, failed, now="2024-02-01 00:00:00")
    new = out.where("event_type = 'requeue'")
    assert rows(new, "gorder_id") == [(7,)]
    assert new.first()["id"] is not None
    assert out.count() == q.count() + 1


def test_range_scan_bounds_and_pivot(spark):
    cells = spark.createDataFrame(
        [("a1", "f", "q", "1", 1), ("b1", "f", "q", "2", 1), ("b1", "f", "q", "3", 5),
         ("b1", "f", "r", "x", 1), ("c1", "f", "q", "4", 1)],
        "row_key string, family string, qualifier string, value string, cell_ts bigint")
    assert rows(sw.scan_range(cells, "b1", "c1"), "row_key") == [("b1",)] * 3
    piv = sw.pivot_rows(cells, ["q", "r"])
    assert rows(piv) == [("a1", "1", None), ("b1", "3", "x"), ("c1", "4", None)]
    keys = spark.createDataFrame([("c1",), ("zz",)], "row_key string")
    assert rows(sw.get_rows(cells, keys), "value") == [("4",)]
