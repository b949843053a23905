"""Lateral service steps, JSON of any keys, cursors, kept stores, patterns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from test_plans import _plan
from tidewater.functions import dates
from tidewater.operators import steps
from tidewater.session import fresh_path
from tidewater.sources import colocated, roles, search as ss, widecolumn as sw


def test_service_step_answers_none_one_and_many(spark):
    inc = spark.createDataFrame([(1, "mine"), (2, None), (3, "x"), (None, "n")], "k int, v string")
    service = spark.createDataFrame([(1, "theirs", 10), (1, "t2", 11), (2, "filled", 20), (9, "no", 1)], "k int, v string, w int")
    call = "SELECT v, w FROM {service} AS s WHERE s.k = row.k"
    assert rows(steps.service_step(inc, service, call)) == sorted(
        [(1, "mine", 10), (1, "mine", 11), (2, "filled", 20), (3, "x", None), (None, "n", None)], key=repr)
    assert rows(steps.service_step(inc, service, call, required=True), "k", "w") == [(1, 10), (1, 11), (2, 20)]
    top = steps.service_step(inc, service, "SELECT w FROM {service} AS s WHERE s.k = row.k ORDER BY w DESC LIMIT 1")
    assert rows(top, "k", "w") == sorted([(1, 11), (2, 20), (3, None), (None, None)], key=repr)
    assert "CartesianProduct" not in _plan(top) and "NestedLoop" not in _plan(top)


def test_spread_of_any_key(spark):
    df = spark.createDataFrame([(1, "k0", '{"a": 1, "b": {"x": [1, 2]}, "it\'s": null}'), (2, "k1", '{"k": "over", "a": "text"}'),
                                (3, "k2", None), (4, "k3", "not json"), (5, "k4", "[1]"), (6, "k5", "{}"), (7, "k6", '{"a\\"b": true, "": 3, "\\"\'": "both"}')],
                               "id int, k string, props string")
    assert rows(steps.spread_pairs(df, "props")) == sorted(
        [(1, "k0", "a", "1"), (1, "k0", "b", '{"x":[1,2]}'), (1, "k0", "it's", None), (2, "k1", "a", "text"), (2, "k1", "k", "over"),
         (7, "k6", 'a"b', "true"), (7, "k6", "", "3"), (7, "k6", "\"'", "both")], key=repr)
    wide = steps.flatten_any(df, "props")
    assert wide.columns == ["id", "k", "", "\"'", "a", 'a"b', "b", "it's"]
    assert rows(wide.where("id = 7")) == [(7, "k6", "3", "both", None, "true", None, None)]
    wide = wide.select("id", "k", "a", 'a"b', "b", "it's")
    assert rows(wide) == sorted([(1, "k0", "1", None, '{"x":[1,2]}', None), (2, "over", "text", None, None, None), (3, "k2", None, None, None, None),
                                 (4, "k3", None, None, None, None), (5, "k4", None, None, None, None), (6, "k5", None, None, None, None),
                                 (7, "k6", None, "true", None, None)], key=repr)
    with pytest.raises(ValueError, match="more than 2 keys"):
        steps.json_keys(df, "props", max_keys=2)


def test_cursor_pages_are_offset_pages(spark):
    idx = spark.createDataFrame([(f"d{i * 7919 % 1000:03d}", i % 3) for i in range(250)], "doc_id string, shop_id int")
    after, seen = None, []
    for page in range(10):
        own = ss.search_after(idx, {"shop_id": 1}, after, size=20)
        assert rows(own) == rows(ss.search_page(idx, {"shop_id": 1}, page=page, size=20))
        seen += [r.doc_id for r in own.collect()]
        after = ss.page_end(own)
        if after is None:
            break
    assert page == 5 and seen == sorted(r.doc_id for r in idx.where("shop_id = 1").collect())
    assert ss.search_after(idx, {}).count() == 0
    assert "GreaterThan(o_orderstatus" not in _plan(ss.search_after(roles.documents(spark, SF_SMALL), {"order_status": "F"}, "5"))


def _scanned(df):
    """Rows that the file scan of an executed plan gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("Scan parquet"):
            found.append(p.metrics().apply("numOutputRows").value())
        for i in range(p.children().size()):
            todo.append(p.children().apply(i))
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.executedPlan())
    return sum(found)


def test_a_kept_store_is_built_once_and_a_miss_reads_nothing(spark):
    path = fresh_path(spark, "kept-cells-test")
    cells = roles.wide_cells(spark, SF_SMALL)
    store = sw.keep_cells(cells, path)
    files = sorted(store.inputFiles())
    again = sw.keep_cells(cells.where("false"), path)
    assert sorted(again.inputFiles()) == files and rows(again) == rows(cells)
    key = cells.orderBy("row_key").collect()[1500].row_key
    assert sw.get_row(store, key).count() == 3
    assert 0 < _scanned(sw.get_row(store, key)) <= cells.count()
    assert _scanned(sw.get_row(store, key + "x")) == 0       # within the range of keys, not in the filter
    import pyarrow.parquet as pq
    assert pq.ParquetFile(files[0].removeprefix("file://")).metadata.num_rows > 0


def test_bucketed_lookups_do_not_deal_the_big_side(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        items = colocated.store_bucketed(roles.items(spark, SF_SMALL), "order_id", fresh_path(spark, "bucketed-test"), buckets=8)
        refunds = colocated.store_bucketed(roles.refunds(spark, SF_SMALL), "order_id", fresh_path(spark, "bucketed-test"), buckets=8)
        batch = roles.orders(spark, SF_SMALL).where("gorder_id < 50").select("order_id")
        plain = roles.items(spark, SF_SMALL)
        joined = batch.join(items, "order_id")
        assert rows(joined, *plain.columns) == rows(batch.join(plain, "order_id"), *plain.columns)
        tree = _plan(joined).split("\n\n")[0]
        assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1 and "Bucketed: true" in _plan(joined)
        assert "Exchange" not in _plan(items.join(refunds, "order_id")).split("\n\n")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("text, fmt, want", [
    ("20240131", "yyyyMMdd", dt.datetime(2024, 1, 31)), ("20241401rest", "yyyyMMdd", dt.datetime(2025, 2, 1)),
    ("2024-02-30 25:61:00 and more", "yyyy-MM-dd HH:mm:ss", dt.datetime(2024, 3, 2, 2, 1)),
    ("0/-1/2024", "dd/MM/yyyy", dt.datetime(2023, 10, 31)), ("5.6.2024", "d.M.yyyy", dt.datetime(2024, 6, 5)),
    ("at 7h", "'at' H'h'", dt.datetime(1970, 1, 1, 7)), ("2024-01-02T03:04:05.678", "yyyy-MM-dd'T'HH:mm:ss.SSS", dt.datetime(2024, 1, 2, 3, 4, 5, 678000)),
    ("  2024- 3-4", "yyyy-MM-dd", dt.datetime(2024, 3, 4)), ("nothing", "yyyy-MM-dd", None), ("2024/01/01", "yyyy-MM-dd", None),
    (None, "yyyy-MM-dd", None), ("", "yyyy-MM-dd", None), ("2024-13-45", "yyyy-MM-dd[ HH:mm:ss]", dt.datetime(2025, 2, 14))])
def test_lenient_patterns(spark, text, fmt, want):
    df = spark.createDataFrame([(text,)], "t string").select(dates.parse_date_lenient("t", fmt).cast("timestamp_ntz").alias("p"))
    assert df.first().p == want


def test_unknown_pattern_letters_fail():
    for fmt in ("yy-MM-dd", "dd MMM yyyy", "yyyy-MM-dd z"):
        with pytest.raises(ValueError, match="not supported"):
            dates._compile(fmt)


def test_routed_bucket_count_is_stored(spark):
    from tidewater.sinks import layout

    path = fresh_path(spark, "routed-count-test")
    docs = spark.range(50).select(F.col("id").cast("string").alias("doc_id"), (F.col("id") % 10).cast("string").alias("routing"))
    layout.write_routed(docs, path, buckets=16)
    for i in range(10):
        assert layout.read_routed(spark, path, str(i)).count() == 5
    assert layout.read_routed(spark, path).count() == 50
    with pytest.raises(ValueError, match="holds 16"):
        layout.read_routed(spark, path, "1", buckets=64)
    with pytest.raises(ValueError, match="holds 16"):
        layout.write_routed(docs, path, buckets=8, mode="append")
