"""Physical-plan checks: pushdown, pruning, bounded broadcasts, partial aggregation."""

from conftest import SF_CHECK
from tidewater.operators import dedup
from tidewater.sources import queue as sq, roles, search as ss
from tidewater.sources import widecolumn as sw


def _plan(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_search_pushes_terms_and_prunes_columns(spark):
    df = ss.search_page(roles.documents(spark, SF_CHECK), {"order_status": "F"}, page=0)
    p = _plan(df)
    assert "EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in p
    assert "TakeOrderedAndProject" in p


def test_claim_broadcasts_bounded_key_set(spark):
    _, remaining = sq.claim(roles.queue(spark, SF_CHECK), 1000, "id")
    p = _plan(remaining)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_last_by_key_is_partial_aggregate(spark):
    q = roles.queue(spark, SF_CHECK)
    p = _plan(dedup.last_by_key(q, "gorder_id", ["create_time", "id"]))
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 2
    assert "Window" not in p


def test_range_scan_reaches_the_scan(spark):
    from tidewater.session import fresh_path

    computed = roles.wide_cells(spark, SF_CHECK)
    cells = sw.store_cells(computed, fresh_path(spark, "cells-plan-test"))
    df = sw.scan_range(cells, "4170", "4171")
    pushed = [line for line in _plan(df).splitlines() if "PushedFilters" in line]
    assert "GreaterThanOrEqual(row_key,4170)" in pushed[0] and "LessThan(row_key,4171)" in pushed[0]
    assert df.count() == sw.scan_range(computed, "4170", "4171").count()
    assert "EqualTo(row_key,4170)" in _plan(sw.get_row(cells, "4170"))
    assert "Or(" in _plan(sw.scan_time_range(cells, 1704412800000, 1704585600000)).split("PushedFilters")[1]


def test_routed_read_prunes_to_one_bucket(spark):
    from tidewater.session import fresh_path
    from tidewater.sinks import layout

    docs = roles.documents(spark, SF_CHECK)
    path = fresh_path(spark, "routed-plan-test")
    layout.write_routed(docs, path, "routing", buckets=16)
    one = layout.read_routed(spark, path, routing_value="7", buckets=16)
    p = _plan(one)
    assert "PartitionFilters: [isnotnull(routing_bucket#" in p and "routing_bucket" in p.split("PartitionFilters")[1]
    assert one.count() == docs.where("routing = '7'").count()


def test_batch_slice_streams_the_big_table(spark):
    from tidewater.operators.merge import batch_slice

    items = roles.items(spark, SF_CHECK)
    batch = roles.orders(spark, SF_CHECK).where("gorder_id < 20").select("order_id")
    sliced = batch_slice(items, [("order_id", "order_id")], batch)
    assert sliced.count() == items.join(batch, "order_id", "left_semi").count()
    # the slice's writing job: the item scan feeds a broadcast semi join
    probe = items.join(batch.distinct(), "order_id", "left_semi")
    probe.write.format("noop").mode("overwrite").save()
    final = _plan(probe)
    assert "BroadcastHashJoin LeftSemi BuildRight" in final
    tree = final.split("\n\n")[0]
    assert "SortMergeJoin" not in tree


def test_a_big_table_is_thinned_before_many_keys_deal_it(spark):
    """Every row that meets a key stays (nulls equal), nearly all others go."""
    from pyspark.sql import functions as F

    from tidewater.operators.places import among, thinned
    big = spark.range(20000).select(F.when(F.col("id") % 1000 != 0, F.col("id")).alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    keys = big.where("a IS NULL OR a % 10 = 3").distinct()
    assert thinned(big, keys, ["a", "b"]) is big                  # few: the planner sends them
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = thinned(big, keys, ["a", "b"])
        met = big.where("a IS NULL OR a % 10 = 3")
        assert some.columns == big.columns and some.intersectAll(met).count() == met.count()
        assert some.count() < met.count() + 200
        # and the exact join comes after the thinning
        own = keys.where("a IS NOT NULL").union(keys.where("a IS NOT NULL"))
        found = among(big, own, ["a", "b"])
        assert found.exceptAll(big.where("a % 10 = 3")).isEmpty() and found.count() == big.where("a % 10 = 3").count()
        joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
        assert "__word" not in joins[0] and "__word" in joins[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
