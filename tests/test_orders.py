from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import orders as ordops
from tidewater.operators.ranking import position_in_group


def _inputs(spark):
    gorders = spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, 4)], "gorder_id bigint, shop_id int")
    orders = spark.createDataFrame(
        [(1, 10, "F", 1000, 5.0), (1, 11, "O", 2000, 6.0),
         (2, 20, None, 3000, 1.0),          # null status fails checkout 2
         (3, 30, "F", 4000, 2.0)],          # checkout 3 gets a duplicate refund
        "gorder_id bigint, order_id bigint, order_status string, order_time bigint, order_pay_amount double")
    addresses = spark.createDataFrame([(10, "ann", "111")], "order_id bigint, buy_account_name string, buy_account_phone string")
    items = spark.createDataFrame(
        [(10, "10-2", 2, 500, 1, 9.0, 1.0), (10, "10-1", 1, 501, 1, 8.0, 2.0),
         (20, "20-1", 1, 502, 1, 7.0, 1.0), (30, "30-1", 1, 503, 1, 6.0, 1.0)],
        "order_id bigint, item_id string, line_no int, goods_id bigint, sku_id bigint, unit_price double, item_count double")
    goods = spark.createDataFrame([(500, "bolt"), (501, "nut")], "goods_id bigint, goods_name string")
    refunds = spark.createDataFrame(
        [(10, "10-1", "R1", 111), (30, "30-1", "R2", 222), (30, "30-1", "R3", 333)],
        "order_id bigint, order_item_id string, apply_type string, create_time bigint")
    return dict(gorders=gorders, orders=orders, addresses=addresses, items=items, goods=goods, refunds=refunds)


def test_order_documents_flat(spark):
    claimed = spark.createDataFrame([(1,), (1,), (2,), (3,), (5,), (4,)], "gorder_id bigint")
    docs, dead = ordops.build_order_documents(claimed, **_inputs(spark))
    got = rows(docs, "order_id", "item_id", "index_id", "goods_name", "has_refund",
               "refund_apply_type", "buy_account_name", "shop_id")
    assert got == sorted([
        (10, "10-1", 0, "nut", True, "R1", "ann", 7),
        (10, "10-2", 1, "bolt", False, None, "ann", 7),
        (11, None, None, None, None, None, None, 7),      # order without items
    ], key=repr)
    assert rows(dead) == sorted([(2, "null order status or time"), (3, "duplicate refund"),
                                 (5, "missing gorder")], key=repr)
    # checkout 4 exists without orders: nothing written, nothing failed


def test_nest_orders_round_trip(spark):
    claimed = spark.createDataFrame([(1,)], "gorder_id bigint")
    docs, _ = ordops.build_order_documents(claimed, **_inputs(spark))
    nested = ordops.nest_orders(docs)
    by_order = {r["order_id"]: r for r in nested.collect()}
    assert [i["item_id"] for i in by_order[10]["items"]] == ["10-1", "10-2"]
    assert [i["index_id"] for i in by_order[10]["items"]] == [0, 1]
    assert by_order[11]["items"] == []
    back = nested.select("order_id", F.explode("items").alias("i")).select("order_id", "i.item_id")
    assert rows(back) == rows(docs.where("item_id is not null"), "order_id", "item_id")


def test_skew_safe_position_matches_window_on_hot_group(spark):
    # one group holds most rows and spans many range slices
    hot = spark.range(0, 5000).select(F.lit(1).alias("g"), (F.col("id") * 7 % 5000).alias("o"))
    cold = spark.range(0, 300).select((F.col("id") % 30 + 2).alias("g"), F.col("id").alias("o"))
    df = hot.unionByName(cold)
    df = df.unionByName(df.where("g = 1").select(F.lit(None).cast("bigint").alias("g"), "o"))   # nulls are a group
    a = position_in_group(df, "g", ["o"], "pos", partitions=16)
    b = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert rows(a, "g", "o", "pos") == rows(b, "g", "o", "pos")
    assert a.where("g = 1").agg(F.max("pos")).first()[0] == 4999
    c = position_in_group(df, "g", ["o"], "pos")          # the planner's own number of slices
    assert rows(c, "g", "o", "pos") == rows(b, "g", "o", "pos")


def test_refund_without_time_fails_its_checkout(spark):
    inp = _inputs(spark)
    inp["refunds"] = spark.createDataFrame(
        [(10, "10-1", "R1", None), (11, "not-an-item", "R2", None)],
        "order_id bigint, order_item_id string, apply_type string, create_time bigint")
    claimed = spark.createDataFrame([(1,)], "gorder_id bigint")
    docs, dead = ordops.build_order_documents(claimed, **inp)
    assert docs.count() == 0 and rows(dead) == [(1, "null refund time")]
    # a refund of no item of the checkout is never read
    inp["refunds"] = inp["refunds"].where("order_id = 11")
    docs, dead = ordops.build_order_documents(claimed, **inp)
    assert docs.count() == 3 and dead.count() == 0


def test_refund_duplicates(spark):
    r = _inputs(spark)["refunds"]
    assert rows(ordops.refund_duplicates(r)) == [(30, "30-1", 2)]


def test_positions_with_nulls_last_and_several_columns(spark):
    """Every slicing gives the positions of one window, nulls last."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 13).alias("a"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 17).cast("string"))).alias("b"),
        F.col("id").cast("double").alias("c"))
    order = [F.col(x).asc_nulls_last() for x in ("a", "b", "c")]
    want = rows(df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order)) - 1))
    for slices in (None, 2, 5, 37):
        assert rows(position_in_group(df, "g", ["a", "b", "c"], "pos", partitions=slices, nulls_last=True)) == want
    hot = position_in_group(df, "g", ["a", "b", "c"], "pos", partitions=8, nulls_last=True)
    tree = hot._jdf.queryExecution().executedPlan().toString()
    assert "Window" in tree and "Python" not in tree


def test_scoped_refunds_count_once_per_order_and_item(spark):
    """One row per (order, item, checkout) with the latest refund; an order that
    two checkouts hold has each refund twice, so both fail."""
    refunds = spark.createDataFrame([(1, "a", "R", 5), (2, "b", "S", 5), (2, "b", "T", 7), (3, "c", "U", None), (4, "d", "V", 1), (9, "z", "W", 1)],
                                    "order_id bigint, order_item_id string, apply_type string, create_time bigint")
    held = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, 30), (4, 40), (4, 41)], "order_id bigint, gorder_id bigint")
    scoped, dup = ordops.scoped_refunds(refunds, held)
    assert rows(scoped, "order_id", "gorder_id", "apply_type", "create_time", "timeless", "n_refunds") == [
        (1, 10, "R", 5, False, 1), (2, 20, "T", 7, False, 2), (3, 30, "U", None, True, 1), (4, 40, "V", 1, False, 2), (4, 41, "V", 1, False, 2)]
    assert rows(dup) == [(20,), (40,), (41,)]
