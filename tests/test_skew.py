"""A key holding most rows: results stay whole and AQE splits the hot join."""

from pyspark.sql import functions as F

from tidewater.operators import dedup, merge

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_lookup_key_is_skew_split_and_whole(spark):
    # checkout 0 owns ~90% of the orders
    orders = (spark.range(0, 40000)
              .select(F.when(F.col("id") % 10 == 0, F.col("id") % 500 + 1).otherwise(F.lit(0))
                      .alias("gorder_id"), F.col("id").alias("order_id"),
                      F.lit("padding-padding-padding").alias("note")))
    batch = spark.range(0, 600).select(F.col("id").alias("gorder_id"), F.lit(1).alias("tag"))

    def run():
        out = merge.lookup_join(batch, orders, "gorder_id", stream_lookup=True)
        return out.count(), out

    n, out = _with_conf(spark, SKEW_CONF, run)
    expected = orders.where("gorder_id < 600").count() + batch.join(
        orders.select("gorder_id").distinct(), "gorder_id", "left_anti").count()
    assert n == expected
    final = _with_conf(spark, SKEW_CONF, lambda: (out.collect(), spark.sparkContext._jvm.PythonSQLUtils
                                                   .explainString(out._jdf.queryExecution(), "formatted"))[1])
    assert "skew=true" in final


def test_last_write_wins_on_hot_key_uses_partial_aggregation(spark):
    events = spark.range(0, 50000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    last = dedup.last_by_key(events, "k", ["seq"])
    got = {r["k"]: r["v"] for r in last.where("k = 7").collect()}
    assert got == {7: 2 * 49999}
    assert last.count() == events.select("k").distinct().count()
