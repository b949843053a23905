"""Routing layout (K11): documents stored in routing buckets.

Routing chooses a shard in the reference.  Here it chooses a partition
directory, ``routing_bucket = pmod(hash(routing), n)``: a read for one
routing value prunes to one directory (the bucket of a literal folds to a
constant), and a batch rewrites only the buckets its keys touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 64


def routing_bucket(routing, buckets: int = DEFAULT_BUCKETS) -> Column:
    c = F.col(routing) if isinstance(routing, str) else routing
    return F.pmod(F.hash(c.cast("string")), F.lit(buckets))


def with_routing_bucket(df: DataFrame, routing: str = "routing", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    return df.withColumn("routing_bucket", routing_bucket(routing, buckets))


def write_routed(df: DataFrame, path: str, routing: str = "routing",
                 buckets: int = DEFAULT_BUCKETS, mode: str = "overwrite") -> None:
    """Write documents partitioned by routing bucket.

    Rows are clustered by bucket first (``REBALANCE``) so each task writes
    few files; AQE splits a bucket that a hot routing value makes too big.
    """
    spark = df.sparkSession
    stored = _stored_buckets(spark, path) if mode == "append" else None
    if stored not in (None, buckets):
        raise ValueError(f"{path} holds {stored} routing buckets, not {buckets}")
    (with_routing_bucket(df, routing, buckets)
        .hint("rebalance", "routing_bucket")
        .write.mode(mode).partitionBy("routing_bucket").parquet(path))
    # a name that Spark's readers pass over
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/_buckets")


def _stored_buckets(spark, path: str) -> int | None:
    """The bucket count that a routed table was written with."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema("buckets int").parquet(f"{path}/_buckets").first()[0]


def read_routed(spark, path: str, routing_value=None, routing: str = "routing",
                buckets: int | None = None) -> DataFrame:
    """The routed table, or one routing value's documents from its bucket.
    The bucket count is the stored one; asking for another fails."""
    stored = _stored_buckets(spark, path)
    if buckets is not None and stored not in (None, buckets):
        raise ValueError(f"{path} holds {stored} routing buckets, not {buckets}")
    buckets = stored or buckets or DEFAULT_BUCKETS
    df = spark.read.parquet(path)
    if routing_value is None:
        return df
    bucket = routing_bucket(F.lit(str(routing_value)), buckets)
    return df.where((F.col("routing_bucket") == bucket) & (F.col(routing) == F.lit(str(routing_value))))
