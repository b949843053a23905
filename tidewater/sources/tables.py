"""Table access for the driver's parquet layout (``<dir>/<name>.parquet``).

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
role views below select only what they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def jdbc_table(spark: SparkSession, url: str, table_or_query: str, properties: dict,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """A relational table as a DataFrame (the lookup connector, S7).

    Filters and projections applied later are pushed to the database.  For
    large tables give a numeric ``partition_column`` with bounds so the read
    runs as ``partitions`` parallel range queries instead of one.
    """
    if partition_column:
        return spark.read.jdbc(url, table_or_query, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=partitions, properties=properties)
    return spark.read.jdbc(url, table_or_query, properties=properties)
