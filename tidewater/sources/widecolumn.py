"""Wide-column table as a long cell table.

A cell is ``(row_key, family, qualifier, value, cell_ts)``; values are text
and row keys compare as bytes (Spark and parquet compare UTF-8 strings
bytewise, the wide-column store's order).  Over a stored cell table
(:func:`store_cells`) predicates on ``row_key`` reach the parquet scan as
pushed filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.keys import day_prefixes


def cells_from_rows(rows: DataFrame, row_key: str, cell_ts: str, family: str, qualifiers) -> DataFrame:
    """S13 (cell explode): one cell per qualifier column of each row."""
    return (rows.unpivot([row_key, cell_ts], list(qualifiers), "qualifier", "value")
                .select(F.col(row_key).alias("row_key"), F.lit(family).alias("family"),
                        "qualifier", F.col("value").cast("string").alias("value"),
                        F.col(cell_ts).alias("cell_ts")))


def store_cells(cells: DataFrame, path: str) -> DataFrame:
    """Write the cells as a table sorted by row key, a range of keys per file,
    and read it: row key predicates then skip files and row groups by their
    statistics."""
    ordered = cells.repartitionByRange("row_key", "qualifier").sortWithinPartitions("row_key", "qualifier")
    ordered.write.mode("overwrite").parquet(path)
    return cells.sparkSession.read.schema(cells.schema).parquet(path)


#: Distinct row keys that a file's bloom filter is made for.
BLOOM_KEYS = 1_000_000


def keep_cells(cells: DataFrame, path: str) -> DataFrame:
    """The kept store at ``path``: built on the first call, read afterwards.

    Cells are sorted by row key, a range of keys per file, with a bloom filter
    on ``row_key`` in every row group: a point get skips files and groups by
    their statistics, and a miss within their range by the filter.  ``cells``
    is not read again once the store is there.
    """
    spark = cells.sparkSession
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        (cells.repartitionByRange("row_key", "qualifier").sortWithinPartitions("row_key", "qualifier").write.mode("overwrite")
         .option("parquet.bloom.filter.enabled#row_key", "true")
         .option("parquet.bloom.filter.expected.ndv#row_key", str(BLOOM_KEYS))
         .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))
    return spark.read.schema(cells.schema).parquet(path)


def get_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """S10 (bulk point get): the cells of the requested row keys."""
    return cells.join(keys.select("row_key").distinct(), "row_key", "left_semi")


def get_row(cells: DataFrame, row_key: str) -> DataFrame:
    """The cells of one row key (a pushed equality filter)."""
    return cells.where(F.col("row_key") == F.lit(row_key))


def scan_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """``start <= row_key < stop`` (start inclusive, stop exclusive)."""
    return cells.where((F.col("row_key") >= F.lit(start)) & (F.col("row_key") < F.lit(stop)))


def scan_time_range(cells: DataFrame, start_ms: int, stop_ms: int) -> DataFrame:
    """S11 over salted keys: one byte range per day of [start_ms, stop_ms).

    One start/stop pair across days would mix salts; the OR of per-day
    ranges is exact and each range is pushed to the scan.
    """
    ranges = day_prefixes(start_ms, stop_ms)
    if not ranges:
        return cells.where(F.lit(False))
    pred = reduce(lambda a, b: a | b,
                  [(F.col("row_key") >= F.lit(lo)) & (F.col("row_key") < F.lit(hi)) for lo, hi in ranges])
    return cells.where(pred)


def pivot_rows(cells: DataFrame, qualifiers, family: str | None = None) -> DataFrame:
    """One record per row key with the named qualifiers as columns; the
    newest cell (by ``cell_ts``, then value) wins.

    The qualifier list is given, so the pivot needs no distinct-values pass;
    ``max_by`` is a partial aggregate, so a hot row key is combined before
    the shuffle.
    """
    df = cells if family is None else cells.where(F.col("family") == F.lit(family))
    qualifiers = list(qualifiers)
    df = df.where(F.col("qualifier").isin(qualifiers))
    return (df.groupBy("row_key")
              .pivot("qualifier", qualifiers)
              .agg(F.max_by("value", F.struct("cell_ts", "value"))))
