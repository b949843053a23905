"""Verdicts on rows of a table of files, without moving its texts.

A row's place is its file and its number there, which stay the same whenever
and wherever the table is read.  A set of places is kept as bitmaps, one bit a
row, so that a filter by verdicts joins texts with one small row per 32,768 of
them (broadcast if the planner finds it small, else the texts are shuffled).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Bits of one of Spark's bitmaps.
BITS = 32_768


def placed(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a struct ``column`` of ``file`` and ``at``.  A frame that is
    not read from files is staged first."""
    try:
        meta = df.metadataColumn("_metadata")
        return df.withColumn(column, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("at")))
    except AnalysisException:
        return placed(stage(df, "placed"), column)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def bitmaps(places: DataFrame, column: str) -> DataFrame:
    """The set of places in ``column`` as ``(file, bucket, bits)``, staged."""
    own = places.select(F.col(f"{column}.file").alias("file"), (F.col(f"{column}.at") + 1).alias("nth"))
    bits = own.groupBy("file", F.bitmap_bucket_number("nth").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("nth")).alias("bits"))
    return stage(bits, "verdicts")


def is_in(rows: DataFrame, column: str, sets: DataFrame, into: str) -> DataFrame:
    """``rows`` with a boolean column ``into``: whether the place in ``column``
    is in the set."""
    at = F.col(f"{column}.at")
    here = sets.select(F.col("file").alias(f"{into}_file"), F.col("bucket").alias(f"{into}_bucket"), F.col("bits").alias(f"{into}_bits"))
    same = (F.col(f"{column}.file") == F.col(f"{into}_file")) & (F.bitmap_bucket_number(at + 1) == F.col(f"{into}_bucket"))
    bit: Column = F.bitmap_bit_position(at + 1)
    byte = F.conv(F.hex(F.substr(F.col(f"{into}_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.getbit(byte, (bit % 8).cast("int")) == 1
    return (rows.join(here, same, "left").withColumn(into, F.coalesce(found, F.lit(False)))
            .drop(f"{into}_file", f"{into}_bucket", f"{into}_bits"))
