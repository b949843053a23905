"""Rows of a stored table chosen by their keys, without moving the rows.

A join of wide rows with many keys deals every row by its key.  Here only the
keys are joined, beside each row's place (its file and its number there); the
places found come back as bitmaps, one bit a row, and the scan of the table is
filtered by them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize

#: Words of 64 bits into which keys are hashed to thin out a big table (8 MB of bits).
THIN_WORDS = 1 << 20
#: Bytes of a key, about, in a set of keys that the planner may send to every task.
KEY_BYTES = 16
#: Bits of one of Spark's bitmaps.
BITS = 32_768
#: Bitmaps (4 KB each) that are sent to every task; more are joined as the planner sees fit.
SENT_BITMAPS = 25_000


def thinned(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``big`` without most rows whose columns ``on`` meet none of ``keys`` (of the
    same columns and types, nulls equal), for a join that follows.

    Keys that are few are sent to every task by the planner.  More of them would
    have ``big`` dealt whole by its key; here their hashes are sent, as bits, and
    only rows that hit one are left to be dealt: all that meet a key, and one in
    twelve of the others at 5 million keys."""
    spark = big.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    kinds, own = dict(big.dtypes), dict(keys.dtypes)
    if any(kinds[c] != own[c] for c in on) or keys.count() * KEY_BYTES <= limit:
        return big
    hashed = F.xxhash64(*on)
    word, bit = F.pmod(F.shiftright(hashed, 6), F.lit(THIN_WORDS)), F.pmod(hashed, F.lit(64)).cast("int")
    bits = keys.groupBy(word.alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("__bits"))
    bits = F.broadcast(materialize(bits, "key-bits"))
    met = big.withColumn("__at", word).join(bits, F.col("__at") == F.col("__word"))
    return met.where(F.getbit("__bits", bit) == 1).select(*big.columns)


def among(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``big`` whose columns ``on`` meet one of ``keys``."""
    some = thinned(big, keys, on)
    if some is big:
        return big.join(keys, on, "left_semi")
    # an inner join: a semi join would be pushed below the thinning
    return some.join(keys.distinct(), on).select(*big.columns)


def by_keys(stored: DataFrame, keys: list[tuple[DataFrame, list[str]]], keep: bool) -> DataFrame:
    """The rows of ``stored``, a scan of files, whose columns meet (``keep``) or
    do not meet any of the keys: frames with the columns to compare, nulls
    equal."""
    place = stored.metadataColumn("_metadata")
    rows = stored.withColumns({"__file": place["file_path"], "__nth": place["row_index"] + 1})
    rows = rows.withColumn("__bucket", F.bitmap_bucket_number("__nth"))
    found = []
    for wanted, on in keys:
        k = wanted.select(*[F.col(c).alias(f"__k_{c}") for c in on]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in on])
        some = thinned(rows.select("__file", "__nth", *on), wanted.select(*on), on)
        # keys are distinct; a semi join would be pushed below the thinning
        found.append(some.join(k, same).select("__file", "__nth"))
    bits = (reduce(DataFrame.unionByName, found).groupBy(F.col("__file").alias("__f"), F.bitmap_bucket_number("__nth").alias("__b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__nth")).alias("__bits")))
    bits = materialize(bits, "row-places")
    if bits.count() <= SENT_BITMAPS:
        bits = F.broadcast(bits)
    bit = F.bitmap_bit_position("__nth")
    byte = F.conv(F.hex(F.substr(F.col("__bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    met = rows.join(bits, (F.col("__file") == F.col("__f")) & (F.col("__bucket") == F.col("__b")), "left")
    return met.where(hit if keep else ~hit).select(*stored.columns)
