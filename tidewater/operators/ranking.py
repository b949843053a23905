"""Position within a parent (G2) and nesting children in order (G1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of one slice, on average, and slices at most.
SLICE_ROWS = 1_000_000
MAX_SLICES = 10_000
#: Sampled rows per slice, from which the slices' bounds are taken.
SAMPLE = 20


def position_in_group(df: DataFrame, group, order, out: str = "index_id",
                      partitions: int | None = None, nulls_last: bool = False) -> DataFrame:
    """0-based position of each row within its group by the columns
    ``order`` (nulls first unless ``nulls_last``).

    ``order`` must be total within a group.  One plan at every size, in which
    no task holds a whole hot group, and one exchange of the rows:

    1. the (group, order) space is cut into slices of about
       :data:`SLICE_ROWS` rows (or ``partitions`` slices) at literal bounds, the
       quantiles of a small sample; a row's slice is an expression (a binary
       search), evaluated only for the groups that a bound falls into, at most
       one per slice.  Any other group lies in one slice and is numbered whole;
    2. the rows of groups with a bound are numbered within (group, slice);
    3. the groups with a bound are counted per slice (a partial aggregate; at
       most two rows per slice), and each slice is offset by those before it.

    Whatever the sample is, the positions are exact.
    """
    whole, pieces, _ = positions(df, group, order, out, partitions, nulls_last)
    return whole if pieces is None else whole.unionByName(pieces)


def positions(df: DataFrame, group, order, out: str = "index_id", partitions: int | None = None, nulls_last: bool = False,
              like: DataFrame | None = None):
    """:func:`position_in_group` in two frames: ``(groups in one slice, groups
    with a bound or None, hashes of the latter's keys)``.  The first is dealt
    by ``group`` alone, so that what follows per group needs no other exchange.
    ``like``: a frame with the same groups and order, cheaper to read, from
    which the bounds are taken."""
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    by = [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc() for c in order]
    number = lambda rows: rows.withColumn(
        out, (F.row_number().over(Window.partitionBy(*group).orderBy(*by)) - 1).cast("int"))
    bounds = _bounds(df if like is None else like, group, order, by, partitions)
    if not bounds:
        return number(df), None, []
    own = F.xxhash64(*group)
    hot = [h for h, in df.sparkSession.createDataFrame(bounds, df.select(*group, *order).schema).select(own).distinct().collect()]
    cut = own.isin(hot)
    return number(df.where(~cut)), _sliced(df.where(cut), cut, group, order, by, bounds, out, nulls_last), hot


def _sliced(df: DataFrame, cut: Column, group: list[str], order: list[str], by: list[Column], bounds: list[tuple], out: str,
            nulls_last: bool) -> DataFrame:
    sliced = df.withColumn("__slice", F.when(cut, _slice(df, group, order, bounds, nulls_last)).otherwise(F.lit(0)))
    local = sliced.withColumn("__local", F.row_number().over(Window.partitionBy(*group, "__slice").orderBy(*by)) - 1)
    sizes = sliced.where(cut).groupBy(*group, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("__slice").alias("__s"), *[F.col(c).alias(f"__g_{c}") for c in group],
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"__g_{c}")), group, F.col("__slice") == F.col("__s"))
    # at most two rows per slice, so the hint is bounded
    return (local.join(F.broadcast(offsets.where("__off > 0")), same, "left")
                 .withColumn(out, (F.coalesce("__off", F.lit(0)) + F.col("__local")).cast("int"))
                 .drop("__slice", "__local", "__off", "__s", *[f"__g_{c}" for c in group]))


def _bounds(df: DataFrame, group: list[str], order: list[str], by: list[Column], partitions: int | None) -> list[tuple]:
    """The last (group, order) values of all slices but the last, ascending."""
    n = df.count()
    slices = partitions or min(MAX_SLICES, -(-n // SLICE_ROWS))
    if slices < 2 or n < 2:
        return []
    some = df.select(*group, *order).sample(fraction=min(1.0, SAMPLE * slices / n), seed=7)
    rows = [tuple(r) for r in some.orderBy(*[F.col(c).asc() for c in group], *by).collect()]
    return list(dict.fromkeys(rows[i * len(rows) // slices] for i in range(1, slices))) if rows else []


def _slice(df: DataFrame, group: list[str], order: list[str], bounds: list[tuple], nulls_last: bool) -> Column:
    """How many bounds lie before a row, by binary search."""
    kinds = [f.dataType for f in df.select(*group, *order).schema]

    def place(values) -> Column:
        parts = []
        for i, (v, kind) in enumerate(zip(values, kinds)):
            last = nulls_last and i >= len(group)
            parts += [(v.isNull() if last else v.isNotNull()).alias(f"n{i}"), v.cast(kind).alias(f"v{i}")]
        return F.struct(*parts)

    here = place([F.col(c) for c in (*group, *order)])
    cuts = F.array(*[place([F.lit(v) for v in b]) for b in bounds])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        beyond = (s["lo"] < s["hi"]) & (here > F.get(cuts, mid))
        return F.struct(F.when(beyond, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(beyond | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    rounds = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.aggregate(rounds, start, halve, lambda s: s["lo"])


def nest_children(df: DataFrame, parent_keys, child_cols, position: str, into: str) -> DataFrame:
    """G1: collect children into a list ordered by ``position``.

    The list is one document's content, so it lives in one row by design;
    jobs keep documents flat and nest only when a nested document is asked
    for.  Parents whose children are all null get an empty list.
    """
    parent_keys = [parent_keys] if isinstance(parent_keys, str) else list(parent_keys)
    parent_cols = [c for c in df.columns if c not in child_cols and c not in parent_keys]
    child = F.struct(*[F.col(c) for c in [position] + [c for c in child_cols if c != position]])
    agg = [F.first(c, ignorenulls=True).alias(c) for c in parent_cols]
    collected = F.collect_list(F.when(F.col(position).isNotNull(), child))
    return df.groupBy(*parent_keys).agg(*agg, F.array_sort(collected).alias(into))
