"""Projections and row guards (P1, P2, P6, P7) and the dead-letter split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.keys import parse_column_defaults, parse_column_list


def project_columns(df: DataFrame, columns, types: dict | None = None) -> DataFrame:
    """The listed columns in order; unknown names become typed nulls.

    ``columns`` is a list or the reference's comma text (blanks skipped,
    names trimmed).
    """
    names = parse_column_list(columns) if isinstance(columns, str) else list(columns)
    types = types or {}
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have
                       else F.lit(None).cast(types.get(c, "string")).alias(c) for c in names])


def project_defaults(df: DataFrame, spec, types: dict | None = None) -> DataFrame:
    """``name[:default]`` -> ``coalesce(col, default)``; no default -> the
    value (or null when the column is unknown).  Defaults are text and are
    cast to the column's type."""
    pairs = parse_column_defaults(spec) if isinstance(spec, str) else dict(spec)
    types = types or {}
    dtypes = dict(df.dtypes)
    out = []
    for name, default in pairs.items():
        t = dtypes.get(name, types.get(name, "string"))
        base = F.col(f"`{name}`") if name in dtypes else F.lit(None).cast(t)
        if default is None:
            out.append(base.alias(name))
        else:
            out.append(F.coalesce(base, F.lit(default).cast(t)).alias(name))
    return df.select(*out)


def split_rows(df: DataFrame, ok):
    """Route rows: ``(good, dead)`` by a boolean column (null = dead)."""
    ok = F.coalesce(ok, F.lit(False))
    return df.where(ok), df.where(~ok)


def require_key(df: DataFrame, key: str):
    """Rows with a null key fail (dead-letter)."""
    return split_rows(df, F.col(key).isNotNull())


def non_empty_groups(df: DataFrame, list_col: str) -> DataFrame:
    """A group without children writes nothing and deletes nothing."""
    return df.where(F.size(F.col(list_col)) > 0)
