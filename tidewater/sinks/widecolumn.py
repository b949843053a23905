"""Wide-column writes (K12, K13) over the long cell table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.operators.dedup import last_by_key


CELL_KEY = ["row_key", "family", "qualifier"]


def put_cells(cells: DataFrame, puts: DataFrame) -> DataFrame:
    """Upsert only the given qualifiers; per (row, family, qualifier)
    the newest cell wins (``cell_ts``, then value for a total order).

    Only the cells the puts address are re-aggregated with them; all other
    cells pass through an anti join against the puts' keys (broadcast when
    small), so a put batch costs a scan, not an aggregate of the table.
    """
    keys = puts.select(*CELL_KEY).distinct()
    untouched = cells.join(keys, CELL_KEY, "left_anti")
    touched = cells.join(keys, CELL_KEY, "left_semi").unionByName(puts.select(*cells.columns))
    return untouched.unionByName(last_by_key(touched, CELL_KEY, ["cell_ts", "value"]))


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop every cell of the given row keys."""
    return cells.join(keys.select("row_key").distinct(), "row_key", "left_anti")
