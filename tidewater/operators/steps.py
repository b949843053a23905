"""Service steps that answer a row with any number of rows (T8, U4), and JSON
objects spread into a row whatever their keys (P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that :func:`flatten_any` spreads into columns at most; more is an error.
MAX_KEYS = 1000


def service_step(incoming: DataFrame, service: DataFrame, answer: str, required: bool = False) -> DataFrame:
    """One call per incoming row, 0..N answers, merged as a lookup is (the
    incoming value wins a clash unless it is null).

    ``answer`` is the call as SQL over ``{service}`` and the columns of the
    incoming ``row``: a filter, a top n, an aggregate.  It is a lateral
    subquery, so the planner runs all calls as one join.  A row without an
    answer passes on unchanged, or goes if ``required``.
    """
    how = "JOIN" if required else "LEFT JOIN"
    both = incoming.sparkSession.sql(f"SELECT struct(row.*) AS row, struct(answer.*) AS answer FROM {{row}} AS row {how} LATERAL ({answer}) AS answer",
                                     row=incoming, service=service)
    new = both.schema["answer"].dataType.fieldNames()
    merged = [(F.coalesce(F.col(f"row.`{c}`"), F.col(f"answer.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c)
              for c in incoming.columns]
    return both.select(*merged, *[F.col(f"answer.`{c}`").alias(c) for c in new if c not in incoming.columns])


def spread_pairs(df: DataFrame, json_col: str) -> DataFrame:
    """P9, one row per key of the JSON object in ``json_col``: the row's other
    columns, ``key`` and ``value`` (text; nested values as JSON, a JSON null is
    null).  A row whose text is null or no object has no pairs."""
    kept = [c for c in df.columns if c != json_col and c not in ("key", "value")]
    parsed = df.withColumn("__variant", F.try_parse_json(json_col)).where(
        F.schema_of_variant("__variant").startswith("OBJECT"))
    pairs = df.sparkSession.tvf.variant_explode(F.col("__variant").outer()).select(
        F.col("key"), F.try_variant_get("value", "$", "string").alias("value"))
    return parsed.select(*[F.col(f"`{c}`") for c in kept], "__variant").lateralJoin(pairs).drop("__variant")


def json_keys(df: DataFrame, json_col: str, max_keys: int = MAX_KEYS) -> list[str]:
    """The keys that occur in the objects of ``json_col``, sorted."""
    found = spread_pairs(df.select(json_col), json_col).select("key").distinct().orderBy("key").limit(max_keys + 1).collect()
    if len(found) > max_keys:
        raise ValueError(f"{json_col} has more than {max_keys} keys")
    return [r.key for r in found]


def flatten_any(df: DataFrame, json_col: str, max_keys: int = MAX_KEYS) -> DataFrame:
    """P9 without a declared schema: every key of the objects in ``json_col``
    becomes a column (text); spread fields win a name clash, also over an
    absent value, as a later put does when the key is there."""
    keys = json_keys(df, json_col, max_keys)
    parsed = df.withColumn("__variant", F.try_parse_json(json_col))

    def value(key: str) -> Column:
        for quote in "'", '"':
            if key and quote not in key:
                return F.try_variant_get("__variant", f"$[{quote}{key}{quote}]", "string")
        # a path cannot spell the empty key, nor one with both quotes
        return F.try_element_at(F.from_json(json_col, "map<string,string>"), F.lit(key))

    kept = [c for c in df.columns if c != json_col]
    return parsed.select(*[F.coalesce(value(c), F.col(f"`{c}`").cast("string")).alias(c) if c in keys else F.col(f"`{c}`") for c in kept],
                         *[value(k).alias(k) for k in keys if k not in kept])
