"""Lookup joins in which the incoming row wins.

Reference semantics: a lookup returns 0..N rows for the incoming key; each
result row is merged with ``lookedUp.putAll(incoming)``, so the incoming
value wins a name clash, and because NULL columns are dropped from both
maps the merged value is ``coalesce(incoming.c, lookup.c)``.  No match
passes the incoming row on unchanged.  That is a left outer equi-join.

Physical strategy.  A plain ``LEFT JOIN`` can only broadcast the lookup
side and can only skew-split the incoming side.  When the incoming side is
a batch of changed keys and the lookup side is a large fact table in which
one key may own a third of the rows, ``stream_lookup=True`` rewrites the
join as ``inner join`` (either side may be broadcast after AQE measures it;
both sides may be skew-split) plus the incoming rows whose key has no match
(an anti join against the lookup keys that occur in the batch, made
distinct after a semi join, see :func:`matched_keys`).  Same result, no
shuffle of the big side when the batch is small and no hot task when a key
is hot.  ``stage=True`` first slices the lookup table to the batch's keys
and writes the slice once (:func:`batch_slice`), so the big table is
scanned once per batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.places import among
from tidewater.session import materialize

_IN = "__in"
_LK = "__lk"


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, dict):
        return list(on.items())
    return [(c, c) if isinstance(c, str) else tuple(c) for c in on]


def not_blank(c: Column) -> Column:
    """P5: a key that is neither null nor blank text."""
    return F.coalesce(F.trim(c.cast("string")) != F.lit(""), F.lit(False))


def _merge_select(incoming: DataFrame, lookup: DataFrame, pairs, lk_alias: str = _LK):
    lk_keys = {r for _, r in pairs}
    in_cols = incoming.columns
    out = []
    for c in in_cols:
        if c in lookup.columns and c not in lk_keys:
            out.append(F.coalesce(F.col(f"{_IN}.`{c}`"), F.col(f"{lk_alias}.`{c}`")).alias(c))
        else:
            out.append(F.col(f"{_IN}.`{c}`"))
    for c in lookup.columns:
        if c in in_cols or c in lk_keys:
            continue
        out.append(F.col(f"{lk_alias}.`{c}`"))
    return out


def _condition(pairs, guard_blank: bool) -> Column:
    conds = [F.col(f"{_IN}.`{l}`") == F.col(f"{_LK}.`{r}`") for l, r in pairs]
    if guard_blank:
        conds += [not_blank(F.col(f"{_IN}.`{l}`")) for l, _ in pairs]
    return reduce(lambda a, b: a & b, conds)


def batch_slice(lookup: DataFrame, pairs, incoming: DataFrame) -> DataFrame:
    """The lookup rows whose key occurs in ``incoming``, scanned once and
    staged: later steps read the batch-sized slice, not the table."""
    wanted = incoming.select(*[F.col(l).alias(r) for l, r in pairs]).distinct()
    return materialize(among(lookup, wanted, [r for _, r in pairs]), "lookup-slice")


def lookup_join(incoming: DataFrame, lookup: DataFrame, on, *, guard_blank: bool = False,
                stream_lookup: bool = False, prefilter: bool = False, stage: bool = False) -> DataFrame:
    """Left lookup, incoming wins, 1:N fans out.

    ``on``: a column name, a list of names, or ``{incoming_col: lookup_col}``.
    Lookup key columns are not emitted (they equal the incoming key).
    ``guard_blank`` (P5): a null or blank key skips the lookup and the row
    passes unchanged.  ``prefilter``: semi-join the lookup to the incoming
    keys first; Catalyst pushes the semi join down into a derived lookup
    (e.g. a join of base tables), so it is computed only for the batch's
    keys.  Use it when ``incoming`` is cheap to read again (a stage table).
    ``stage``: additionally write that slice once (:func:`batch_slice`), so
    a split lookup scans the big table once instead of twice.
    """
    pairs = _pairs(on)
    if stage:
        lookup = batch_slice(lookup, pairs, incoming)
    elif prefilter:
        wanted = incoming.select(*[F.col(l).alias(r) for l, r in pairs]).distinct()
        lookup = lookup.join(wanted, [r for _, r in pairs], "left_semi")
    if not stream_lookup:
        joined = incoming.alias(_IN).join(lookup.alias(_LK), _condition(pairs, guard_blank), "left")
        return joined.select(*_merge_select(incoming, lookup, pairs))

    matched = (incoming.alias(_IN)
               .join(lookup.alias(_LK), _condition(pairs, guard_blank), "inner")
               .select(*_merge_select(incoming, lookup, pairs)))
    in_keys = [l for l, _ in pairs]
    hit_keys = matched_keys(lookup, pairs, incoming)
    if guard_blank:
        hit_keys = hit_keys.where(reduce(lambda a, b: a & b, [not_blank(F.col(k)) for k in in_keys]))
    unmatched = incoming.join(hit_keys, in_keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def matched_keys(big: DataFrame, pairs, small: DataFrame, null_safe: bool = False) -> DataFrame:
    """The distinct keys of ``big`` that also occur in ``small``, under the
    ``small`` names.

    ``big``'s key column is scanned (pruned) and semi-joined to the distinct
    keys of ``small`` (broadcast when AQE measures them small), then made
    distinct: the shuffle carries at most the batch's keys, whatever the size
    of ``big`` and however hot one of its keys is.  A distinct over all of
    ``big``'s keys would shuffle the whole key column when keys are unique.
    """
    names = [l for l, _ in pairs]
    keys = big.select(*[F.col(r).alias(l) for l, r in pairs])
    wanted = small.select(*[F.col(n).alias(f"__w_{n}") for n in names]).distinct()
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = reduce(lambda a, b: a & b, [eq(F.col(n), F.col(f"__w_{n}")) for n in names])
    return keys.join(wanted, cond, "left_semi").distinct()


def lookup_chain(incoming: DataFrame, steps, stage_between: bool = True) -> DataFrame:
    """Each step looks up by the previous step's output key.

    ``steps`` is a list of ``(lookup_df, on, kwargs)`` applied in order with
    ``df.transform``; composition is the whole "chain wiring".  A split
    lookup reads its input three times, so with ``stage_between`` the output
    of a step that feeds a split lookup is written once as a stage table
    (otherwise the first input would be recomputed 3^n times).
    """
    df = incoming
    for i, (lookup, on, kw) in enumerate(steps):
        if i and stage_between and (kw or {}).get("stream_lookup"):
            df = materialize(df, "chain-step")
        df = df.transform(lambda d, lk=lookup, o=on, k=kw: lookup_join(d, lk, o, **(k or {})))
    return df


def strict_lookup(incoming: DataFrame, lookup: DataFrame, on, stage: bool = False):
    """T4 head: ``(found, missing)``; a missing key fails the incoming row.
    ``stage`` as in :func:`lookup_join`."""
    pairs = _pairs(on)
    if stage:
        lookup = batch_slice(lookup, pairs, incoming)
    found = (incoming.alias(_IN).join(lookup.alias(_LK), _condition(pairs, False), "inner")
             .select(*_merge_select(incoming, lookup, pairs)))
    in_keys = [l for l, _ in pairs]
    missing = incoming.join(matched_keys(lookup, pairs, incoming), in_keys, "left_anti")
    return found, missing


def exists_split(incoming: DataFrame, target: DataFrame, on):
    """``(existing, new)`` by key presence in ``target``."""
    pairs = _pairs(on)
    in_keys = [l for l, _ in pairs]
    keys = matched_keys(target, pairs, incoming)
    return (incoming.join(keys, in_keys, "left_semi"), incoming.join(keys, in_keys, "left_anti"))


def overlay_non_null(source: DataFrame, target: DataFrame, on, columns=None) -> DataFrame:
    """Non-null source fields overwrite the target row; others kept.

    Rows of ``target`` without a source row are unchanged.  ``source`` must
    hold at most one row per key (dedupe with G4 first).
    """
    pairs = _pairs(on)
    t_keys = [r for _, r in pairs]
    cols = columns or [c for c in target.columns if c in source.columns and c not in t_keys]
    s = source.select(*[F.col(l).alias(f"__s_{r}") for l, r in pairs],
                      *[F.col(c).alias(f"__s_{c}") for c in cols])
    cond = reduce(lambda a, b: a & b, [F.col(r) == F.col(f"__s_{r}") for _, r in pairs])
    j = target.join(s, cond, "left")
    out = [F.coalesce(F.col(f"__s_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
           for c in target.columns]
    return j.select(*out)


def flatten_struct(df: DataFrame, struct_col: str) -> DataFrame:
    """Spread one struct level into the row; the spread fields win name
    clashes (later ``putAll`` wins)."""
    fields = df.select(f"{struct_col}.*").columns
    keep = [F.col(f"`{c}`") for c in df.columns if c != struct_col and c not in fields]
    return df.select(*keep, *[F.col(f"{struct_col}.`{f}`").alias(f) for f in fields])


def flatten_json(df: DataFrame, json_col: str, schema: str) -> DataFrame:
    """P9 on JSON text (the queue's ``props``): parse with a declared schema,
    then spread."""
    parsed = df.withColumn("__json", F.from_json(F.col(json_col), schema)).drop(json_col)
    return flatten_struct(parsed, "__json")
