"""Document-index sinks (K3-K10) over a document table.

A document table has ``doc_id`` (text), ``routing`` (text, may be null) and
payload columns.  Every sink is a pure ``(index, batch) -> index`` function;
a batch is applied as one set operation (a bulk request), never row by row.

Routing picks the shard in the reference and is not a predicate there; a
lookup can see another routing's document on the same shard.  Here routing
is matched null-safely and exactly, which is the intended behaviour.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import last_by_key
from tidewater.operators.places import by_keys


def _keys(with_routing: bool) -> list[str]:
    return ["doc_id", "routing"] if with_routing else ["doc_id"]


def _anti(index: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    k = keys_df.select(*[F.col(c).alias(f"__k_{c}") for c in keys]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys])
    return index.join(k, cond, "left_anti")


def assign_ids(batch: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A null id gets a generated one (the index generates ids for such
    requests).  ``uuid()`` is seeded per plan and partition, so a retried
    task regenerates the same ids."""
    return batch.withColumn(id_col, F.coalesce(F.col(id_col).cast("string"), F.expr("uuid()")))


def index_documents(index: DataFrame, batch: DataFrame, order=None, stored: bool = False) -> DataFrame:
    """K3/K5: replace whole documents by id, create the rest.

    Within one bulk request the last request for an id wins; ``order``
    (e.g. ``["ts", "event_id"]``) gives that order, else the greatest row.
    ``stored`` as in :func:`replace_groups`.
    """
    batch = assign_ids(batch)
    if order:
        batch = last_by_key(batch, "doc_id", order).drop(*order)
    else:
        batch = last_by_key(batch, "doc_id", [c for c in batch.columns if c != "doc_id"])
    kept = by_keys(index, [(batch, ["doc_id"])], keep=False) if stored else _anti(index, batch, ["doc_id"])
    return kept.unionByName(batch.select(*[c for c in batch.columns if c in index.columns]),
                            allowMissingColumns=True)


def index_with_parent(index: DataFrame, batch: DataFrame, parent_col: str, order=None) -> DataFrame:
    """K4: index with routing = the parent id."""
    return index_documents(index, batch.withColumn("routing", F.col(parent_col).cast("string")), order)


def update_documents(index: DataFrame, batch: DataFrame, with_routing: bool = False, order=None):
    """K6/K7: partial update; of several updates of one document in a batch
    the last by ``order`` wins (without it, the greatest).  Fields present in ``batch`` replace the
    document's fields; others are kept.  Returns ``(index, missing)``:
    a batch row whose document does not exist fails (dead-letter)."""
    keys = _keys(with_routing)
    fields = [c for c in batch.columns if c not in keys and c in index.columns]
    if fields:  # one update per document: the greatest fields win a tie
        when = [c for c in order or [] if c not in fields]
        batch = last_by_key(batch.select(*keys, *fields, *when), keys, [*(order or []), *fields]).drop(*when)
    b = batch.select(*[F.col(c).alias(f"__b_{c}") for c in keys + fields])
    cond = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"__b_{c}")),
                  keys[1:], F.col(keys[0]) == F.col(f"__b_{keys[0]}"))
    j = index.join(b, cond, "left")
    hit = F.col("__b_doc_id").isNotNull()
    updated = j.select(*[F.when(hit, F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c) if c in fields
                         else F.col(c) for c in index.columns])
    missing = _anti_batch(batch, index, keys)
    return updated, missing


def _anti_batch(batch: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose document is not in the index.  Only index keys that
    occur in the batch are collected (semi join first), never all of them."""
    wanted = batch.select(*[F.col(c).alias(f"__w_{c}") for c in keys]).distinct()
    wcond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__w_{c}")) for c in keys])
    k = (index.select(*keys).join(wanted, wcond, "left_semi")
              .select(*[F.col(c).alias(f"__k_{c}") for c in keys]).distinct())
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys])
    return batch.join(k, cond, "left_anti")


def delete_documents(index: DataFrame, ids: DataFrame, with_routing: bool = False) -> DataFrame:
    """K8: delete by id (single or bulk; optional routing)."""
    return _anti(index, ids, _keys(with_routing))


def term_predicate(terms: dict):
    """AND of exact-match terms; ``None`` when there are no terms."""
    if not terms:
        return None
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in terms.items()])


def delete_by_query(index: DataFrame, terms: dict, routing=None):
    """Delete every document matching all terms (and the routing when
    given).  Returns ``(remaining, deleted_count_df)``."""
    pred = term_predicate(terms)
    if pred is None:
        return index, index.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("deleted"))
    if routing is not None:
        pred = pred & F.col("routing").eqNullSafe(F.lit(routing))
    hit = F.coalesce(pred, F.lit(False))
    return index.where(~hit), index.where(hit).agg(F.count(F.lit(1)).cast("bigint").alias("deleted"))


def replace_groups(index: DataFrame, batch: DataFrame, group_cols=("shop_id", "gorder_id"),
                   id_col: str = "doc_id", routing_col: str = "shop_id", stored: bool = False) -> DataFrame:
    """K9: every group present in the batch is deleted from the index, then
    the batch's documents are inserted by id: a document of the same id and
    routing that another group holds (an order that moved to another checkout
    of the shop) is replaced too.

    Groups are matched null-safely (a null shop is a group value).  The
    reference deletes only the first 100 documents of a group; here the
    whole group goes, so a group larger than a page cannot leave stale
    documents.  A group with no documents in the batch deletes nothing
    (P6).  Documents of the group left under another group key (e.g. an old
    shop) stay, as in the reference.  ``stored``: the index is a scan of files;
    its documents are filtered by place and not exchanged, whatever the size
    of the batch.
    """
    keys = [list(group_cols)]
    if id_col in index.columns and id_col in batch.columns:
        keys.append([routing_col, id_col])
    if stored:
        kept = by_keys(index, [(batch.select(*k), k) for k in keys], keep=False)
    else:
        kept = index
        for k in keys:
            kept = _anti(kept, batch.select(*k), k)
    return kept.unionByName(batch.select(*[c for c in batch.columns if c in index.columns]),
                            allowMissingColumns=True)
