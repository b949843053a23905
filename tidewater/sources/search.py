"""Document-index reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.merge import matched_keys
from tidewater.operators.places import by_keys
from tidewater.session import materialize
from tidewater.sinks.search import term_predicate

# Default page size of a term search.
DEFAULT_PAGE_SIZE = 100


def get_documents(index: DataFrame, ids: DataFrame, with_routing: bool = False, stored: bool = False) -> DataFrame:
    """S8 (bulk): one row per requested id with ``_doc_id`` and ``found``.

    A miss is an empty document (payload columns null, ``found`` false), the
    reading the reference's null-pointer on a miss was meant to have.  The
    requests are the small side: the hits are an inner join (AQE broadcasts
    the requests and streams the index), the misses an anti join against
    the index keys that occur in the request, so the index is never
    shuffled whole.  ``stored``: the index is a scan of files; the documents
    found are filtered by place and not exchanged, however many are asked for.
    """
    keys = ["doc_id", "routing"] if with_routing else ["doc_id"]
    req = ids.select(*keys).distinct()
    if stored:
        req = materialize(req, "asked-ids")
    payload = [c for c in index.columns if c not in keys]
    idx = index.select(*keys, *payload, F.lit(True).alias("found"))
    cond = reduce(lambda a, b: a & b, [req[k].eqNullSafe(idx[k]) for k in keys])
    if stored:
        hits = by_keys(index, [(req, keys)], keep=True).select(*keys, *payload, F.lit(True).alias("found"))
    else:
        hits = req.join(idx, cond, "inner").select(*[req[k] for k in keys], *[idx[f"`{c}`"] for c in payload],
                                                  idx["found"])
    present = matched_keys(index, [(k, k) for k in keys], req, null_safe=True)
    misses = req.join(present, reduce(lambda a, b: a & b, [req[k].eqNullSafe(present[k]) for k in keys]),
                      "left_anti")
    misses = misses.select(*keys, *[F.lit(None).cast(t).alias(c) for c, t in index.dtypes if c in payload],
                           F.lit(False).alias("found"))
    out = hits.unionByName(misses)
    return out.select(F.col("doc_id").alias("_doc_id"), *keys, *payload, "found")


def get_document(index: DataFrame, doc_id: str, routing: str | None = None) -> DataFrame:
    """S8 (single id): the document with ``_doc_id``; empty frame on a miss."""
    df = index.where(F.col("doc_id") == F.lit(doc_id))
    if routing:
        df = df.where(F.col("routing") == F.lit(routing))
    return df.withColumn("_doc_id", F.col("doc_id"))


def search_after(index: DataFrame, terms: dict, after: str | None = None, size: int = DEFAULT_PAGE_SIZE,
                 routing: str | None = None) -> DataFrame:
    """S9 by a cursor: the ``size`` matches that follow ``doc_id`` ``after`` in
    order (from the start if null).  A page sorts ``size`` rows, however deep
    it lies, where :func:`search_page` sorts all rows before it; the cursor is
    a pushed filter.  The pages are the same as long as ids are unique."""
    pred = term_predicate(terms)
    if pred is None:
        return index.where(F.lit(False)).withColumn("_doc_id", F.col("doc_id"))
    df = index.where(pred if after is None else pred & (F.col("doc_id") > F.lit(after)))
    if routing:
        df = df.where(F.col("routing") == F.lit(routing))
    return df.orderBy("doc_id").limit(size).withColumn("_doc_id", F.col("doc_id"))


def page_end(page: DataFrame) -> str | None:
    """The cursor after a page (one value; null: there is no further page)."""
    return page.agg(F.max("_doc_id")).first()[0]


def search_page(index: DataFrame, terms: dict, page: int = 0, size: int = DEFAULT_PAGE_SIZE,
                routing: str | None = None) -> DataFrame:
    """AND of exact terms, page ``page`` (0-based) of ``size`` rows.

    No terms -> empty result.  The index has no sort key; ``doc_id`` is
    added as the order so pages are stable.  The plan is a filtered scan
    and a TakeOrderedAndProject of ``(page + 1) * size`` rows.
    """
    pred = term_predicate(terms)
    if pred is None:
        return index.where(F.lit(False)).withColumn("_doc_id", F.col("doc_id"))
    df = index.where(pred)
    if routing:
        df = df.where(F.col("routing") == F.lit(routing))
    return (df.orderBy("doc_id").offset(page * size).limit(size)
              .withColumn("_doc_id", F.col("doc_id")))
