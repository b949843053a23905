"""Ranked lexical search by Block-Max MaxScore.

Index.  A shard is a few megabytes of consecutive documents; a task turns each
of its shards into posting lists, one row per (shard, term).  A list is cut
into blocks of :data:`BLOCK` postings (document gaps and frequencies in the
fewest whole bytes); a block's head keeps its last document, its greatest
frequency and its shortest document, from which the greatest score within it
follows once the corpus counts are known.  Every document and term is indexed.

Search.  The lists of the queries' terms are kept in one pass over the index
and dealt by (shard, block of queries).  For a query and a shard, lists are
taken by falling bound.  While the bounds of the lists not yet taken reach the
k-th best score so far, a list is *essential*: a document met there first may
still win, so that it is read whole.  The other lists only complete the
candidates: a candidate whose score, block bound and remaining bounds fall
short goes before its block is unpacked, and only blocks that still hold
candidates are unpacked.  The shards' best k are merged by a window over k rows
per shard, cut to k per task before they are dealt.

A term's matches, weights and scores are those of the contract (64-bit
integers, rounding down); the bounds use the same integers, so no document is
lost.  Equal scores go by ascending doc_id, a null after all others, then by
place in the table.  Null and empty texts have no terms; a query without terms
or matches gives no rows.  Rows of equal doc_id, and queries of equal item_id,
are documents and queries of their own.  Texts are read whole.  Only
``doc_id``, ``text`` and ``item_id``, ``text`` are read.  Empty tables give no
rows.  A shard must fit in a task; it holds :data:`SHARD_BYTES` of text, or one
longer text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_array, give_back, lower_ascii, numbered_slices, pieces, stage, text_bytes

#: Text of one shard, postings of one block, queries that one task answers.
SHARD_BYTES = 8 << 20
BLOCK = 128
QUERY_BLOCK = 1000

#: Fixed values of the contract: bytes between terms, results of a query.
_GAP = np.zeros(256, bool)
_GAP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10

_HEAD = np.dtype([("last", "<u4"), ("max_tf", "<u4"), ("min_n", "<u4"), ("count", "<u2"), ("width", "u1")])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------------ index

def _terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, in order, and the index of each text's first."""
    data, ends = text_bytes(column)
    # A-Z are letters of terms too: lower them before gaps are looked up
    data = lower_ascii(data)
    gap = _GAP[data]
    starts, stops, first = pieces(data, ends, gap)
    return binary_array(data[~gap], stops - starts), first


def posting_lists(column: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """A shard's terms, their document counts, block heads and packed blocks,
    and the number of terms of each document."""
    terms, first = _terms(column)
    lengths = np.diff(first)
    n_docs = len(lengths)
    coded = terms.dictionary_encode()
    owner = np.repeat(np.arange(n_docs), lengths)
    # a posting per (term, document), in order; the count is the frequency
    both, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * max(n_docs, 1) + owner, return_counts=True)
    term, doc = both // max(n_docs, 1), both % max(n_docs, 1)
    df = np.bincount(term, minlength=len(coded.dictionary))
    begin = np.concatenate(([0], np.cumsum(df)))
    place = np.arange(len(doc)) - begin[term]
    block_at = np.flatnonzero(place % BLOCK == 0)
    count = np.diff(np.append(block_at, len(doc)))
    gaps = doc.copy()
    gaps[1:] -= doc[:-1]
    gaps[block_at] = doc[block_at]
    heads = np.zeros(len(block_at), _HEAD)
    if len(block_at):
        widest = np.maximum.reduceat(np.maximum(gaps, tf), block_at)
        heads["last"] = doc[block_at + count - 1]
        heads["max_tf"] = np.maximum.reduceat(tf, block_at)
        heads["min_n"] = np.minimum.reduceat(lengths[doc], block_at)
        heads["count"] = count
        heads["width"] = np.where(widest < 1 << 8, 1, np.where(widest < 1 << 16, 2, 4))
    width = heads["width"].astype(np.int64)
    start = np.concatenate(([0], np.cumsum(2 * count * width)))
    packed = np.zeros(start[-1], np.uint8)
    block_of = np.repeat(np.arange(len(block_at)), count)
    within = np.arange(len(doc)) - block_at[block_of] if len(doc) else np.zeros(0, np.int64)
    for w in (1, 2, 4):
        own = np.flatnonzero(width[block_of] == w)
        at = start[block_of[own]] + within[own] * w
        for b in range(w):
            packed[at + b] = (gaps[own] >> (8 * b)) & 255
            packed[at + count[block_of[own]] * w + b] = (tf[own] >> (8 * b)) & 255
    first_block = np.searchsorted(block_at, begin)
    head_bytes = pa.Array.from_buffers(pa.binary(), len(df), [None, pa.py_buffer((first_block * _HEAD.itemsize).astype(np.int32)), pa.py_buffer(heads)])
    data_bytes = pa.Array.from_buffers(pa.binary(), len(df), [None, pa.py_buffer(start[first_block].astype(np.int32)), pa.py_buffer(packed)])
    return coded.dictionary, df, head_bytes, data_bytes, lengths


def _index(batches: Iterable[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    names = ["shard", "term", "df", "total", "heads", "data", "doc_ids"]
    for shard, part in numbered_slices(batches, shard_bytes):
        ids = part.column("doc_id")
        terms, df, heads, data, lengths = posting_lists(part.column("text"))
        n = len(terms)
        none = pa.nulls(n, pa.list_(ids.type))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, shard)), terms, pa.array(df.astype(np.int64)), pa.array(np.zeros(n, np.int64)), heads, data, none], names)
        # the shard's documents: a row without a term
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.nulls(1, pa.binary()), pa.array([int((lengths > 0).sum())], pa.int64()),
             pa.array([int(lengths.sum())], pa.int64()), pa.nulls(1, pa.binary()), pa.array([lengths.astype("<i8").tobytes()]),
             pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names)
        give_back()


def build_index(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Posting lists of all ``documents``, staged: ``(shard, term, df, total,
    heads, data, doc_ids)``.  A shard's row without a term holds its documents'
    ids and lengths, how many have terms (``df``) and all their terms
    (``total``)."""
    own = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    rows = own.mapInArrow(lambda batches: _index(batches, shard_bytes),
                          f"shard long, term binary, df long, total long, heads binary, data binary, doc_ids array<{kind}>")
    return stage(rows, "search-index")


# ----------------------------------------------------------------- search

class _List:
    """A posting list of one shard with its bounds; blocks are unpacked when
    asked for, once."""

    def __init__(self, weight: int, heads: bytes, data: bytes, m_of) -> None:
        self.weight, self.data = weight, np.frombuffer(data, np.uint8)
        h = np.frombuffer(heads, _HEAD)
        self.last, self.count, self.width = h["last"].astype(np.int64), h["count"].astype(np.int64), h["width"].astype(np.int64)
        self.start = np.concatenate(([0], np.cumsum(2 * self.count * self.width)))
        self.bounds = _gain(weight, h["max_tf"].astype(np.int64), m_of(h["min_n"].astype(np.int64)))
        self.bound = int(self.bounds.max())
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of block ``b``."""
        if b not in self.kept:
            n, kind = self.count[b], f"<u{self.width[b]}"
            raw = self.data[self.start[b]:self.start[b + 1]].view(kind).astype(np.int64)
            docs = np.cumsum(raw[:n])
            self.kept[b] = docs, _gain(self.weight, raw[n:], m[docs])
        return self.kept[b]

    def blocks(self, which, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.block(int(b), m) for b in which]
        return np.concatenate([d for d, _ in found]), np.concatenate([s for _, s in found])


def _gain(weight: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_documents(lists: list[_List], m: np.ndarray, k: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a shard (fewer, if fewer score above 0) by
    (score, ``rank``) and their scores."""
    lists = sorted(lists, key=lambda x: -x.bound)
    rest = np.concatenate((np.cumsum([x.bound for x in lists][::-1])[::-1], [0]))
    scores, least, i = np.zeros(len(m), np.int64), 0, 0
    while i < len(lists) and rest[i] >= least:
        docs, gains = lists[i].blocks(range(len(lists[i].last)), m)
        scores[docs] += gains
        least = _kth(scores, k)
        i += 1
    found = np.flatnonzero((scores > 0) & (scores + rest[i] >= least))
    for j in range(i, len(lists)):
        own, after = lists[j], rest[j + 1]
        at = np.searchsorted(own.last, found)
        inside = at < len(own.last)
        bound = np.where(inside, own.bounds[np.minimum(at, len(own.last) - 1)], 0)
        alive = scores[found] + bound + after >= least
        found, at, inside = found[alive], at[alive], inside[alive]
        if inside.any():
            docs, gains = own.blocks(np.unique(at[inside]), m)
            where = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            scores[found] += np.where(docs[where] == found, gains[where], 0)
            least = max(least, _kth(scores[found], k))
        found = found[scores[found] + after >= least]
    found = found[np.lexsort((rank[found], -scores[found]))][:k]
    return found, scores[found]


def _shard_best(table: pa.Table, n_docs: int, n_terms: int, k: int, kind: pa.DataType) -> pa.Table:
    """Answers of one (shard, block of queries): its lists, and the row of its
    documents."""
    names = ["item_no", "doc_id", "score", "shard", "place"]
    rows = table.to_pydict()
    home = rows["term"].index(None)
    lengths = np.frombuffer(rows["data"][home], "<i8")
    ids = pa.array(rows["doc_ids"][home], kind)
    rank = np.empty(len(ids), np.int64)
    rank[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    # equal ids keep the order of their places
    same = np.argsort(rank)
    known = ids.take(pa.array(same))
    new = np.ones(len(ids), bool)
    if len(ids) > 1:
        new[1:] = pc.fill_null(pc.not_equal(known[1:], known[:-1]), False).to_numpy(zero_copy_only=False)
        new[1:] |= np.diff(known.is_null().to_numpy(zero_copy_only=False).astype(int)) != 0
    group = np.empty(len(ids), np.int64)
    group[same] = np.cumsum(new)
    rank[np.lexsort((np.arange(len(ids)), group))] = np.arange(len(ids))

    def m_of(n):
        return 100 - 90 + (90 * n * n_docs) // n_terms

    m = m_of(lengths)
    of_item: dict[int, list[_List]] = {}
    for i, term in enumerate(rows["term"]):
        if term is not None:
            own = _List(rows["w"][i], rows["heads"][i], rows["data"][i], m_of)
            for item in rows["items"][i]:
                of_item.setdefault(item, []).append(own)
    found = {n: [] for n in ("item_no", "place", "score")}
    for item, lists in of_item.items():
        docs, scores = best_documents(lists, m, k, rank)
        found["item_no"].append(np.full(len(docs), item))
        found["place"].append(docs)
        found["score"].append(scores)
    item_no, place, score = (np.concatenate([np.zeros(0, np.int64), *found[n]]) for n in ("item_no", "place", "score"))
    return pa.Table.from_arrays([pa.array(item_no), ids.take(pa.array(place)), pa.array(score),
                                 pa.array(np.full(len(place), rows["shard"][home])), pa.array(place)], names)


def _query_terms(text: str) -> Column:
    found = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_TERM), F.lit(0))
    return F.explode(F.transform(F.array_distinct(found), lambda x: x.cast("binary")))


def search(index: DataFrame, items: DataFrame, k: int = TOP, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of
    :func:`build_index` for each row of ``items`` (``item_id``, ``text``)."""
    asked = stage(items.select(F.monotonically_increasing_id().alias("item_no"), "item_id", "text"), "search-items")
    each = asked.select("item_no", _query_terms("text").alias("term"))
    terms = stage(each.groupBy("term", F.floor(F.col("item_no") / query_block).alias("part"))
                  .agg(F.collect_list("item_no").alias("items")), "search-terms")
    # one pass over the index: the lists that the queries need
    lists = index.where(F.col("term").isNotNull()).join(terms.select("term").distinct(), "term", "left_semi")
    lists = stage(lists.select("shard", "term", "df", "heads", "data"), "search-lists")
    sizes = index.where(F.col("term").isNull()).agg(F.sum("df"), F.sum("total")).first()
    n_docs, n_terms = sizes[0] or 0, max(sizes[1] or 0, 1)
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.sum("df") + 1)))
    weights = lists.groupBy("term").agg(weight.alias("w"))
    kind = index.schema["doc_ids"].dataType.elementType
    own = lists.join(weights.join(terms, "term"), "term").select(
        "shard", "part", "term", "w", "items", "heads", "data", F.lit(None).cast(index.schema["doc_ids"].dataType).alias("doc_ids"))
    parts = lists.join(terms.select("term", "part"), "term").select("shard", "part").distinct()
    homes = index.where(F.col("term").isNull()).join(parts, "shard").select(
        "shard", "part", "term", F.lit(None).cast("long").alias("w"), F.lit(None).cast("array<long>").alias("items"), "heads", "data", "doc_ids")
    arrow_kind = _arrow_type(kind)
    best = own.unionByName(homes).groupBy("shard", "part").applyInArrow(
        lambda table: _shard_best(table, n_docs, n_terms, k, arrow_kind),
        f"item_no long, doc_id {kind.simpleString()}, score long, shard long, place long")
    order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "shard", "place")
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
