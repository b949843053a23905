"""Shards of near-equal bytes by k-d tree partitioning.

A node of the tree that should become several shards is split along its widest
metadata dimension (width relative to the whole table) at the weighted median,
the place where the bytes below are in proportion to the shards on that side.
A median is found by counting bytes per bucket of the key's range and
descending into the bucket that holds it, for all nodes of a level at once;
the driver sees one row per node and round.

Copies of one text (equal checksum and size) take part with the least values
of their group in every dimension, and a dimension's key ends in the checksum,
so they lie side by side: a group shares a shard unless a cut falls into it,
and a cut falls into one group at most.  There it goes by the row's own number,
so a group of any size, also of rows that agree in every column, is cut
anywhere.  Each cut is within one document of its target, hence the law
``bytes``: sizes near equal.

Null text counts as none (size 16, checksum 0); null metadata sorts first.  A
very long text is one document like any other.  Only ``doc_id``, ``text``,
``lang`` and ``source`` are read, so other columns may have any name.  An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SHARDS = 40
#: Bytes that a document has besides its text.
OVERHEAD = 16
#: Buckets of a key range per node and round.
BUCKETS = 2048
#: Rows that one task numbers at most, on average.
ROWS_PER_SLOT_GROUP = 50_000
DIMENSIONS = ("by_size", "by_lang", "by_source", "by_order")


@dataclass
class Node:
    """A part of the table that becomes ``shards`` shards from ``first`` on."""

    first: int
    shards: int
    weight: int = 0
    dimension: int = 0
    cut: tuple[int, int] = (0, 0)  # the last (key, row number) on the left
    search: dict = field(default_factory=dict)


def _grid(value: Column, low: float, high: float) -> Column:
    """A value's place in its range as an integer of 31 bits."""
    width = max(high - low, 1e-9)
    return F.least(F.lit((1 << 31) - 1), F.floor((F.coalesce(value, F.lit(low)) - low) / width * ((1 << 31) - 1))).cast("long")


def metadata(documents: DataFrame, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, the row's number and one 63-bit key per dimension."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    raw = stage(documents.select(
        "doc_id", F.monotonically_increasing_id().alias("id"), F.col("doc_id").cast("double").alias("order"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + overhead).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")).cast("double").alias("lang"),
        F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")).cast("double").alias("source")), "metadata")
    # partial minima, then one small row per group of copies; the planner splits
    # a large group's side of the join
    own = ("lang", "source", "order")
    groups = (raw.groupBy("text_crc32", "size").agg(F.count(F.lit(1)).alias("copies"), *(F.min(c).alias(f"least_{c}") for c in own))
              .where("copies > 1"))
    raw = raw.join(groups, ["text_crc32", "size"], "left").select(
        "doc_id", "id", "size", "text_crc32", *(F.when(F.col("copies").isNull(), F.col(c)).otherwise(F.col(f"least_{c}")).alias(c) for c in own))
    raw = stage(raw, "metadata")
    values = {"by_size": F.log2("size"), "by_lang": F.col("lang"), "by_source": F.col("source"), "by_order": F.col("order")}
    ends = raw.agg(*(f(v).alias(f"{k}_{n}") for k, v in values.items() for n, f in (("lo", F.min), ("hi", F.max)))).first()
    keys = [(F.shiftleft(_grid(v, ends[f"{k}_lo"] or 0.0, ends[f"{k}_hi"] or 0.0), 32) + F.col("text_crc32")).alias(k)
            for k, v in values.items()]
    return raw.select("doc_id", "id", "size", "text_crc32", *keys)


def _descend(placed: DataFrame, nodes: list[Node]) -> DataFrame:
    """Move the rows beyond their node's cut to its upper half."""
    table = placed.sparkSession.createDataFrame(
        [(n.first, n.dimension, *n.cut, n.first + n.shards // 2) for n in nodes],
        "node int, dimension int, cut_key long, cut_id long, upper int")
    key = _key(F.col("dimension"))
    beyond = (key > F.col("cut_key")) | ((key == F.col("cut_key")) & (F.col("id") > F.col("cut_id")))
    return (placed.join(F.broadcast(table), "node", "left")
            .withColumn("node", F.when(F.col("dimension").isNotNull() & beyond, F.col("upper")).otherwise(F.col("node")))
            .drop("dimension", "cut_key", "cut_id", "upper"))


def _key(dimension: Column) -> Column:
    out = F.col(DIMENSIONS[-1])
    for i, name in enumerate(DIMENSIONS[:-1]):
        out = F.when(dimension == i, F.col(name)).otherwise(out)
    return out


def _narrow(rows: DataFrame, nodes: list[Node]) -> None:
    """One round: each node's range shrinks to the bucket with its median."""
    spark = rows.sparkSession
    step = [(n.first, n.dimension, n.search["lo"], n.search["hi"], max(1, -(-(n.search["hi"] - n.search["lo"] + 1) // BUCKETS)),
             n.search.get("key"), n.search["below"], n.search["target"]) for n in nodes]
    table = spark.createDataFrame(step, "node int, dimension int, lo long, hi long, width long, fixed long, below long, target double")
    here = rows.join(F.broadcast(table), "node").withColumn("key", _key(F.col("dimension")))
    # a round looks at the keys, or, for one key, at the ids that share it
    here = here.filter(F.col("fixed").isNull() | (F.col("key") == F.col("fixed")))
    here = here.withColumn("at", F.when(F.col("fixed").isNull(), F.col("key")).otherwise(F.col("id")))
    here = here.filter((F.col("at") >= F.col("lo")) & (F.col("at") <= F.col("hi")))
    buckets = here.groupBy("node", "below", "target", F.expr("(at - lo) div width").alias("bucket")).agg(
        F.sum("size").alias("bytes"), F.min("at").alias("least"), F.max("at").alias("most"))
    run = buckets.withColumn("upto", F.col("below") + F.sum("bytes").over(Window.partitionBy("node").orderBy("bucket")))
    hit = run.filter(F.col("upto") >= F.col("target")).groupBy("node").agg(F.min(F.struct("bucket", "upto", "bytes", "least", "most")).alias("b"))
    found = {r.node: r.b for r in hit.collect()}
    for n in nodes:
        b = found[n.first]
        n.search |= {"lo": b.least, "hi": b.most, "below": b.upto - b.bytes, "inside": b.bytes}


def _split(rows: DataFrame, nodes: list[Node]) -> None:
    """Choose each node's widest dimension and its cut."""
    spread = rows.groupBy("node").agg(F.sum("size").alias("weight"), F.min("id").alias("id_lo"),
                                         F.max("id").alias("id_hi"), *(
        f(name).alias(f"{name}_{n}") for name in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))))
    stats = {r.node: r for r in spread.collect()}
    live = []
    for n in nodes:
        if n.first not in stats:
            n.cut = (0, 0)
            continue
        r = stats[n.first]
        ends = [(r[f"{name}_lo"], r[f"{name}_hi"]) for name in DIMENSIONS]
        n.dimension = max(range(len(ends)), key=lambda i: (ends[i][1] >> 32) - (ends[i][0] >> 32))
        lo, hi = ends[n.dimension]
        n.weight = r.weight
        n.search = {"lo": lo, "hi": hi, "ids": (r.id_lo, r.id_hi), "below": 0, "target": r.weight * (n.shards // 2) / n.shards}
        live.append(n)
    searching = live
    while searching:
        _narrow(rows, searching)
        done = []
        for n in searching:
            s = n.search
            if s["lo"] == s["hi"] and "key" not in s:
                s |= {"key": s["lo"], "lo": s["ids"][0], "hi": s["ids"][1]}
            elif s["lo"] == s["hi"]:
                # the row at the median goes to the side that it suits better
                left = s["target"] - s["below"] >= s["below"] + s["inside"] - s["target"]
                n.cut = (s["key"], s["lo"] if left else s["lo"] - 1)
                done.append(n)
        searching = [n for n in searching if not any(n is d for d in done)]


def shard_documents(documents: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, ``shard`` and ``slot`` (gapless from 0 in
    each shard, by doc_id within hashed groups)."""
    rows = metadata(documents, overhead)
    front = [Node(0, shards)]
    placed = stage(rows.withColumn("node", F.lit(0)), "tree")
    while any(n.shards > 1 for n in front):
        nodes = [n for n in front if n.shards > 1]
        _split(placed, nodes)
        placed = stage(_descend(placed, nodes), "tree")
        front = [m for n in nodes for m in (Node(n.first, n.shards // 2), Node(n.first + n.shards // 2, n.shards - n.shards // 2))]
    return number(placed.select("doc_id", "size", "text_crc32", F.col("node").alias("shard")), shards)


def number(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add ``slot``: shards are numbered in groups of doc_id hashes whose
    counts give the offsets, so no task holds a shard."""
    total = placed.count()
    groups = max(1, math.ceil(total / shards / ROWS_PER_SLOT_GROUP))
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32"))
    return dealt.withColumn("place", place).join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place") - 1).alias("slot"))
