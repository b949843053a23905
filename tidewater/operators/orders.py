"""Order-document enrichment (T4-T6, G1, G2), built flat and nested last.

The reference fetches one checkout ("gorder") per queue row from a service,
nests its orders and items into the row, then lets two more services mutate
the nested maps (address per order, refund per item).  Here every step is a
join on flat rows, one row per (order, item); an order without items is one
row with null item columns.  Nesting, when a nested document is wanted, is
a single ``groupBy(order_id)`` at the end (:func:`nest_orders`).

Failure rules kept from the reference (the failing checkout goes to the
dead-letter set and is requeued; nothing of it is written):

* the checkout is missing from the checkout table;
* one of its orders has a null status or order time;
* one order's refund list holds two refunds for the same item;
* a refund of one of its items has no time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.dedup import last_by_key
from tidewater.operators.merge import batch_slice, lookup_join, strict_lookup
from tidewater.operators.places import among, thinned
from tidewater.operators.ranking import nest_children, position_in_group, positions
from tidewater.session import materialize

ORDER_COLUMNS = ["shop_id", "gorder_id", "order_id", "order_status", "order_time",
                 "order_pay_amount", "buy_account_name", "buy_account_phone"]
ITEM_COLUMNS = ["index_id", "item_id", "goods_id", "goods_name", "goods_img", "sku_id",
                "sku_desc", "unit_price", "item_count", "has_refund", "refund_apply_type",
                "refund_apply_time"]
FLAT_DOC_COLUMNS = ORDER_COLUMNS + ITEM_COLUMNS
# Line number, then item id; the remaining item columns make the order
# total where an item id repeats in the source (sf0.001 has one).
ITEM_ORDER = ["line_no", "item_id", "unit_price", "item_count"]


def resolve_gorders(keys: DataFrame, gorders: DataFrame, stage: bool = True):
    """T1 + T4 head: shop id of each claimed checkout; ``(found, missing)``.

    ``gorders`` has ``gorder_id`` and ``shop_id``.
    """
    return strict_lookup(keys, gorders, "gorder_id", stage=stage)


def order_rows(found: DataFrame, orders: DataFrame, stage: bool = True):
    """T4 body: one row per order of each found checkout; ``(rows, bad)``.

    A checkout with no orders yields no rows (P6: nothing written, nothing
    deleted).  A checkout with an order whose status or time is null fails
    as a whole.  With ``stage`` the order table is sliced to the batch's
    checkouts once (one scan); the join and the failure check read the
    slice.
    """
    if stage:
        orders = batch_slice(orders, [("gorder_id", "gorder_id")], found)
    bad = (orders.where(F.col("order_status").isNull() | F.col("order_time").isNull())
                 .select("gorder_id").distinct())
    rows = found.join(orders, "gorder_id", "inner").join(bad, "gorder_id", "left_anti")
    return rows, found.join(bad, "gorder_id", "left_semi")


def enrich_address(rows: DataFrame, addresses: DataFrame) -> DataFrame:
    """T5: receiver name/phone per order; absent (null) when no address.

    The address table is semi-filtered to the batch's orders first, so a
    derived address table is only computed for them.
    """
    return lookup_join(rows, addresses, "order_id", prefilter=True)


def positioned_items(rows: DataFrame, items: DataFrame, rebuild: bool = False) -> DataFrame:
    """The items of the batch's orders with their 0-based position.

    ``items`` is keyed by ``order_id`` and holds ``line_no`` for ordering.
    """
    # An item's position depends only on the items of its order, so it is
    # computed on the narrow item rows, before the join to the orders.
    return position_in_group(batch_items(rows, items, rebuild), ["order_id"], ITEM_ORDER, "index_id", nulls_last=True).drop("line_no")


def item_positions(items: DataFrame, like: DataFrame | None = None):
    """:func:`positioned_items` of ``items`` in the two frames of
    :func:`~tidewater.operators.ranking.positions`."""
    return positions(items, ["order_id"], ITEM_ORDER, "index_id", nulls_last=True, like=like)


def batch_items(rows: DataFrame, items: DataFrame, rebuild: bool = False) -> DataFrame:
    """The items of the batch's orders (``rebuild``: of all orders)."""
    if rebuild:
        # Every order is in the batch: slicing would copy the item table.
        return items
    # The batch's items: the item table streamed once through a semi
    # join on the batch's order ids (broadcast when AQE measures them
    # small) and staged; the steps below read the batch-sized stage.
    return materialize(among(items, rows.select("order_id"), ["order_id"]), "batch-items")


def attach_items(rows: DataFrame, items: DataFrame, goods: DataFrame,
                 rebuild: bool = False) -> DataFrame:
    """T4 items + goods names + 0-based position.

    An order without items keeps one row with null item columns.
    """
    placed = positioned_items(rows, items, rebuild)
    flat = lookup_join(rows, placed, "order_id", stream_lookup=not rebuild)
    return lookup_join(flat, goods, "goods_id")


def refund_duplicates(refunds: DataFrame) -> DataFrame:
    """T6 failure rule: (order_id, item id) pairs with more than one refund."""
    return (refunds.groupBy("order_id", "order_item_id")
                   .agg(F.count(F.lit(1)).cast("bigint").alias("n_refunds"))
                   .where(F.col("n_refunds") > 1))


def enrich_refund(flat: DataFrame, refunds: DataFrame, orders_of_batch: DataFrame | None = None):
    """``has_refund`` (default false), type and epoch-ms time per item.

    Matching is by item id across all orders of the checkout, as in the
    reference.  ``orders_of_batch`` (``order_id``, ``gorder_id``) scopes the
    refund feed to the batch; by default it is taken from ``flat``.
    A checkout with two refunds of one item in an order, or with an item
    whose refund has no time, fails as a whole.  Returns
    ``(flat, failed)``, ``failed`` with ``dl_reason``.
    """
    src = flat if orders_of_batch is None else orders_of_batch
    per_item, failed = refunds_by_item(refunds, src.select("order_id", "gorder_id"), flat.select("gorder_id", "item_id"))
    out = lookup_join(flat, per_item.withColumn("has_refund", F.lit(True)), ["gorder_id", "item_id"])
    out = out.withColumn("has_refund", F.when(F.col("item_id").isNotNull(),
                                              F.coalesce(F.col("has_refund"), F.lit(False))))
    return out.join(failed, "gorder_id", "left_anti"), failed


def refunds_by_item(refunds: DataFrame, order_of: DataFrame, held: DataFrame):
    """The T6 feed of a batch: ``(per_item, failed)``.

    ``per_item`` has one refund per (checkout, item) of the orders in
    ``order_of`` (``order_id``, ``gorder_id``); ``failed`` are the checkouts
    with two refunds of one item in an order, or with an item of ``held``
    (``gorder_id``, ``item_id``) whose refund has no time.
    """
    scoped, dup = scoped_refunds(refunds, order_of)
    # One refund per (checkout, item); two orders of one checkout refunding
    # the same item id resolve to the latest refund.
    per_item = last_by_key(
        scoped.select("gorder_id", F.col("order_item_id").alias("item_id"),
                      F.col("apply_type").alias("refund_apply_type"),
                      F.col("create_time").alias("refund_apply_time")),
        ["gorder_id", "item_id"], ["refund_apply_time", "refund_apply_type"])
    timeless = (scoped.where("timeless")
                .select("gorder_id", F.col("order_item_id").alias("item_id"))
                .join(held, ["gorder_id", "item_id"], "left_semi")
                .select("gorder_id").distinct().join(dup, "gorder_id", "left_anti"))
    failed = (dup.withColumn("dl_reason", F.lit("duplicate refund"))
              .unionByName(timeless.withColumn("dl_reason", F.lit("null refund time"))))
    return per_item, failed


def scoped_refunds(refunds: DataFrame, order_of: DataFrame, whole: bool = False):
    """The refunds of the orders in ``order_of`` with their checkout, one row per
    (order, item, checkout): the latest refund, whether one is ``timeless`` and
    ``n_refunds``; and the checkouts with two refunds of one item in an order.
    ``whole``: nearly every order is among them."""
    # The refund feed is scanned and exchanged once, by order, where it is also
    # counted and joined, and staged: the duplicate check and the per-item pick
    # both read the stage.
    latest = F.max_by(F.struct("apply_type", "create_time"), F.struct("create_time", "apply_type"))
    if not whole:
        refunds = thinned(refunds, order_of.select("order_id"), ["order_id"])
    each = (refunds.repartition("order_id").groupBy("order_id", "order_item_id")
            .agg(latest.alias("__latest"), F.max(F.col("create_time").isNull()).alias("timeless"),
                 F.count(F.lit(1)).cast("bigint").alias("n_refunds")))
    held = order_of.repartition("order_id").distinct().withColumn(
        "__checkouts", F.count(F.lit(1)).over(Window.partitionBy("order_id")))
    # an order that two checkouts hold has each of its refunds twice
    scoped = each.join(held, "order_id").select("order_id", "gorder_id", "order_item_id", "__latest.*", "timeless",
                                                (F.col("n_refunds") * F.col("__checkouts")).alias("n_refunds"))
    scoped = materialize(scoped, "batch-refunds")
    return scoped, scoped.where("n_refunds > 1").select("gorder_id").distinct()


def nest_orders(flat: DataFrame) -> DataFrame:
    """G1: one row per order with ``items`` as an ordered list."""
    child = [c for c in ITEM_COLUMNS if c in flat.columns]
    return nest_children(flat, ["order_id"], child, "index_id", "items")


def build_order_documents(claimed: DataFrame, gorders: DataFrame, orders: DataFrame,
                          addresses: DataFrame, items: DataFrame, goods: DataFrame,
                          refunds: DataFrame, rebuild: bool = False):
    """J2 enrichment: claimed queue rows -> flat order documents.

    Returns ``(docs, dead)``: ``docs`` in :data:`FLAT_DOC_COLUMNS`, ``dead``
    one row per failing checkout with ``dl_reason``.  ``rebuild`` says the
    claimed keys are every checkout (a full rebuild of the index): the big
    tables are then joined directly instead of being sliced to the batch
    and staged, which would copy them.  Same result either way.
    """
    rows, dead = order_level(claimed, gorders, orders, addresses, rebuild)
    flat = attach_items(rows, items, goods, rebuild=rebuild)
    flat, refund_failed = enrich_refund(flat, refunds, rows)
    docs = flat.select(*[F.col(c) if c in flat.columns else F.lit(None).cast("string").alias(c)
                         for c in FLAT_DOC_COLUMNS])
    return docs, dead.unionByName(refund_failed.select("gorder_id", "dl_reason"))


def order_level(claimed: DataFrame, gorders: DataFrame, orders: DataFrame, addresses: DataFrame, rebuild: bool = False):
    """T1, T4 and T5 of J2: ``(one row per order of the claimed checkouts with
    its address, failing checkouts)``."""
    keys = claimed.select("gorder_id").where(F.col("gorder_id").isNotNull()).distinct()
    found, missing = resolve_gorders(keys, gorders, stage=not rebuild)
    rows, bad = order_rows(found, orders, stage=not rebuild)
    # Order level, one row per order of the batch: small next to the item
    # table and read several times below, so it is written once as a stage
    # table in the shared folder instead of being recomputed per reference.
    rows = materialize(enrich_address(rows, addresses), "order-rows")
    dead = (missing.select("gorder_id", F.lit("missing gorder").alias("dl_reason"))
            .unionByName(bad.select("gorder_id", F.lit("null order status or time").alias("dl_reason"))))
    return rows, dead
