"""Domain roles over the driver's test tables (see FIXTURES.md).

The reference reads a change queue, a checkout ("gorder") table, order and
item services, an address service, a refund service, a search index and a
wide-column table.  Here each role is a lazy projection of a test table;
the jobs only ever see the role columns.  Ids stay ``bigint`` through the
joins (cheaper to hash and compare than text) and become text only where a
document id is text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import epoch_millis
from tidewater.functions.keys import id_text, item_key, salted_row_key
from tidewater.sources.tables import table
from tidewater.sources.widecolumn import cells_from_rows

# Fixed values of the fixture mapping.
INDEX_AS_OF = "2000-01-01"      # stored indexes were built from orders before this day
WIDE_FAMILY = "info"            # column family of the wide-column view of the queue
WIDE_QUALIFIERS = ("event_type", "user_id", "value")
EXISTING_TARGET_STATUS = 2      # status of commission rows already in the target
ABSENT_SEGMENT = "BUILDING"     # checkouts that the partial checkout table lacks
MOVED_PRIORITY = "5-LOW"        # orders that the moved target holds under another checkout
SETTLED_ORDER_STATUS = "F"      # orders with this status already have a commission row


def queue(spark: SparkSession, d: str) -> DataFrame:
    """Change queue: ``id`` is the delete key, ``gorder_id`` the payload key."""
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("gorder_id"),
        F.col("ts").alias("create_time"),
        "event_type", "value", "props")


def gorders(spark: SparkSession, d: str) -> DataFrame:
    """Checkout table: buyer account and benefit user (= shop)."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("gorder_id"),
        F.col("c_name").alias("buy_account"),
        F.col("c_nationkey").alias("benefit_user"))


def partial_gorders(spark: SparkSession, d: str) -> DataFrame:
    """The checkout table without one market segment, so that lookups miss."""
    c = table(spark, d, "customer").where(F.col("c_mktsegment") != ABSENT_SEGMENT)
    return c.select(F.col("c_custkey").alias("gorder_id"), F.col("c_nationkey").alias("shop_id"))


def orders(spark: SparkSession, d: str) -> DataFrame:
    """Order rows of a checkout.  The test table has one amount column, so
    pay and commission amounts are both ``o_totalprice``; there is no
    per-order buyer account column."""
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_custkey").alias("gorder_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("order_type"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("commission_amount"),
        F.col("o_totalprice").alias("pay_amount"),
        epoch_millis("o_orderdate").alias("pay_success_time"),
        epoch_millis("o_orderdate").alias("order_time"),
        F.col("o_orderdate").alias("order_date"))


def items(spark: SparkSession, d: str) -> DataFrame:
    """Order items; ``item_id`` is unique at sf0.01 and sf0.1."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        item_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("goods_id"),
        F.col("l_suppkey").alias("sku_id"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_quantity").alias("item_count"))


def goods(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("goods_id"), F.col("p_name").alias("goods_name"))


def addresses(spark: SparkSession, d: str) -> DataFrame:
    """Receiver per order: the checkout's customer name and nation name."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .select(F.col("o_orderkey").alias("order_id"),
                     F.col("c_name").alias("buy_account_name"),
                     F.col("n_name").alias("buy_account_phone")))


def refunds(spark: SparkSession, d: str) -> DataFrame:
    """Refund feed: returned lines, keyed by the order and item they refund."""
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        item_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_item_id"),
        F.col("l_linestatus").alias("apply_type"),
        epoch_millis("l_shipdate").alias("create_time"))


def late_refunds(spark: SparkSession, d: str) -> DataFrame:
    """A later refund feed: accepted lines, one row per order and item."""
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "A")
    each = li.select(F.col("l_orderkey").alias("order_id"),
                     item_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_item_id"),
                     F.col("l_linestatus").alias("apply_type"), epoch_millis("l_shipdate").alias("create_time"))
    return each.groupBy("order_id", "order_item_id").agg(F.max("apply_type").alias("apply_type"), F.max("create_time").alias("create_time"))


def line_refunds(spark: SparkSession, d: str) -> DataFrame:
    """Refund feed keyed by order and line number alone, which repeat in the
    line table: refunds of one item twice."""
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"))


def commission_target(spark: SparkSession, d: str, moved: bool = False) -> DataFrame:
    """Commission events already in the target: one stale row per settled
    order, status 2, amounts not yet filled in.  ``moved``: the orders of one
    priority are held under the next checkout's id."""
    gorder = F.col("o_custkey")
    if moved:
        gorder = F.when(F.col("o_orderpriority") == MOVED_PRIORITY, gorder + 1).otherwise(gorder)
    o = table(spark, d, "orders").filter(F.col("o_orderstatus") == SETTLED_ORDER_STATUS)
    return o.select(
        F.lit("UNKNOWN").alias("order_type"),
        F.lit(0.0).alias("amount"),
        F.lit(None).cast("string").alias("buy_account"),
        F.lit(None).cast("int").alias("benefit_user_account"),
        F.lit(0.0).alias("sales_amount"),
        F.lit(None).cast("bigint").alias("event_time"),
        gorder.alias("gorder_id"),
        F.col("o_orderkey").alias("order_id"),
        F.lit(EXISTING_TARGET_STATUS).alias("status"))


def documents(spark: SparkSession, d: str, as_of: str | None = None) -> DataFrame:
    """Order documents in the search index; with ``as_of`` the index as it was
    then (orders before it), for batches that replace and create.
    ``doc_id`` = order id, ``routing`` = checkout id."""
    o = table(spark, d, "orders")
    if as_of is not None:
        o = o.filter(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
             .select(id_text("o_orderkey").alias("doc_id"),
                     id_text("o_custkey").alias("routing"),
                     F.col("c_nationkey").alias("shop_id"),
                     F.col("o_custkey").alias("gorder_id"),
                     F.col("o_orderkey").alias("order_id"),
                     F.col("o_orderstatus").alias("order_status"),
                     F.col("o_orderpriority").alias("order_priority"),
                     F.col("o_totalprice").alias("order_pay_amount"),
                     epoch_millis("o_orderdate").alias("order_time")))


def wide_cells(spark: SparkSession, d: str) -> DataFrame:
    """Wide-column view of the queue: one cell per (row, qualifier)."""
    ev = table(spark, d, "events")
    rows = ev.select(
        salted_row_key("ts", "event_id").alias("row_key"),
        epoch_millis("ts").alias("cell_ts"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.format_string("%.2f", "value").alias("value"))
    return cells_from_rows(rows, "row_key", "cell_ts", WIDE_FAMILY, list(WIDE_QUALIFIERS))
