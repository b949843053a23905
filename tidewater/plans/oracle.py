"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans, straight from the semantics, over
the raw test tables (``events customer orders lineitem part nation``).
Column names and types match the Spark outputs.
"""

from __future__ import annotations

from tidewater.sources.roles import ABSENT_SEGMENT, INDEX_AS_OF, MOVED_PRIORITY

def floor_millis(sql: str) -> str:
    """Rewrite ``epoch_ms(x)`` (DuckDB rounds to the nearest ms) as
    ``(epoch_us(x) // 1000)`` (truncation, as Spark's ``unix_millis`` and
    Java's ``getTime`` of a timestamp do)."""
    out, i, tag = [], 0, "epoch_ms("
    while True:
        j = sql.find(tag, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(tag)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = floor_millis(sql[j + len(tag):k - 1])
        out.append(f"(epoch_us({inner}) // 1000)")
        i = k


ITEM_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
KEYS = "SELECT DISTINCT user_id AS gorder_id FROM events WHERE user_id IS NOT NULL"
ALL_KEYS = "SELECT c_custkey AS gorder_id FROM customer"
AS_OF = f"o.o_orderdate < TIMESTAMP '{INDEX_AS_OF}'"

ORDERS = """SELECT o_custkey AS gorder_id, o_orderkey AS order_id, o_orderpriority AS order_type,
  o_orderstatus AS order_status, o_totalprice AS commission_amount, o_totalprice AS pay_amount,
  epoch_ms(o_orderdate) AS pay_success_time, epoch_ms(o_orderdate) AS order_time FROM orders"""
ITEMS = f"""SELECT l_orderkey AS order_id, {ITEM_ID} AS item_id, l_linenumber AS line_no,
  l_partkey AS goods_id, l_suppkey AS sku_id, l_extendedprice AS unit_price, l_quantity AS item_count
  FROM lineitem"""
ADDRESS = """SELECT o.o_orderkey AS order_id, c.c_name AS buy_account_name, n.n_name AS buy_account_phone
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""
REFUNDS = f"""SELECT l_orderkey AS order_id, {ITEM_ID} AS order_item_id, l_linestatus AS apply_type,
  epoch_ms(l_shipdate) AS create_time FROM lineitem WHERE l_returnflag = 'R'"""
PARTIAL_GORDERS = f"""SELECT c_custkey AS gorder_id, c_nationkey AS shop_id FROM customer
  WHERE c_mktsegment <> '{ABSENT_SEGMENT}'"""
MOVED_TARGET = f"""SELECT CASE WHEN o_orderpriority = '{MOVED_PRIORITY}' THEN o_custkey + 1 ELSE o_custkey END AS gorder_id,
  o_orderkey AS order_id FROM orders WHERE o_orderstatus = 'F'"""
#: Refunds of accepted lines, one per order and item.
LATE_REFUNDS = f"""SELECT l_orderkey AS order_id, {ITEM_ID} AS item_id, max(l_linestatus) AS apply_type,
  epoch_ms(max(l_shipdate)) AS create_time FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2"""
DOC_COLS = ("doc_id, routing, shop_id, gorder_id, order_id, order_status, order_priority, "
            "order_pay_amount, order_time")


def docs(where: str = AS_OF) -> str:
    return f"""SELECT CAST(o.o_orderkey AS VARCHAR) AS doc_id, CAST(o.o_custkey AS VARCHAR) AS routing,
  c.c_nationkey AS shop_id, o.o_custkey AS gorder_id, o.o_orderkey AS order_id,
  o.o_orderstatus AS order_status, o.o_orderpriority AS order_priority,
  o.o_totalprice AS order_pay_amount, epoch_ms(o.o_orderdate) AS order_time
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey WHERE {where}"""


CURRENT_DOCS = docs("TRUE")
QUEUED_DOCS = f"SELECT * FROM ({CURRENT_DOCS}) WHERE gorder_id IN (SELECT user_id FROM events)"

FLAT_DOC_COLS = ("shop_id, gorder_id, order_id, order_status, order_time, order_pay_amount, "
                 "buy_account_name, buy_account_phone, index_id, item_id, goods_id, goods_name, "
                 "goods_img, sku_id, sku_desc, unit_price, item_count, has_refund, "
                 "refund_apply_type, refund_apply_time")


def order_docs_ctes(p: str, keys_sql: str, order_filter: str = "TRUE") -> str:
    """CTEs ending in ``{p}_docs``: flat order documents of the keys."""
    return f"""
{p}_k AS ({keys_sql}),
{p}_found AS (SELECT k.gorder_id, c.c_nationkey AS shop_id FROM {p}_k k
  JOIN customer c ON c.c_custkey = k.gorder_id),
{p}_ords0 AS (SELECT f.gorder_id, f.shop_id, o.o_orderkey AS order_id, o.o_orderstatus AS order_status,
  epoch_ms(o.o_orderdate) AS order_time, o.o_totalprice AS order_pay_amount
  FROM {p}_found f JOIN orders o ON o.o_custkey = f.gorder_id WHERE {order_filter}),
{p}_bad AS (SELECT DISTINCT gorder_id FROM {p}_ords0 WHERE order_status IS NULL OR order_time IS NULL),
{p}_ords AS (SELECT x.*, a.buy_account_name, a.buy_account_phone FROM {p}_ords0 x
  LEFT JOIN ({ADDRESS}) a ON a.order_id = x.order_id
  WHERE x.gorder_id NOT IN (SELECT gorder_id FROM {p}_bad)),
{p}_flat AS (SELECT x.*, i.item_id, i.line_no, i.goods_id, i.sku_id, i.unit_price, i.item_count,
  gd.p_name AS goods_name FROM {p}_ords x LEFT JOIN ({ITEMS}) i ON i.order_id = x.order_id
  LEFT JOIN part gd ON gd.p_partkey = i.goods_id),
{p}_idx AS (SELECT *, CASE WHEN item_id IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY order_id
  ORDER BY line_no ASC NULLS LAST, item_id ASC NULLS LAST, unit_price ASC NULLS LAST, item_count ASC NULLS LAST)
  - 1 AS INTEGER) END AS index_id FROM {p}_flat),
{p}_oo AS (SELECT DISTINCT order_id, gorder_id FROM {p}_idx),
{p}_scoped AS (SELECT r.*, oo.gorder_id FROM ({REFUNDS}) r JOIN {p}_oo oo ON oo.order_id = r.order_id),
{p}_dup AS (SELECT DISTINCT oo.gorder_id FROM (SELECT order_id FROM {p}_scoped
  GROUP BY order_id, order_item_id HAVING count(*) > 1) d JOIN {p}_oo oo ON oo.order_id = d.order_id),
{p}_timeless AS (SELECT DISTINCT s.gorder_id FROM {p}_scoped s JOIN {p}_idx x ON x.gorder_id = s.gorder_id
  AND x.item_id = s.order_item_id WHERE s.create_time IS NULL),
{p}_pi AS (SELECT gorder_id, order_item_id AS item_id, apply_type AS refund_apply_type,
  create_time AS refund_apply_time FROM (SELECT *, row_number() OVER (PARTITION BY gorder_id, order_item_id
  ORDER BY create_time DESC NULLS LAST, apply_type DESC NULLS LAST) AS rn FROM {p}_scoped) WHERE rn = 1),
{p}_docs AS (SELECT x.shop_id, x.gorder_id, x.order_id, x.order_status, x.order_time, x.order_pay_amount,
  x.buy_account_name, x.buy_account_phone, x.index_id, x.item_id, x.goods_id, x.goods_name,
  CAST(NULL AS VARCHAR) AS goods_img, x.sku_id, CAST(NULL AS VARCHAR) AS sku_desc, x.unit_price,
  x.item_count, CASE WHEN x.item_id IS NOT NULL THEN p.item_id IS NOT NULL END AS has_refund,
  p.refund_apply_type, p.refund_apply_time
  FROM {p}_idx x LEFT JOIN {p}_pi p ON p.gorder_id = x.gorder_id AND p.item_id = x.item_id
  WHERE x.gorder_id NOT IN (SELECT gorder_id FROM {p}_dup)
  AND x.gorder_id NOT IN (SELECT gorder_id FROM {p}_timeless))"""


#: The index of J2 in flat form, from the CTEs b (as of the day before) and n.
ORDER_INDEX = f"""SELECT {FLAT_DOC_COLS}, CAST(order_id AS VARCHAR) AS doc_id FROM b_docs x WHERE NOT EXISTS (SELECT 1 FROM n_docs y
  WHERE y.shop_id IS NOT DISTINCT FROM x.shop_id AND y.gorder_id IS NOT DISTINCT FROM x.gorder_id)
UNION ALL SELECT {FLAT_DOC_COLS}, CAST(order_id AS VARCHAR) AS doc_id FROM n_docs"""


def documents_of(flat: str) -> str:
    """One row per order of a flat form, its items as text."""
    return f"""SELECT doc_id, CAST(0 AS INTEGER) AS part, shop_id, gorder_id, order_id, order_status, order_time, order_pay_amount,
  buy_account_name, buy_account_phone, CAST(count(item_id) AS BIGINT) AS n_items,
  CAST(coalesce(sum(CAST(round(unit_price * 100) AS BIGINT)), 0) AS BIGINT) AS cents,
  coalesce(string_agg(concat_ws(':', index_id, item_id, goods_id, goods_name, sku_id, has_refund, refund_apply_type, refund_apply_time),
    ';' ORDER BY index_id) FILTER (WHERE item_id IS NOT NULL), '') AS items
FROM {flat} GROUP BY ALL"""


def item_docs_ctes(p: str, keys_sql: str, order_filter: str = "TRUE") -> str:
    """CTEs ending in ``{p}_docs`` (item documents) and ``{p}_dead``."""
    return f"""
{p}_k AS ({keys_sql}),
{p}_found AS (SELECT k.gorder_id, c.c_nationkey AS shop_id FROM {p}_k k
  JOIN customer c ON c.c_custkey = k.gorder_id),
{p}_rows0 AS (SELECT f.gorder_id, f.shop_id, o.o_orderkey AS order_id, o.o_orderstatus AS order_status,
  epoch_ms(o.o_orderdate) AS order_time, o.o_totalprice AS order_pay_amount
  FROM {p}_found f JOIN orders o ON o.o_custkey = f.gorder_id WHERE {order_filter}),
{p}_bad AS (SELECT DISTINCT gorder_id FROM {p}_rows0 WHERE order_status IS NULL OR order_time IS NULL),
{p}_rows AS (SELECT * FROM {p}_rows0 WHERE gorder_id NOT IN (SELECT gorder_id FROM {p}_bad)),
{p}_flat AS (SELECT x.*, i.item_id, i.goods_id, i.sku_id, i.unit_price, i.item_count,
  gd.p_name AS goods_name FROM {p}_rows x LEFT JOIN ({ITEMS}) i ON i.order_id = x.order_id
  LEFT JOIN part gd ON gd.p_partkey = i.goods_id),
{p}_all AS (SELECT shop_id, gorder_id, order_id, order_status, CAST(NULL AS VARCHAR) AS buy_account_name,
  CAST(NULL AS VARCHAR) AS buy_account_phone, order_time, order_pay_amount, item_id,
  CAST(NULL AS INTEGER) AS apply_status, CAST(NULL AS VARCHAR) AS apply_type,
  CAST(NULL AS BIGINT) AS apply_time, goods_id, goods_name, CAST(NULL AS VARCHAR) AS goods_img, sku_id,
  CAST(NULL AS VARCHAR) AS sku_desc, unit_price, item_count FROM {p}_flat),
{p}_docs AS (SELECT *, item_id AS doc_id, CAST(NULL AS VARCHAR) AS routing FROM {p}_all
  WHERE item_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY unit_price DESC, item_count DESC) = 1),
{p}_dead AS (SELECT gorder_id, 'missing gorder' AS dl_reason FROM {p}_k
  WHERE gorder_id NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT gorder_id, 'null order status or time' AS dl_reason FROM {p}_bad
  UNION ALL SELECT gorder_id, 'null item id' AS dl_reason FROM {p}_all WHERE item_id IS NULL)"""


def wide_cells_ctes() -> str:
    return """
ev AS (SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, printf('%.2f', value) AS value,
  epoch_ms(ts) AS cell_ts, epoch_ms(date_trunc('day', ts)) AS day_ms FROM events),
rk AS (SELECT *, CAST((day_ms // 100000) % 10 AS VARCHAR) || CAST(day_ms AS VARCHAR)
  || CAST(event_id AS VARCHAR) AS row_key FROM ev),
cells AS (
  SELECT row_key, 'info' AS family, 'event_type' AS qualifier, event_type AS value, cell_ts FROM rk
  UNION ALL SELECT row_key, 'info', 'user_id', user_id, cell_ts FROM rk
  UNION ALL SELECT row_key, 'info', 'value', value, cell_ts FROM rk)"""


def commission_batch_ctes() -> str:
    return f"""
k AS ({KEYS}),
g AS (SELECT k.gorder_id, c.c_name AS gorder_buy_account, c.c_nationkey AS gorder_benefit_user
  FROM k LEFT JOIN customer c ON c.c_custkey = k.gorder_id),
o AS (SELECT g.*, x.order_id, x.order_type, x.commission_amount, x.pay_amount, x.pay_success_time
  FROM g LEFT JOIN ({ORDERS}) x ON x.gorder_id = g.gorder_id),
batch AS (SELECT order_type, commission_amount AS amount, CAST(NULL AS VARCHAR) AS buy_account,
  gorder_benefit_user AS benefit_user_account, pay_amount AS sales_amount, pay_success_time AS event_time,
  gorder_id, order_id FROM o WHERE order_id IS NOT NULL),
tgt AS (SELECT 'UNKNOWN' AS order_type, CAST(0.0 AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS buy_account,
  CAST(NULL AS INTEGER) AS benefit_user_account, CAST(0.0 AS DOUBLE) AS sales_amount,
  CAST(NULL AS BIGINT) AS event_time, o_custkey AS gorder_id, o_orderkey AS order_id, 2 AS status
  FROM orders WHERE o_orderstatus = 'F')"""
