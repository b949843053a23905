"""Registered queries: one per operator of the inventory, plus the jobs.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the raw tables) share column names.  Every query reads the test
tables and runs over them whole; limits appear only where they are the
operator (queue poll size, result page).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import dates, keys
from tidewater.operators import counters, dedup, documents, merge, orders as ordops, projection, ranking, steps
from tidewater.plans import jobs
from tidewater.plans import oracle as sql
from tidewater.session import materialize, passing_path
from tidewater.sinks import layout, search as ksearch, table as ktable, widecolumn as kwide
from tidewater.sources import colocated, queue as squeue, roles, search as ssearch, widecolumn as swide
from tidewater.sources.tables import table
from tidewater.streaming.runner import CommissionStream, ItemIndexStream, OrderSearchStream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries.
REQUEUE_TIME = "2024-02-01 00:00:00"
SEARCH_TERMS = {"order_status": "F", "order_priority": "1-URGENT"}
SEARCH_PAGE = 1
SEARCH_SHOP = 7
DELETE_TERMS = {"order_status": "O", "order_priority": "5-LOW"}
RANGE_START, RANGE_STOP = "2024-01-05 00:00:00", "2024-01-12 00:00:00"
REFUND_STATUS = "R"


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = sql.floor_millis(oracle_sql)
        return fn
    return deco


def _queue_keys(spark, d):
    return dedup.distinct_keys(roles.queue(spark, d), "gorder_id")


def _ms(ts: str) -> int:
    import datetime as _dt
    t = _dt.datetime.fromisoformat(ts).replace(tzinfo=_dt.timezone.utc)
    return int(t.timestamp() * 1000)


# ------------------------------------------------------------ sources (S)

@register("queue_scan", "SELECT event_id AS id, user_id AS gorder_id, event_type FROM events "
                        f"ORDER BY event_id LIMIT {squeue.POLL_ROWS_ORDER_SEARCH}")
def q_queue_scan(spark, d):
    return squeue.poll(roles.queue(spark, d), squeue.POLL_ROWS_ORDER_SEARCH).select(
        "id", "gorder_id", "event_type")


@register("queue_claim_by_id",
          "SELECT event_id AS id, user_id AS gorder_id, event_type FROM events WHERE event_id NOT IN "
          f"(SELECT event_id FROM events ORDER BY event_id LIMIT {squeue.POLL_ROWS_ORDER_SEARCH})")
def q_queue_claim_by_id(spark, d):
    _, remaining = squeue.claim(roles.queue(spark, d), squeue.POLL_ROWS_ORDER_SEARCH, "id")
    return remaining.select("id", "gorder_id", "event_type")


@register("queue_claimed", f"""SELECT 'id' AS claim, CAST(NULL AS BIGINT) AS id, gorder_id, event_type
FROM (SELECT event_id, user_id AS gorder_id, event_type FROM events ORDER BY event_id LIMIT {squeue.POLL_ROWS_ORDER_SEARCH})
UNION ALL SELECT 'key', event_id, user_id, event_type
FROM (SELECT * FROM events ORDER BY event_id LIMIT {squeue.POLL_ROWS_COMMISSION})""")
def q_queue_claimed(spark, d):
    by_id, _ = squeue.claim(roles.queue(spark, d), squeue.POLL_ROWS_ORDER_SEARCH, "id")
    by_key, _ = squeue.claim(roles.queue(spark, d), squeue.POLL_ROWS_COMMISSION, "gorder_id")
    both = (by_id.withColumn("claim", F.lit("id"))                # the delete key is stripped ...
            .unionByName(by_key.withColumn("claim", F.lit("key")), allowMissingColumns=True))
    return both.select("claim", "id", "gorder_id", "event_type")  # ... unless it is the payload key


@register("queue_claim_by_key",
          "SELECT event_id AS id, user_id AS gorder_id, event_type FROM events WHERE user_id NOT IN "
          f"(SELECT user_id FROM (SELECT user_id FROM events ORDER BY event_id "
          f"LIMIT {squeue.POLL_ROWS_COMMISSION}))")
def q_queue_claim_by_key(spark, d):
    _, remaining = squeue.claim(roles.queue(spark, d), squeue.POLL_ROWS_COMMISSION, "gorder_id")
    return remaining.select("id", "gorder_id", "event_type")


@register("requeue_failed", f"""WITH {sql.item_docs_ctes('n', sql.KEYS)}
SELECT user_id AS gorder_id, event_type, epoch_ms(ts) AS create_ms FROM events
UNION ALL SELECT DISTINCT gorder_id, 'requeue', epoch_ms(TIMESTAMP '{REQUEUE_TIME}') FROM n_dead""")
def q_requeue_failed(spark, d):
    _, dead = jobs.item_index_batch(spark, d, roles.queue(spark, d))
    out = squeue.requeue(roles.queue(spark, d), dead, now=REQUEUE_TIME)
    return out.select("gorder_id", "event_type", dates.epoch_millis("create_time").alias("create_ms"))


@register("table_lookup", f"""SELECT k.gorder_id, c.c_name AS gorder_buy_account,
  c.c_nationkey AS gorder_benefit_user FROM ({sql.KEYS}) k LEFT JOIN customer c ON c.c_custkey = k.gorder_id""")
def q_table_lookup(spark, d):
    g = roles.gorders(spark, d).select("gorder_id", F.col("buy_account").alias("gorder_buy_account"),
                                       F.col("benefit_user").alias("gorder_benefit_user"))
    return merge.lookup_join(_queue_keys(spark, d), g, "gorder_id", stream_lookup=True)


@register("doc_get", f"""WITH ids AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS doc_id FROM orders
  WHERE o_custkey IN (SELECT user_id FROM events)), dx AS ({sql.docs()})
SELECT ids.doc_id AS _doc_id, ids.doc_id, dx.routing, dx.shop_id, dx.gorder_id, dx.order_id,
  dx.order_status, dx.order_priority, dx.order_pay_amount, dx.order_time, dx.doc_id IS NOT NULL AS found
FROM ids LEFT JOIN dx ON dx.doc_id = ids.doc_id""")
def q_doc_get(spark, d):
    ids = (roles.orders(spark, d).join(_queue_keys(spark, d), "gorder_id", "left_semi")
           .select(keys.id_text("order_id").alias("doc_id")))
    return ssearch.get_documents(roles.documents(spark, d, roles.INDEX_AS_OF), ids)


@register("doc_search_page", f"""SELECT {sql.DOC_COLS}, doc_id AS _doc_id FROM ({sql.CURRENT_DOCS})
WHERE order_status = 'F' AND order_priority = '1-URGENT' ORDER BY doc_id LIMIT 100 OFFSET {100 * SEARCH_PAGE}""")
def q_doc_search_page(spark, d):
    return ssearch.search_page(roles.documents(spark, d), SEARCH_TERMS, page=SEARCH_PAGE)


@register("doc_search_after", ORACLE["doc_search_page"])
def q_doc_search_after(spark, d):
    """The same page by cursors: each page starts after the last id before it."""
    index, after = roles.documents(spark, d), None
    for _ in range(SEARCH_PAGE):
        after = ssearch.page_end(ssearch.search_after(index, SEARCH_TERMS, after))
    return ssearch.search_after(index, SEARCH_TERMS, after)


def _stored_cells(spark, d):
    """The cell store of a data folder, built once in a checkpoint folder."""
    cells = roles.wide_cells(spark, d)
    return swide.keep_cells(cells, passing_path(spark, "wide-cells", f"{spark.sparkContext.applicationId}-{zlib.crc32(d.encode())}"))


@register("wide_get", f"""WITH {sql.wide_cells_ctes()}
SELECT * FROM cells WHERE row_key IN (SELECT row_key FROM rk WHERE event_type = 'purchase')""")
def q_wide_get(spark, d):
    cells = _stored_cells(spark, d)
    wanted = (cells.where((F.col("qualifier") == "event_type") & (F.col("value") == "purchase"))
              .select("row_key"))
    return swide.get_rows(cells, wanted)


@register("wide_range_scan", f"""WITH {sql.wide_cells_ctes()}
SELECT c.* FROM cells c JOIN rk ON rk.row_key = c.row_key
WHERE rk.day_ms >= epoch_ms(TIMESTAMP '{RANGE_START}') AND rk.day_ms < epoch_ms(TIMESTAMP '{RANGE_STOP}')""")
def q_wide_range_scan(spark, d):
    return swide.scan_time_range(_stored_cells(spark, d), _ms(RANGE_START), _ms(RANGE_STOP))


@register("wide_pivot", f"""WITH {sql.wide_cells_ctes()}
SELECT row_key, arg_max(value, cell_ts) FILTER (WHERE qualifier = 'event_type') AS event_type,
  arg_max(value, cell_ts) FILTER (WHERE qualifier = 'user_id') AS user_id,
  arg_max(value, cell_ts) FILTER (WHERE qualifier = 'value') AS value
FROM cells GROUP BY row_key""")
def q_wide_pivot(spark, d):
    return swide.pivot_rows(roles.wide_cells(spark, d), roles.WIDE_QUALIFIERS, roles.WIDE_FAMILY)


@register("wide_unpivot", f"WITH {sql.wide_cells_ctes()} SELECT * FROM cells")
def q_wide_unpivot(spark, d):
    return roles.wide_cells(spark, d)


# ------------------------------------------------- projections, predicates

@register("project_columns", """SELECT o_orderpriority AS order_type, o_totalprice AS commission_amount,
  CAST(NULL AS VARCHAR) AS buy_account, CAST(NULL AS VARCHAR) AS gorder_benefit_user,
  o_totalprice AS pay_amount, epoch_ms(o_orderdate) AS pay_success_time, o_custkey AS gorder_id,
  o_orderkey AS order_id FROM orders""")
def q_project_columns(spark, d):
    return projection.project_columns(roles.orders(spark, d), jobs.COMMISSION_COLUMNS)


# Fixed value: the column list with defaults sampled in the reference (a
# person's name replaced by "x").
DEFAULTS_SPEC = ("order_type:1, commission_amount, buy_account:x , gorder_benefit_user, "
                 "pay_amount:100, pay_success_time: , gorder_id, order_id")


@register("project_defaults", """SELECT coalesce(o_orderpriority, '1') AS order_type,
  o_totalprice AS commission_amount, 'x' AS buy_account, CAST(NULL AS VARCHAR) AS gorder_benefit_user,
  coalesce(o_totalprice, 100.0) AS pay_amount, epoch_ms(o_orderdate) AS pay_success_time,
  o_custkey AS gorder_id, o_orderkey AS order_id FROM orders""")
def q_project_defaults(spark, d):
    return projection.project_defaults(roles.orders(spark, d), DEFAULTS_SPEC)


@register("guard_blank_key", """WITH e AS (SELECT event_id AS id, CASE event_type WHEN 'error' THEN ' '
  WHEN 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS gorder_key FROM events)
SELECT e.id, e.gorder_key, c.c_nationkey AS shop_id FROM e LEFT JOIN customer c
  ON CAST(c.c_custkey AS VARCHAR) = e.gorder_key""")
def q_guard_blank_key(spark, d):
    """Errors carry a blank key and sign-ups none; the lookup table has a row
    with the blank key (checkout 0 once more), which must never match."""
    key = (F.when(F.col("event_type") == "error", F.lit(" "))
            .when(F.col("event_type") != "signup", keys.id_text("gorder_id")))
    inc = roles.queue(spark, d).select("id", key.alias("gorder_key"))
    lk = roles.gorders(spark, d).select(keys.id_text("gorder_id").alias("gorder_key"),
                                        F.col("benefit_user").alias("shop_id"))
    lk = lk.unionByName(lk.where("gorder_key = '0'").withColumn("gorder_key", F.lit(" ")))
    return merge.lookup_join(inc, lk, "gorder_key", guard_blank=True)


@register("require_key", f"""WITH {sql.item_docs_ctes('n', sql.KEYS)}
SELECT shop_id, gorder_id, order_id FROM n_all WHERE item_id IS NULL""")
def q_require_key(spark, d):
    inp = jobs._order_search_inputs(spark, d)
    found, _ = merge.strict_lookup(_queue_keys(spark, d), inp["gorders"], "gorder_id")
    rows = found.join(inp["orders"], "gorder_id")
    flat = merge.lookup_join(rows, inp["items"], "order_id", stream_lookup=True)
    _, dead = projection.require_key(flat, "item_id")
    return dead.select("shop_id", "gorder_id", "order_id")


@register("overlay_non_null", """WITH last AS (SELECT user_id, value, event_type FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT c.c_custkey AS gorder_id, c.c_name AS buy_account, coalesce(l.value, c.c_acctbal) AS balance,
  coalesce(CASE WHEN l.event_type = 'purchase' THEN 'BUYER' END, c.c_mktsegment) AS segment
FROM customer c LEFT JOIN last l ON l.user_id = c.c_custkey""")
def q_overlay_non_null(spark, d):
    q = roles.queue(spark, d)
    last = dedup.last_by_key(q.select("gorder_id", "create_time", "id", "value", "event_type"),
                             "gorder_id", ["create_time", "id"])
    src = last.select("gorder_id", F.col("value").alias("balance"),
                      F.when(F.col("event_type") == "purchase", F.lit("BUYER")).alias("segment"))
    tgt = table(spark, d, "customer").select(
        F.col("c_custkey").alias("gorder_id"), F.col("c_name").alias("buy_account"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return merge.overlay_non_null(src, tgt, "gorder_id")


@register("flatten_struct", """SELECT event_id AS id, user_id AS gorder_id, event_type,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_flatten_struct(spark, d):
    q = roles.queue(spark, d).select("id", "gorder_id", "event_type", "props")
    return merge.flatten_json(q, "props", "k INT")


def _keyed_queue(spark, d):
    """Queue rows whose JSON has one more key, named by the row's type."""
    q = roles.queue(spark, d)
    own = F.to_json(F.map_concat(F.from_json("props", "map<string,string>"), F.create_map("event_type", F.col("gorder_id").cast("string"))))
    return q.select("id", F.when(F.col("event_type") != "error", own).alias("props"), F.lit("as queued").alias("view"))


@register("flatten_pairs", """SELECT event_id AS id, 'as queued' AS view, 'k' AS key, json_extract_string(props, '$.k') AS value
FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, 'as queued', event_type, CAST(user_id AS VARCHAR)
FROM events WHERE event_type <> 'error'""")
def q_flatten_pairs(spark, d):
    return steps.spread_pairs(_keyed_queue(spark, d), "props")


@register("flatten_any", """SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k,
  CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) ELSE 'as queued' END AS view,
  CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS click,
  CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) END AS purchase,
  CASE WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) END AS signup FROM events""")
def q_flatten_any(spark, d):
    """Every key becomes a column, none declared; one clashes with a column of
    the row."""
    return steps.flatten_any(_keyed_queue(spark, d), "props")


# ------------------------------------------------------------------ joins


@register("service_step", f"""SELECT k.gorder_id, o.order_id, o.pay_amount FROM ({sql.KEYS}) k LEFT JOIN (
  SELECT * FROM (SELECT o_custkey AS gorder_id, o_orderkey AS order_id, o_totalprice AS pay_amount, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') WHERE rn <= 2) o ON o.gorder_id = k.gorder_id""")
def q_service_step(spark, d):
    """A service that answers a checkout with its two dearest urgent open
    orders: none, one or two rows."""
    o = roles.orders(spark, d).where("order_type = '1-URGENT' and order_status = 'O'").select("gorder_id", "order_id", "pay_amount")
    return steps.service_step(_queue_keys(spark, d), o, """SELECT order_id, pay_amount FROM {service} AS o
        WHERE o.gorder_id = row.gorder_id ORDER BY pay_amount DESC, order_id LIMIT 2""")


@register("service_step_required", f"""SELECT k.gorder_id, x.n_open, x.open_amount FROM ({sql.KEYS}) k JOIN (
  SELECT o_custkey AS gorder_id, CAST(count(*) AS BIGINT) AS n_open, max(o_totalprice) AS open_amount FROM orders
  WHERE o_orderstatus = 'O' GROUP BY o_custkey HAVING count(*) > 1) x ON x.gorder_id = k.gorder_id""")
def q_service_step_required(spark, d):
    """A service that answers with a summary, or not at all: unanswered rows go."""
    o = roles.orders(spark, d).where("order_status = 'O'").select("gorder_id", "order_id", "pay_amount")
    return steps.service_step(_queue_keys(spark, d), o, """SELECT count(*) AS n_open, max(pay_amount) AS open_amount FROM {service} AS o
        WHERE o.gorder_id = row.gorder_id HAVING count(*) > 1""", required=True)


@register("lookup_join", """SELECT e.event_id AS id, e.user_id AS gorder_id, e.event_type,
  coalesce(CASE WHEN e.event_type <> 'error' THEN e.value END, c.c_acctbal) AS value, c.c_mktsegment AS segment
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id""")
def q_lookup_join(spark, d):
    # errors have no value of their own: the lookup's fills in
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    inc = roles.queue(spark, d).select("id", "gorder_id", "event_type", value)
    lk = table(spark, d, "customer").select(F.col("c_custkey").alias("gorder_id"),
                                            F.col("c_acctbal").alias("value"),
                                            F.col("c_mktsegment").alias("segment"))
    return merge.lookup_join(inc, lk, "gorder_id")


@register("lookup_fanout", f"""SELECT k.gorder_id, o.order_id, o.order_type, o.order_status, o.pay_amount
FROM ({sql.KEYS}) k LEFT JOIN ({sql.ORDERS}) o ON o.gorder_id = k.gorder_id""")
def q_lookup_fanout(spark, d):
    o = roles.orders(spark, d).select("gorder_id", "order_id", "order_type", "order_status", "pay_amount")
    return merge.lookup_join(_queue_keys(spark, d), o, "gorder_id", stream_lookup=True)


@register("lookup_chain", f"""SELECT k.gorder_id, c.c_nationkey AS shop_id, o.o_orderkey AS order_id,
  i.item_id FROM ({sql.KEYS}) k LEFT JOIN customer c ON c.c_custkey = k.gorder_id
  LEFT JOIN orders o ON o.o_custkey = k.gorder_id LEFT JOIN ({sql.ITEMS}) i ON i.order_id = o.o_orderkey""")
def q_lookup_chain(spark, d):
    steps = [
        (roles.gorders(spark, d).select("gorder_id", F.col("benefit_user").alias("shop_id")),
         "gorder_id", {"stream_lookup": True}),
        (roles.orders(spark, d).select("gorder_id", "order_id"), "gorder_id", {"stream_lookup": True}),
        (roles.items(spark, d).select("order_id", "item_id"), "order_id", {"stream_lookup": True}),
    ]
    return merge.lookup_chain(_queue_keys(spark, d), steps)


@register("lookup_colocated", ORACLE["lookup_chain"])
def q_lookup_colocated(spark, d):
    """The chain of lookups over bucketed tables: only the batch is dealt."""
    bucketed = lambda df, key: colocated.store_bucketed(df, key, passing_path(spark, "bucketed"))
    orders = bucketed(roles.orders(spark, d).select("gorder_id", "order_id"), "gorder_id")
    items = bucketed(roles.items(spark, d).select("order_id", "item_id"), "order_id")
    g = merge.lookup_join(_queue_keys(spark, d), roles.gorders(spark, d).select("gorder_id", F.col("benefit_user").alias("shop_id")), "gorder_id")
    return merge.lookup_join(merge.lookup_join(g, orders, "gorder_id"), items, "order_id")


def _order_batch(spark, d):
    docs, _ = jobs.order_search_batch(spark, d, roles.queue(spark, d))
    return docs


@register("nest_orders", f"""WITH {sql.order_docs_ctes('n', sql.KEYS)}
SELECT order_id, any_value(gorder_id) AS gorder_id, any_value(shop_id) AS shop_id,
  CAST(count(item_id) AS BIGINT) AS n_items,
  coalesce(string_agg(item_id, ',' ORDER BY index_id), '') AS item_ids,
  CAST(sum(CASE WHEN has_refund THEN 1 ELSE 0 END) AS BIGINT) AS n_refunded FROM n_docs GROUP BY order_id""")
def q_nest_orders(spark, d):
    nested = ordops.nest_orders(_order_batch(spark, d))
    return nested.select(
        "order_id", "gorder_id", "shop_id",
        F.size("items").cast("bigint").alias("n_items"),
        F.array_join(F.transform("items", lambda x: x["item_id"]), ",").alias("item_ids"),
        F.size(F.filter("items", lambda x: x["has_refund"])).cast("bigint").alias("n_refunded"))


@register("strict_lookup_missing", f"""SELECT k.gorder_id,
  CASE WHEN g.gorder_id IS NULL THEN 'missing' ELSE 'found' END AS status
FROM ({sql.KEYS}) k LEFT JOIN ({sql.PARTIAL_GORDERS}) g ON g.gorder_id = k.gorder_id""")
def q_strict_lookup_missing(spark, d):
    found, missing = ordops.resolve_gorders(_queue_keys(spark, d), roles.partial_gorders(spark, d))
    return (found.select("gorder_id", F.lit("found").alias("status"))
            .unionByName(missing.select("gorder_id", F.lit("missing").alias("status"))))


@register("enrich_address", f"""SELECT o.o_custkey AS gorder_id, o.o_orderkey AS order_id,
  a.buy_account_name, a.buy_account_phone FROM orders o LEFT JOIN ({sql.ADDRESS}) a ON a.order_id = o.o_orderkey
WHERE o.o_custkey IN (SELECT user_id FROM events)""")
def q_enrich_address(spark, d):
    rows = roles.orders(spark, d).join(_queue_keys(spark, d), "gorder_id", "left_semi")
    return ordops.enrich_address(rows.select("gorder_id", "order_id"), roles.addresses(spark, d))


@register("enrich_refund", f"""WITH {sql.order_docs_ctes('n', sql.KEYS)}
SELECT order_id, item_id, has_refund, refund_apply_type, refund_apply_time FROM n_docs WHERE item_id IS NOT NULL""")
def q_enrich_refund(spark, d):
    return (_order_batch(spark, d).where(F.col("item_id").isNotNull())
            .select("order_id", "item_id", "has_refund", "refund_apply_type", "refund_apply_time"))


@register("refund_duplicates", """SELECT l_orderkey AS order_id, concat_ws('-', l_orderkey, l_linenumber)
  AS order_item_id, CAST(count(*) AS BIGINT) AS n_refunds FROM lineitem WHERE l_returnflag = 'R'
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_refund_duplicates(spark, d):
    return ordops.refund_duplicates(roles.line_refunds(spark, d))


# ------------------------------------------------ aggregations and windows

@register("item_index", f"""SELECT order_id, item_id, unit_price, item_count, CAST(row_number() OVER
  (PARTITION BY order_id ORDER BY line_no, item_id, unit_price, item_count) - 1 AS INTEGER) AS index_id
  FROM ({sql.ITEMS})""")
def q_item_index(spark, d):
    items = roles.items(spark, d).select("order_id", "item_id", "line_no", "unit_price", "item_count")
    order = ["line_no", "item_id", "unit_price", "item_count"]
    return ranking.position_in_group(items, ["order_id"], order, "index_id").drop("line_no")


@register("distinct_keys", sql.KEYS)
def q_distinct_keys(spark, d):
    return _queue_keys(spark, d)


@register("dedup_last", """SELECT gorder_id, id, event_type, value, create_ms FROM (SELECT user_id AS gorder_id,
  event_id AS id, event_type, value, epoch_ms(ts) AS create_ms, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def q_dedup_last(spark, d):
    q = roles.queue(spark, d).select("gorder_id", "id", "event_type", "value", "create_time")
    last = dedup.last_by_key(q, "gorder_id", ["create_time", "id"])
    return last.select("gorder_id", "id", "event_type", "value",
                       dates.epoch_millis("create_time").alias("create_ms"))


@register("step_counters", f"""WITH {sql.order_docs_ctes('n', sql.KEYS)}
SELECT 'queue' AS step, 'emitted' AS status, CAST(count(*) AS BIGINT) AS n FROM events
UNION ALL SELECT 'gorder', CASE WHEN gorder_id IN (SELECT gorder_id FROM ({sql.PARTIAL_GORDERS})) THEN 'acked'
  ELSE 'failed' END, CAST(count(*) AS BIGINT) FROM n_k GROUP BY 2
UNION ALL SELECT 'document', 'emitted', CAST(count(*) AS BIGINT) FROM n_docs""")
def q_step_counters(spark, d):
    q = roles.queue(spark, d)
    found, missing = ordops.resolve_gorders(dedup.distinct_keys(q, "gorder_id"), roles.partial_gorders(spark, d))
    docs, _ = jobs.order_search_batch(spark, d, q)
    return counters.step_counters([("queue", "emitted", q), ("gorder", "acked", found),
                                   ("gorder", "failed", missing), ("document", "emitted", docs)])


# -------------------------------------------------------------- functions

@register("date_add_days", """SELECT event_id AS id, epoch_ms(ts + INTERVAL 7 DAY) AS plus7_ms,
  epoch_ms(ts - INTERVAL 3 DAY) AS minus3_ms FROM events""")
def q_date_add_days(spark, d):
    q = roles.queue(spark, d)
    return q.select("id", dates.epoch_millis(dates.add_days("create_time", 7)).alias("plus7_ms"),
                    dates.epoch_millis(dates.add_days("create_time", -3)).alias("minus3_ms"))


@register("date_format", """SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
  strftime(ts, '%Y-%m-%d') AS day_text FROM events""")
def q_date_format(spark, d):
    q = roles.queue(spark, d)
    return q.select("id", dates.format_date("create_time").alias("ts_text"),
                    dates.format_date("create_time", dates.DAY_FORMAT).alias("day_text"))


@register("date_parse", """SELECT event_id AS id,
  epoch_ms(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) AS parsed_ms,
  CASE WHEN event_type <> 'error' THEN epoch_ms(date_trunc('second', ts)) END AS bad_ms,
  epoch_ms(date_trunc('second', ts)) AS strict_ms,
  epoch_ms(date_trunc('month', ts) + INTERVAL 12 MONTH + to_days(CAST(day(ts) + 30 AS INTEGER))
    + to_hours(hour(ts) + 24) + to_minutes(minute(ts) + 60) + to_seconds(CAST(floor(second(ts)) AS BIGINT)))
    AS rolled_ms FROM events""")
def q_date_parse(spark, d):
    q = roles.queue(spark, d)
    text = dates.format_date("create_time")
    bad = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(text)
    t = F.col("create_time")
    # out-of-range month, day, hour and minute: they roll over
    rolled = F.format_string("%d-%d-%d %d:%d:%d", F.year(t), F.month(t) + 12, F.dayofmonth(t) + 31,
                             F.hour(t) + 24, F.minute(t) + 60, F.second(t))
    return q.select("id", dates.epoch_millis(dates.parse_date(text)).alias("parsed_ms"),
                    dates.epoch_millis(dates.parse_date(bad)).alias("bad_ms"),
                    dates.epoch_millis(dates.parse_date(text, strict=True)).alias("strict_ms"),
                    dates.epoch_millis(dates.parse_date_lenient(rolled)).alias("rolled_ms"))


@register("date_parse_formats", """SELECT event_id AS id,
  epoch_ms(date_trunc('day', ts) + INTERVAL 13 MONTH) AS compact_ms,
  epoch_ms(date_trunc('month', ts) - INTERVAL 2 MONTH + to_days(CAST(hour(ts) AS INTEGER) - 1)) AS negative_ms,
  epoch_ms(date_trunc('minute', ts) - INTERVAL 90 MINUTE) AS trailing_ms,
  epoch_ms(TIMESTAMP '1970-01-01' + to_minutes(minute(ts) + 1440)) AS clock_ms,
  CASE WHEN event_type <> 'error' THEN epoch_ms(date_trunc('day', ts)) END AS bad_ms FROM events""")
def q_date_parse_formats(spark, d):
    """Lenient parsing by given patterns: fields side by side, a month beyond
    the year, negative and zero fields, trailing text, absent fields, bad text."""
    q, t = roles.queue(spark, d), F.col("create_time")
    ms = lambda text, fmt: dates.epoch_millis(dates.parse_date_lenient(text, fmt))
    next_year = F.date_format(t + F.expr("INTERVAL 13 MONTH"), "yyyyMMdd")
    return q.select(
        "id", ms(next_year, "yyyyMMdd").alias("compact_ms"),
        ms(F.format_string("%d/%d/%d", F.hour(t), F.month(t) - 2, F.year(t)), "dd/MM/yyyy").alias("negative_ms"),
        ms(F.format_string("%s at %d:%d and more", F.date_format(t, "yyyy.MM.dd"), F.hour(t) - 1, F.minute(t) - 30),
           "yyyy.MM.dd 'at' HH:mm").alias("trailing_ms"),
        ms(F.format_string("24h%d", F.minute(t)), "HH'h'mm").alias("clock_ms"),
        ms(F.when(F.col("event_type") != "error", F.date_format(t, "d.M.yyyy")).otherwise("no date"), "d.M.yyyy").alias("bad_ms"))


@register("epoch_millis", "SELECT event_id AS id, epoch_ms(ts) AS ts_ms, "
                          "epoch_ms(date_trunc('day', ts)) AS day_ms FROM events")
def q_epoch_millis(spark, d):
    q = roles.queue(spark, d)
    return q.select("id", dates.epoch_millis("create_time").alias("ts_ms"),
                    dates.day_start_millis("create_time").alias("day_ms"))


@register("salted_row_key", f"WITH {sql.wide_cells_ctes()} SELECT event_id AS id, row_key FROM rk")
def q_salted_row_key(spark, d):
    q = roles.queue(spark, d)
    return q.select("id", keys.salted_row_key("create_time", "id").alias("row_key"))


# ------------------------------------------------------------------ sinks

@register("insert_rows", f"""WITH {sql.commission_batch_ctes()}
SELECT * FROM tgt UNION ALL SELECT *, 1 AS status FROM batch""")
def q_insert_rows(spark, d):
    batch, _ = jobs.commission_batch(roles.queue(spark, d), roles.gorders(spark, d), roles.orders(spark, d))
    return ktable.insert_rows(roles.commission_target(spark, d),
                              batch.withColumn("status", F.lit(ktable.INSERTED_STATUS)))


@register("upsert_commission", f"""WITH {sql.commission_batch_ctes()}, moved AS ({sql.MOVED_TARGET})
SELECT b.gorder_id, b.order_id, CASE
  WHEN EXISTS (SELECT 1 FROM moved t WHERE t.order_id = b.order_id AND t.gorder_id = b.gorder_id) THEN 'update'
  WHEN EXISTS (SELECT 1 FROM moved t WHERE t.order_id = b.order_id) THEN 'lost' ELSE 'insert' END AS action
FROM batch b""")
def q_upsert_commission(spark, d):
    batch, _ = jobs.commission_batch(roles.queue(spark, d), roles.gorders(spark, d), roles.orders(spark, d))
    return ktable.upsert_actions(roles.commission_target(spark, d, moved=True), batch, "order_id",
                                 ["gorder_id", "order_id"])


@register("upsert_lost", f"""WITH {sql.commission_batch_ctes()}, moved AS ({sql.MOVED_TARGET})
SELECT b.* FROM batch b JOIN moved t ON t.order_id = b.order_id WHERE t.gorder_id <> b.gorder_id""")
def q_upsert_lost(spark, d):
    """The updates of J1 that another checkout's row takes away (reported)."""
    batch, _ = jobs.commission_batch(roles.queue(spark, d), roles.gorders(spark, d), roles.orders(spark, d))
    _, lost = ktable.upsert_commission(roles.commission_target(spark, d, moved=True), batch)
    return lost.select(*batch.columns)


@register("doc_index", f"""WITH dx AS ({sql.docs()}), b AS (SELECT doc_id, CAST(NULL AS VARCHAR) AS routing,
  shop_id, gorder_id, order_id, order_status, order_priority, order_pay_amount, order_time FROM ({sql.QUEUED_DOCS}))
SELECT * FROM dx WHERE doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT * FROM b""")
def q_doc_index(spark, d):
    batch = _queued_docs(spark, d).withColumn("routing", F.lit(None).cast("string"))
    return ksearch.index_documents(roles.documents(spark, d, roles.INDEX_AS_OF), batch)


def _queued_docs(spark, d):
    cur = roles.documents(spark, d)
    return cur.join(_queue_keys(spark, d), "gorder_id", "left_semi").select(*roles.documents(spark, d).columns)


@register("doc_index_parent", f"""WITH dx AS ({sql.docs()}), b AS (SELECT doc_id,
  CAST(shop_id AS VARCHAR) AS routing, shop_id, gorder_id, order_id, order_status, order_priority,
  order_pay_amount, order_time FROM ({sql.QUEUED_DOCS}))
SELECT * FROM dx WHERE doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT * FROM b""")
def q_doc_index_parent(spark, d):
    return ksearch.index_with_parent(roles.documents(spark, d, roles.INDEX_AS_OF), _queued_docs(spark, d), "shop_id")


def _refund_updates(spark, d):
    r = roles.refunds(spark, d).select(keys.id_text("order_id").alias("doc_id")).distinct()
    return r.withColumn("order_status", F.lit(REFUND_STATUS))


@register("doc_update", f"""WITH dx AS ({sql.docs()}), u AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS doc_id
  FROM lineitem WHERE l_returnflag = 'R')
SELECT dx.doc_id, dx.routing, dx.shop_id, dx.gorder_id, dx.order_id,
  CASE WHEN u.doc_id IS NOT NULL THEN '{REFUND_STATUS}' ELSE dx.order_status END AS order_status,
  dx.order_priority, dx.order_pay_amount, dx.order_time FROM dx LEFT JOIN u ON u.doc_id = dx.doc_id""")
def q_doc_update(spark, d):
    updated, _ = ksearch.update_documents(roles.documents(spark, d, roles.INDEX_AS_OF), _refund_updates(spark, d))
    return updated


@register("doc_update_repeated", f"""WITH dx AS ({sql.docs()}), u AS (SELECT CAST(l_orderkey AS VARCHAR) AS doc_id,
  max(l_linestatus) AS line_status FROM lineitem GROUP BY l_orderkey)
SELECT dx.doc_id, dx.routing, dx.shop_id, dx.gorder_id, dx.order_id,
  CASE WHEN u.doc_id IS NOT NULL THEN u.line_status ELSE dx.order_status END AS order_status,
  dx.order_priority, dx.order_pay_amount, dx.order_time FROM dx LEFT JOIN u ON u.doc_id = dx.doc_id""")
def q_doc_update_repeated(spark, d):
    """One update per line, many per document: one document stays, the
    greatest update wins."""
    updates = table(spark, d, "lineitem").select(keys.id_text("l_orderkey").alias("doc_id"),
                                                 F.col("l_linestatus").alias("order_status"))
    updated, _ = ksearch.update_documents(roles.documents(spark, d, roles.INDEX_AS_OF), updates)
    return updated


@register("doc_update_last", f"""WITH dx AS ({sql.docs()}), u AS (SELECT CAST(l_orderkey AS VARCHAR) AS doc_id,
  arg_max(l_returnflag, (l_shipdate, l_returnflag)) AS flag FROM lineitem GROUP BY l_orderkey)
SELECT dx.doc_id, dx.routing, dx.shop_id, dx.gorder_id, dx.order_id, coalesce(u.flag, dx.order_status) AS order_status,
  dx.order_priority, dx.order_pay_amount, dx.order_time FROM dx LEFT JOIN u ON u.doc_id = dx.doc_id""")
def q_doc_update_last(spark, d):
    """One update per line, many per document: the last by ship date wins."""
    updates = table(spark, d, "lineitem").select(keys.id_text("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("order_status"),
                                                 F.col("l_shipdate").alias("at"))
    updated, _ = ksearch.update_documents(roles.documents(spark, d, roles.INDEX_AS_OF), updates, order=["at"])
    return updated


@register("doc_update_missing", f"""WITH dx AS ({sql.docs()})
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS doc_id, '{REFUND_STATUS}' AS order_status FROM lineitem
WHERE l_returnflag = 'R' AND CAST(l_orderkey AS VARCHAR) NOT IN (SELECT doc_id FROM dx)""")
def q_doc_update_missing(spark, d):
    _, missing = ksearch.update_documents(roles.documents(spark, d, roles.INDEX_AS_OF), _refund_updates(spark, d))
    return missing


@register("doc_delete", f"""WITH dx AS ({sql.CURRENT_DOCS})
SELECT * FROM dx WHERE doc_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
  WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error'))""")
def q_doc_delete(spark, d):
    q = roles.queue(spark, d).where(F.col("event_type") == "error")
    ids = (roles.orders(spark, d).join(dedup.distinct_keys(q, "gorder_id"), "gorder_id", "left_semi")
           .select(keys.id_text("order_id").alias("doc_id")))
    return ksearch.delete_documents(roles.documents(spark, d), ids)


@register("doc_delete_by_query", f"""SELECT * FROM ({sql.CURRENT_DOCS})
WHERE NOT (order_status = 'O' AND order_priority = '5-LOW')""")
def q_doc_delete_by_query(spark, d):
    remaining, _ = ksearch.delete_by_query(roles.documents(spark, d), DELETE_TERMS)
    return remaining


@register("doc_delete_count", f"""SELECT CAST(count(*) AS BIGINT) AS deleted FROM ({sql.CURRENT_DOCS})
WHERE order_status = 'O' AND order_priority = '5-LOW'""")
def q_doc_delete_count(spark, d):
    _, n = ksearch.delete_by_query(roles.documents(spark, d), DELETE_TERMS)
    return n


@register("replace_group", f"""WITH dx AS ({sql.docs()}), b AS ({sql.QUEUED_DOCS})
SELECT * FROM dx WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.shop_id IS NOT DISTINCT FROM dx.shop_id
  AND b.gorder_id IS NOT DISTINCT FROM dx.gorder_id)
UNION ALL SELECT * FROM b""")
def q_replace_group(spark, d):
    return ksearch.replace_groups(roles.documents(spark, d, roles.INDEX_AS_OF), _queued_docs(spark, d), ("shop_id", "gorder_id"))


@register("routing_layout", f"SELECT {sql.DOC_COLS} FROM ({sql.CURRENT_DOCS})")
def q_routing_layout(spark, d):
    path = passing_path(spark, "routing-layout")
    layout.write_routed(roles.documents(spark, d), path, "routing")
    return layout.read_routed(spark, path).select(*roles.documents(spark, d).columns)


def _wide_puts(spark, d):
    cells = roles.wide_cells(spark, d)
    hit = cells.where((F.col("qualifier") == "event_type") & (F.col("value") == "error"))
    return hit.select("row_key", "family", "qualifier", F.lit("error_resolved").alias("value"),
                      (F.col("cell_ts") + F.lit(1000)).alias("cell_ts"))


@register("wide_put", f"""WITH {sql.wide_cells_ctes()},
puts AS (SELECT row_key, family, qualifier, 'error_resolved' AS value, cell_ts + 1000 AS cell_ts FROM cells
  WHERE qualifier = 'event_type' AND value = 'error'),
allc AS (SELECT * FROM cells UNION ALL SELECT * FROM puts)
SELECT row_key, family, qualifier, value, cell_ts FROM (SELECT *, row_number() OVER (PARTITION BY row_key,
  family, qualifier ORDER BY cell_ts DESC, value DESC) AS rn FROM allc) WHERE rn = 1""")
def q_wide_put(spark, d):
    return kwide.put_cells(roles.wide_cells(spark, d), _wide_puts(spark, d))


@register("wide_delete", f"""WITH {sql.wide_cells_ctes()}
SELECT * FROM cells WHERE row_key NOT IN (SELECT row_key FROM rk WHERE event_type = 'signup')""")
def q_wide_delete(spark, d):
    cells = roles.wide_cells(spark, d)
    gone = cells.where((F.col("qualifier") == "event_type") & (F.col("value") == "signup")).select("row_key")
    return kwide.delete_rows(cells, gone)


# ------------------------------------------------------------------- jobs

@register("job_commission", f"""WITH {sql.commission_batch_ctes()}
SELECT CASE WHEN b.order_id IS NOT NULL THEN b.order_type ELSE t.order_type END AS order_type,
  CASE WHEN b.order_id IS NOT NULL THEN b.amount ELSE t.amount END AS amount,
  CASE WHEN b.order_id IS NOT NULL THEN b.buy_account ELSE t.buy_account END AS buy_account,
  CASE WHEN b.order_id IS NOT NULL THEN b.benefit_user_account ELSE t.benefit_user_account END AS benefit_user_account,
  CASE WHEN b.order_id IS NOT NULL THEN b.sales_amount ELSE t.sales_amount END AS sales_amount,
  CASE WHEN b.order_id IS NOT NULL THEN b.event_time ELSE t.event_time END AS event_time,
  t.gorder_id, t.order_id, t.status
FROM tgt t LEFT JOIN batch b ON b.gorder_id = t.gorder_id AND b.order_id = t.order_id
UNION ALL SELECT *, 1 AS status FROM batch WHERE order_id NOT IN (SELECT order_id FROM tgt)""")
def q_job_commission(spark, d):
    target, _, _ = jobs.job_commission(spark, d)
    return target


@register("job_order_search", f"""WITH {sql.order_docs_ctes('b', sql.ALL_KEYS, sql.AS_OF)},
{sql.order_docs_ctes('n', sql.KEYS)}
SELECT {sql.FLAT_DOC_COLS}, CAST(order_id AS VARCHAR) AS doc_id FROM b_docs x WHERE NOT EXISTS (SELECT 1 FROM n_docs y
  WHERE y.shop_id IS NOT DISTINCT FROM x.shop_id AND y.gorder_id IS NOT DISTINCT FROM x.gorder_id)
UNION ALL SELECT {sql.FLAT_DOC_COLS}, CAST(order_id AS VARCHAR) AS doc_id FROM n_docs""")
def q_job_order_search(spark, d):
    """The stored documents of J2 in their flat form, one row per item."""
    index, _ = jobs.job_order_search(spark, d)
    return documents.explode_documents(index)


@register("job_order_documents", f"""WITH {sql.order_docs_ctes('b', sql.ALL_KEYS, sql.AS_OF)},
{sql.order_docs_ctes('n', sql.KEYS)}, flat AS ({sql.ORDER_INDEX})
{sql.documents_of('flat')}""")
def q_job_order_documents(spark, d):
    """The index of J2 as stored: one row per order, its items nested (shown
    as text)."""
    index, _ = jobs.job_order_search(spark, d)
    return _shown(index)


def _shown(index):
    price = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + F.round(x["unit_price"] * 100).cast("bigint"))
    return index.select("doc_id", "part", "shop_id", "gorder_id", "order_id", "order_status", "order_time", "order_pay_amount",
                        "buy_account_name", "buy_account_phone", F.size("items").cast("bigint").alias("n_items"),
                        price.alias("cents"), documents.items_text().alias("items"))


@register("order_document_get", f"""WITH {sql.order_docs_ctes('b', sql.ALL_KEYS, sql.AS_OF)},
{sql.order_docs_ctes('n', sql.KEYS)}, flat AS ({sql.ORDER_INDEX}), stored AS ({sql.documents_of('flat')}),
ids AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS doc_id FROM lineitem WHERE l_returnflag = 'R')
SELECT ids.doc_id AS _doc_id, stored.shop_id, stored.order_status, stored.n_items, stored.items, stored.doc_id IS NOT NULL AS found
FROM ids LEFT JOIN stored ON stored.doc_id = ids.doc_id""")
def q_order_document_get(spark, d):
    """S8 on stored documents: those of all refunded orders, misses too."""
    index, _ = jobs.job_order_search(spark, d)
    ids = roles.refunds(spark, d).select(keys.id_text("order_id").alias("doc_id"))
    found = ssearch.get_documents(materialize(index, "order-index"), ids, stored=True)
    return found.select("_doc_id", "shop_id", "order_status", F.size("items").cast("bigint").alias("n_items"),
                        documents.items_text().alias("items"), "found")


@register("order_document_search", f"""WITH {sql.order_docs_ctes('b', sql.ALL_KEYS, sql.AS_OF)},
{sql.order_docs_ctes('n', sql.KEYS)}, flat AS ({sql.ORDER_INDEX})
SELECT * FROM ({sql.documents_of('flat')}) WHERE order_status = 'F' AND shop_id = {SEARCH_SHOP} ORDER BY doc_id
LIMIT 100 OFFSET {100 * SEARCH_PAGE}""")
def q_order_document_search(spark, d):
    """S9 on stored documents: a page of one shop's."""
    index, _ = jobs.job_order_search(spark, d)
    return _shown(ssearch.search_page(index, {"order_status": "F", "shop_id": SEARCH_SHOP}, page=SEARCH_PAGE))


@register("order_document_refund", f"""WITH {sql.order_docs_ctes('b', sql.ALL_KEYS, sql.AS_OF)}, flat AS (
  SELECT x.* REPLACE (x.has_refund OR u.item_id IS NOT NULL AS has_refund,
    coalesce(u.apply_type, x.refund_apply_type) AS refund_apply_type, coalesce(u.create_time, x.refund_apply_time) AS refund_apply_time),
    CAST(x.order_id AS VARCHAR) AS doc_id
  FROM b_docs x LEFT JOIN ({sql.LATE_REFUNDS}) u ON u.order_id = x.order_id AND u.item_id = x.item_id)
{sql.documents_of('flat')}""")
def q_order_document_refund(spark, d):
    """A later refund feed merged into the arrays of the stored index (T6 on
    documents that are there already)."""
    index, buckets = jobs.stored_order_index(spark, d)
    return _shown(documents.merge_refunds(index, roles.late_refunds(spark, d), buckets=buckets, whole=True)[0])


@register("job_item_index", f"""WITH {sql.item_docs_ctes('b', sql.ALL_KEYS, sql.AS_OF)},
{sql.item_docs_ctes('n', sql.KEYS)}
SELECT * FROM b_docs WHERE doc_id NOT IN (SELECT doc_id FROM n_docs) UNION ALL SELECT * FROM n_docs""")
def q_job_item_index(spark, d):
    index, _ = jobs.job_item_index(spark, d)
    return index


STREAM_FILES = 4
#: Bytes of a row group of the queue files, the least that a task reads.
QUEUE_ROW_GROUP = 4 << 20


def _run_stream(cls, spark, d, max_files=1):
    """A job over the queue as it arrives: the queue table in four files."""
    root = passing_path(spark, f"{cls.name}-stream")
    # several row groups to a file: a batch of one file is read by many tasks
    (table(spark, d, "events").repartitionByRange(STREAM_FILES, "event_id").write
     .option("parquet.block.size", QUEUE_ROW_GROUP).parquet(f"{root}/queue"))
    job = cls(spark, d, f"{root}/queue", work_root=f"{root}/work", max_files=max_files)
    job.run(available_now=True)
    return job.result()


@register("stream_order_search", ORACLE["job_order_search"])
def q_stream_order_search(spark, d):
    """J2 as a Structured Streaming query over the queue table (an
    ``availableNow`` run of two micro-batches); the final index equals the
    batch job's."""
    return documents.explode_documents(_run_stream(OrderSearchStream, spark, d, max_files=2))


@register("stream_commission", ORACLE["job_commission"])
def q_stream_commission(spark, d):
    """J1 as a Structured Streaming query (four micro-batches); the final
    target equals the batch job's."""
    return _run_stream(CommissionStream, spark, d)


@register("stream_item_index", ORACLE["job_item_index"])
def q_stream_item_index(spark, d):
    """J3 as a Structured Streaming query (four micro-batches); the final item
    index equals the batch job's."""
    return _run_stream(ItemIndexStream, spark, d)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
