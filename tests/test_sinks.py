
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_plans import _plan as plan
from tidewater.sinks import search as ks, table as kt, widecolumn as kw
from tidewater.sinks.appended import AppendedTable
from tidewater.session import fresh_path

TGT = ("order_type string, amount double, buy_account string, benefit_user_account int, "
       "sales_amount double, event_time bigint, gorder_id bigint, order_id bigint, status int")
BATCH = ("order_type string, amount double, buy_account string, benefit_user_account int, "
         "sales_amount double, event_time bigint, gorder_id bigint, order_id bigint")


def test_upsert_keeps_status_inserts_with_1_and_reports_lost(spark):
    tgt = spark.createDataFrame([("old", 0.0, None, None, 0.0, None, 1, 10, 2),
                                 ("old", 0.0, None, None, 0.0, None, 9, 30, 2)], TGT)
    batch = spark.createDataFrame([("new", 5.0, None, 3, 6.0, 100, 1, 10),    # update
                                   ("new", 7.0, "b", 3, 8.0, 200, 1, 20),     # insert
                                   ("new", 1.0, "c", 3, 1.0, 300, 1, 30)],    # id under gorder 9: lost
                                  BATCH)
    out, lost = kt.upsert_commission(tgt, batch)
    assert rows(out) == sorted([
        ("new", 5.0, None, 3, 6.0, 100, 1, 10, 2),
        ("old", 0.0, None, None, 0.0, None, 9, 30, 2),
        ("new", 7.0, "b", 3, 8.0, 200, 1, 20, 1)], key=repr)
    assert rows(lost, "order_id") == [(30,)]
    acts = kt.upsert_actions(tgt, batch, "order_id", ["gorder_id", "order_id"])
    assert rows(acts, "order_id", "action") == [(10, "update"), (20, "insert"), (30, "lost")]


def test_upsert_dedupes_batch_last_write_wins(spark):
    tgt = spark.createDataFrame([], TGT)
    b = spark.createDataFrame([("a", 1.0, None, 1, 1.0, 5, 1, 10, 1), ("b", 2.0, None, 1, 2.0, 6, 1, 10, 2)],
                              BATCH + ", seq int")
    out, _ = kt.upsert_commission(tgt, b, order=["seq"])
    assert rows(out, "order_type", "status") == [("b", 1)]


DOCS = "doc_id string, routing string, shop_id int, gorder_id bigint, v string"


def test_replace_group_replaces_whole_large_group(spark):
    old = [(f"d{i}", "r", 1, 7, "old") for i in range(150)] + [("x", "r", 2, 8, "keep"), ("y", "r", None, 9, "n")]
    idx = spark.createDataFrame(old, DOCS)
    batch = spark.createDataFrame([("d0", "r", 1, 7, "new"), ("z", "r", None, 9, "new")], DOCS)
    out = ks.replace_groups(idx, batch, ("shop_id", "gorder_id"))
    assert rows(out, "doc_id", "v") == sorted([("d0", "new"), ("x", "keep"), ("z", "new")], key=repr)
    # empty batch group deletes nothing
    same = ks.replace_groups(idx, batch.where("false"), ("shop_id", "gorder_id"))
    assert same.count() == idx.count()


def test_index_update_delete(spark):
    idx = spark.createDataFrame([("a", "r1", 1, 1, "x"), ("b", "r2", 1, 1, "y")], DOCS)
    batch = spark.createDataFrame([("a", "r1", 5, 1, "x2"), (None, None, 6, 2, "auto")], DOCS)
    out = ks.index_documents(idx, batch)
    got = {r["v"]: r for r in out.collect()}
    assert set(got) == {"x2", "y", "auto"} and got["auto"]["doc_id"]
    upd = spark.createDataFrame([("b", "new-y"), ("nope", "z")], "doc_id string, v string")
    updated, missing = ks.update_documents(idx, upd)
    assert rows(updated, "doc_id", "v", "shop_id") == [("a", "x", 1), ("b", "new-y", 1)]
    assert rows(missing, "doc_id") == [("nope",)]
    gone = ks.delete_documents(idx, spark.createDataFrame([("a", "r1"), ("b", "other")], "doc_id string, routing string"),
                               with_routing=True)
    assert rows(gone, "doc_id") == [("b",)]
    rem, n = ks.delete_by_query(idx, {"v": "x", "shop_id": 1})
    assert rows(rem, "doc_id") == [("b",)] and n.first()["deleted"] == 1
    rem2, n2 = ks.delete_by_query(idx, {})
    assert rem2.count() == 2 and n2.first()["deleted"] == 0


def test_wide_put_and_delete(spark):
    cells = spark.createDataFrame([("k1", "f", "q", "v1", 1), ("k2", "f", "q", "v2", 1)],
                                  "row_key string, family string, qualifier string, value string, cell_ts bigint")
    puts = spark.createDataFrame([("k1", "f", "q", "v1b", 2), ("k1", "f", "q2", "n", 2), ("k2", "f", "q", "old", 0)],
                                 cells.schema)
    out = kw.put_cells(cells, puts)
    assert rows(out, "row_key", "qualifier", "value") == [("k1", "q", "v1b"), ("k1", "q2", "n"), ("k2", "q", "v2")]
    assert rows(kw.delete_rows(out, spark.createDataFrame([("k1",)], "row_key string")), "row_key") == [("k2",)]


def _target(spark, root, name="epoch"):
    return AppendedTable(spark, f"{root}/index", ["shop_id", "gorder_id"], f"{root}/{name}")


def test_appended_batches_hold_only_their_rows_and_replays_change_nothing(spark):
    root = fresh_path(spark, "appended-test")
    t = _target(spark, root)
    base = spark.createDataFrame([(f"d{i}", None, i % 8 or None, i, "old") for i in range(40)], DOCS)
    t.initialize(lambda: base)
    t.initialize(lambda: base.limit(0))                  # there is one already
    one = spark.createDataFrame([("d3", None, 3, 3, "new"), ("n1", None, 3, 99, "new"), ("d8", None, None, 8, "new")], DOCS)
    two = spark.createDataFrame([("d4", None, 4, 4, "two"), ("x4", None, 4, 4, "two")], DOCS)
    t.append(0, one)
    t.append(1, two)
    state = rows(t.read(), *base.columns)
    assert t.read().count() == 42 and t.rows().where("epoch > 0").count() == 5
    assert rows(t.read().where("v = 'new'"), "doc_id") == [("d3",), ("d8",), ("n1",)]
    for i, df in ((0, one), (1, two), (0, one)):        # replays of any age
        t.append(i, df)
        assert rows(t.read(), *base.columns) == state
    assert rows(t.read((t.epoch, 1)).where("gorder_id = 4"), "v") == [("old",)]
    assert rows(t.read(only=two), "doc_id") == [("d4",), ("x4",)]
    assert rows(t.compact(f"{root}/compacted").read(), *base.columns) == state


def test_new_checkpoint_over_an_old_target_loses_nothing(spark):
    root = fresh_path(spark, "appended-epoch-test")
    t = _target(spark, root)
    t.initialize(lambda: spark.createDataFrame([("d1", None, 1, 1, "old")], DOCS))
    t.append(0, spark.createDataFrame([("d2", None, 1, 2, "first")], DOCS))
    again = _target(spark, root, "epoch2")               # batch ids start anew
    assert _target(spark, root).epoch == t.epoch < again.epoch
    again.append(0, spark.createDataFrame([("d1", None, 1, 1, "second")], DOCS))
    assert rows(again.read(), "doc_id", "v") == [("d1", "second"), ("d2", "first")] == rows(t.read(), "doc_id", "v")


def test_get_documents_bulk_and_single(spark):
    from tidewater.sources import search as ss

    idx = spark.createDataFrame([("a", "r1", 1, 1, "x"), ("b", None, 1, 1, "y")], DOCS)
    req = spark.createDataFrame([("a", "r1"), ("b", None), ("zz", "r1"), ("a", "r9")], "doc_id string, routing string")
    got = ss.get_documents(idx, req, with_routing=True)
    assert rows(got, "_doc_id", "routing", "v", "found") == sorted(
        [("a", "r1", "x", True), ("b", None, "y", True), ("zz", "r1", None, False), ("a", "r9", None, False)],
        key=repr)
    assert rows(ss.get_document(idx, "b"), "_doc_id", "v") == [("b", "y")]
    assert ss.get_document(idx, "nope").count() == 0
    assert ss.search_page(idx, {}).count() == 0


def test_search_pages_are_slices_of_the_sorted_matches(spark):
    from tidewater.sources import search as ss

    idx = spark.createDataFrame([(f"d{i:03d}", "r1" if i % 2 else "r2", i % 3, i, "x" if i % 5 else "y")
                                 for i in range(250)], DOCS)
    match = sorted(r["doc_id"] for r in idx.where("v = 'x' and shop_id = 1").collect())
    for page in range(3):
        got = [r["_doc_id"] for r in ss.search_page(idx, {"v": "x", "shop_id": 1}, page=page, size=20).collect()]
        assert got == match[page * 20:(page + 1) * 20]
    routed = ss.search_page(idx, {"v": "x"}, page=0, size=1000, routing="r1")
    assert {r["routing"] for r in routed.collect()} == {"r1"}


def test_repeated_ids_in_a_batch_leave_one_document(spark):
    idx = spark.createDataFrame([("a", None, 1, 1, "x")], DOCS)
    twice = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("b", "u3"), ("b", "u3")], "doc_id string, v string")
    updated, missing = ks.update_documents(idx, twice)
    assert rows(updated, "doc_id", "v") == [("a", "u2")] and rows(missing, "doc_id", "v") == [("b", "u3")]
    both = spark.createDataFrame([("a", None, 1, 1, "n1"), ("a", None, 1, 1, "n2"), ("c", None, 1, 1, "n3")], DOCS)
    assert rows(ks.index_documents(idx, both), "doc_id", "v") == [("a", "n2"), ("c", "n3")]


def _one(spark, root, **more):
    return AppendedTable(spark, f"{root}/index", ["k"], f"{root}/epoch", **more)


def test_a_bucketed_log_opens_only_the_batchs_buckets(spark):
    """State reads name the batch's buckets in PartitionFilters."""
    t = _one(spark, fresh_path(spark, "bucket-test"), buckets=32)
    t.initialize(lambda: spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    for i in range(3):
        t.append(i, spark.range(i * 10, i * 10 + 5).select(F.col("id").alias("k"), F.lit(f"b{i}").alias("v")))
    batch = spark.createDataFrame([(11,), (399,), (1000,)], "k bigint")
    state = t.read((t.epoch, 2), only=batch)
    assert rows(state) == [(11, "b1"), (399, "old")]
    touched = t._buckets_of(batch)
    scans = [x for x in plan(state).split("PartitionFilters: [")[1:]]
    assert scans and all("bucket#" in s.split("]")[0] and str(touched[0]) in s.split("]")[0] for s in scans)


def test_the_number_of_buckets_is_stored(spark):
    root = fresh_path(spark, "bucket-count-test")
    _one(spark, root, buckets=4).initialize(lambda: spark.range(20).select(F.col("id").alias("k")))
    assert _one(spark, root).read().count() == 20 and _one(spark, root).buckets == 4
    with pytest.raises(ValueError, match="holds 4 buckets"):
        _one(spark, root, buckets=8).read()


def test_one_routing_value_reads_one_bucket(spark):
    t = AppendedTable(spark, f"{(root := fresh_path(spark, 'routed-log-test'))}/index", ["shop_id", "gorder_id"], f"{root}/epoch",
                      bucket_by=["shop_id"], buckets=16)
    t.initialize(lambda: spark.range(200).select((F.col("id") % 20).alias("shop_id"), F.col("id").alias("gorder_id")))
    t.append(0, spark.createDataFrame([(7, 7), (None, 3)], "shop_id bigint, gorder_id bigint"))
    one = t.read(routing={"shop_id": 7})
    assert {r.shop_id for r in one.collect()} == {7} and one.count() == 10
    assert all("bucket#" in s.split("]")[0] for s in plan(one).split("PartitionFilters: [")[1:])
    assert rows(t.read(routing={"shop_id": None}), "gorder_id") == [(3,)]


def test_cost_stays_flat_over_fifty_batches(spark):
    """Few segments and waiting batches, however many batches came; every
    state equals that of plain replacement by key."""
    t = _one(spark, fresh_path(spark, "flat-test"), buckets=2, merge_after=4)
    want = {i: "old" for i in range(200)}
    t.initialize(lambda: spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    shuffled, widest = spark.conf.get("spark.sql.shuffle.partitions"), 0
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for i in range(50):
            own = [(i * 7 + j * 3) % 260 for j in range(5)]
            t.append(i, spark.createDataFrame([(k, f"b{i}") for k in own], "k bigint, v string").coalesce(1))
            want |= {k: f"b{i}" for k in own}
            t.maintain()
            widest = max(widest, len(t.pending()) + len(t._manifest()[1]))
        assert widest <= 4 + 7 and len(t._names(f"{t.root}/segments")) <= 14
        assert rows(t.read()) == sorted(want.items(), key=repr)
        assert sum(len(t._names(f"{t.root}/log/epoch={e}")) for e in t._names(f"{t.root}/log")) <= 8
        t.merge(everything=True)
        assert len(t._manifest()[1]) == 1 and rows(t.read()) == sorted(want.items(), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)


def test_replay_after_a_merge_and_readers_of_the_old_form(spark):
    t = _one(spark, fresh_path(spark, "merge-replay-test"), buckets=2, merge_after=2)
    t.initialize(lambda: spark.createDataFrame([(1, "old"), (2, "old")], "k bigint, v string"))
    for i in range(3):
        t.append(i, spark.createDataFrame([(2 * (i == 2), f"b{i}")], "k bigint, v string"))
    before = t.read()
    state = rows(before)
    t.merge()
    assert t.pending() == [(t.epoch, 2)] and rows(t.read()) == state == rows(before)   # a running reader keeps its folders
    assert rows(t.read((t.epoch, 2))) == [(0, "b1"), (1, "old"), (2, "old")]   # a replay sees what the batch saw
    for i in (1, 2):                                     # replays of a merged batch and of the latest
        t.append(i, spark.createDataFrame([(2 * (i == 2), f"b{i}")], "k bigint, v string"))
        assert rows(t.read()) == state


def test_a_moved_order_leaves_its_old_checkout(spark):
    """K9 by group and by id within the routing, in every form of the table."""
    kinds = "doc_id string, shop_id bigint, gorder_id bigint, v string"
    base = spark.createDataFrame([("5", 1, 10, "old"), ("6", 1, 10, "old"), ("5", 2, 20, "other shop")], kinds)
    moved = spark.createDataFrame([("5", 1, 11, "moved")], kinds)
    gone = spark.createDataFrame([("9", 1, 11, "without 5")], kinds)
    assert rows(ks.replace_groups(base, moved), "doc_id", "gorder_id", "v") == [
        ("5", 11, "moved"), ("5", 20, "other shop"), ("6", 10, "old")]
    want = rows(ks.replace_groups(ks.replace_groups(base, moved), gone))
    assert ("5", 1, 10, "old") not in want and ("5", 1, 11, "moved") not in want
    for merge in ((), (1,), (0,), (0, 1)):
        root = fresh_path(spark, "moved-test")
        t = AppendedTable(spark, f"{root}/index", ["shop_id", "gorder_id"], f"{root}/epoch",
                          [["shop_id", "gorder_id"], ["shop_id", "doc_id"]], ["shop_id"], buckets=1)
        t.initialize(lambda: base)
        # a large oldest segment, so that merges leave it out
        live = t._manifest()[1]
        t._publish([(live[0].segment, 10**6)], (0, 0))
        for i, batch in enumerate((moved, gone)):
            t.append(i, batch)
            if i in merge:
                t.merge()
        assert rows(t.read()) == want, merge
        t.merge(everything=True)
        assert rows(t.read()) == want, merge


def test_repeated_orders_of_a_batch_act_row_by_row(spark):
    kinds = "order_type string, amount double, buy_account string, benefit_user_account int, sales_amount double, event_time bigint, gorder_id bigint, order_id bigint"
    target = spark.createDataFrame([("OLD", 0.0, None, None, 0.0, None, 1, 100, 2)], kinds + ", status int")
    row = lambda t, g, o, at: (t, 1.0, None, 3, 2.0, at, g, o)
    batch = spark.createDataFrame([row("a", 1, 100, 5), row("b", 1, 100, 6), row("c", 2, 100, 9),
                                   row("d", 7, 200, 4), row("e", 7, 200, 8), row("f", 8, 200, 6)], kinds)
    new, lost = kt.upsert_commission(target, batch, order=["event_time"])
    assert rows(new, "order_id", "gorder_id", "order_type", "status") == [(100, 1, "b", 2), (200, 7, "e", 1)]
    assert rows(lost, "order_id", "gorder_id", "order_type") == [(100, 2, "c"), (200, 8, "f")]


def test_the_last_update_of_a_document_wins(spark):
    idx = spark.createDataFrame([("a", None, 1, 1, "x")], DOCS)
    twice = spark.createDataFrame([("a", "z-first", 1), ("a", "a-last", 2), ("b", "u", 1)], "doc_id string, v string, at int")
    updated, missing = ks.update_documents(idx, twice, order=["at"])
    assert rows(updated, "doc_id", "v") == [("a", "a-last")] and updated.columns == idx.columns
    assert rows(missing, "doc_id") == [("b",)]


def test_last_of_repeated_equals_last_by_key(spark):
    from tidewater.operators.dedup import last_by_key, last_of_repeated
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 0), ("b", 1.0, 5), ("c", 3.0, 1), ("c", 3.0, 2)], "item_id string, unit_price double, n int")
    may = spark.createDataFrame([("a",), ("c",), ("c",), ("z",)], "item_id string")
    assert rows(last_of_repeated(df, may, "item_id", ["unit_price", "n"])) == rows(last_by_key(df, "item_id", ["unit_price", "n"]))
    assert rows(last_of_repeated(df, may, "item_id", ["unit_price", "n"])) == [("a", 2.0, 0), ("b", 1.0, 5), ("c", 3.0, 2)]


def test_a_stage_table_leaves_no_shuffle_files(spark):
    import time

    from tidewater.session import FREE_SHUFFLES, materialize

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    kept = materialize(spark.range(1000).repartition(3, "id"), "no-shuffle-left")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and kept.count() == 1000
    assert FREE_SHUFFLES not in spark.conf.getAll   # the session's own setting is back


def test_what_a_first_state_was_made_from_goes_once_it_is_written(spark):
    from tidewater.session import fresh_path, materialize
    from tidewater.sinks.appended import AppendedTable
    root, made = fresh_path(spark, "first-state-test"), []

    def state():
        rows = materialize(spark.range(100).selectExpr("id % 5 AS shop_id", "id AS doc_id"), "first-state")
        made.append(rows.inputFiles()[0].rsplit("/", 1)[0])
        return rows

    t = AppendedTable(spark, f"{root}/index", ["shop_id"], f"{root}/epoch", buckets=4)
    t.initialize(state)
    assert made and not t._finished(made[0]) and t.read().count() == 100
