
from conftest import rows
from tidewater.operators import merge


def test_incoming_wins_and_null_falls_back(spark):
    inc = spark.createDataFrame([(1, "in-a", None), (2, None, "in-b"), (3, "x", "y")],
                                "k int, a string, b string")
    lk = spark.createDataFrame([(1, "lk-a", "lk-b", 10), (2, "lk-a2", "lk-b2", 20)],
                               "k int, a string, b string, extra int")
    for stream in (False, True):
        out = merge.lookup_join(inc, lk, "k", stream_lookup=stream)
        assert out.columns == ["k", "a", "b", "extra"]
        assert rows(out) == [(1, "in-a", "lk-b", 10), (2, "lk-a2", "in-b", 20), (3, "x", "y", None)]


def test_fanout_and_renamed_key(spark):
    inc = spark.createDataFrame([(1, "p"), (2, "q")], "gid int, tag string")
    lk = spark.createDataFrame([(1, 100), (1, 101), (9, 900)], "g int, order_id int")
    for stream in (False, True):
        out = merge.lookup_join(inc, lk, {"gid": "g"}, stream_lookup=stream)
        assert rows(out) == [(1, "p", 100), (1, "p", 101), (2, "q", None)]


def test_guard_blank_key_passes_row_unchanged(spark):
    inc = spark.createDataFrame([("1",), (" ",), (None,), ("",)], "k string")
    lk = spark.createDataFrame([("1", "one"), (" ", "blank"), ("", "empty")], "k string, v string")
    for stream in (False, True):
        out = merge.lookup_join(inc, lk, "k", guard_blank=True, stream_lookup=stream)
        assert rows(out) == sorted([("1", "one"), (" ", None), (None, None), ("", None)], key=repr)


def test_null_key_matches_nothing(spark):
    inc = spark.createDataFrame([(None, "a")], "k int, v string")
    lk = spark.createDataFrame([(None, "z")], "k int, w string")
    assert rows(merge.lookup_join(inc, lk, "k")) == [(None, "a", None)]


def test_chain_uses_previous_output_key(spark):
    keys = spark.createDataFrame([(1,)], "g int")
    orders = spark.createDataFrame([(1, 10), (1, 11)], "g int, o int")
    items = spark.createDataFrame([(10, "i1"), (10, "i2")], "o int, item string")
    out = merge.lookup_chain(keys, [(orders, "g", None), (items, "o", {"stream_lookup": True})])
    assert rows(out) == [(1, 10, "i1"), (1, 10, "i2"), (1, 11, None)]


def test_strict_lookup_splits_missing(spark):
    keys = spark.createDataFrame([(1,), (2,)], "g int")
    lk = spark.createDataFrame([(1, "s")], "g int, shop string")
    found, missing = merge.strict_lookup(keys, lk, "g")
    assert rows(found) == [(1, "s")]
    assert rows(missing) == [(2,)]


def test_overlay_non_null(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, bal double")
    src = spark.createDataFrame([(1, None, 5.0), (3, "z", 9.0)], "k int, name string, bal double")
    assert rows(merge.overlay_non_null(src, tgt, "k")) == [(1, "a", 5.0), (2, "b", 2.0)]


def test_flatten_json_later_wins(spark):
    df = spark.createDataFrame([(1, 7, '{"k": 3, "v": 8}')], "id int, k int, props string")
    out = merge.flatten_json(df, "props", "k INT, v INT")
    assert sorted(out.columns) == ["id", "k", "v"]
    assert rows(out, "id", "k", "v") == [(1, 3, 8)]


def test_commission_batch_dead_letters_checkout_without_orders(spark):
    from tidewater.plans.jobs import commission_batch

    claimed = spark.createDataFrame([(1,), (2,), (1,)], "gorder_id bigint")
    gorders = spark.createDataFrame([(1, "acct", 5), (2, "b2", 6)], "gorder_id bigint, buy_account string, benefit_user int")
    orders = spark.createDataFrame([(1, 10, "HIGH", 3.0, 4.0, 100)],
                                   "gorder_id bigint, order_id bigint, order_type string, commission_amount double, "
                                   "pay_amount double, pay_success_time bigint")
    batch, dead = commission_batch(claimed, gorders, orders)
    assert rows(batch) == [("HIGH", 3.0, None, 5, 4.0, 100, 1, 10)]
    assert rows(dead) == [(2, "no order")]


def test_exists_split_and_empty_groups(spark):
    from tidewater.operators.projection import non_empty_groups, project_defaults

    inc = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    tgt = spark.createDataFrame([(1,), (1,), (5,)], "k int")
    old, new = merge.exists_split(inc, tgt, "k")
    assert rows(old) == [(1, "a")]
    assert rows(new) == sorted([(2, "b"), (None, "c")], key=repr)
    nested = spark.createDataFrame([(1, [1, 2]), (2, [])], "g int, orders array<int>")
    assert rows(non_empty_groups(nested, "orders"), "g") == [(1,)]
    typed = project_defaults(spark.createDataFrame([(None, None)], "n int, s string"), "n:7, s:x, u")
    assert typed.dtypes == [("n", "int"), ("s", "string"), ("u", "string")]
    assert rows(typed) == [(7, "x", None)]


def test_staged_lookups_equal_unstaged(spark):
    inc = spark.createDataFrame([("1", "a"), (" ", "b"), (None, "c"), ("2", None), ("9", "z")], "k string, v string")
    lk = spark.createDataFrame([("1", "x", 1), ("1", "y", 2), (" ", "blank", 3), ("2", "w", 4), ("7", "u", 5)],
                               "k string, v string, n int")
    for guard in (False, True):
        plain = merge.lookup_join(inc, lk, "k", guard_blank=guard)
        staged = merge.lookup_join(inc, lk, "k", guard_blank=guard, stream_lookup=True, stage=True)
        assert rows(staged) == rows(plain)
    f1, m1 = merge.strict_lookup(inc, lk, "k")
    f2, m2 = merge.strict_lookup(inc, lk, "k", stage=True)
    assert rows(f1) == rows(f2) and rows(m1) == rows(m2)
    assert rows(m2, "k") == sorted([(None,), ("9",)], key=repr)
