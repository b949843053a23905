"""Property tests: equivalent plans agree on random inputs."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tidewater.functions import keys as fkeys
from tidewater.operators import dedup, merge
from tidewater.operators.ranking import position_in_group

SMALL = settings(max_examples=8, deadline=None)
key = st.one_of(st.none(), st.integers(0, 4))
text = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@SMALL
@given(st.lists(st.tuples(key, text), max_size=12), st.lists(st.tuples(key, text, text), max_size=12))
def test_split_lookup_equals_left_join(spark, inc, lk):
    i = spark.createDataFrame(inc, "k int, a string")
    l = spark.createDataFrame(lk, "k int, a string, b string")
    plain = merge.lookup_join(i, l, "k")
    split = merge.lookup_join(i, l, "k", stream_lookup=True)
    assert rows(split) == rows(plain)
    # model: left join, incoming wins on a
    model = []
    for k, a in inc:
        hits = [r for r in lk if k is not None and r[0] == k]
        model += [(k, a if a is not None else la, lb) for _, la, lb in hits] or [(k, a, None)]
    assert rows(plain) == sorted(model, key=repr)


@SMALL
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=30, unique_by=lambda t: t[1]))
def test_last_by_key_matches_model(spark, data):
    df = spark.createDataFrame([(k, s, s * 10) for k, s in data], "k int, seq int, v int")
    got = rows(dedup.last_by_key(df, "k", ["seq"]))
    model = {}
    for k, s in data:
        if k not in model or s > model[k]:
            model[k] = s
    assert got == sorted((k, s, s * 10) for k, s in model.items())


@SMALL
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200)), min_size=1, max_size=60,
                unique_by=lambda t: t))
def test_skew_safe_positions_equal_window(spark, data):
    df = spark.createDataFrame(data, "g int, o int")
    a = position_in_group(df, "g", ["o"], "p", partitions=3)
    b = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert rows(a, "g", "o", "p") == rows(b, "g", "o", "p")


ident = st.text(alphabet="abcdefgh_", min_size=1, max_size=6)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(ident, st.one_of(st.none(), st.text(alphabet="xyz019", min_size=1, max_size=4))),
                min_size=1, max_size=6, unique_by=lambda t: t[0]))
def test_column_spec_round_trip(pairs):
    spec = " , ".join(n if d is None else f"{n}:{d}" for n, d in pairs)
    assert fkeys.parse_column_defaults(spec) == dict(pairs)
    assert fkeys.parse_column_list(" , ".join(n for n, _ in pairs)) == [n for n, _ in pairs]


DAY = 86_400_000


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 60), st.integers(1, 10), st.lists(st.integers(0, 80 * DAY), max_size=20))
def test_day_ranges_select_exactly_the_window(start_day, n_days, offsets):
    base = 1_704_067_200_000                     # 2024-01-01
    start, stop = base + start_day * DAY, base + (start_day + n_days) * DAY
    ranges = fkeys.day_prefixes(start, stop)
    for off in offsets:
        ts = base + off
        day = ts - ts % DAY
        key = f"{fkeys.salted_prefix(day)}{ts % 997}"
        inside = any(lo <= key < hi for lo, hi in ranges)
        assert inside == (start <= day < stop)
