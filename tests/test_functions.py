import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import dates, keys


def test_column_list_parsing_matches_reference_sample():
    spec = ("order_type:1, commission_amount, buy_account:x , gorder_benefit_user, "
            "pay_amount:100, pay_success_time: , gorder_id, order_id")
    assert keys.parse_column_list("order_type, commission_amount, , gorder_id ") == [
        "order_type", "commission_amount", "gorder_id"]
    d = keys.parse_column_defaults(spec)
    assert d["order_type"] == "1"
    assert d["buy_account"] == "x"
    assert d["pay_amount"] == "100"
    assert d["pay_success_time"] is None
    assert d["gorder_benefit_user"] is None
    assert list(d) == ["order_type", "commission_amount", "buy_account", "gorder_benefit_user",
                       "pay_amount", "pay_success_time", "gorder_id", "order_id"]
    assert keys.parse_column_list("  ") == []


def test_salted_row_key_and_day_ranges(spark):
    ts = dt.datetime(2024, 1, 5, 13, 30)
    df = spark.createDataFrame([(ts, 42)], "ts timestamp_ntz, id bigint")
    day_ms = 1704412800000
    salt = (day_ms // 100000) % 10
    got = df.select(keys.salted_row_key("ts", "id").alias("k")).first()["k"]
    assert got == f"{salt}{day_ms}42"
    ranges = keys.day_prefixes(day_ms, day_ms + 2 * 86_400_000)
    assert len(ranges) == 2
    lo, hi = ranges[0]
    assert lo <= got < hi


def test_dates(spark):
    ts = dt.datetime(2024, 1, 31, 23, 59, 58, 999999)
    df = spark.createDataFrame([(ts, "2024-01-02 03:04:05", "junk")], "ts timestamp_ntz, s string, bad string")
    r = df.select(
        dates.epoch_millis(dates.add_days("ts", 1)).alias("plus"),
        dates.epoch_millis(dates.add_days("ts", -31)).alias("minus"),
        dates.format_date("ts").alias("f"),
        dates.format_date(F.lit(None).cast("timestamp"), dates.DAY_FORMAT).alias("fnull"),
        dates.epoch_millis(dates.parse_date("s")).alias("parsed"),
        dates.parse_date("bad").alias("badparsed"),
        dates.day_start_millis("ts").alias("day"),
    ).first()
    base = int(dt.datetime(2024, 1, 31, 23, 59, 58, 999000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert r["plus"] == base + 86_400_000
    assert r["minus"] == base - 31 * 86_400_000
    assert r["f"] == "2024-01-31 23:59:58"
    assert r["fnull"] is None
    assert r["parsed"] == int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert r["badparsed"] is None
    assert r["day"] == int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_strict_parse_raises(spark):
    import pytest
    df = spark.createDataFrame([("not a date",)], "s string")
    with pytest.raises(Exception):
        df.select(dates.parse_date("s", strict=True)).collect()


def test_lenient_parse_rolls_over(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-13-01 24:00:61",), ("2024-01-05 10:20:30",),
                                ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(dates.format_date(dates.parse_date_lenient("s"))).collect()]
    assert got == ["2024-03-01 00:00:00", "2025-01-02 00:01:01", "2024-01-05 10:20:30", None, None]


def test_lenient_parsing_extracts_a_required_field_once(spark):
    df = spark.createDataFrame([("3/-2/2024",), ("03/00/2024 x",), ("no",), ("1/2/12345678901",), (None,)], "t string")
    out = df.select(dates.epoch_millis(dates.parse_date_lenient("t", "dd/MM/yyyy")).alias("ms"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 3
    day = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert [r.ms for r in out.collect()] == [day(2023, 10, 3), day(2023, 12, 3), None, None, None]
    shared = df.sparkSession.createDataFrame([("2024-125",)], "t string").select(dates.parse_date_lenient("t", "yyyy-MM'5'").cast("string"))
    assert shared.first()[0] == "2024-12-01 00:00:00"
