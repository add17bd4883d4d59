"""Column builders on small hand-made frames (SC1-SC28 edge cases)."""

import datetime as dt

from pyspark.sql import functions as F

from bidscope.functions import exprs as X


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_blank_to(spark):
    assert one(spark, [("",), (None,), ("a",)], "c string", X.app_label("c")) == ["(空)", "(空)", "a"]


def test_geo_region_box_edges(spark):
    rows = [(29.8, 113.6), (31.6, 115.2), (29.79, 114.0), (None, 114.0), (30.0, None), (31.61, 115.0)]
    got = one(spark, rows, "lat double, lon double", X.geo_region("lat", "lon"))
    assert got == ["武汉", "武汉", "非武汉", "地理缺失", "地理缺失", "非武汉"]


def test_ad_slot_labels(spark):
    got = one(spark, [("4",), ("5",), ("10",), ("7",), (None,), ("abc",), ("4.0",)], "c string", X.ad_slot("c"))
    assert got == ["4-插屏", "5-开屏", "10-信息流", "7-其他", "未知", "未知", "4-插屏"]
    assert one(spark, [(4,), (None,)], "c int", X.ad_slot("c")) == ["4-插屏", "未知"]


def test_price_bucket_upper_bounds_inclusive(spark):
    rows = [(None,), (100.0,), (100.01,), (500.0,), (1000.0,), (1500.0,), (2000.0,), (2000.5,), (0.0,)]
    got = one(spark, rows, "p double", X.price_bucket("p"))
    assert got == ["未知", "100", "100-500", "100-500", "500-1000", "1000-1500", "1500-2000", "2000+", "100"]


def test_target_group(spark):
    got = one(spark, [(195,), (196,), (None,)], "s bigint", X.target_group("s"))
    assert got == ["武汉定向", "全国定向", "全国定向"]


def test_safe_ratio_zero_and_null(spark):
    got = one(spark, [(1, 0), (None, 2), (1, None), (3, 4)], "n bigint, d bigint", X.safe_ratio("n", "d"))
    assert got == [0.0, 0.0, 0.0, 0.75]


def test_wpr_value_blank_and_malformed(spark):
    got = one(spark, [("",), ("n/a",), (None,), ("12.5",)], "w string", X.wpr_value("w"))
    assert got == [0.0, 0.0, 0.0, 12.5]


def test_track_key_reference_pattern_keeps_closing_quote(spark):
    attrs = '{"url":"https://x/dragIndex/9?rid=r1&pyck=s1"}'
    rows = [(attrs, "root", "parent"), ('{"url":"https://x/"}', "root", "parent")]
    df = spark.createDataFrame(rows, "a string, root string, parent string")
    got = df.select(X.track_key("a", r"[?&]pyck=([^&]+)", "parent"),
                    X.track_key("a", r"[?&]rid=([^&]+)", "root"), X.page_id("a")).collect()
    assert tuple(got[0]) == ('s1"}', "r1", "9")       # Q3: last parameter captures the quote
    assert tuple(got[1]) == ("parent", "root", "")
    strict = df.select(X.track_key("a", r'[?&]pyck=([^&"#]+)', "parent")).first()[0]
    assert strict == "s1"


def test_direct_jump(spark):
    rows = [("", "c", 0), (None, "c", 0), ("lp", "c", 0), ("", "", 0), ("", "c", 1)]
    got = one(spark, rows, "lp string, curl string, pe int", X.direct_jump("lp", "curl", "pe"))
    assert got == [1, 1, 0, 0, 0]


def test_delta_text(spark):
    rows = [(110.0, 100.0), (90.0, 100.0), (5.0, 0.0), (0.0, None)]
    got = one(spark, rows, "c double, p double", X.delta_text("c", "p"))
    assert got == ["+10.00%", "-10.00%", "前日为0", "前日为0"]


def test_label_chain_and_osc(spark):
    df = spark.createDataFrame([(None, "b", 7), (None, None, 7)], "a string, b string, i bigint")
    assert [r[0] for r in df.select(X.label_chain("a", "b", "i")).collect()] == ["b", "7"]
    df2 = spark.createDataFrame([("o", None, "c")], "o string, s string, c string")
    assert df2.select(X.order_strategy_creative("o", "s", "c")).first()[0] == "o /  / c"


def test_hours_seen_counts_distinct_hours(spark):
    df = spark.createDataFrame([(1, 0), (1, 23), (1, 23), (1, None), (2, None), (3, 5)], "k int, h int")
    got = dict(map(tuple, df.groupBy("k").agg(X.hours_seen("h")).collect()))
    assert got == {1: 2, 2: 0, 3: 1}


def test_day_window_literal_type(spark):
    from bidscope.sources.tables import day_window
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 23:59:59' t UNION ALL SELECT TIMESTAMP_NTZ '2024-01-03 00:00:00'")
    assert day_window(df, "t", dt.date(2024, 1, 2), 1).count() == 1
    assert day_window(df, "t", dt.date(2024, 1, 2), 2).count() == 2
