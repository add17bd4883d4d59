"""Reference semantics on tiny hand-made tables, guards, checks, sinks."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bidscope.operators.checks import NoDataForDay, OrderNotDelivered, assert_day, assert_delivered, report_checks, validate
from bidscope.operators.daily import daily_kpi
from bidscope.operators.facts import app_key, app_names, day_requests, wide_fact
from bidscope.plans import basic, bidding, spend
from bidscope.plans.context import ReportContext
from bidscope.plans.report import build_report, run_report
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.app_mapping import load_app_mapping
from bidscope.sources.schema import SCHEMAS
from bidscope.sources.tables import FunnelSources, TableSource, conform, load_sources, load_table

DAY = dt.date(2024, 1, 2)
T = dt.datetime


def mk(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def tiny(spark, **over):
    """Two requests, three responses (one duplicated, one without request), wins, clicks, tracks."""
    req = [("r1", "1", T(2024, 1, 2, 3, 0), "app.a", 1.0, None, 30.0, 114.0, 4, None, None),
           ("r2", "1", T(2024, 1, 2, 5, 0), "", 2.0, None, None, 114.0, 5, None, None),
           ("r0", "1", T(2024, 1, 1, 5, 0), "app.a", 2.0, None, 30.0, 114.0, 10, None, None)]
    resp = [("r1", "s1", "1", T(2024, 1, 2, 3, 1), 150.0, 218, 195, " 1 ", "", "c", None),
            ("r1", "s1", "1", T(2024, 1, 2, 3, 1), 150.0, 218, 195, " 1 ", "", "c", None),   # duplicate
            ("r9", "s1", "1", T(2024, 1, 2, 7, 0), None, 219, 196, " 2 ", "lp", "", None),   # no request
            ("r0", "s1", "1", T(2024, 1, 1, 5, 1), 90.0, 218, 195, " 1 ", "", "c", None)]
    res = [("r1", "s1", T(2024, 1, 2, 3, 2), "1000"), ("r1", "s1", T(2024, 1, 2, 3, 3), ""),
           ("r9", "s1", T(2024, 1, 2, 7, 1), "n/a"), ("r0", "s1", T(2024, 1, 1, 5, 2), "500")]
    clk = [("r1", "s1", T(2024, 1, 2, 3, 4)), ("r0", "s1", T(2024, 1, 1, 23, 59))]
    url = '{"url":"https://lp/dragIndex/%s?rid=%s&pyck=%s&z=1"}'
    trk = [(T(2024, 1, 2, 3, 5), "pageExp", url % ("9", "r1", "s1"), None, None),
           (T(2024, 1, 2, 3, 6), "pageExp", url % ("10", "r1", "s1"), None, None),
           (T(2024, 1, 2, 3, 7), "jumpButton", url % ("10", "r1", "s1"), None, None),
           (T(2024, 1, 2, 0, 10), "pageExp", url % ("3", "r0", "s1"), None, None)]   # next day, click was day 1
    strat = [(195, "old", "o-a", 218, T(2024, 1, 1)), (195, "new", "o-b", 218, T(2024, 1, 2)),
             (195, "zzz", "o-c", 218, T(2023, 1, 1))]
    crea = [(1, "cr1", "co", "cs", "m1", "img")]
    amap = [("app.a", "App A", "1", "5", "2024"), ("app.a", "App A old", "0", "9", "2025")]
    tabs = dict(bid_request=mk(spark, "bid_request", req), bid_response=mk(spark, "bid_response", resp),
                bid_result=mk(spark, "bid_result", res), bid_click=mk(spark, "bid_click", clk),
                track_event=mk(spark, "track_event", trk), dim_strategy=mk(spark, "dim_strategy", strat),
                dim_creative=mk(spark, "dim_creative", crea), app_mapping=mk(spark, "app_mapping", amap))
    tabs.update(over)
    return FunnelSources(**tabs)


def test_wide_fanout_null_hour_and_names(spark):
    w = wide_fact(tiny(spark), FunnelRequest(DAY)).orderBy("response_id").collect()
    assert len(w) == 3                                   # duplicates kept (Q7)
    r1 = [r for r in w if r.response_id == "r1"]
    assert [r.win for r in r1] == [2, 2] and [r.click for r in r1] == [1, 1]   # fan-out of the pair
    assert r1[0].spend_yuan == pytest.approx(1000 / 100000)
    assert r1[0].page_id == "9" and r1[0].page_exp == 1 and r1[0].jump == 1    # string max of page ids
    assert r1[0].strategy_name == "new" and r1[0].app_name == "App A"         # latest dim, verified mapping
    r9 = [r for r in w if r.response_id == "r9"][0]
    assert r9.hour is None and r9.app_bundle == "(空)" and r9.geo_region == "地理缺失"   # Q2
    assert r9.strategy_name == "196" and r9.creative_name == " 2 "     # no dim rows: ids as text
    assert r9.win == 1 and r9.spend_yuan == 0.0                               # malformed wpr counts as 0


def test_daily_tracks_on_click_day(spark):
    k = {r.d: r for r in daily_kpi(tiny(spark), FunnelRequest(DAY), Rules(), "basic").collect()}
    assert k[DAY].page_exp == 1 and k[DAY].jumps == 1
    assert k[dt.date(2024, 1, 1)].page_exp == 1        # event on day 2, click on day 1 (Q6)
    assert k[DAY].wins == 3 and k[DAY].clicks == 1


def test_null_hour_kept_as_null_in_hour_tables(spark):
    ctx = ReportContext(tiny(spark), FunnelRequest(DAY, "spend"))
    hours = {r.hour: r for r in spend.spend_hour(ctx).collect()}
    assert None in hours and hours[None].invites == 0 and hours[None].bids == 1      # Q1 deviation
    assert hours[3].bids == 2 and hours[3].invites == 1


def test_order_requests_time_bound(spark):
    src = tiny(spark)
    ids = {r.request_id for r in day_requests(src, FunnelRequest(DAY, order_id=218)).collect()}
    assert ids == {"r1"}
    late = src.bid_response.withColumn("response_time", F.col("response_time") + F.expr("INTERVAL 1 DAY"))
    assert day_requests(src.replace(bid_response=late), FunnelRequest(DAY, order_id=218)).count() == 0


def test_guards(spark):
    src = tiny(spark)
    assert_delivered(src, FunnelRequest(DAY, order_id=218))
    with pytest.raises(OrderNotDelivered):
        assert_delivered(src, FunnelRequest(DAY, order_id=999))
    kpi = daily_kpi(src, FunnelRequest(dt.date(2024, 3, 1), "spend"), Rules(), "spend")
    with pytest.raises(NoDataForDay):
        assert_day(kpi, FunnelRequest(dt.date(2024, 3, 1), "spend"))


def test_gantt_uses_max_name_and_drops_null_ids(spark):
    g = basic.gantt_bids(ReportContext(tiny(spark), FunnelRequest(DAY))).collect()
    names = {r.strategy_id: r.ad_name for r in g}
    assert names[195] == "zzz"                            # AG14 string max, not the latest (Q12)
    assert {r.strategy_id: r.h03 for r in g}[195] == 2


def test_blank_apps_are_spread(spark):
    """Responses of the blank app have many join keys; its name and those of others stay."""
    apps = ["", None, "app.a"]
    req = [(f"r{i}", "1", T(2024, 1, 2, 3, 0), apps[i % 3], 1.0, None, 30.0, 114.0, 4, None, None) for i in range(300)]
    resp = [(f"r{i}", "s1", "1", T(2024, 1, 2, 3, 1), 150.0, 218, 195, "1", "", "c", None) for i in range(330)]   # 30 without a request
    for amap, blank in (([("(空)", "Blank", "1", "5", "2024"), ("(空)", "Old", "0", "9", "2025"), ("app.a", "App A", "1", "5", "2024")], "Blank"),
                        ([("app.a", "App A", "1", "5", "2024"), ("app.a", "Old", "0", "5", "2024")], "(空)")):
        src = tiny(spark, bid_request=mk(spark, "bid_request", req), bid_response=mk(spark, "bid_response", resp), app_mapping=mk(spark, "app_mapping", amap))
        got = {(r.app_bundle, r.app_name): r["count"] for r in wide_fact(src, FunnelRequest(DAY)).groupBy("app_bundle", "app_name").count().collect()}
        assert got == {("(空)", blank): 230, ("app.a", "App A"): 100}
    keys = src.bid_request.select(app_key("app_bundle", "request_id").alias("k")).groupBy("k").count().collect()
    assert sorted(k["count"] for k in keys) == [1] * 200 + [100]
    # the fact is not dealt by its app, so a group-by on it has a shuffle of its own and hot apps can be split
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = wide_fact(src, FunnelRequest(DAY))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "xxhash64(response_id" in plan


def test_app_mapping_csv(spark, tmp_path):
    assert load_app_mapping(spark, str(tmp_path / "missing.csv")).count() == 0
    bad = tmp_path / "bad.csv"
    bad.write_text("pkg,name\na,b\n", encoding="utf-8")
    assert load_app_mapping(spark, str(bad)).count() == 0
    good = tmp_path / "good.csv"
    good.write_text("﻿app_package_name,app_name,is_verified,request_count,etl_time\n"
                    "app.a, A1 ,0,100,2024-01-01\napp.a,A2,1,1,2023-01-01\napp.b,,1,1,x\n", encoding="utf-8")
    m = {r.app_package_name: r.app_name for r in app_names(load_app_mapping(spark, str(good))).collect()}
    assert m == {"app.a": "A2"}
    only_two = tmp_path / "two.csv"
    only_two.write_text("app_package_name,app_name\napp.c,C\n", encoding="utf-8")
    assert app_names(load_app_mapping(spark, str(only_two))).count() == 1


def test_report_build_checks_and_write(spark, src_small, tmp_path):
    from bidscope.sources.fixture import TEST_DAY
    req = FunnelRequest(TEST_DAY, "bidding")
    tables = build_report(src_small, req, scratch=str(tmp_path / "scratch"))
    res = validate(report_checks(tables, "bidding"))
    assert res.ok, res.errors
    assert any(c["check"] == "apps_outside_top" for c in res.checks)
    path, res2 = run_report(src_small, FunnelRequest(TEST_DAY, "basic", 218), str(tmp_path))
    assert res2.ok and path.endswith("analysis=basic/day=2024-01-02/order=218")
    manifest = sorted((json.loads(line) for p in Path(path, "_manifest").glob("*.json")
                       for line in p.read_text().splitlines()), key=lambda r: r["seq"])
    assert manifest[0]["table"] == "basic_kpi"
    assert spark.read.parquet(f"{path}/basic_kpi").count() == 1


def test_parquet_source_pushes_day_filter(spark, src_small, tmp_path):
    from bidscope.sources.tables import day_window
    root = tmp_path / "tables"
    src_small.bid_response.write.parquet(str(root / "bid_response"))
    df = day_window(load_table(spark, "bid_response", TableSource("parquet", str(root))), "response_time", DAY, 1)
    plan = df.select("response_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(response_time), GreaterThanOrEqual(response_time" in plan
    assert "ReadSchema: struct<response_id:string,response_time:timestamp_ntz>" in plan


def test_sources_from_parquet_match_fixture(spark, src_small, tmp_path):
    root = tmp_path / "all"
    for name in ("bid_request", "bid_response", "bid_result", "bid_click", "track_event", "dim_strategy",
                 "dim_creative", "app_mapping"):
        getattr(src_small, name).write.parquet(str(root / name))
    src = load_sources(spark, TableSource("parquet", str(root)))
    a = basic.basic_kpi(ReportContext(src, FunnelRequest(DAY))).collect()
    b = basic.basic_kpi(ReportContext(src_small, FunnelRequest(DAY))).collect()
    assert a == b


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("pkg", 7)], "app_package_name string, app_name int")
    out = conform(df, "app_mapping")
    assert out.schema == SCHEMAS["app_mapping"] and out.first().app_name == "7" and out.first().is_verified is None
    with pytest.raises(ValueError, match="order_id"):
        conform(spark.createDataFrame([("1", "x")], "strategy_id string, strategy_name string"), "dim_strategy")


def test_request_defaults():
    r = FunnelRequest("2026-07-25", "bidding")
    assert r.prev_day == dt.date(2026, 7, 24) and r.order_id is None
    with pytest.raises(ValueError):
        FunnelRequest("2026-07-25", "other")


def test_shared_fact_reports_equal_separate(spark, src_small):
    from bidscope.plans.report import build_reports
    from bidscope.sources.fixture import TEST_DAY
    shared = build_reports(src_small, FunnelRequest(TEST_DAY, order_id=218))
    for a in ("basic", "spend", "bidding"):
        sep = build_report(src_small, FunnelRequest(TEST_DAY, a, 218), materialize=False)
        assert list(shared[a]) == list(sep)
        for name in ("app_hour", "spend_app", "bid_kpi", "basic_kpi", "spend_kpi", "gantt_spend", "hourly",
                     "order_fit", "strategy_fit", "creative_fit", "spend_by_order", "spend_by_strategy",
                     "spend_order_strategy_creative", "bid_order_strategy_creative", "app_funnel",
                     "spend_hour", "spend_region", "spend_ad_slot", "bid_app", "bid_hour"):
            if name in sep:
                assert sorted(map(tuple, shared[a][name].collect()), key=str) == \
                    sorted(map(tuple, sep[name].collect()), key=str), (a, name)


def test_day_partitioned_tables_prune_partitions(spark, src_small, tmp_path):
    from bidscope.sources.tables import day_window, write_event_table
    root = tmp_path / "parted"
    write_event_table(src_small.bid_response, str(root / "bid_response"), "response_time")
    df = day_window(load_table(spark, "bid_response", TableSource("parquet", str(root), day_column="dt")), "response_time", DAY, 1)
    plan = df.select("response_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(response_time)" in plan
    assert df.count() == day_window(src_small.bid_response, "response_time", DAY, 1).count()


def test_labelled_output_moves_spend_last(spark, src_small, tmp_path):
    from bidscope.sources.fixture import TEST_DAY
    from bidscope.sources.sinks import labelled, write_report
    ctx = ReportContext(src_small, FunnelRequest(TEST_DAY))
    out = labelled(basic.hourly(ctx), "basic")
    assert out.columns[-1] == "花销(元)" and out.columns[0] == "hour" and "出价→竞得" in out.columns
    assert labelled(spend.spend_kpi(ReportContext(src_small, FunnelRequest(TEST_DAY, "spend"))), "spend").columns[7] == "花费(元)"
    path = write_report({"hourly": basic.hourly(ctx)}, str(tmp_path), FunnelRequest(TEST_DAY), fmt="csv", labels=True)
    assert spark.read.option("header", True).csv(f"{path}/hourly").count() == 24


def test_blank_request_ids_join_like_any_other(spark):
    src = tiny(spark)
    blank_q = mk(spark, "bid_request", [("", "1", T(2024, 1, 2, 1, 0), "app.a", 1.0, None, 30.0, 114.0, 4, None, None)] * 3)
    blank_r = mk(spark, "bid_response", [("", "s1", "1", T(2024, 1, 2, 1, 1), 10.0, 218, 195, " 1 ", "", "c", None)] * 4)
    s2 = src.replace(bid_request=src.bid_request.unionByName(blank_q), bid_response=src.bid_response.unionByName(blank_r))
    w = wide_fact(s2, FunnelRequest(DAY))
    assert w.filter(F.col("response_id") == "").count() == 12


def test_sources_do_not_lose_data(spark, src_small, tmp_path):
    from bidscope.sources.app_mapping import load_app_mapping
    from bidscope.sources.tables import TableSource, conform, day_window, jdbc_options, load_table
    late = src_small.bid_response.filter(F.to_date("response_time") == F.lit(DAY)).withColumn("dt", F.date_add(F.to_date("response_time"), 1))
    late.write.parquet(f"{tmp_path}/bid_response")
    n = late.count()
    plain = load_table(spark, "bid_response", TableSource("parquet", str(tmp_path)))
    assert day_window(plain, "response_time", DAY, 1).count() == n, "a column called dt means nothing by itself"
    pruned = load_table(spark, "bid_response", TableSource("parquet", str(tmp_path), day_column="dt", lateness_days=1))
    assert day_window(pruned, "response_time", DAY, 1).count() == n
    with pytest.raises(ValueError, match="wpr"):
        conform(src_small.bid_result.drop("wpr"), "bid_result")
    assert conform(src_small.bid_request.drop("geo_city"), "bid_request").columns == src_small.bid_request.columns
    assert load_app_mapping(spark, f"{tmp_path}/none.csv").count() == 0
    from py4j.protocol import Py4JJavaError
    with pytest.raises(Py4JJavaError, match="nosuchscheme"):
        load_app_mapping(spark, "nosuchscheme://host/mapping.csv")
    source = TableSource("jdbc", "jdbc:mysql://h/db", jdbc_partitions=8)
    with pytest.raises(ValueError, match="window"):
        jdbc_options("bid_click", source, None)
    got = jdbc_options("bid_click", source, (DAY, 2))
    assert (got["partitionColumn"], got["numPartitions"], got["dbtable"]) == ("response_time", "8", "bid_click")
    assert "partitionColumn" not in jdbc_options("dim_strategy", source, None)


def test_a_day_is_written_by_many_tasks(spark, src_small, tmp_path):
    from bidscope.sources.tables import write_event_table
    rows = src_small.bid_response
    big = rows.unionByName(rows).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_event_table(big, f"{tmp_path}/t", "response_time")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "t" / f"dt={DAY}").glob("*.parquet"))) > 1


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from bidscope.session import ensure_checkpoint_dir
    session = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
                              conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_report_checks_read_what_was_written(spark, src_small, tmp_path):
    from bidscope.plans.report import run_report
    path, result = run_report(src_small, FunnelRequest(DAY, "bidding"), str(tmp_path))
    assert result.ok and spark.read.parquet(f"{path}/bid_app").count() > 0
    assert not list(tmp_path.glob("_scratch/bidscope-tables/*")), "intermediate tables are deleted"


def test_unscoped_shared_reports_equal_separate(spark, src_small):
    from bidscope.plans.report import build_reports
    from bidscope.sources.fixture import TEST_DAY
    shared = build_reports(src_small, FunnelRequest(TEST_DAY))
    for a, names in (("basic", ("app_funnel", "hourly", "order_fit", "app_hour", "app_order", "hour_order")),
                     ("spend", ("spend_region", "spend_ad_slot", "spend_app", "spend_target_group",
                                "spend_ad_slot_strategy", "spend_hour")),
                     ("bidding", ("bid_app", "bid_hour", "x_app_hour", "bid_price_bucket", "x_hour_order",
                                  "x_hour_bucket", "x_order_bucket", "bid_order_strategy_creative"))):
        ctx = ReportContext(src_small, FunnelRequest(TEST_DAY, a))
        mod = {"basic": basic, "spend": spend, "bidding": bidding}[a]
        for n in names:
            assert sorted(map(tuple, shared[a][n].drop(*[c for c in shared[a][n].columns if c.startswith("flag_")]).collect()), key=str) == \
                sorted(map(tuple, mod.TABLES[n](ctx).collect()), key=str), (a, n)
