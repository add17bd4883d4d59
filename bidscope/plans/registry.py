"""Named queries over a sources directory: every report table and operator-level view."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.functions.exprs import ad_slot, geo_region, price_bucket, target_group
from bidscope.operators.checks import report_checks, with_flags
from bidscope.operators.cube import Levels, fact_cube, measure
from bidscope.operators.facts import (
    app_names, click_pairs, clicks_by_key, day_requests, latest_strategy, track_keys, tracks_by_key, wide_fact,
    wins_by_key,
)
from bidscope.operators.metrics import top_apps
from bidscope.plans import basic, bidding, spend
from bidscope.plans.context import ReportContext, scratch_table_root
from bidscope.plans.report import build_report, run_report
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.fixture import TEST_DAY, TEST_ORDER, fixture_sources
from bidscope.sources.rejects import reject_ledger
from bidscope.sources.sinks import read_report
from bidscope.sources.store import EventStore, buckets_for, load_event_store, write_event_store
from bidscope.sources.tables import day_window

Query = Callable[[SparkSession, str], DataFrame]


def _ctx(spark: SparkSession, sf_dir: str, analysis: str, order: int | None = None) -> ReportContext:
    return ReportContext(fixture_sources(spark, sf_dir), FunnelRequest(TEST_DAY, analysis, order), Rules())


def _table(analysis: str, fn, order: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_ctx(spark, sf_dir, analysis, order))
    run.__doc__ = fn.__doc__
    return run


def _op(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_ctx(spark, sf_dir, "basic"))
    run.__doc__ = fn.__doc__
    return run


def _wide_order(ctx):
    return ReportContext(ctx.src, ctx.req.with_order(TEST_ORDER), ctx.rules).wide


def _apps_outside(ctx):
    """JN14: apps of the day's fact outside the bidding app table, with their bids."""
    c = ReportContext(ctx.src, ctx.req.with_analysis("bidding"), ctx.rules)
    bids = c.wide.groupBy("app_bundle").agg(F.count(F.lit(1)).alias("bids"))
    return bids.join(bidding.bid_app(c).select("app_bundle"), "app_bundle", "left_anti")


def _flagged(analysis, fn):
    """SC26: attention flags on one table of an analysis."""
    def run(ctx):
        c = ReportContext(ctx.src, ctx.req.with_analysis(analysis), ctx.rules)
        return with_flags(fn(c), analysis, c.total("spend_yuan"), ctx.rules)
    return run


def _unclicked(ctx):
    return replace(ctx.rules, landing_page_requires_click=False)


def _broken_checks(ctx):
    """CK1-CK4 on a bidding report with a missing table, an empty one, one app too many and foreign apps."""
    c = ReportContext(ctx.src, ctx.req.with_analysis("bidding"), ctx.rules)
    apps = c.wide.groupBy("app_bundle").agg(F.count(F.lit(1)).alias("bids"))
    tables = {
        "bid_app": apps.orderBy(F.col("bids").desc(), "app_bundle").limit(ctx.rules.bid_app_rows + 1),
        "bid_hour": c.wide.filter(F.lit(False)).select("hour"),
        "x_app_hour": c.wide.select("app_bundle", "hour"),
        "bid_compare": c.wide.filter(F.lit(False)).select("hour"),
    }
    return report_checks(tables, "bidding", ctx.rules)


def _store(ctx):
    """The event tables stored by response id; an id is hot here from 7 rows, so that both parts have rows."""
    spark = ctx.src.bid_response.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")     # what joins of buckets need (sources/store.py)
    root = scratch_table_root(spark)
    store = EventStore("default", root, buckets=buckets_for(ctx.src, 8), hot_rows=6, prefix=f"store_{root.rsplit('/', 1)[-1]}_")
    write_event_store(ctx.src, store)
    return load_event_store(spark, store, ctx.src)


def _stored_order_kpi(ctx):
    """D1 with the order scope (JN7) on tables stored by response id."""
    return bidding.bid_kpi(ReportContext(_store(ctx), ctx.req.with_order(TEST_ORDER).with_analysis("bidding"), ctx.rules))


def _published_report(ctx):
    """SNK1, SNK2, CK5: the bidding report staged, checked and published; its app table as readers find it."""
    spark, req = ctx.src.bid_response.sparkSession, ctx.req.with_analysis("bidding")
    root = scratch_table_root(spark)
    run_report(ctx.src, req, root, ctx.rules)
    return read_report(spark, root, req)["bid_app"]


def _fact_cube(ctx):
    """AG20: three levels of the fact's cube from one grouping-sets pass."""
    levels = Levels([["order_id"], ["hour"], ["ad_slot", "price_bucket"]])
    names = ("bids", "wins", "spend_yuan", "avg_bid_price", "active_hours", "start_time", "last_time")
    return levels.aggregate(fact_cube(ctx.wide, ctx.rules)).select("level", *levels.keys, *[measure(m, ctx.rules) for m in names])


def _reject_ledger(ctx):
    """SRC1, SC6: the ledger of responses stored as text, some of them broken, and of the wins' prices."""
    broken = ctx.src.bid_response.withColumns({
        "order_id": F.when(F.col("strategy_id") % 10 == 3, F.concat(F.lit("o-"), F.col("order_id"))).otherwise(F.col("order_id").cast("string")),
        "response_time": F.when((F.col("strategy_id") % 25 == 4) & F.col("response_time").isNotNull(), F.lit("soon"))
                          .otherwise(F.col("response_time").cast("string"))})
    return reject_ledger({"bid_request": ctx.src.bid_request, "bid_response": broken, "bid_result": ctx.src.bid_result}, (ctx.req.day, 1))


OPS = {
    "wide_fact": lambda c: c.wide,
    "wide_fact_order": _wide_order,
    "op_track_keys": lambda c: track_keys(day_window(c.src.track_event, "event_time", c.req.day, 1), c.rules),
    "op_click_pairs": lambda c: click_pairs(day_window(c.src.bid_click, "response_time", c.req.prev_day, 2)),
    "op_latest_strategy": lambda c: latest_strategy(c.src.dim_strategy),
    "op_app_names": lambda c: app_names(c.src.app_mapping),
    "op_order_requests": lambda c: day_requests(c.src, c.req.with_order(TEST_ORDER)).select(
        "request_id", "imp_id", "request_time"),
    "op_geo_region": lambda c: day_window(c.src.bid_request, "request_time", c.req.day, 1).select(
        "request_id", geo_region("geo_lat", "geo_lon", c.rules.wuhan_box).alias("geo_region")),
    "op_ad_slot": lambda c: day_window(c.src.bid_request, "request_time", c.req.day, 1).select(
        "request_id", ad_slot("imp_adviewtype", c.rules.ad_slot_names).alias("ad_slot")),
    "op_target_group": lambda c: day_window(c.src.bid_response, "response_time", c.req.day, 1).select(
        "response_id", "bid_seat_id", "strategy_id",
        target_group("strategy_id", c.rules.target_strategy_ids).alias("target_group")),
    "op_price_bucket": lambda c: day_window(c.src.bid_response, "response_time", c.req.day, 1).select(
        "response_id", "bid_seat_id", "bid_price",
        price_bucket("bid_price", c.rules.price_bounds, c.rules.price_labels).alias("price_bucket")),
    "op_label_chain": lambda c: c.wide.select("response_id", "bid_seat_id", "order_name", "strategy_name",
                                              "creative_name", "order_strategy_creative"),
    "op_top_apps": lambda c: top_apps(c.cells(["app_bundle"]), c.rules.app_top_n),
    "op_apps_outside": _apps_outside,
    "op_attention_flags": _flagged("spend", spend.spend_app),
    "op_attention_flags_basic": _flagged("basic", basic.hourly),
    "op_attention_flags_bidding": _flagged("bidding", bidding.bid_app),
    "op_failing_checks": _broken_checks,
    "op_fact_cube": _fact_cube,
    "op_stored_wide_fact": lambda c: wide_fact(_store(c), c.req, c.rules),
    "op_stored_order_kpi": _stored_order_kpi,
    "op_published_report": _published_report,
    "op_reject_ledger": _reject_ledger,
    "basic_kpi_unclicked": lambda c: basic.basic_kpi(ReportContext(c.src, c.req, _unclicked(c))),
    "basic_kpi_unclicked_order": lambda c: basic.basic_kpi(ReportContext(c.src, c.req.with_order(TEST_ORDER), _unclicked(c))),
    "wide_fact_unclicked": lambda c: wide_fact(c.src, c.req, _unclicked(c)),
    "op_wins_by_key": lambda c: wins_by_key(day_window(c.src.bid_result, "response_time", c.req.day, 1)).withColumn(
        "spend_yuan", F.col("spend_raw") / F.lit(c.rules.spend_divisor)).drop("spend_raw"),
    "op_clicks_by_key": lambda c: clicks_by_key(day_window(c.src.bid_click, "response_time", c.req.day, 1)),
    "op_tracks_by_key": lambda c: tracks_by_key(
        track_keys(day_window(c.src.track_event, "event_time", c.req.day, 1), c.rules)).join(
        clicks_by_key(day_window(c.src.bid_click, "response_time", c.req.day, 1)).select(
            "response_id", "bid_seat_id"), ["response_id", "bid_seat_id"], "left_semi"),
}


def _report_checks(analysis: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Data checks (CK1-CK4) over the tables of one report, built from one written fact."""
        ctx = _ctx(spark, sf_dir, analysis)
        tables = build_report(ctx.src, ctx.req, ctx.rules)
        return report_checks(tables, analysis, ctx.rules)
    return run


# Every report table is also registered with the order scope (``<name>_order``).
ORDER_SCOPED = {a: list(mod.TABLES) for a, mod in (("basic", basic), ("spend", spend), ("bidding", bidding))}


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for analysis, mod in (("basic", basic), ("spend", spend), ("bidding", bidding)):
        for name, fn in mod.TABLES.items():
            q[name] = _table(analysis, fn)
    for analysis, mod in (("basic", basic), ("spend", spend), ("bidding", bidding)):
        for name in ORDER_SCOPED[analysis]:
            q[f"{name}_order"] = _table(analysis, mod.TABLES[name], TEST_ORDER)
    q["report_checks"] = _report_checks("bidding")
    q["report_checks_basic"] = _report_checks("basic")
    q["report_checks_spend"] = _report_checks("spend")
    for name, fn in OPS.items():
        q[name] = _op(fn)
    return q
