"""Basic analysis tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.exprs import delta_text, safe_ratio
from bidscope.operators.cube import STATES, measure, merged, roll_up
from bidscope.operators.daily import with_rates
from bidscope.operators.facts import day_responses, strategy_max_name
from bidscope.operators.metrics import (
    HOUR_COLS, HOURS, active_hour_count, analysis_metrics, by_hour, compare_days, day_pairs,
    join_requests, keep_apps, sort_by, top_apps, top_k,
)
from bidscope.plans.context import GANTT_KEYS, ReportContext

KPI_COLS = ["d", "invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "load_fail"]
COMPARE_METRICS = ["invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan"]

ORDER_KEYS = ["order_id", "order_name"]
STRATEGY_KEYS = ["order_id", "strategy_id", "order_name", "strategy_name"]
CREATIVE_KEYS = ["order_id", "strategy_id", "creative_id", "order_name", "strategy_name", "creative_name",
                 "material_id", "material_type"]


def _bid_agg(ctx: ReportContext, keys) -> DataFrame:
    return analysis_metrics(ctx.funnel(keys), "basic")


def basic_kpi(ctx: ReportContext) -> DataFrame:
    """The day's funnel totals and step rates."""
    return with_rates(ctx.current().select(*KPI_COLS), has_invite=True)


def filter_loss(ctx: ReportContext) -> DataFrame:
    """R2: both days with rates, the un-bid estimate and the load-failure rate."""
    return sort_by(with_rates(ctx.kpi.select(*KPI_COLS), has_invite=True).withColumns({
        "unbid_estimate": F.col("invites") - F.col("bids"),
        "load_fail_rate": safe_ratio("load_fail", "page_exp"),
    }), [F.col("d").asc()])


def basic_compare(ctx: ReportContext) -> DataFrame:
    """Day-over-day comparison of seven metrics."""
    return compare_days(ctx.kpi, COMPARE_METRICS, ctx.req.day, ctx.req.prev_day)


def gantt_bids(ctx: ReportContext) -> DataFrame:
    """Strategy x response-hour bid counts of the day (final basic gantt).

    One aggregate over the day's responses gives the 24 hour cells, first/last
    response and bid count; active hours are the non-zero cells.  Rows without
    an order or strategy id drop out (the reference's inner join).  The name is
    the string maximum over all dim versions (AG14).
    """
    r = day_responses(ctx.src, ctx.req).filter(F.col("order_id").isNotNull() & F.col("strategy_id").isNotNull())
    g = r.groupBy("order_id", "strategy_id").agg(
        F.min("response_time").alias("start_time"), F.max("response_time").alias("last_time"),
        F.count(F.lit(1)).alias("bids"),
        *[F.count(F.when(F.hour("response_time") == F.lit(h), F.lit(1))).alias(f"h{h:02d}") for h in HOURS])
    names = strategy_max_name(ctx.src.dim_strategy).select(
        F.col("strategy_id").alias("_sid"), F.col("strategy_name").alias("_sname"))
    g = g.join(names, F.col("strategy_id") == F.col("_sid"), "left")
    out = g.select(
        "order_id", "strategy_id",
        F.coalesce(F.col("_sname"), F.col("strategy_id").cast("string")).alias("ad_name"),
        "start_time", "last_time", active_hour_count().alias("active_hours"), "bids", *HOUR_COLS)
    return sort_by(out, [F.col("bids").desc()], ["order_id", "strategy_id", "ad_name"])


def gantt_bids_request_hour(ctx: ReportContext) -> DataFrame:
    """The earlier basic gantt -- bids by request hour per strategy and names.

    Cells come from rows with a request hour and all four keys present; the
    summary (first/last response, active hours, bids, wins, clicks, spend)
    is per (order, strategy) over all rows.
    """
    keys4 = STRATEGY_KEYS
    rows = ctx.level(GANTT_KEYS).groupBy(*keys4).agg(
        *merged(["start_time", "last_time", "hour_mask", "bids", "wins", "clicks", "spend_raw"]), *by_hour("bids"))
    pair = Window.partitionBy("order_id", "strategy_id")
    whole = {c: STATES[c][1](c).over(pair) for c in ("start_time", "last_time", "hour_mask", "bids", "wins", "clicks", "spend_raw")}
    # Cells need all four keys and an hour; the pair's summary is over all of its rows.
    shown = F.col("hour_mask").isNotNull()
    for k in keys4:
        shown = shown & F.col(k).isNotNull()
    out = rows.select(*keys4, shown.alias("_shown"), *[w.alias(c) for c, w in whole.items()], *HOUR_COLS).filter("_shown").select(
        *keys4, "start_time", "last_time", measure("active_hours", ctx.rules), "bids", "wins", "clicks",
        measure("spend_yuan", ctx.rules), *[F.coalesce(c, F.lit(0)).alias(c) for c in HOUR_COLS])
    return sort_by(out, [F.col("bids").desc()], keys4)


def order_fit(ctx: ReportContext) -> DataFrame:
    """Funnel by order."""
    return sort_by(_bid_agg(ctx, ORDER_KEYS), [F.col("bids").desc()], ORDER_KEYS)


def strategy_fit(ctx: ReportContext) -> DataFrame:
    """Funnel by order and strategy."""
    return sort_by(_bid_agg(ctx, STRATEGY_KEYS), [F.col("bids").desc()], STRATEGY_KEYS)


def creative_fit(ctx: ReportContext) -> DataFrame:
    """Funnel by order, strategy and creative; first ``creative_rows`` by bids."""
    return top_k(_bid_agg(ctx, CREATIVE_KEYS), [F.col("bids").desc()], ctx.rules.creative_rows, CREATIVE_KEYS)


def app_funnel(ctx: ReportContext) -> DataFrame:
    """App funnel.  Invites and active hours are counted only for the top
    ``app_top_n`` apps (+ ``(空)``) (TK1, FLT2); every app of the wide fact is
    kept (right join) and the first ``basic_app_rows`` by bids are shown (Q10)."""
    apps = top_apps(ctx.cells(["app_name", "app_bundle"]), ctx.rules.app_top_n)
    # filtering the per-app aggregate equals filtering the requests (the filter is on the key)
    req_agg = ctx.with_app_name(keep_apps(ctx.request_counts("app_bundle", active_hours=True), apps))
    bid = ctx.funnel(["app_name", "app_bundle"])
    j = join_requests(req_agg, bid, ["app_name", "app_bundle"], "right")
    j = with_rates(j, has_invite=True)
    return top_k(j, [F.col("bids").desc()], ctx.rules.basic_app_rows, ["app_name", "app_bundle"])


def landing(ctx: ReportContext) -> DataFrame:
    """Landing pages: visits and interaction rates (FLT4, SC21)."""
    g = roll_up(ctx.cells(["page_id"]), ["page_id"], ["page_exp", "complete", "scroll", "video", "jumps", "direct_jump_bids"]).withColumnsRenamed({
        "page_exp": "visits", "complete": "complete_visits", "scroll": "scroll_visits", "video": "video_visits",
        "jumps": "page_click_visits", "direct_jump_bids": "direct_jump_clicks"})
    g = g.filter((F.col("page_id") != "") | (F.col("visits") > 0) | (F.col("direct_jump_clicks") > 0))
    g = g.withColumns({
        "complete_rate": safe_ratio("complete_visits", "visits"),
        "scroll_rate": safe_ratio("scroll_visits", "visits"),
        "video_rate": safe_ratio("video_visits", "visits"),
        "page_click_rate": safe_ratio("page_click_visits", "visits"),
    })
    return sort_by(g, [F.col("visits").desc()], ["page_id"])


def hourly(ctx: ReportContext) -> DataFrame:
    """Requests by hour (with average floor) joined to the bid funnel by
    request hour; hours without bids are dropped (FLT5)."""
    req_agg = ctx.request_counts("hour", avg_floor=True)
    bid = ctx.funnel(["hour"])
    j = with_rates(join_requests(req_agg, bid, ["hour"], "left"), has_invite=True)
    if ctx.rules.drop_zero_bid_hours:
        j = j.filter(F.col("bids") > 0)
    return sort_by(j, [F.col("hour").asc_nulls_last()])


def app_hour(ctx: ReportContext) -> DataFrame:
    """App x request hour, first ``cross_limit`` by bids."""
    keys = ["app_name", "app_bundle", "hour"]
    return top_k(_bid_agg(ctx, keys), [F.col("bids").desc()], ctx.rules.cross_limit, keys)


def app_order(ctx: ReportContext) -> DataFrame:
    """App x order/strategy/creative, first ``cross_limit`` by bids."""
    keys = ["app_name", "app_bundle", "order_strategy_creative"]
    return top_k(_bid_agg(ctx, keys), [F.col("bids").desc()], ctx.rules.cross_limit, keys)


def hour_order(ctx: ReportContext) -> DataFrame:
    """Hour x order/strategy/creative sorted by hour then bids, then cut (TK7)."""
    g = _bid_agg(ctx, ["hour", "order_strategy_creative"])
    return top_k(g, [F.col("hour").asc_nulls_last(), F.col("bids").desc()], ctx.rules.cross_limit,
                 ["order_strategy_creative"])


# Finding rows (sequence, kind, metric) of the basic summary.
FINDING_ROWS = [
    (1, "overview", "bids"), (1, "overview", "wins"),
    (2, "funnel", "rate_bid_win"), (2, "funnel", "rate_win_click"), (2, "funnel", "jumps"),
    (3, "landing", "page_exp"), (3, "landing", "clicks"),
    (5, "spend", "spend_yuan"),
]


def findings(ctx: ReportContext) -> DataFrame:
    """R14/SC29: finding rules over the two-day KPI as rows.

    A missing day counts as zeros.  ``alert`` marks the attribution warning
    (page exposures above clicks) on the landing rows.
    """
    spark = ctx.kpi.sparkSession
    metrics = sorted({m for _, _, m in FINDING_ROWS})
    rows = spark.createDataFrame(FINDING_ROWS, "seq int, kind string, metric string")
    k = with_rates(ctx.kpi, has_invite=True)
    pairs = day_pairs(k, metrics, ctx.req.day, ctx.req.prev_day,
                      "value", "prev_value")
    j = F.broadcast(rows).join(pairs, "metric", "left")
    j = j.withColumns({"value": F.coalesce("value", F.lit(0.0)), "prev_value": F.coalesce("prev_value", F.lit(0.0))})
    # attribution warning: the day's page exposures above its clicks (evaluated per landing row)
    cur = {m: F.max(F.when(F.col("metric") == m, F.col("value"))).over(Window.partitionBy("kind"))
           for m in ("page_exp", "clicks")}
    alert = F.when(F.col("kind") == "landing", F.coalesce(cur["page_exp"] > cur["clicks"], F.lit(False)))
    return j.select("seq", "kind", "metric", "value", "prev_value",
                    delta_text("value", "prev_value").alias("delta_text"),
                    alert.otherwise(F.lit(False)).alias("alert"))


TABLES = {
    "basic_kpi": basic_kpi,
    "filter_loss": filter_loss,
    "basic_compare": basic_compare,
    "gantt_bids": gantt_bids,
    "gantt_bids_request_hour": gantt_bids_request_hour,
    "order_fit": order_fit,
    "strategy_fit": strategy_fit,
    "creative_fit": creative_fit,
    "app_funnel": app_funnel,
    "landing": landing,
    "hourly": hourly,
    "app_hour": app_hour,
    "app_order": app_order,
    "hour_order": hour_order,
    "findings": findings,
}
