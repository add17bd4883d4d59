"""Spend analysis tables (S1-S13).  Shares divide by the day's KPI spend (SC18),
taken as a scalar subquery -- no join, no driver round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.exprs import safe_ratio
from bidscope.operators.cube import measure, merged, roll_up
from bidscope.operators.metrics import (
    HOUR_COLS, analysis_metrics, by_hour, compare_days, join_requests, sort_by, top_k,
)
from bidscope.plans.context import GANTT_KEYS, ReportContext

KPI_COLS = ["d", "invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "active_hours", "strategies"]
COMPARE_METRICS = ["spend_yuan", "invites", "bids", "wins", "clicks", "page_exp", "jumps"]
OSC_KEYS = ["order_id", "strategy_id", "creative_id", "order_name", "strategy_name", "creative_name",
            "material_id", "material_type", "order_strategy_creative"]


def _total(ctx):
    return ctx.total("spend_yuan")


def _bid_agg(ctx: ReportContext, keys) -> DataFrame:
    return analysis_metrics(ctx.funnel(keys), "spend", spend_total=_total(ctx))


def _with_requests(ctx: ReportContext, req_agg: DataFrame, keys) -> DataFrame:
    bid = ctx.funnel(keys)
    j = join_requests(req_agg, bid, keys, "right")
    return analysis_metrics(j, "spend", spend_total=_total(ctx), has_invite=True)


def spend_kpi(ctx: ReportContext) -> DataFrame:
    """The day's spend overview: funnel, rates, unit costs, spend per active hour."""
    k = analysis_metrics(ctx.current().select(*KPI_COLS), "spend", spend_total=_total(ctx), has_invite=True)
    return k.withColumn("spend_per_active_hour", safe_ratio("spend_yuan", "active_hours"))


def spend_compare(ctx: ReportContext) -> DataFrame:
    """Day-over-day comparison."""
    return compare_days(ctx.kpi, COMPARE_METRICS, ctx.req.day, ctx.req.prev_day)


SUMMARY_COLS = ["active_hours", "spend_yuan", "opportunity_invites", "bids", "wins", "clicks", "page_exp", "jumps",
                "cost_per_win", "cost_per_click", "cost_per_jump", "rate_bid_win", "rate_win_click",
                "rate_click_page", "rate_page_jump", "spend_share"]


def spend_by_order(ctx: ReportContext) -> DataFrame:
    """S3: spend by order; opportunity invites = bids."""
    keys = ["order_id", "order_name"]
    g = _bid_agg(ctx, keys).withColumn("opportunity_invites", F.col("bids"))
    return sort_by(g.select(*keys, *SUMMARY_COLS), [F.col("spend_yuan").desc()], keys)


def spend_by_strategy(ctx: ReportContext) -> DataFrame:
    """Spend by order and strategy."""
    keys = ["order_id", "strategy_id", "order_name", "strategy_name"]
    g = _bid_agg(ctx, keys).withColumn("opportunity_invites", F.col("bids"))
    return sort_by(g.select(*keys, *SUMMARY_COLS), [F.col("spend_yuan").desc()], keys)


def gantt_spend(ctx: ReportContext) -> DataFrame:
    """Strategy x request-hour spend; a cell shows the hour's spend only
    where the strategy bid in that hour.  Keyed by (order, strategy, name)
    (Q14).  A ``total`` row carries the day's KPI spend and the spend of
    every hour present in the wide fact (AG17)."""
    keys = ["order_id", "strategy_id", "strategy_name"]
    div = F.lit(float(ctx.rules.spend_divisor))
    # The rows and their total are two grouping sets of one small frame (strategies x hours).
    g = ctx.level(GANTT_KEYS).groupingSets([keys, []], *keys).agg(
        *merged(["start_time", "last_time", "hour_mask", "spend_raw", "bids", "wins"]),
        *by_hour("spend_raw"), F.grouping_id().alias("_gid"))
    total = F.col("_gid") > 0

    def unless_total(c):
        return F.when(~total, c)

    out = g.select(
        F.when(total, "total").otherwise("strategy").alias("row_kind"), *keys,
        *[unless_total(F.col(c)).alias(c) for c in ("start_time", "last_time")],
        unless_total(measure("active_hours", ctx.rules)).alias("active_hours"),
        F.when(total, _total(ctx)).otherwise(measure("spend_yuan", ctx.rules)).alias("spend_yuan"),
        *[unless_total(F.col(c)).alias(c) for c in ("bids", "wins")],
        *[(F.col(c) / div).alias(c) for c in HOUR_COLS])
    return sort_by(out, [F.col("row_kind").desc(), F.col("spend_yuan").desc()], keys)


def spend_app(ctx: ReportContext) -> DataFrame:
    """Spend by app; invites of every app (right join), first ``spend_app_rows`` by spend."""
    req = ctx.with_app_name(ctx.request_counts("app_bundle"))
    j = _with_requests(ctx, req, ["app_name", "app_bundle"])
    return top_k(j, [F.col("spend_yuan").desc()], ctx.rules.spend_app_rows, ["app_name", "app_bundle"])


def spend_hour(ctx: ReportContext) -> DataFrame:
    """Spend by request hour (a null hour stays null, Q1)."""
    req = ctx.request_counts("hour")
    return sort_by(_with_requests(ctx, req, ["hour"]), [F.col("hour").asc_nulls_last()])


def spend_order_strategy_creative(ctx: ReportContext) -> DataFrame:
    """Spend by order/strategy/creative, first ``spend_osc_rows`` by spend."""
    return top_k(_bid_agg(ctx, OSC_KEYS), [F.col("spend_yuan").desc()], ctx.rules.spend_osc_rows, OSC_KEYS)


def spend_target_group(ctx: ReportContext) -> DataFrame:
    """Spend by targeting group (strategy id set)."""
    g = _bid_agg(ctx, ["target_group"]).withColumn("opportunity_invites", F.col("bids"))
    cols = ["target_group", "spend_yuan", "opportunity_invites", "bids", "wins", "clicks", "page_exp", "jumps",
            "cost_per_win", "cost_per_click", "cost_per_jump", "rate_bid_win", "rate_win_click",
            "rate_click_page", "rate_page_jump", "spend_share"]
    return sort_by(g.select(*cols), [F.col("spend_yuan").desc()], ["target_group"])


def spend_region(ctx: ReportContext) -> DataFrame:
    """Spend by request coordinates region, first ``spend_region_rows`` by spend."""
    req = ctx.request_counts("geo_region")
    j = _with_requests(ctx, req, ["geo_region"])
    return top_k(j, [F.col("spend_yuan").desc()], ctx.rules.spend_region_rows, ["geo_region"])


def spend_ad_slot(ctx: ReportContext) -> DataFrame:
    """Spend by ad slot type (requests grouped by the slot label, AG19)."""
    req = ctx.request_counts("ad_slot")
    return sort_by(_with_requests(ctx, req, ["ad_slot"]), [F.col("spend_yuan").desc()], ["ad_slot"])


def spend_ad_slot_strategy(ctx: ReportContext) -> DataFrame:
    """Spend by strategy and ad slot."""
    keys = ["strategy_id", "strategy_name", "ad_slot"]
    g = _bid_agg(ctx, keys).select(*keys, "spend_yuan", "bids", "wins", "clicks", "cost_per_win",
                                   "cost_per_click", "spend_share")
    return sort_by(g, [F.col("spend_yuan").desc()], keys)


def spend_landing(ctx: ReportContext) -> DataFrame:
    """Spend by landing page: exposure, jumps, costs, reach and read rates."""
    g = roll_up(ctx.cells(["page_id"]), ["page_id"], ["spend_raw", "clicks", "page_exp", "jumps", "complete", "scroll", "video"])
    g = g.select("page_id", measure("spend_yuan", ctx.rules), "clicks", "page_exp", "jumps", F.col("complete").alias("complete_visits"),
                 F.col("scroll").alias("scroll_visits"), F.col("video").alias("video_visits"))
    g = g.filter((F.col("page_id") != "") | (F.col("page_exp") > 0) | (F.col("jumps") > 0))
    g = g.withColumns({
        "cost_per_exposure": safe_ratio("spend_yuan", "page_exp"),
        "cost_per_jump": safe_ratio("spend_yuan", "jumps"),
        "rate_click_page": safe_ratio("page_exp", "clicks"),
        "rate_page_jump": safe_ratio("jumps", "page_exp"),
        "complete_rate": safe_ratio("complete_visits", "page_exp"),
        "spend_share": safe_ratio("spend_yuan", _total(ctx)),
    })
    return sort_by(g, [F.col("spend_yuan").desc()], ["page_id"])


TABLES = {
    "spend_kpi": spend_kpi,
    "spend_compare": spend_compare,
    "spend_by_order": spend_by_order,
    "spend_by_strategy": spend_by_strategy,
    "gantt_spend": gantt_spend,
    "spend_app": spend_app,
    "spend_hour": spend_hour,
    "spend_order_strategy_creative": spend_order_strategy_creative,
    "spend_target_group": spend_target_group,
    "spend_region": spend_region,
    "spend_ad_slot": spend_ad_slot,
    "spend_ad_slot_strategy": spend_ad_slot_strategy,
    "spend_landing": spend_landing,
}
