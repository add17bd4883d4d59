"""Bidding analysis tables (D1-D13).  Shares divide by the day's KPI bids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidscope.operators.cube import measure, merged
from bidscope.operators.metrics import (
    HOUR_COLS, analysis_metrics, by_hour, compare_days, join_requests, sort_by, top_k,
)
from bidscope.plans.context import GANTT_KEYS, ReportContext
from bidscope.plans.spend import OSC_KEYS

KPI_COLS = ["d", "invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "active_hours",
            "strategies", "avg_bid_price", "min_bid_price", "max_bid_price"]
COMPARE_METRICS = ["invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "avg_bid_price"]


def _total(ctx):
    return ctx.total("bids")


def _agg(ctx: ReportContext, keys, apps: DataFrame | None = None) -> DataFrame:
    return analysis_metrics(ctx.funnel(keys, apps), "bidding", bid_total=_total(ctx))


def _with_requests(ctx: ReportContext, req_agg: DataFrame, keys) -> DataFrame:
    bid = ctx.funnel(keys)
    j = join_requests(req_agg, bid, keys, "right")
    return analysis_metrics(j, "bidding", bid_total=_total(ctx), has_invite=True)


def bid_kpi(ctx: ReportContext) -> DataFrame:
    """The day's bidding overview with price statistics."""
    return analysis_metrics(ctx.current().select(*KPI_COLS), "bidding", bid_total=_total(ctx), has_invite=True)


def bid_compare(ctx: ReportContext) -> DataFrame:
    """Day-over-day comparison (adds the average bid price)."""
    return compare_days(ctx.kpi, COMPARE_METRICS, ctx.req.day, ctx.req.prev_day)


def gantt_bid_price(ctx: ReportContext) -> DataFrame:
    """D3: strategy rows (order, strategy, name) with first/last response, active
    hours, bids and average price; hour cells are the bids of the (order,
    strategy) in each request hour (null ids get no cells).  A ``total`` row
    carries the day's KPI bids and the bids of every hour present."""
    keys = ["order_id", "strategy_id", "strategy_name"]
    # The rows and their total are two grouping sets of one small frame (strategies x hours).
    g = ctx.level(GANTT_KEYS).groupingSets([keys, []], *keys).agg(
        *merged(["start_time", "last_time", "hour_mask", "bids", "price_sum", "price_n"]),
        *by_hour("bids"), F.grouping_id().alias("_gid"))
    total = F.col("_gid") > 0
    pair = Window.partitionBy("_gid", "order_id", "strategy_id")
    named = F.col("order_id").isNotNull() & F.col("strategy_id").isNotNull()

    def unless_total(c):
        return F.when(~total, c)

    # a pair's cells are those of all its names; the total's hours without bids stay empty
    cells = [F.when(total, F.col(c)).otherwise(F.coalesce(F.when(named, F.sum(c).over(pair)), F.lit(0))).alias(c) for c in HOUR_COLS]
    out = g.select(
        F.when(total, "total").otherwise("strategy").alias("row_kind"), *keys,
        *[unless_total(F.col(c)).alias(c) for c in ("start_time", "last_time")],
        unless_total(measure("active_hours", ctx.rules)).alias("active_hours"),
        F.when(total, _total(ctx).cast("bigint")).otherwise(F.col("bids")).alias("bids"),
        unless_total(measure("avg_bid_price", ctx.rules)).alias("avg_bid_price"), *cells)
    return sort_by(out, [F.col("row_kind").desc(), F.col("bids").desc()], keys)


def bid_app(ctx: ReportContext) -> DataFrame:
    """Bidding by app, first ``bid_app_rows`` by bids."""
    req = ctx.with_app_name(ctx.request_counts("app_bundle"))
    j = _with_requests(ctx, req, ["app_name", "app_bundle"])
    return top_k(j, [F.col("bids").desc()], ctx.rules.bid_app_rows, ["app_name", "app_bundle"])


def bid_hour(ctx: ReportContext) -> DataFrame:
    """Bidding by request hour."""
    req = ctx.request_counts("hour")
    return sort_by(_with_requests(ctx, req, ["hour"]), [F.col("hour").asc_nulls_last()])


def bid_order_strategy_creative(ctx: ReportContext) -> DataFrame:
    """By order/strategy/creative, first ``bid_osc_rows`` by bids."""
    return top_k(_agg(ctx, OSC_KEYS), [F.col("bids").desc()], ctx.rules.bid_osc_rows, OSC_KEYS)


def bid_price_bucket(ctx: ReportContext) -> DataFrame:
    """By bid price bucket, ordered by average price."""
    return sort_by(_agg(ctx, ["price_bucket"]), [F.col("avg_bid_price").asc_nulls_last()], ["price_bucket"])


def _top_apps(ctx: ReportContext) -> DataFrame:
    """FLT3: the apps shown in the app table (top ``bid_app_rows``), whose cells the cross tables keep."""
    return ctx.memo("bid_top_apps", lambda: bid_app(ctx).select("app_bundle"))


def _cross(ctx, keys, order, limit=None, tie=None, apps=None):
    g = _agg(ctx, keys, apps)
    tie = keys if tie is None else tie
    return sort_by(g, order, tie) if limit is None else top_k(g, order, limit, tie)


def x_app_hour(ctx: ReportContext) -> DataFrame:
    """App x hour over the top apps, first ``cross_limit`` by bids."""
    return _cross(ctx, ["app_name", "app_bundle", "hour"], [F.col("bids").desc()],
                  ctx.rules.cross_limit, apps=_top_apps(ctx))


def x_app_order(ctx: ReportContext) -> DataFrame:
    """App x order/strategy/creative over the top apps."""
    return _cross(ctx, ["app_name", "app_bundle", "order_strategy_creative"], [F.col("bids").desc()],
                  ctx.rules.cross_limit, apps=_top_apps(ctx))


def x_app_bucket(ctx: ReportContext) -> DataFrame:
    """App x price bucket over the top apps."""
    return _cross(ctx, ["app_name", "app_bundle", "price_bucket"], [F.col("bids").desc()],
                  ctx.rules.cross_limit, apps=_top_apps(ctx))


def x_hour_order(ctx: ReportContext) -> DataFrame:
    """Hour x order/strategy/creative, sorted by hour then bids, then cut."""
    return _cross(ctx, ["hour", "order_strategy_creative"],
                  [F.col("hour").asc_nulls_last(), F.col("bids").desc()], ctx.rules.cross_limit,
                  ["order_strategy_creative"])


def x_hour_bucket(ctx: ReportContext) -> DataFrame:
    """Hour x price bucket, sorted by hour then average price (all rows)."""
    return _cross(ctx, ["hour", "price_bucket"],
                  [F.col("hour").asc_nulls_last(), F.col("avg_bid_price").asc_nulls_last()], None, ["price_bucket"])


def x_order_bucket(ctx: ReportContext) -> DataFrame:
    """order/strategy/creative x price bucket, first ``cross_limit`` by bids."""
    return _cross(ctx, ["order_strategy_creative", "price_bucket"], [F.col("bids").desc()],
                  ctx.rules.cross_limit)


TABLES = {
    "bid_kpi": bid_kpi,
    "bid_compare": bid_compare,
    "gantt_bid_price": gantt_bid_price,
    "bid_app": bid_app,
    "bid_hour": bid_hour,
    "bid_order_strategy_creative": bid_order_strategy_creative,
    "bid_price_bucket": bid_price_bucket,
    "x_app_hour": x_app_hour,
    "x_app_order": x_app_order,
    "x_app_bucket": x_app_bucket,
    "x_hour_order": x_hour_order,
    "x_hour_bucket": x_hour_bucket,
    "x_order_bucket": x_order_bucket,
}
