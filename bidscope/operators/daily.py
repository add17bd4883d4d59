"""Two-day KPI frame (AG1-AG5, JN7, JN8): one row per day of ``[prev_day, prev_day+2)``.

Without an order every count comes from its own table by event day; with an
order the day and the invites are the order's responses (Q5) and wins,
clicks and tracks are joined to them (Q4).  Tracks are attributed to the
click's day (Q6).  Each branch pre-aggregates to at most a few rows per day
before the spine join, so the spine joins are tiny.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.exprs import flag, safe_ratio, wpr_value
from bidscope.operators.facts import PAIR, TRACK_FLAGS, events_by_pair, track_keys
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.tables import FunnelSources, day_window

DAILY_FLAGS = ("page_exp", "jump", "load_fail")

# KPI columns of each analysis; ``all`` is the superset shared by whole-day runs.
KPI_COLUMNS = {
    "basic": ["d", "invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "load_fail"],
    "spend": ["d", "invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "active_hours",
              "strategies"],
    "bidding": ["d", "invites", "bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan", "active_hours",
                "strategies", "avg_bid_price", "min_bid_price", "max_bid_price"],
}
KPI_COLUMNS["all"] = KPI_COLUMNS["bidding"] + ["load_fail"]


def _bid_stats(responses: DataFrame) -> DataFrame:
    """AG4/AG5: bids, distinct strategies and hours, price stats of each day.

    Responses are reduced map-side to a mergeable row for each (day, strategy), hours being the
    bits of a mask. A strategy is one of these rows, so counting them counts strategies: the
    second aggregate merges them and nothing is expanded for a distinct count. (Bitmaps of ids
    would do the same, but their aggregate sorts all responses first.)
    """
    by_strategy = responses.groupBy(F.to_date("response_time").alias("d"), "strategy_id").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour("response_time"))).alias("_hours"),
        F.count(F.lit(1)).alias("_n"), F.sum("bid_price").alias("_ps"), F.count("bid_price").alias("_pn"),
        F.min("bid_price").alias("_pmin"), F.max("bid_price").alias("_pmax"))
    return by_strategy.groupBy("d").agg(
        F.sum("_n").alias("bids"),
        F.count("strategy_id").alias("strategies"),
        F.bit_count(F.bit_or("_hours")).cast("bigint").alias("active_hours"),
        F.try_divide(F.sum("_ps"), F.sum("_pn")).alias("avg_bid_price"),
        F.min("_pmin").alias("min_bid_price"), F.max("_pmax").alias("max_bid_price"))


def _clicks_and_tracks_by_day(src: FunnelSources, start, rules: Rules, flags) -> DataFrame:
    """Clicks per day and, per click day, the clicked pairs with each track flag
    (AG1 clicks, AG3, AG9, JN3).

    Clicks and tracks are read once each and meet in one union and ``groupBy`` by pair, combined
    map-side, without a join. A pair counts on a day when it has a click that day; null
    keys never meet.
    """
    days = [start + dt.timedelta(days=i) for i in range(2)]
    counts = [f"_n{i}" for i in range(len(days))]
    clicks = day_window(src.bid_click, "response_time", start, 2).select(
        *PAIR, *[(F.to_date("response_time") == F.lit(d)).cast("int").alias(c) for c, d in zip(counts, days)])
    tracks = track_keys(day_window(src.track_event, "event_time", start, 2), rules).select(
        *PAIR, *[flag("event_code", TRACK_FLAGS[f]).alias(f) for f in flags])
    keyed = F.col("response_id").isNotNull() & F.col("bid_seat_id").isNotNull()
    per_pair = clicks.unionByName(tracks, allowMissingColumns=True).groupBy(*PAIR).agg(
        *[F.sum(c).alias(c) for c in counts], *[F.max(f).alias(f) for f in flags])
    totals = per_pair.agg(*[F.sum(c).alias(f"clicks_{i}") for i, c in enumerate(counts)],
                          *[F.sum(F.when(keyed & (F.col(c) > 0), F.coalesce(F.col(f), F.lit(0)))).alias(f"{f}_{i}")
                            for i, c in enumerate(counts) for f in flags])
    rows = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"clicks_{i}").alias("clicks"),
                                        *[F.col(f"{f}_{i}").alias(f) for f in flags])
                               for i, d in enumerate(days)]))
    return totals.select(rows.alias("r")).select("r.*")


def _tracks_by_own_day(src: FunnelSources, start, rules: Rules, flags) -> DataFrame:
    """Without the click rule: pairs with each track flag by the event's own day, and the click rows."""
    day = F.to_date("event_time").alias("d")
    tracks = day_window(src.track_event, "event_time", start, 2)
    keys = track_keys(tracks, rules, day)
    pairs = keys.groupBy("d", *PAIR).agg(*[F.max(flag("event_code", TRACK_FLAGS[f])).alias(f) for f in flags])
    keyed = F.col("response_id").isNotNull() & F.col("bid_seat_id").isNotNull()
    seen = pairs.filter(keyed).groupBy("d").agg(*[F.sum(f).alias(f) for f in flags])
    clicks = (day_window(src.bid_click, "response_time", start, 2)
              .groupBy(F.to_date("response_time").alias("d")).agg(F.count(F.lit(1)).alias("clicks")))
    return seen.join(clicks, "d", "full")


def _order_pairs(src: FunnelSources, req: FunnelRequest, rules: Rules, flags) -> DataFrame:
    """JN7: per (day, pair) of the order, its response copies and the pair's events.

    Copies multiply wins and spend (join fan-out), but clicks and tracks count distinct
    pairs, so copies are counted before the join.
    """
    copies = (day_window(src.bid_response, "response_time", req.prev_day, 2).filter(F.col("order_id") == F.lit(req.order_id))
              .groupBy(F.to_date("response_time").alias("d"), *PAIR).agg(F.count(F.lit(1)).alias("_copies")))
    ev = events_by_pair(src, req.prev_day, 2, rules, flags=flags, with_page=False)
    return copies.join(ev, PAIR, "left").withColumnsRenamed(
        {"win": "_win", "spend_raw": "_spend", "click": "_click", **{f: f"_{f}" for f in flags}})


def daily_kpi(src: FunnelSources, req: FunnelRequest, rules: Rules = Rules(),
              analysis: str | None = None) -> DataFrame:
    """Both days with the counts of the analysis (basic adds load failures;
    spend adds hours and strategies; bidding adds bid price stats)."""
    analysis = analysis or req.analysis
    start = req.prev_day
    flags = DAILY_FLAGS if analysis in ("basic", "all") else ("page_exp", "jump")
    resp = day_window(src.bid_response, "response_time", start, 2)

    if req.order_id is None:
        spine = (day_window(src.bid_request, "request_time", start, 2)
                 .groupBy(F.to_date("request_time").alias("d")).agg(F.count(F.lit(1)).alias("invites")))
        if analysis == "basic":
            bid = resp.groupBy(F.to_date("response_time").alias("d")).agg(F.count(F.lit(1)).alias("bids"))
        else:
            bid = _bid_stats(resp)
        win = (day_window(src.bid_result, "response_time", start, 2)
               .groupBy(F.to_date("response_time").alias("d"))
               .agg(F.count(F.lit(1)).alias("wins"), F.sum(wpr_value("wpr")).alias("spend_raw")))
        by_day = _clicks_and_tracks_by_day if rules.landing_page_requires_click else _tracks_by_own_day
        clk_trk = by_day(src, start, rules, flags)
        out = (spine.join(bid, "d", "left").join(win, "d", "left").join(clk_trk, "d", "left"))
    else:
        base = resp.filter(F.col("order_id") == F.lit(req.order_id)).select(
            F.to_date("response_time").alias("d"), "response_time", "strategy_id", "bid_price")
        # part by part if the tables are stored by response id
        per_pair = reduce(DataFrame.unionByName, [_order_pairs(part, req, rules, flags) for part in src.by_id()])
        has_click = F.coalesce(F.col("_click"), F.lit(0)) > 0
        counted = has_click if rules.landing_page_requires_click else F.lit(True)
        ev_day = per_pair.groupBy("d").agg(
            F.sum("_copies").alias("invites"),
            F.sum(F.col("_copies") * F.coalesce(F.col("_win"), F.lit(0))).alias("wins"),
            F.sum(F.col("_copies") * F.coalesce(F.col("_spend"), F.lit(0.0))).alias("spend_raw"),
            F.sum(F.when(has_click, 1).otherwise(0)).alias("clicks"),
            *[F.sum(F.when(counted, F.coalesce(F.col(f"_{f}"), F.lit(0))).otherwise(0)).alias(f)
              for f in flags])
        if analysis == "basic":
            out = ev_day.withColumn("bids", F.col("invites"))
        else:
            out = ev_day.join(_bid_stats(base), "d", "left")

    cols = [F.col("d"), F.col("invites").cast("bigint").alias("invites")]
    for c in ("bids", "wins", "clicks", "page_exp", "jumps"):
        src_col = "jump" if c == "jumps" else c
        cols.append(F.coalesce(F.col(src_col), F.lit(0)).cast("bigint").alias(c))
    cols.append((F.coalesce(F.col("spend_raw"), F.lit(0.0)) / F.lit(float(rules.spend_divisor))).alias("spend_yuan"))
    if analysis != "basic":
        cols.append(F.coalesce(F.col("active_hours"), F.lit(0)).cast("bigint").alias("active_hours"))
        cols.append(F.coalesce(F.col("strategies"), F.lit(0)).cast("bigint").alias("strategies"))
    if analysis in ("bidding", "all"):
        for c in ("avg_bid_price", "min_bid_price", "max_bid_price"):
            cols.append(F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c))
    if analysis in ("basic", "all"):
        cols.append(F.coalesce(F.col("load_fail"), F.lit(0)).cast("bigint").alias("load_fail"))
    return out.select(*cols)


def with_rates(df: DataFrame, has_invite: bool = True) -> DataFrame:
    """SC16: funnel step rates."""
    steps = [("rate_bid_win", "wins", "bids"), ("rate_win_click", "clicks", "wins"),
             ("rate_click_page", "page_exp", "clicks"), ("rate_page_jump", "jumps", "page_exp")]
    if has_invite:
        steps.insert(0, ("rate_invite_bid", "bids", "invites"))
    return df.withColumns({name: safe_ratio(n, d) for name, n, d in steps})


def with_costs(df: DataFrame, per=("wins", "clicks", "jumps")) -> DataFrame:
    """SC17: spend per win / click / jump."""
    names = {"wins": "cost_per_win", "clicks": "cost_per_click", "jumps": "cost_per_jump",
             "page_exp": "cost_per_exposure"}
    return df.withColumns({names[p]: safe_ratio("spend_yuan", p) for p in per})


def with_share(df: DataFrame, col: str, total, name: str) -> DataFrame:
    """SC18: ``col / total`` where ``total`` is a scalar Column (the day KPI); 0 when it is 0."""
    return df.withColumn(name, safe_ratio(col, total))
