"""Aggregations over cells of the fact and the requests (AG10-AG20, SC16-SC22, SC26, TK*).

``funnel_agg`` is the one group-by behind ~30 report tables; it merges cells (see
``operators/cube.py``) and keeps null keys (like ``groupby(dropna=False)``).  Spend is
summed in raw ``wpr`` units and divided once at the end, so sums are exact for
integral units.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.exprs import delta_text, hours_seen, safe_ratio
from bidscope.operators.cube import measure, roll_up, states_of
from bidscope.operators.daily import with_costs, with_rates, with_share
from bidscope.plans.request import EMPTY_APP_LABEL, Rules

HOURS = list(range(24))

BASE_MEASURES = ("bids", "wins", "clicks", "page_exp", "jumps", "spend_yuan")


MEASURES = {
    "basic": BASE_MEASURES + ("direct_jump_bids",),
    "spend": BASE_MEASURES + ("active_hours",),
    "bidding": BASE_MEASURES + ("avg_bid_price", "min_bid_price", "max_bid_price", "active_hours"),
}


def funnel_agg(cells: DataFrame, keys: Sequence[str], measures: Sequence[str], rules: Rules = Rules()) -> DataFrame:
    """AG10: cells merged by ``keys`` (null keys kept) into funnel measures."""
    return roll_up(cells, keys, states_of(measures)).select(*keys, *[measure(m, rules) for m in measures])


def analysis_metrics(df: DataFrame, analysis: str, spend_total=None, bid_total=None,
                     has_invite: bool = False) -> DataFrame:
    """Rates, unit costs and share for one analysis (SC16-SC18).

    basic: rates; spend: rates, spend per win/click/jump, share of the day's
    spend; bidding: rates, spend per win/click, share of the day's bids.
    """
    df = with_rates(df, has_invite=has_invite)
    if analysis == "spend":
        df = with_costs(df, ("wins", "clicks", "jumps"))
        if spend_total is not None:
            df = with_share(df, "spend_yuan", spend_total, "spend_share")
    elif analysis == "bidding":
        df = with_costs(df, ("wins", "clicks"))
        if bid_total is not None:
            df = with_share(df, "bids", bid_total, "bid_share")
    return df


def request_agg(requests: DataFrame, key: Column, label: str, avg_floor: bool = False,
                active_hours: bool = False) -> DataFrame:
    """AG15: request counts by a key expression (plus average floor / distinct hours)."""
    aggs = [F.count(F.lit(1)).alias("invites")]
    if avg_floor:
        # the only sum of non-integral doubles in the reports: rounded so the
        # value does not depend on the summation order
        aggs.append(F.round(F.avg("imp_bidfloor"), 6).alias("avg_floor"))
    if active_hours:
        aggs.append(hours_seen(F.hour("request_time")).alias("active_hours"))
    return requests.groupBy(key.alias(label)).agg(*aggs)


def join_requests(req_agg: DataFrame, bid_agg: DataFrame, keys: Sequence[str], how: str = "right") -> DataFrame:
    """JN9/JN10: request aggregate joined to the bid aggregate on ``keys``.

    ``right`` keeps every bid-side group (JN10), ``left`` every request-side
    group (JN9).  Keys match null-safely (pandas merges match missing keys);
    afterwards missing metrics become 0 (SC24) -- the keys themselves are not
    filled (Q1).
    """
    r = req_agg.select(*[F.col(k).alias(f"_rk_{k}") for k in keys],
                       *[c for c in req_agg.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_rk_{k}"))
        cond = c if cond is None else cond & c
    if how == "right":
        j = bid_agg.join(r, cond, "left")
    elif how == "left":
        j = r.join(bid_agg, cond, "left").withColumns({k: F.col(f"_rk_{k}") for k in keys})
    else:
        raise ValueError(how)
    j = j.drop(*[f"_rk_{k}" for k in keys])
    j = j.select(*keys, *[c for c in j.columns if c not in keys])
    metrics = [f for f in j.schema.fields if f.name not in keys and not isinstance(f.dataType, T.StringType)]
    return j.withColumns({f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)) for f in metrics})


def top_k(df: DataFrame, order: Sequence[Column], n: int, tie_keys: Sequence[str] = ()) -> DataFrame:
    """TK*: first ``n`` rows by ``order`` with the group keys as tie-breakers."""
    return df.orderBy(*order, *[F.col(k).asc_nulls_first() for k in tie_keys]).limit(n)


def sort_by(df: DataFrame, order: Sequence[Column], tie_keys: Sequence[str] = ()) -> DataFrame:
    """TK8: a full sort (report order), keys as tie-breakers."""
    return df.orderBy(*order, *[F.col(k).asc_nulls_first() for k in tie_keys])


def top_apps(cells: DataFrame, n: int) -> DataFrame:
    """TK1: the ``n`` apps with most responses, plus ``(空)``; at most n+1 rows."""
    top = top_k(roll_up(cells, ["app_bundle"], ["bids"]), [F.col("bids").desc()], n, ["app_bundle"]).select("app_bundle")
    spark = cells.sparkSession
    empty = spark.createDataFrame([(EMPTY_APP_LABEL,)], "app_bundle string")
    return top.unionByName(empty).distinct()


def keep_apps(df: DataFrame, apps: DataFrame, col: str = "app_bundle") -> DataFrame:
    """FLT2/FLT3: rows whose app is in ``apps`` (a top-k frame, bounded by its limit)."""
    a = apps.select(F.col("app_bundle").alias("_app"))
    return df.join(F.broadcast(a), F.col(col) == F.col("_app"), "left_semi")


HOUR_COLS = [f"h{h:02d}" for h in HOURS]


def by_hour(state: str, prefix: str = "h") -> list[Column]:
    """AG12: 24 conditional sums of a state of cells that have an hour; null where the hour has no cell."""
    return [F.sum(F.when(F.col("hour") == F.lit(h), F.col(state))).alias(f"{prefix}{h:02d}") for h in HOURS]


def active_hour_count(prefix: str = "h") -> Column:
    """Hours with a non-zero cell (equals count(distinct hour) of the group)."""
    return sum((F.when(F.col(f"{prefix}{h:02d}") > 0, F.lit(1)).otherwise(F.lit(0)) for h in HOURS),
               F.lit(0)).cast("bigint")


def day_pairs(kpi: DataFrame, metrics: Sequence[str], day, prev_day,
              cur: str = "current", prev: str = "previous") -> DataFrame:
    """The KPI in long form with both days side by side: one row per metric,
    from ONE pass over the KPI (unpivot, then a conditional aggregate by metric)."""
    long = kpi.select("d", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["d"], list(metrics), "metric", "_v")
    return long.groupBy("metric").agg(
        F.max(F.when(F.col("d") == F.lit(day), F.col("_v"))).alias(cur),
        F.max(F.when(F.col("d") == F.lit(prev_day), F.col("_v"))).alias(prev),
        F.max(F.when(F.col("d") == F.lit(day), F.lit(True))).alias(f"_has_{cur}"),
        F.max(F.when(F.col("d") == F.lit(prev_day), F.lit(True))).alias(f"_has_{prev}"))


def compare_days(kpi: DataFrame, metrics: Sequence[str], day, prev_day) -> DataFrame:
    """AG18/SC19/SC28: one row per metric with current, previous, change and change rate.

    Empty when either day has no KPI row (the reference skips the table).
    """
    spark = kpi.sparkSession
    order = spark.createDataFrame([(i + 1, m) for i, m in enumerate(metrics)], "seq int, metric string")
    j = (day_pairs(kpi, metrics, day, prev_day)
         .filter(F.col("_has_current") & F.col("_has_previous"))
         .join(F.broadcast(order), "metric"))
    return j.select(
        "seq", "metric", "current", "previous",
        (F.col("current") - F.col("previous")).alias("delta"),
        safe_ratio(F.col("current") - F.col("previous"), "previous").alias("delta_rate"),
        delta_text("current", "previous").alias("delta_text"))
