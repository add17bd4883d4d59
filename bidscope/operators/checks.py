"""Guards (FLT7, FLT8) and report data checks (CK1-CK5).

Guards are ``limit(1)`` probes -- the only driver actions before a report is
written.  ``report_checks`` builds the checks of unwritten tables as one small
DataFrame (one row per check) from per-table aggregates. ``staged_checks`` needs no
job for the counts of a written report: they were observed while it was written.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.operators.facts import day_responses
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.tables import FunnelSources


class OrderNotDelivered(RuntimeError):
    """FLT7: the requested order has no bid response on the day (an ordinary outcome)."""


class NoDataForDay(RuntimeError):
    """FLT8: the KPI frame has no row for the requested day."""


def assert_delivered(src: FunnelSources, req: FunnelRequest) -> None:
    if req.order_id is None:
        return
    if day_responses(src, req).limit(1).count() == 0:
        raise OrderNotDelivered(f"order {req.order_id} has no bid response on {req.day}; no report built")


def assert_day(kpi: DataFrame, req: FunnelRequest) -> None:
    if kpi.filter(F.col("d") == F.lit(req.day)).limit(1).count() == 0:
        raise NoDataForDay(f"no data for {req.day}")


# Table names of each report in sheet order (CK1 expects all of them).
EXPECTED_TABLES = {
    "basic": ["basic_kpi", "findings", "filter_loss", "basic_compare", "gantt_bids", "order_fit", "strategy_fit",
              "creative_fit", "app_funnel", "landing", "hourly", "app_hour", "app_order", "hour_order", "notes"],
    "spend": ["spend_kpi", "spend_compare", "spend_by_order", "spend_by_strategy", "gantt_spend", "spend_app",
              "spend_hour", "spend_order_strategy_creative", "spend_target_group", "spend_region", "spend_ad_slot",
              "spend_ad_slot_strategy", "spend_landing", "notes"],
    "bidding": ["bid_kpi", "bid_compare", "gantt_bid_price", "bid_app", "bid_hour", "bid_order_strategy_creative",
                "bid_price_bucket", "x_app_hour", "x_app_order", "x_app_bucket", "x_hour_order", "x_hour_bucket",
                "x_order_bucket", "notes"],
}
# Tables that are rightly empty without a previous day (the comparison is skipped).
MAY_BE_EMPTY = {"basic_compare", "spend_compare", "bid_compare"}
APP_CROSS_TABLES = ("x_app_hour", "x_app_order", "x_app_bucket")


CHECK_SCHEMA = "check string, table string, value bigint, ok boolean"


def _shape_checks(analysis: str, columns: dict[str, int]) -> list[tuple]:
    """CK1 and the columns of CK2, known without a job: every expected table, and the columns of those there."""
    expected = EXPECTED_TABLES[analysis]
    return [("present", t, 1 if t in columns else 0, t in columns) for t in expected] + \
           [("columns", t, columns[t], columns[t] > 0) for t in expected if t in columns]


def _outside_apps(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """CK4: apps of each cross table that the app table lacks; all of them are cut to a few hundred rows."""
    apps = tables["bid_app"].select("app_bundle").distinct()
    return [tables[t].select("app_bundle").distinct().join(apps, "app_bundle", "left_anti")
            .agg(F.count(F.lit(1)).alias("value")).select(
                F.lit("apps_outside_top").alias("check"), F.lit(t).alias("table"), "value", (F.col("value") == 0).alias("ok"))
            for t in APP_CROSS_TABLES if t in tables]


def report_checks(tables: dict[str, DataFrame], analysis: str, rules: Rules = Rules()) -> DataFrame:
    """CK1-CK4 as rows ``(check, table, value, ok)``.

    CK1 presence, CK2 row and column counts (no rows is an error but for comparisons), CK3
    app-table size (bidding), CK4 cross-table bundles outside the app table (bidding).
    """
    spark = next(iter(tables.values())).sparkSession
    parts = [spark.createDataFrame(_shape_checks(analysis, {t: len(df.columns) for t, df in tables.items()}), CHECK_SCHEMA)]
    for t in EXPECTED_TABLES[analysis]:
        if t in tables:
            parts.append(tables[t].agg(F.count(F.lit(1)).alias("value")).select(
                F.lit("rows").alias("check"), F.lit(t).alias("table"), "value",
                ((F.col("value") > 0) | F.lit(t in MAY_BE_EMPTY)).alias("ok")))
    if analysis == "bidding" and "bid_app" in tables:
        parts.append(tables["bid_app"].agg(F.count(F.lit(1)).alias("value")).select(
            F.lit("app_top_n").alias("check"), F.lit("bid_app").alias("table"), "value",
            (F.col("value") <= F.lit(rules.bid_app_rows)).alias("ok")))
        parts += _outside_apps(tables)
    return reduce(DataFrame.unionByName, parts)


def staged_checks(spark: SparkSession, staged, analysis: str, rules: Rules = Rules()) -> list[tuple]:
    """CK1-CK4 of a staged report: the counts observed while it was written, and CK4 from the written tables."""
    out = _shape_checks(analysis, staged.columns)
    out += [("rows", t, n, n > 0 or t in MAY_BE_EMPTY) for t, n in staged.rows.items() if t in EXPECTED_TABLES[analysis]]
    if analysis == "bidding" and "bid_app" in staged.rows:
        n = staged.rows["bid_app"]
        out.append(("app_top_n", "bid_app", n, n <= rules.bid_app_rows))
        outside = _outside_apps({t: staged.read(spark, t) for t in ("bid_app", *APP_CROSS_TABLES) if t in staged.rows})
        out += [tuple(r) for r in reduce(DataFrame.unionByName, outside).collect()] if outside else []
    return out


@dataclass
class ValidationResult:
    """CK5: overall outcome of the checks."""

    ok: bool
    checks: list = field(default_factory=list)
    errors: list = field(default_factory=list)


def validate(checks: DataFrame | list[tuple]) -> ValidationResult:
    """CK5: from the check frame (one row per check: bounded by the number of tables) or its rows."""
    rows = checks.collect() if isinstance(checks, DataFrame) else checks
    done = [dict(zip(("check", "table", "value", "ok"), r)) for r in rows]
    errors = [f"{r['check']} {r['table']}={r['value']}" for r in done if not r["ok"]]
    return ValidationResult(ok=not errors, checks=done, errors=errors)


def with_flags(df: DataFrame, analysis: str, total_spend=None, rules: Rules = Rules()) -> DataFrame:
    """SC26: attention flags as boolean columns (the reference colours cells).

    spend over 30% of the day's spend (spend); any jump (spend, bidding) or
    1-5 jumps (basic); click->page or page->jump rate above 1 (basic).
    """
    cols = set(df.columns)
    flags = {}
    if analysis == "spend" and "spend_yuan" in cols and total_spend is not None:
        share = F.try_divide(F.col("spend_yuan"), total_spend)
        flags["flag_spend_share"] = F.coalesce(share > F.lit(rules.spend_attention_share), F.lit(False))
    if "jumps" in cols:
        if analysis == "basic":
            flags["flag_jumps"] = (F.col("jumps") >= 1) & (F.col("jumps") <= 5)
        else:
            flags["flag_jumps"] = F.col("jumps") > 0
    if analysis == "basic":
        for rate, name in (("rate_click_page", "flag_page_rate"), ("rate_page_jump", "flag_jump_rate")):
            if rate in cols:
                flags[name] = F.col(rate) > 1
    return df.withColumns(flags) if flags else df
