"""Scalar rules as Spark ``Column`` expressions.

All of these stay inside whole-stage codegen: no Python UDF is involved.
Arguments accept a column name or a ``Column``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidscope.plans.request import (
    AD_SLOT_NAMES, AD_SLOT_OTHER, AD_SLOT_UNKNOWN, EMPTY_APP_LABEL, GEO_IN_LABEL,
    GEO_MISSING_LABEL, GEO_OUT_LABEL, PAGE_ID_PATTERN, PRICE_BUCKET_BOUNDS,
    PRICE_BUCKET_LABELS, PRICE_UNKNOWN, TARGET_IN_LABEL, TARGET_OUT_LABEL,
    WUHAN_BOX, WUHAN_TARGET_STRATEGY_IDS,
)

__all__ = [
    "col_of", "blank_to", "app_label", "wpr_value", "track_key", "page_id",
    "label_chain", "order_strategy_creative", "geo_region", "ad_slot", "target_group",
    "price_bucket", "direct_jump", "safe_ratio", "flag", "delta_text", "hours_seen", "pct_text",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to(c, label: str) -> Column:
    """SC1: ``''`` or null becomes ``label``."""
    return F.coalesce(F.nullif(col_of(c), F.lit("")), F.lit(label))


def app_label(c) -> Column:
    """SC1 for app bundles: blank bundle -> ``(空)``."""
    return blank_to(c, EMPTY_APP_LABEL)


def wpr_value(c) -> Column:
    """SC6 (per row): the ``wpr`` text as a number; blank or unparseable -> 0."""
    return F.coalesce(F.nullif(col_of(c), F.lit("")).try_cast("double"), F.lit(0.0))


def track_key(attrs, pattern: str, fallback) -> Column:
    """SC2: key parsed from the URL text, else the fallback id column."""
    parsed = F.regexp_extract(col_of(attrs).cast("string"), pattern, 1)
    return F.coalesce(F.nullif(parsed, F.lit("")), col_of(fallback))


def page_id(attrs, pattern: str = PAGE_ID_PATTERN) -> Column:
    """SC3: landing page id text ('' when the URL has none)."""
    return F.regexp_extract(col_of(attrs).cast("string"), pattern, 1)


def label_chain(*cols) -> Column:
    """SC7: first non-null of the name sources, the last one cast to text."""
    parts = [col_of(c) for c in cols[:-1]] + [col_of(cols[-1]).cast("string")]
    return F.coalesce(*parts)


def order_strategy_creative(order_name, strategy_name, creative_name) -> Column:
    """SC8: ``order / strategy / creative`` with null parts as ''."""
    def part(c):
        return F.coalesce(col_of(c).cast("string"), F.lit(""))
    return F.concat(part(order_name), F.lit(" / "), part(strategy_name), F.lit(" / "), part(creative_name))


def geo_region(lat, lon, box: tuple = WUHAN_BOX) -> Column:
    """SC9: inclusive lat/lon box -> in / out; a missing coordinate -> missing."""
    lat_c, lon_c = col_of(lat), col_of(lon)
    lat_min, lat_max, lon_min, lon_max = box
    return (F.when(lat_c.isNull() | lon_c.isNull(), F.lit(GEO_MISSING_LABEL))
            .when(lat_c.between(F.lit(float(lat_min)), F.lit(float(lat_max)))
                  & lon_c.between(F.lit(float(lon_min)), F.lit(float(lon_max))), F.lit(GEO_IN_LABEL))
            .otherwise(F.lit(GEO_OUT_LABEL)))


def ad_slot(code, names: dict | None = None) -> Column:
    """SC10: ``<code>-<name>``; unknown codes ``<code>-其他``; non-numeric -> 未知."""
    names = AD_SLOT_NAMES if names is None else names
    c = col_of(code)
    num = c.cast("string").try_cast("double")
    as_int = F.when(num == F.floor(num), num.cast("bigint"))
    name = F.lit(AD_SLOT_OTHER)
    for k in sorted(names, reverse=True):
        name = F.when(as_int == F.lit(int(k)), F.lit(names[k])).otherwise(name)
    return F.when(as_int.isNull(), F.lit(AD_SLOT_UNKNOWN)).otherwise(
        F.concat(as_int.cast("string"), F.lit("-"), name))


def target_group(strategy_id, ids: Iterable[int] = WUHAN_TARGET_STRATEGY_IDS) -> Column:
    """SC11: strategy id in the configured set -> targeted group, else nationwide."""
    c = col_of(strategy_id)
    return F.when(c.isin([int(i) for i in ids]), F.lit(TARGET_IN_LABEL)).otherwise(F.lit(TARGET_OUT_LABEL))


def price_bucket(price, bounds: tuple = PRICE_BUCKET_BOUNDS, labels: tuple = PRICE_BUCKET_LABELS) -> Column:
    """SC12: upper-inclusive bid price buckets; null -> 未知."""
    c = col_of(price)
    expr = F.when(c.isNull(), F.lit(PRICE_UNKNOWN))
    for bound, label in zip(bounds, labels):
        expr = expr.when(c <= F.lit(float(bound)), F.lit(label))
    return expr.otherwise(F.lit(labels[len(bounds)]))


def direct_jump(land_page, curl, page_exp) -> Column:
    """SC13: no landing page, a click URL, and no page exposure -> 1 else 0."""
    cond = ((F.coalesce(col_of(land_page), F.lit("")) == F.lit(""))
            & (F.coalesce(col_of(curl), F.lit("")) != F.lit(""))
            & (col_of(page_exp) == F.lit(0)))
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num, den) -> Column:
    """SC15: num / den as double; 0 when den is 0/null or num is null."""
    return F.coalesce(F.try_divide(col_of(num).cast("double"), col_of(den).cast("double")), F.lit(0.0))


def flag(event_code, codes) -> Column:
    """SC25: 1 when the event code is in ``codes`` else 0."""
    codes = [codes] if isinstance(codes, str) else list(codes)
    return F.when(col_of(event_code).isin(codes), F.lit(1)).otherwise(F.lit(0))


def hours_seen(hour) -> Column:
    """Distinct hours of a group as the bits of one mask: mergeable, so no second aggregation by hour."""
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1), col_of(hour).cast("int")))
    return F.coalesce(F.bit_count(mask), F.lit(0)).cast("bigint")


def pct_text(rate) -> Column:
    """A ratio as ``12.34%`` text (two decimals)."""
    return F.format_string("%.2f%%", F.round(col_of(rate).cast("double") * F.lit(100.0), 2))


def delta_text(cur, prev) -> Column:
    """SC28: day-over-day change as ``+x.xx%``; previous 0 -> ``前日为0``."""
    c = F.coalesce(col_of(cur).cast("double"), F.lit(0.0))
    p = F.coalesce(col_of(prev).cast("double"), F.lit(0.0))
    sign = F.when(c >= p, F.lit("+")).otherwise(F.lit(""))
    body = F.format_string("%.2f%%", F.round((c - p) / p * F.lit(100.0), 2))
    return F.when(p == F.lit(0.0), F.lit("前日为0")).otherwise(F.concat(sign, body))

