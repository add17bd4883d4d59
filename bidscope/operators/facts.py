"""Response-grain fact and its building blocks (JN1-JN5, AG6-AG9, AG13, WN1, WN2).

Scale notes
-----------
* Every event table is read through ``day_window`` so the time range reaches
  the scan (parquet ``PushedFilters`` / JDBC WHERE).
* Wins and clicks are unioned into one narrow frame and grouped once by
  ``(response_id, bid_seat_id)``; page tracks are grouped by the same pair and joined.
* Dimensions are joined without hints: Catalyst's statistics and AQE's measured
  shuffle sizes decide between broadcast and shuffle joins, and AQE splits the
  partitions of hot (for example blank) ids on the left side of the joins.
* Rows of blank apps are spread when the app names are joined (``app_key``): no task gets them all. Names of apps are joined
  to the requests, those of creatives and strategies last: a shuffle of the responses moves no long text that a later join can add.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.exprs import (
    ad_slot, app_label, blank_to, direct_jump, flag, geo_region, label_chain,
    order_strategy_creative, page_id, price_bucket, target_group, track_key, wpr_value,
)
from bidscope.plans.request import EMPTY_APP_LABEL, GEO_MISSING_LABEL, FunnelRequest, Rules
from bidscope.sources.tables import FunnelSources, day_window

PAIR = ["response_id", "bid_seat_id"]

# Page-track event codes behind each per-visit flag.
TRACK_FLAGS = {
    "page_exp": ("pageExp",),
    "complete": ("pageViewComplete",),
    "scroll": ("scrollStart", "scrollEnd"),
    "video": ("vidPlay", "vidPause"),
    "jump": ("jumpButton",),
    "load_fail": ("pageLoadFail", "pageLoadTimeout"),
}
# White space in the sense of Unicode, which the reference strips from mapping names.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WIDE_FLAGS = ("page_exp", "complete", "scroll", "video", "jump")
# Columns of the wide fact in their order, without those derived of them.
WIDE_COLUMNS = ("response_time", "request_time", "hour", "app_bundle", "app_name", "geo_city", "geo_region", "geo_lat", "geo_lon",
                "imp_bidfloor", "imp_adviewtype", "imp_adlocation", "imp_templateid", "ad_slot", "response_id", "bid_seat_id",
                "bid_price", "order_id", "strategy_id", "creative_id", "order_name", "strategy_name", "creative_name",
                "material_id", "material_type", "land_page", "curl", "dpl_url", "win", "spend_raw", "click", "page_id", *WIDE_FLAGS)


def track_keys(events: DataFrame, rules: Rules = Rules(), *extra) -> DataFrame:
    """SC2/SC3: (response_id, bid_seat_id) of each page event, its page id, code and ``extra`` columns."""
    attrs = F.col("preset_attributes")
    return events.select(
        track_key(attrs, rules.rid_pattern, "root_id").alias("response_id"),
        track_key(attrs, rules.pyck_pattern, "parent_event_id").alias("bid_seat_id"),
        page_id(attrs, rules.page_id_pattern).alias("page_id"),
        F.col("event_code"), *extra,
    )


def tracks_by_key(keys: DataFrame, flags=WIDE_FLAGS, with_page: bool = True) -> DataFrame:
    """AG7/AG8: per-pair event flags (max of 1/0) and the string-max page id."""
    aggs = [F.max(flag("event_code", TRACK_FLAGS[f])).alias(f) for f in flags]
    if with_page:
        aggs.insert(0, F.max("page_id").alias("page_id"))
    return keys.groupBy(*PAIR).agg(*aggs)


def click_pairs(clicks: DataFrame) -> DataFrame:
    """AG9: distinct (click day, response_id, bid_seat_id)."""
    return clicks.select(F.to_date("response_time").alias("d"), *PAIR).distinct()


def wins_by_key(results: DataFrame) -> DataFrame:
    """AG6: win rows and summed ``wpr`` per pair."""
    return results.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("win"),
                                      F.sum(wpr_value("wpr")).alias("spend_raw"))


def clicks_by_key(clicks: DataFrame) -> DataFrame:
    """AG6: click rows per pair."""
    return clicks.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("click"))


def events_by_pair(src: FunnelSources, start: dt.date, days: int, rules: Rules = Rules(),
                   flags=WIDE_FLAGS, with_page: bool = True) -> DataFrame:
    """Wins, clicks and page-track flags of each pair in ``[start, start+days)``.

    Wins, clicks and track flags share one union and one ``groupBy``. Page ids are text, whose
    maximum sorts: with them, tracks are grouped apart by the same pair and joined. With the
    click rule only the tracks of pairs with a click count, so clicks are read once for both.
    """
    flag_cols = list(flags)
    wins = day_window(src.bid_result, "response_time", start, days).select(
        *PAIR, F.lit(1).alias("w"), wpr_value("wpr").alias("s"))
    clicks = day_window(src.bid_click, "response_time", start, days).select(*PAIR, F.lit(1).alias("c"))
    tracks = track_keys(day_window(src.track_event, "event_time", start, days), rules)
    # Keys that are missing match no response.
    tracks = tracks.filter(F.col("response_id").isNotNull() & F.col("bid_seat_id").isNotNull())
    rows = wins.unionByName(clicks, allowMissingColumns=True)
    sums = [F.count("w").alias("win"), F.sum("s").alias("spend_raw"), F.count("c").alias("click")]
    need_click = rules.landing_page_requires_click
    if with_page:
        # Without the click rule a pair may have tracks only.
        seen = tracks_by_key(tracks, flag_cols)
        if src.buckets:
            seen = seen.repartition(src.buckets, "response_id")     # to the stored wins and clicks, which stay
        agg = rows.groupBy(*PAIR).agg(*sums).join(seen, PAIR, "left" if need_click else "full")
    else:
        seen = tracks.select(*PAIR, *[flag("event_code", TRACK_FLAGS[f]).alias(f) for f in flag_cols])
        agg = rows.unionByName(seen, allowMissingColumns=True).groupBy(*PAIR).agg(*sums, *[F.max(f).alias(f) for f in flag_cols])

    def counted(c: str) -> Column:
        return F.when(F.col("click") > 0, F.col(c)) if need_click else F.col(c)

    out = [*PAIR, F.coalesce(F.col("win"), F.lit(0)).alias("win"),
           F.coalesce(F.col("spend_raw"), F.lit(0.0)).alias("spend_raw"),
           F.coalesce(F.col("click"), F.lit(0)).alias("click")]
    out += [F.coalesce(counted(f), F.lit(0)).alias(f) for f in flag_cols]
    if with_page:
        out.append(counted("page_id").alias("page_id"))
    return agg.select(*out)


def latest_strategy(dim: DataFrame) -> DataFrame:
    """AG13/WN1: newest row per strategy by ``etl_time`` (ties broken by name)."""
    w = Window.partitionBy("strategy_id").orderBy(
        F.col("etl_time").desc_nulls_last(), F.col("strategy_name").asc_nulls_first(),
        F.col("order_name").asc_nulls_first(), F.col("order_id").asc_nulls_first())
    return (dim.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("strategy_id", "strategy_name", "order_id", "order_name"))


def strategy_max_name(dim: DataFrame) -> DataFrame:
    """AG14: one name per strategy as the string maximum (final basic gantt)."""
    return dim.groupBy("strategy_id").agg(F.max("strategy_name").alias("strategy_name"))


def app_names(mapping: DataFrame) -> DataFrame:
    """WN2: one app name per package: verified, then request count, then etl_time (all desc).

    White space around names is cut off, blank package or name rows are dropped;
    unparseable numbers rank as 0.
    """
    m = mapping.select(
        F.btrim(F.coalesce(F.col("app_package_name").cast("string"), F.lit("")), F.lit(WHITE_SPACE)).alias("app_package_name"),
        F.btrim(F.coalesce(F.col("app_name").cast("string"), F.lit("")), F.lit(WHITE_SPACE)).alias("app_name"),
        F.coalesce(F.col("is_verified").cast("string").try_cast("double"), F.lit(0.0)).alias("v"),
        F.coalesce(F.col("request_count").cast("string").try_cast("double"), F.lit(0.0)).alias("rc"),
        F.col("etl_time").cast("string").alias("etl_time"),
    ).filter((F.col("app_package_name") != "") & (F.col("app_name") != ""))
    w = Window.partitionBy("app_package_name").orderBy(
        F.col("v").desc(), F.col("rc").desc(), F.col("etl_time").desc_nulls_last(), F.col("app_name").asc())
    return (m.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("app_package_name", "app_name"))


def app_key(bundle: str, *spread: str) -> Column:
    """The label of an app as a join key; blank apps, often the most frequent ones, have keys of many values that
    no package has (of the ``spread`` columns), so that their rows are dealt over all tasks."""
    label = app_label(bundle)
    return F.when(label != F.lit(EMPTY_APP_LABEL), label).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64(*spread).cast("string")))


def creative_key(creative_id: str) -> Column:
    """What a response's creative is looked up by."""
    return F.trim(F.col(creative_id))


def scope_order(responses: DataFrame, order_id: int | None) -> DataFrame:
    """FLT1: restrict responses to one order; no-op without an order."""
    return responses if order_id is None else responses.filter(F.col("order_id") == F.lit(int(order_id)))


def day_responses(src: FunnelSources, req: FunnelRequest) -> DataFrame:
    return scope_order(day_window(src.bid_response, "response_time", req.day, 1), req.order_id)


def wide_fact(src: FunnelSources, req: FunnelRequest, rules: Rules = Rules()) -> DataFrame:
    """One row per bid response of the day with request, win, click, track and dims.

    Duplicate response keys keep their duplicates (and each copy carries the
    pair's wins, clicks and spend), as in the reference.  Sources stored by response id are
    joined part by part: the buckets without a shuffle, the hot ids with one.
    """
    return with_dimensions(fact_events(src, req, rules), src, rules)


def fact_events(src: FunnelSources, req: FunnelRequest, rules: Rules = Rules()) -> DataFrame:
    """JN1-JN3, JN12: one row per bid response of the day with its request, app, wins, clicks and tracks.

    What later columns need of long texts is worked out before the shuffles, so that readers which do
    not show the texts do not move them.
    """
    return reduce(DataFrame.unionByName, [_events_part(part, req, rules) for part in src.by_id()])


def _named(requests: DataFrame, names: DataFrame, buckets: int) -> DataFrame:
    """WN2: the mapped name of ``app_bundle`` (labels) as ``_m_name``; null for blank apps and those without a name.

    Requests stored in ``buckets`` of their id stay there: the names go to them, by way of their few columns.
    """
    if not buckets:
        j = requests.join(names, app_key("app_bundle", "response_id", "bid_imp_id", "request_time") == F.col("_m_pkg"), "left")
        return j.withColumn("_m_name", F.when(F.col("app_bundle") != F.lit(EMPTY_APP_LABEL), F.col("_m_name"))).drop("_m_pkg")
    keys = ["response_id", "bid_imp_id", "app_bundle"]
    asked = requests.filter(F.col("app_bundle") != F.lit(EMPTY_APP_LABEL)).select(*keys).distinct()
    known = asked.join(names, F.col("app_bundle") == F.col("_m_pkg")).select(*keys, "_m_name").repartition(buckets, "response_id")
    return requests.join(known, keys, "left")


def _events_part(src: FunnelSources, req: FunnelRequest, rules: Rules) -> DataFrame:
    r = day_responses(src, req).select(
        "response_id", "bid_seat_id", "bid_imp_id", "response_time", "bid_price", "order_id",
        "strategy_id", "creative_id", "land_page", "curl", "dpl_url", direct_jump("land_page", "curl", F.lit(0)).alias("_direct"))
    names = app_names(src.app_mapping).withColumnsRenamed(
        {"app_package_name": "_m_pkg", "app_name": "_m_name"})
    # the blank app's name, if the mapping has one
    blank_name = names.filter(F.col("_m_pkg") == F.lit(EMPTY_APP_LABEL)).select(F.max("_m_name")).scalar()
    # requests under the names of the response columns that they match
    q = day_window(src.bid_request, "request_time", req.day, 1).select(
        F.col("request_id").alias("response_id"), F.col("imp_id").alias("bid_imp_id"), "request_time",
        F.hour("request_time").alias("hour"), app_label("app_bundle").alias("app_bundle"),
        "imp_bidfloor", "geo_city", "geo_lat", "geo_lon", geo_region("geo_lat", "geo_lon", rules.wuhan_box).alias("_region"),
        "imp_adviewtype", "imp_adlocation", "imp_templateid")
    # requests are fewer and shorter than responses with all that is joined to them, so apps are named here
    q = _named(q, names, src.buckets).withColumnsRenamed({"response_id": "_q_id", "bid_imp_id": "_q_imp"})
    ev = events_by_pair(src, req.day, 1, rules).withColumnsRenamed(
        {"response_id": "_e_id", "bid_seat_id": "_e_seat"})

    w = r.join(q, (F.col("response_id") == F.col("_q_id")) & (F.col("bid_imp_id") == F.col("_q_imp")), "left")
    w = w.join(ev, (F.col("response_id") == F.col("_e_id")) & (F.col("bid_seat_id") == F.col("_e_seat")), "left")
    w = w.withColumn("app_bundle", F.coalesce("app_bundle", F.lit(EMPTY_APP_LABEL)))
    name = F.when(F.col("app_bundle") == F.lit(EMPTY_APP_LABEL), blank_name).otherwise(F.col("_m_name"))
    return w.select(
        "response_time", "request_time", "hour", "app_bundle", F.coalesce(name, "app_bundle").alias("app_name"),
        "geo_city", F.coalesce("_region", F.lit(GEO_MISSING_LABEL)).alias("geo_region"),
        "geo_lat", "geo_lon", "imp_bidfloor", "imp_adviewtype", "imp_adlocation", "imp_templateid",
        "response_id", "bid_seat_id", "bid_price", "order_id", "strategy_id", "creative_id", "land_page", "curl", "dpl_url", "_direct",
        F.coalesce(F.col("win"), F.lit(0)).alias("win"),
        F.coalesce(F.col("spend_raw"), F.lit(0.0)).alias("spend_raw"),
        F.coalesce(F.col("click"), F.lit(0)).alias("click"),
        F.coalesce(F.col("page_id"), F.lit("")).alias("page_id"),
        *[F.coalesce(F.col(f), F.lit(0)).alias(f) for f in WIDE_FLAGS])


def with_dimensions(events: DataFrame, src: FunnelSources, rules: Rules = Rules(), strategies: DataFrame | None = None) -> DataFrame:
    """JN4, JN5: the wide fact of ``fact_events`` or of those of its columns that a reader kept.
    ``strategies``: their newest rows, if a caller has them.

    Names are long and come last. Creatives are joined before strategies, which are few and broadcast.
    """
    strat = (latest_strategy(src.dim_strategy) if strategies is None else strategies).select(
        F.col("strategy_id").alias("_s_id"), F.col("strategy_name").alias("_s_strategy_name"),
        F.col("order_name").alias("_s_order_name"))
    crea = src.dim_creative.select(
        F.col("creative_id").cast("string").alias("_d_id"), F.col("creative_name").alias("_d_creative_name"),
        F.col("order_name").alias("_d_order_name"), F.col("strategy_name").alias("_d_strategy_name"),
        "material_id", "material_type")
    w = events.join(crea, creative_key("creative_id") == F.col("_d_id"), "left")
    w = w.join(strat, F.col("strategy_id") == F.col("_s_id"), "left")

    made = {
        "geo_city": blank_to("geo_city", GEO_MISSING_LABEL),
        "ad_slot": ad_slot("imp_adviewtype", rules.ad_slot_names),
        "order_name": label_chain("_s_order_name", "_d_order_name", "order_id"),
        "strategy_name": label_chain("_s_strategy_name", "_d_strategy_name", "strategy_id"),
        "creative_name": label_chain("_d_creative_name", "creative_id"),
    }
    derived = {
        "spend_yuan": F.col("spend_raw") / F.lit(float(rules.spend_divisor)),
        "order_strategy_creative": order_strategy_creative("order_name", "strategy_name", "creative_name"),
        "direct_jump": F.when(F.col("page_exp") == F.lit(0), F.col("_direct")).otherwise(F.lit(0)),
        "target_group": target_group("strategy_id", rules.target_strategy_ids),
        "price_bucket": price_bucket("bid_price", rules.price_bounds, rules.price_labels),
    }
    added = {"ad_slot", "order_name", "strategy_name", "creative_name", "material_id", "material_type"}
    kept = [c for c in WIDE_COLUMNS if c in events.columns or c in added]
    first = w.select(*[made[c].alias(c) if c in made else F.col(c) for c in kept], "_direct")
    return first.withColumns(derived).drop("_direct")


def hour_bin(time: Column) -> Column:
    """The hour of a time without a zone, counted from 1970."""
    return (F.unix_date(time.cast("date")) * F.lit(24) + F.hour(time)).cast("bigint")


def answered_bins(responses: DataFrame) -> DataFrame:
    """Responses as time bins of their request keys: one row for each (response_id, bid_imp_id) with a map
    from hour bins to their (least, greatest) response time.

    Hours are combined map-side first, so a hot id is one row a task and hour, and its map
    has no more entries than the scanned window has hours.
    """
    hours = responses.groupBy("response_id", "bid_imp_id", hour_bin(F.col("response_time")).alias("_bin")).agg(
        F.min("response_time").alias("least"), F.max("response_time").alias("greatest")).filter(F.col("_bin").isNotNull())
    return hours.groupBy(F.col("response_id").alias("_r_id"), F.col("bid_imp_id").alias("_r_imp")).agg(
        F.map_from_entries(F.collect_list(F.struct("_bin", F.struct("least", "greatest")))).alias("_bins"))


def order_requests(requests: DataFrame, responses: DataFrame, order_id: int | None) -> DataFrame:
    """JN6: requests with a response of the order within one day after the request.

    The responses of each key are reduced to hour bins (``answered_bins``) before the left-semi
    join, so a request reads one row of its key, however often the id is on either side, and
    probes 25 bins of it: any response of the 23 whole hours in between counts, in the request's
    own hour the greatest time must not be before it, and in the same hour of the next day the least
    must be before the day's end. Without an order it is a no-op; ``responses`` are those of a
    bounded window.
    """
    if order_id is None:
        return requests
    bins = answered_bins(scope_order(responses, order_id))
    asked = hour_bin(F.col("request_time"))
    until = F.timestamp_add("DAY", F.lit(1), F.col("request_time"))
    same = (F.col("request_id") == F.col("_r_id")) & (F.col("imp_id") == F.col("_r_imp"))
    answered = (F.arrays_overlap(F.map_keys("_bins"), F.sequence(asked + 1, asked + 23))
                | F.coalesce(F.try_element_at("_bins", asked)["greatest"] >= F.col("request_time"), F.lit(False))
                | F.coalesce(F.try_element_at("_bins", asked + 24)["least"] < until, F.lit(False)))
    return requests.join(bins, same & answered, "left_semi")


def day_requests(src: FunnelSources, req: FunnelRequest) -> DataFrame:
    """Requests of the day, order-limited through JN6 when the request has an order."""
    if req.order_id is None:
        return day_window(src.bid_request, "request_time", req.day, 1)
    # a request of the day can only match responses in [day, day + 2)
    return reduce(DataFrame.unionByName, [
        order_requests(day_window(part.bid_request, "request_time", req.day, 1),
                       day_window(part.bid_response, "response_time", req.day, 2), req.order_id) for part in src.by_id()])
