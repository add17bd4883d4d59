"""Maps the driver's TPC-H-like tables onto the eight funnel inputs.

Deterministic integer arithmetic only, so Spark and DuckDB derive identical
tables (the DuckDB form is ``FIXTURE_SQL`` below, used by the oracle).
Base time T0 = 2024-01-01 00:00:00 (no zone); ``ts(x) = T0 + x seconds``;
``sec = (orderkey * 7919) % 172800`` spreads rows over two days.  The test
day is 2024-01-02, the previous day 2024-01-01, the scoped order 218.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.sources.tables import FunnelSources, conform

TEST_DAY = dt.date(2024, 1, 2)
TEST_ORDER = 218

# Fixed values of the fixture (track event codes and their keep-modulus).
TRACK_CODES = (("pageExp", 2), ("pageViewComplete", 3), ("scrollStart", 5),
               ("vidPlay", 7), ("jumpButton", 11), ("pageLoadFail", 23))

_T0 = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


def _ts(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(_T0))


def _sec(orderkey: str) -> Column:
    return (F.col(orderkey) * F.lit(7919)) % F.lit(172800)


def _txt(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bid_request(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        _txt(k).alias("request_id"),
        F.when(k % 8 == 3, F.lit("2")).otherwise(F.lit("1")).alias("imp_id"),
        _ts(_sec("o_orderkey")).alias("request_time"),
        F.when(F.col("o_custkey") % 11 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("app."), _txt("o_custkey"))).alias("app_bundle"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("imp_bidfloor"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("city-"), _txt(k % 5))).alias("geo_city"),
        F.when(k % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(29.0) + (k % 40).cast("double") / F.lit(10.0)).alias("geo_lat"),
        (F.lit(113.0) + (k % 30).cast("double") / F.lit(10.0)).alias("geo_lon"),
        F.when(k % 5 == 0, F.lit(4)).when(k % 5 == 1, F.lit(5)).when(k % 5 == 2, F.lit(10))
         .when(k % 5 == 3, F.lit(7)).otherwise(F.lit(None).cast("int")).alias("imp_adviewtype"),
        F.concat(F.lit("loc-"), _txt(k % 3)).alias("imp_adlocation"),
        F.when(k % 6 != 0, F.concat(F.lit("t-"), _txt(k % 4))).alias("imp_templateid"),
    )


def _line_keys() -> list[Column]:
    return [_txt("l_orderkey").alias("response_id"), _txt("l_linenumber").alias("bid_seat_id")]


def _line_ts(extra: int) -> Column:
    return _ts(_sec("l_orderkey") + F.lit(60) * F.col("l_linenumber") + F.lit(extra))


def bid_response(lineitem: DataFrame) -> DataFrame:
    p = F.col("l_partkey")
    return lineitem.select(
        *_line_keys(),
        F.when((F.col("l_orderkey") % 8 == 3) & (F.col("l_linenumber") != 5), F.lit("2")).otherwise(F.lit("1")).alias("bid_imp_id"),
        _line_ts(0).alias("response_time"),
        F.when(p % 97 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(50.0) * F.col("l_quantity")).alias("bid_price"),
        (F.lit(211) + F.col("l_suppkey") % 10).alias("order_id"),
        (F.lit(190) + p % 60).alias("strategy_id"),
        F.concat(F.lit(" "), _txt(p), F.lit(" ")).alias("creative_id"),
        F.when(p % 4 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("https://lp.example/p/"), _txt(p % 12))).alias("land_page"),
        F.when(p % 3 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("https://click.example/c/"), _txt(p))).alias("curl"),
        F.when(p % 5 == 0, F.concat(F.lit("app://open/"), _txt(p))).alias("dpl_url"),
    )


def bid_result(lineitem: DataFrame) -> DataFrame:
    p = F.col("l_partkey")
    wpr = (F.when(p % 13 == 0, F.lit("")).when(p % 101 == 0, F.lit("n/a"))
           .otherwise(_txt((F.lit(1000.0) * F.col("l_quantity")).cast("bigint") + p)))
    return (lineitem.filter(F.col("l_returnflag").isin("A", "R"))
            .select(*_line_keys(), _line_ts(5).alias("response_time"), wpr.alias("wpr")))


def bid_click(lineitem: DataFrame) -> DataFrame:
    return (lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
            .select(*_line_keys(), _line_ts(30).alias("response_time")))


def track_event(lineitem: DataFrame) -> DataFrame:
    p = F.col("l_partkey")
    hit = [F.when((p + F.col("l_suppkey")) % m == 0, F.lit(code)) for code, m in TRACK_CODES]
    base = F.concat(F.lit('{"url":"https://lp.example/dragIndex/'), _txt(p % 12))
    with_keys = F.concat(base, F.lit("?rid="), _txt("l_orderkey"), F.lit("&pyck="),
                         _txt("l_linenumber"), F.lit('&z=1"}'))
    attrs = F.when(p % 9 == 0, F.concat(base, F.lit('"}'))).otherwise(with_keys)
    return (lineitem.filter(F.col("l_linestatus") == "F")
            .select(_line_ts(45).alias("event_time"), F.explode(F.array_compact(F.array(*hit))).alias("event_code"), attrs.alias("preset_attributes"),
                    _txt("l_orderkey").alias("root_id"), _txt("l_linenumber").alias("parent_event_id")))


def dim_strategy(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    sid = F.lit(190) + p % 60
    return (part.filter(p % 60 != 59)
            .select(sid.alias("strategy_id"),
                    F.concat(F.lit("strategy-"), _txt(sid), F.lit("-v"), _txt(F.floor(p / 60))).alias("strategy_name"),
                    F.concat(F.lit("order-"), _txt(F.col("p_size") % 10)).alias("order_name"),
                    (F.lit(211) + p % 10).alias("order_id"),
                    _ts(F.lit(60) * p).alias("etl_time")))


def dim_creative(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    return (part.filter(p % 20 != 19)
            .select(p.alias("creative_id"), F.col("p_name").alias("creative_name"),
                    F.concat(F.lit("c-order-"), _txt(p % 5)).alias("order_name"),
                    F.concat(F.lit("c-strategy-"), _txt(p % 7)).alias("strategy_name"),
                    F.concat(F.lit("m"), _txt(p % 8)).alias("material_id"),
                    F.col("p_type").alias("material_type")))


def app_mapping(customer: DataFrame) -> DataFrame:
    """Text columns, as read from the mapping CSV: current names for keys with
    k % 3 != 0, an older second version for k % 5 == 1, a blank name for k % 45 == 3."""
    k = F.col("c_custkey")
    pkg = F.concat(F.lit("app."), _txt(k))
    current = customer.filter(k % 3 != 0).select(
        pkg.alias("app_package_name"), F.concat(F.lit("App "), _txt(k)).alias("app_name"),
        F.when(k % 4 == 0, F.lit("yes")).otherwise(_txt(k % 2)).alias("is_verified"),
        _txt(k * 10).alias("request_count"),
        F.concat(F.lit("2024-01-01 00:00:"), F.lpad(_txt(k % 60), 2, "0")).alias("etl_time"))
    older = customer.filter((k % 5 == 1) & (k % 3 != 0)).select(
        pkg.alias("app_package_name"), F.concat(F.lit("App "), _txt(k), F.lit(" old")).alias("app_name"),
        F.lit("0").alias("is_verified"), _txt(k * 10 + 5).alias("request_count"),
        F.lit("2023-12-31 00:00:00").alias("etl_time"))
    blank = customer.filter(k % 45 == 3).select(
        pkg.alias("app_package_name"), F.lit("  ").alias("app_name"), F.lit("1").alias("is_verified"),
        F.lit("999").alias("request_count"), F.lit("2024-01-01 00:00:00").alias("etl_time"))
    return current.unionByName(older).unionByName(blank)


def fixture_sources(spark: SparkSession, sf_dir: str) -> FunnelSources:
    orders, lineitem = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    part, customer = _read(spark, sf_dir, "part"), _read(spark, sf_dir, "customer")
    return FunnelSources(
        bid_request=conform(bid_request(orders), "bid_request"),
        bid_response=conform(bid_response(lineitem), "bid_response"),
        bid_result=conform(bid_result(lineitem), "bid_result"),
        bid_click=conform(bid_click(lineitem), "bid_click"),
        track_event=conform(track_event(lineitem), "track_event"),
        dim_strategy=conform(dim_strategy(part), "dim_strategy"),
        dim_creative=conform(dim_creative(part), "dim_creative"),
        app_mapping=conform(app_mapping(customer), "app_mapping"),
    )


# The same eight tables as DuckDB views (CTE prelude of every oracle query).
_DT0 = "TIMESTAMP '2024-01-01 00:00:00'"
_OSEC = "((o_orderkey * 7919) % 172800)"
_LSEC = "((l_orderkey * 7919) % 172800)"
_CODES = ", ".join(f"('{c}', {m})" for c, m in TRACK_CODES)

FIXTURE_SQL: dict[str, str] = {
    "bid_request": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS request_id, CASE WHEN o_orderkey % 8 = 3 THEN '2' ELSE '1' END AS imp_id,
         {_DT0} + to_seconds({_OSEC}) AS request_time,
         CASE WHEN o_custkey % 11 = 0 THEN '' ELSE 'app.' || CAST(o_custkey AS VARCHAR) END AS app_bundle,
         o_totalprice / 1000.0::DOUBLE AS imp_bidfloor,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '' ELSE 'city-' || CAST(o_orderkey % 5 AS VARCHAR) END AS geo_city,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 29.0::DOUBLE + CAST(o_orderkey % 40 AS DOUBLE) / 10.0::DOUBLE END AS geo_lat,
         113.0::DOUBLE + CAST(o_orderkey % 30 AS DOUBLE) / 10.0::DOUBLE AS geo_lon,
         CAST(CASE o_orderkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 7 ELSE NULL END AS INTEGER) AS imp_adviewtype,
         'loc-' || CAST(o_orderkey % 3 AS VARCHAR) AS imp_adlocation,
         CASE WHEN o_orderkey % 6 <> 0 THEN 't-' || CAST(o_orderkey % 4 AS VARCHAR) END AS imp_templateid
  FROM orders""",
    "bid_response": f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS response_id, CAST(l_linenumber AS VARCHAR) AS bid_seat_id,
         CASE WHEN l_orderkey % 8 = 3 AND l_linenumber <> 5 THEN '2' ELSE '1' END AS bid_imp_id,
         {_DT0} + to_seconds({_LSEC} + 60 * l_linenumber) AS response_time,
         CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 50.0::DOUBLE * l_quantity END AS bid_price,
         CAST(211 + l_suppkey % 10 AS BIGINT) AS order_id,
         CAST(190 + l_partkey % 60 AS BIGINT) AS strategy_id,
         ' ' || CAST(l_partkey AS VARCHAR) || ' ' AS creative_id,
         CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'https://lp.example/p/' || CAST(l_partkey % 12 AS VARCHAR) END AS land_page,
         CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 'https://click.example/c/' || CAST(l_partkey AS VARCHAR) END AS curl,
         CASE WHEN l_partkey % 5 = 0 THEN 'app://open/' || CAST(l_partkey AS VARCHAR) END AS dpl_url
  FROM lineitem""",
    "bid_result": f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS response_id, CAST(l_linenumber AS VARCHAR) AS bid_seat_id,
         {_DT0} + to_seconds({_LSEC} + 60 * l_linenumber + 5) AS response_time,
         CASE WHEN l_partkey % 13 = 0 THEN '' WHEN l_partkey % 101 = 0 THEN 'n/a'
              ELSE CAST(CAST(1000.0 * l_quantity AS BIGINT) + l_partkey AS VARCHAR) END AS wpr
  FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
    "bid_click": f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS response_id, CAST(l_linenumber AS VARCHAR) AS bid_seat_id,
         {_DT0} + to_seconds({_LSEC} + 60 * l_linenumber + 30) AS response_time
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "track_event": f"""
  SELECT {_DT0} + to_seconds({_LSEC} + 60 * l_linenumber + 45) AS event_time, c.code AS event_code,
         CASE WHEN l_partkey % 9 = 0
              THEN '{{"url":"https://lp.example/dragIndex/' || CAST(l_partkey % 12 AS VARCHAR) || '"}}'
              ELSE '{{"url":"https://lp.example/dragIndex/' || CAST(l_partkey % 12 AS VARCHAR) || '?rid='
                   || CAST(l_orderkey AS VARCHAR) || '&pyck=' || CAST(l_linenumber AS VARCHAR) || '&z=1"}}' END AS preset_attributes,
         CAST(l_orderkey AS VARCHAR) AS root_id, CAST(l_linenumber AS VARCHAR) AS parent_event_id
  FROM lineitem, (VALUES {_CODES}) AS c(code, m)
  WHERE l_linestatus = 'F' AND (l_partkey + l_suppkey) % c.m = 0""",
    "dim_strategy": f"""
  SELECT CAST(190 + p_partkey % 60 AS BIGINT) AS strategy_id,
         'strategy-' || CAST(190 + p_partkey % 60 AS VARCHAR) || '-v' || CAST(p_partkey // 60 AS VARCHAR) AS strategy_name,
         'order-' || CAST(p_size % 10 AS VARCHAR) AS order_name,
         CAST(211 + p_partkey % 10 AS BIGINT) AS order_id,
         {_DT0} + to_seconds(60 * p_partkey) AS etl_time
  FROM part WHERE p_partkey % 60 <> 59""",
    "dim_creative": """
  SELECT CAST(p_partkey AS BIGINT) AS creative_id, p_name AS creative_name,
         'c-order-' || CAST(p_partkey % 5 AS VARCHAR) AS order_name,
         'c-strategy-' || CAST(p_partkey % 7 AS VARCHAR) AS strategy_name,
         'm' || CAST(p_partkey % 8 AS VARCHAR) AS material_id, p_type AS material_type
  FROM part WHERE p_partkey % 20 <> 19""",
    "app_mapping": """
  SELECT 'app.' || CAST(c_custkey AS VARCHAR) AS app_package_name, 'App ' || CAST(c_custkey AS VARCHAR) AS app_name,
         CASE WHEN c_custkey % 4 = 0 THEN 'yes' ELSE CAST(c_custkey % 2 AS VARCHAR) END AS is_verified,
         CAST(c_custkey * 10 AS VARCHAR) AS request_count,
         '2024-01-01 00:00:' || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS etl_time
  FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL
  SELECT 'app.' || CAST(c_custkey AS VARCHAR), 'App ' || CAST(c_custkey AS VARCHAR) || ' old', '0',
         CAST(c_custkey * 10 + 5 AS VARCHAR), '2023-12-31 00:00:00'
  FROM customer WHERE c_custkey % 5 = 1 AND c_custkey % 3 <> 0
  UNION ALL
  SELECT 'app.' || CAST(c_custkey AS VARCHAR), '  ', '1', '999', '2024-01-01 00:00:00'
  FROM customer WHERE c_custkey % 45 = 3""",
}


def fixture_prelude() -> str:
    """``WITH`` clause defining the eight fixture tables for DuckDB."""
    return "WITH " + ",\n".join(f"{name} AS ({sql}\n)" for name, sql in FIXTURE_SQL.items())
