"""Sources: the mapping's CSV dialect, the reject ledger, retries of planned reads, interval bins, distinct strategies."""

import datetime as dt
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from bidscope.operators.daily import daily_kpi
from bidscope.operators.facts import answered_bins, app_names, order_requests
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.app_mapping import load_app_mapping, read_mapping
from bidscope.sources.rejects import LEDGER_SCHEMA, RejectedValues, check_rejects, reject_ledger
from bidscope.sources.retry import lost_connection, with_retry
from bidscope.sources.schema import SCHEMAS
from bidscope.sources.tables import TableSource, load_sources, load_table
from tests.test_semantics import tiny

DAY = dt.date(2024, 1, 2)
T = dt.datetime


# ---- mapping CSV --------------------------------------------------------------------------------------------------

def _csv(spark, tmp_path, text: str, bom: bool = True):
    path = tmp_path / "mapping.csv"
    path.write_bytes(("﻿" if bom else "").encode() + text.encode())
    return str(path)


def test_quoted_fields(spark, tmp_path):
    path = _csv(spark, tmp_path, 'app_package_name,app_name,is_verified,request_count,etl_time\n'
                '"com.a","My ""Best"" App, v2",1,10,2024-01-01\n'
                'com.b,"two\nlines",0,5,2024-01-01\r\n'
                'com.c,"",1,1,2024-01-01\n'
                'com.d,plain "inner" quotes,1,1,2024-01-01\n')
    rows = {r.app_package_name: r for r in load_app_mapping(spark, path).collect()}
    assert rows["com.a"].app_name == 'My "Best" App, v2' and rows["com.a"].is_verified == "1" and rows["com.a"].etl_time == "2024-01-01"
    assert rows["com.b"].app_name == "two\nlines" and rows["com.b"].request_count == "5"
    assert not rows["com.c"].app_name and rows["com.d"].app_name == 'plain "inner" quotes'
    assert {r.app_package_name for r in app_names(load_app_mapping(spark, path)).collect()} == {"com.a", "com.b", "com.d"}


def test_white_space_and_missing_texts(spark, tmp_path):
    path = _csv(spark, tmp_path, 'app_name,app_package_name\n　App A\t, com.a \nNA,com.b\nnull,com.c\n NA ,com.d\nApp E,nan\n   ,com.f\n', bom=False)
    assert {(r.app_package_name, r.app_name) for r in app_names(load_app_mapping(spark, path)).collect()} == {("com.a", "App A"), ("com.d", "NA")}


def test_quoted_header_after_the_mark(spark, tmp_path):
    path = _csv(spark, tmp_path, '"app_package_name","app_name"\ncom.a,A\n')
    assert [tuple(r)[:2] for r in load_app_mapping(spark, path).collect()] == [("com.a", "A")]


def test_rows_of_a_wrong_length(spark, tmp_path):
    path = _csv(spark, tmp_path, "app_package_name,app_name,is_verified\ncom.a,A,1\ncom.b,B\ncom.c,C,1,extra\n")
    bad = read_mapping(spark, path).filter("_corrupt_record IS NOT NULL").collect()
    assert {r.app_package_name for r in bad} == {"com.b", "com.c"}
    assert {r.app_package_name for r in load_app_mapping(spark, path).collect()} == {"com.a", "com.b", "com.c"}
    with pytest.raises(ValueError, match="wrong number of fields"):
        load_app_mapping(spark, path, strict=True)


# ---- reject ledger ------------------------------------------------------------------------------------------------

def _texts(spark, rows):
    return spark.createDataFrame(rows, "response_id string, bid_seat_id string, bid_imp_id string, response_time string, bid_price string, "
                                 "order_id string, strategy_id bigint, creative_id string, land_page string, curl string")


BROKEN = [("r1", "s", "1", "2024-01-02 03:00:00", "1.5", "218", 195, "1", "", "c"),
          ("r2", "s", "1", "not a time", "1.5", "218", 195, "1", "", "c"),
          ("r3", "s", "1", "2024-01-02 04:00:00", "", "o-218", 195, "1", "", "c"),
          ("r4", "s", "1", "2024-01-05 04:00:00", "x", "o-219", 195, "1", "", "c"),
          ("r5", "s", "1", None, None, None, None, None, None, None)]


def test_bad_order_id_and_bad_time(spark):
    ledger = reject_ledger({"bid_response": _texts(spark, BROKEN)})
    assert ledger.schema.simpleString() == f"struct<{LEDGER_SCHEMA.replace(' bigint', ':bigint').replace(' string', ':string').replace(', ', ',')}>"
    got = {r.column: (r.stored, r.declared, r.filled, r.rejected) for r in ledger.collect()}
    assert got == {"response_time": ("string", "timestamp_ntz", 4, 1), "bid_price": ("string", "double", 3, 1), "order_id": ("string", "bigint", 4, 2)}
    in_day = {r.column: (r.filled, r.rejected) for r in reject_ledger({"bid_response": _texts(spark, BROKEN)}, (DAY, 1)).collect()}
    assert in_day == {"response_time": (3, 1), "bid_price": (2, 0), "order_id": (3, 1)}
    with pytest.raises(RejectedValues, match="bid_response.order_id: 2 of 4 values are no bigint"):
        check_rejects(ledger, 0.25)
    assert len(check_rejects(ledger, 0.5)) == 3


def test_tables_in_their_types_are_not_read(spark, src_small):
    assert reject_ledger({"bid_response": src_small.bid_response, "dim_strategy": src_small.dim_strategy}).collect() == []
    empty = reject_ledger({"bid_response": _texts(spark, [])}).collect()
    assert [(r.filled, r.rejected) for r in empty] == [(0, 0)] * 3 and check_rejects(reject_ledger({"bid_response": _texts(spark, [])}), 0.0)


def test_loading_with_a_limit(spark, tmp_path):
    src = tiny(spark)
    for name in SCHEMAS:
        getattr(src, name).write.parquet(str(tmp_path / name))
    _texts(spark, BROKEN).write.mode("overwrite").parquet(str(tmp_path / "bid_response"))
    source = TableSource("parquet", str(tmp_path))
    assert load_sources(spark, source).bid_response.filter("order_id IS NULL").count() == 3      # unseen, as reports need it
    with pytest.raises(RejectedValues, match="order_id"):
        load_sources(spark, source, window=(DAY, 1), reject_limit=0.0)
    assert load_sources(spark, source, window=(DAY, 1), reject_limit=0.5).bid_response.count() == 5


def test_a_day_column_that_is_not_there(spark, src_small, tmp_path):
    src_small.bid_click.write.parquet(str(tmp_path / "bid_click"))
    with pytest.raises(ValueError, match="bid_click lacks the columns .*'dt'"):
        load_table(spark, "bid_click", TableSource("parquet", str(tmp_path), day_column="dt"))


# ---- retries ------------------------------------------------------------------------------------------------------

class Reader:
    def __init__(self, *errors):
        self.errors, self.calls = list(errors), 0

    def __call__(self):
        self.calls += 1
        if self.errors:
            raise self.errors.pop(0)
        return "frame"


def test_a_reader_that_fails_twice():
    waits: list[float] = []
    reader = Reader(ConnectionResetError(), ConnectionResetError())
    assert with_retry(reader, 3, sleep=waits.append) == "frame" and reader.calls == 3 and waits == [2, 4]
    reader = Reader(*[ConnectionResetError() for _ in range(6)])
    with pytest.raises(ConnectionResetError):
        with_retry(reader, 5, sleep=waits.append)
    assert reader.calls == 5 and waits[2:] == [2, 4, 8, 8]
    reader = Reader(ValueError("no such table"))
    with pytest.raises(ValueError):
        with_retry(reader, sleep=waits.append)
    assert reader.calls == 1


def test_which_errors_are_a_lost_connection(spark):
    jvm = spark._jvm
    def raised(cause):
        outer = jvm.java.lang.RuntimeException("while planning", cause)
        return Py4JJavaError("An error occurred", outer)
    sql = jvm.java.sql.SQLException
    assert lost_connection(raised(sql("gone", "HY000", 2006))) and lost_connection(raised(sql("lost", "HY000", 2013)))
    assert lost_connection(raised(jvm.java.sql.SQLNonTransientConnectionException("link", "08S01", 0)))
    assert not lost_connection(raised(sql("denied", "28000", 1045))) and not lost_connection(raised(sql("no state")))
    assert not lost_connection(raised(jvm.java.io.IOException("disk"))) and not lost_connection(ValueError("x"))


def test_a_missing_driver_is_raised_at_once(spark):
    waits: list[float] = []
    with pytest.raises(Exception) as error:
        load_table(spark, "dim_strategy", TableSource("jdbc", "jdbc:mysql://127.0.0.1:1/db", options={"driver": "no.such.Driver"}))
    assert not lost_connection(error.value) and not waits


# ---- JN6 by bins --------------------------------------------------------------------------------------------------

def _brute(requests, responses):
    day = dt.timedelta(days=1)
    return sorted(q for q in requests if q[0] is not None and q[1] is not None
                  and any(r[0] == q[0] and r[1] == q[1] and r[2] is not None and q[2] is not None and q[2] <= r[2] < q[2] + day for r in responses))


def test_bins_on_an_id_hot_on_both_sides(spark):
    """Times around hour and day bounds, one id in most rows; a request reads one row of at most 49 bins."""
    r = random.Random(7)
    start = T(2024, 1, 2)
    def times(n, days):
        return [start + dt.timedelta(hours=r.randrange(0, 24 * days), seconds=r.choice([0, 0, 1, 3599, 1800]), microseconds=r.choice([0, 0, 1, 999999])) for _ in range(n)]
    ids = ["hot"] * 6 + ["a", "b", "c", "", None]
    requests = [(r.choice(ids), r.choice(["1", "1", "2", None]), t) for t in times(400, 1)]
    responses = [(r.choice(["hot", "a", "b", "", None]), r.choice(["1", "2"]), t) for t in times(60, 2)]
    q = spark.createDataFrame(requests, "request_id string, imp_id string, request_time timestamp_ntz")
    a = spark.createDataFrame(responses, "response_id string, bid_imp_id string, response_time timestamp_ntz").withColumn("order_id", F.lit(218).cast("bigint"))
    got = sorted(tuple(x) for x in order_requests(q, a, 218).collect())
    want = _brute(requests, responses)
    assert got == want and 0 < len(want) < len(requests)
    bins = answered_bins(a).collect()
    assert len(bins) == len({(x[0], x[1]) for x in responses}) and max(len(b._bins) for b in bins) <= 49
    assert order_requests(q, a, 999).count() == 0 and order_requests(q, a, None).count() == len(requests)


def test_bins_at_the_bounds(spark):
    """The first instant counts, the last one does not; both of one bin without one between do not."""
    t = T(2024, 1, 2, 3, 30)
    def hit(*answers):
        q = spark.createDataFrame([("x", "1", t)], "request_id string, imp_id string, request_time timestamp_ntz")
        a = spark.createDataFrame([("x", "1", s, 1) for s in answers], "response_id string, bid_imp_id string, response_time timestamp_ntz, order_id bigint")
        return order_requests(q, a, 1).count() == 1
    day, tick = dt.timedelta(days=1), dt.timedelta(microseconds=1)
    assert hit(t) and hit(t + day - tick) and not hit(t - tick) and not hit(t + day)
    assert not hit(t - tick, t + day) and hit(t - tick, t + day, t + dt.timedelta(hours=5))
    assert not hit(t - dt.timedelta(minutes=30), t - tick) and hit(t + day - dt.timedelta(minutes=30), t + day + tick)


# ---- AG4 ----------------------------------------------------------------------------------------------------------

def test_distinct_strategies_and_hours(spark):
    ids = [None, 0, -1, -32768, 32767, 32768, 32769, 2 ** 62, 195, 195, None]
    resp = [(f"r{i}", "s", "1", T(2024, 1, 2, i % 5, i), 10.0 if i % 3 else None, 218, s, "1", "", "c", None) for i, s in enumerate(ids)]
    src = tiny(spark, bid_response=spark.createDataFrame(resp, SCHEMAS["bid_response"]))
    df = daily_kpi(src, FunnelRequest(DAY, "bidding"), Rules(), "bidding")
    row = df.filter(F.col("d") == F.lit(DAY)).first()
    assert (row.strategies, row.active_hours, row.bids) == (8, 5, 11)
    assert row.min_bid_price == row.max_bid_price == row.avg_bid_price == 10.0
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
