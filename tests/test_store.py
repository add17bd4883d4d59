"""Tables stored by response id: the parts, the plans without a shuffle, equal results."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from bidscope.operators.daily import daily_kpi
from bidscope.operators.facts import day_requests, wide_fact
from bidscope.plans.context import ReportContext
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.plans import bidding
from bidscope.sources.fixture import TEST_DAY, TEST_ORDER
from bidscope.sources.schema import SCHEMAS
from bidscope.sources.store import STORE_KEYS, EventStore, buckets_for, drop_event_store, hot_ids, load_event_store, write_event_store
from bidscope.sources.tables import FunnelSources
from tests.test_differential import tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    return EventStore("default", str(tmp_path_factory.mktemp("store")), buckets=4, hot_rows=6, prefix=f"t{uuid.uuid4().hex}_")


@pytest.fixture(scope="module")
def stored(spark, src_small, store):
    write_event_store(src_small, store)
    yield load_event_store(spark, store, src_small)
    drop_event_store(spark, store)


def test_parts_hold_every_row_once(stored, src_small):
    hot = {r.id for r in hot_ids(src_small, EventStore("default", "", hot_rows=6)).collect()}
    assert hot and hot == {r.response_id for r in stored.parts[1].bid_response.select("response_id").distinct().collect()}
    for name, key in STORE_KEYS.items():
        assert rows(getattr(stored, name).select(key)) == rows(getattr(src_small, name).select(key))
        assert stored.parts[0].__getattribute__(name).filter(F.col(key).isin(list(hot))).count() == 0
    assert stored.track_event.count() == src_small.track_event.count()


def _children(node):
    """Children of a physical node; a finished stage stands for its plan."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return [node.executedPlan()]
    if node.nodeName().endswith("QueryStage"):
        return [node.plan()]
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def shuffles_up_to_join(plan, column: str) -> list[tuple[int, int]]:
    """For each scan of a table with ``column``: (shuffles, joins) between it and the joins by id, dimensions left out."""
    found = []

    def walk(node, shuffles, joins):
        name = node.nodeName()
        if name.startswith("Scan"):
            if column in node.toString():
                found.append((shuffles, joins))
            return
        if "Join" in name:
            text = node.toString().split("\n")[0]
            if "response_id" in text:      # a join by id: shuffles above it are the dimensions'
                shuffles, joins = 0, joins + 1
        if name == "Exchange":
            shuffles += 1
        for child in _children(node):
            walk(child, shuffles, joins)

    walk(plan, 0, 0)
    return found


def _ran(spark, df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan()


def test_buckets_join_without_a_shuffle(spark, stored, src_small):
    """On the buckets the joins by id shuffle neither responses nor requests, wins or clicks; without them they do."""
    req = FunnelRequest(TEST_DAY)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # event tables are no broadcasts
    try:
        for src, shuffled in ((stored.parts[0], False), (stored.parts[1], True)):
            plan = _ran(spark, wide_fact(src, req))
            for column in ("bid_price", "imp_adviewtype", "wpr"):
                seen = shuffles_up_to_join(plan, column)
                assert seen and all(joins for _, joins in seen)
                assert all((n > 0) == shuffled for n, _ in seen), (column, seen)
            assert ("Bucketed: true" in plan.toString()) == (not shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("order", [None, TEST_ORDER])
def test_same_fact_and_kpi(stored, src_small, order):
    req = FunnelRequest(TEST_DAY, "bidding", order)
    assert rows(wide_fact(stored, req)) == rows(wide_fact(src_small, req))
    assert rows(daily_kpi(stored, req, Rules(), "all")) == rows(daily_kpi(src_small, req, Rules(), "all"))
    assert rows(day_requests(stored, req).select(src_small.bid_request.columns)) == rows(day_requests(src_small, req))


def test_random_rows_with_null_blank_and_hot_ids(spark, tmp_path):
    """An id that holds a third of the rows, null and blank ids: hot in all tables together."""
    data = tables(3)
    src = FunnelSources(**{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in data.items()})
    store = EventStore("default", str(tmp_path), buckets=3, hot_rows=10, prefix=f"r{uuid.uuid4().hex}_")
    write_event_store(src, store)
    stored = load_event_store(spark, store, src)
    assert stored.parts[1].bid_response.filter("response_id IS NULL").count() + stored.parts[1].bid_response.filter("response_id = '7'").count() > 40
    for order in (None, TEST_ORDER):
        req = FunnelRequest(TEST_DAY, "bidding", order)
        assert rows(wide_fact(stored, req)) == rows(wide_fact(src, req))
        a, b = ReportContext(stored, req), ReportContext(src, req)
        for name in ("bid_kpi", "bid_app", "gantt_bid_price"):
            assert rows(bidding.TABLES[name](a)) == rows(bidding.TABLES[name](b)), name
    drop_event_store(spark, store)
    assert not list(tmp_path.iterdir())


def test_buckets_grow_with_the_tables(spark, src_small):
    """Buckets hold about ``rows`` rows of the largest table, whichever it is; small and empty tables have ``least``."""
    empty = src_small.replace(**{n: getattr(src_small, n).limit(0) for n in STORE_KEYS})
    assert buckets_for(empty, 8) == 8
    for name in STORE_KEYS:
        table = spark.range(1001).select(F.col("id").cast("string").alias(STORE_KEYS[name]))
        src = empty.replace(**{name: table})
        assert [buckets_for(src, 8, rows) for rows in (1001, 100, 10)] == [8, 11, 101], name


def test_empty_tables(spark, src_small, tmp_path):
    src = src_small.replace(**{n: getattr(src_small, n).limit(0) for n in (*STORE_KEYS, "track_event")})
    store = EventStore("default", str(tmp_path), buckets=2, prefix=f"e{uuid.uuid4().hex}_")
    write_event_store(src, store)
    assert wide_fact(load_event_store(spark, store, src_small), FunnelRequest(dt.date(2024, 1, 2))).count() == 0
    drop_event_store(spark, store)
