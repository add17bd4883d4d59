"""What reports and stores keep on disk while they are written."""

import re
import time
import uuid

import pytest
from pyspark.sql import functions as F

from bidscope.operators.facts import wide_fact
from bidscope.plans import context, spend
from bidscope.plans.context import ReportContext
from bidscope.plans.report import build_report
from bidscope.plans.request import FunnelRequest
from bidscope.plans.together import shuffles_deleted
from bidscope.sources import store as store_module
from bidscope.sources.fixture import TEST_DAY
from bidscope.sources.schema import SCHEMAS
from bidscope.sources.store import STORE_KEYS, EventStore, buckets_for, drop_event_store, load_event_store, write_event_store
from bidscope.sources.tables import FunnelSources
from tests.test_differential import tables
from tests.test_store import _ran, rows, shuffles_up_to_join


@pytest.fixture(scope="module")
def random_sources(spark):
    return FunnelSources(**{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in tables(8).items()})


def shuffles_left(spark) -> set[str]:
    """Names of the shuffle files on disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def left_after(spark, before: set[str]) -> set[str]:
    """New shuffle files, once Spark had time to delete those that it was told to."""
    for _ in range(50):
        if not (left := shuffles_left(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_a_report_deletes_its_shuffles(spark, random_sources, tmp_path):
    """Those of the steps that write its tables, and the tables that only the next step reads."""
    before = shuffles_left(spark)
    with ReportContext(random_sources, FunnelRequest(TEST_DAY, "spend")).materialize(str(tmp_path)) as ctx:
        assert not left_after(spark, before)
        names = {p.name for p in next((tmp_path / "bidscope-tables").iterdir()).iterdir()}
        assert "level_0" in names and not names & {"events", "cube"}
        assert ctx.kpi.count() == 2
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    with shuffles_deleted(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == was


def test_the_cube_has_no_shuffle_of_its_own(spark, random_sources, tmp_path):
    """It is grouped where the join with the creatives left the rows."""
    seen = []

    def store(df, name):
        seen.append((name, df))
        return context.write_and_read(df, str(tmp_path / name))

    ctx = ReportContext(random_sources, FunnelRequest(TEST_DAY, "spend"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = store(context.fact_events(ctx.src, ctx.req, ctx.rules).select(*context.CELL_EVENTS), "events")
        plan = _ran(spark, ctx._cube(events, store)).toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning(trim(creative_id" in plan and "hashpartitioning(order_id" not in plan


@pytest.mark.parametrize("most", [1, 3])
def test_hot_creatives_are_told_apart(spark, random_sources, tmp_path, monkeypatch, most):
    """The tables of a report are the same if some creatives, null among them, are hot."""
    monkeypatch.setattr(context, "HOT_CREATIVE_ROWS", most)
    null = random_sources.bid_response.withColumn("creative_id", F.when(F.col("bid_seat_id") != "s1", F.col("creative_id")))
    src = random_sources.replace(bid_response=null)
    req = FunnelRequest(TEST_DAY, "spend")
    with ReportContext(src, req).materialize(str(tmp_path)) as ctx:
        folder = next((tmp_path / "bidscope-tables").iterdir())
        assert spark.read.parquet(str(folder / "hot_creatives")).count() > 0
        got = build_report(src, req, flags=False, ctx=ctx)
        alone = ReportContext(src, req)
        for name in ("spend_order_strategy_creative", "spend_app", "spend_landing", "gantt_spend"):
            assert rows(got[name]) == rows(spend.TABLES[name](alone)), name


def test_a_store_deletes_its_shuffles(spark, random_sources, tmp_path, monkeypatch):
    """also with hot ids beyond the hottest; every bucket of a day is one file, whatever the session's partitions."""
    monkeypatch.setattr(store_module, "HOTTEST", 2)
    store = EventStore("default", str(tmp_path), buckets=3, hot_rows=2, prefix=f"d{uuid.uuid4().hex}_")
    before = shuffles_left(spark)
    write_event_store(random_sources, store)
    assert not left_after(spark, before)
    assert spark.read.parquet(store.path("hot_ids")).count() > 2
    stored = load_event_store(spark, store, random_sources)
    hot = spark.read.parquet(store.path("hot_ids"))
    for name, key in STORE_KEYS.items():
        assert rows(getattr(stored, name).select(key)) == rows(getattr(random_sources, name).select(key))
        even, apart = (getattr(p, name) for p in stored.parts)
        assert even.join(hot, F.col(key).eqNullSafe(F.col("id")), "left_semi").count() == 0
        assert apart.join(hot, F.col(key).eqNullSafe(F.col("id")), "left_anti").count() == 0
        files = [(p.parent.name, re.search(r"_(\d{5})\.", p.name)[1]) for p in (tmp_path / f"{store.prefix}{name}").glob("dt=*/*.parquet")]
        assert len(files) == len(set(files)), name
    assert rows(wide_fact(stored, FunnelRequest(TEST_DAY))) == rows(wide_fact(random_sources, FunnelRequest(TEST_DAY)))
    drop_event_store(spark, store)


def test_few_buckets_join_without_a_shuffle(spark, src_small, tmp_path):
    """nothing that is stored in buckets is shuffled by id, though the session has more shuffle partitions than buckets."""
    store = EventStore("default", str(tmp_path), buckets=3, hot_rows=6, prefix=f"f{uuid.uuid4().hex}_")
    write_event_store(src_small, store)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("-1", "16")):
        spark.conf.set(n, v)
    try:
        plan = _ran(spark, wide_fact(load_event_store(spark, store, src_small).parts[0], FunnelRequest(TEST_DAY)))
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    for column in ("bid_price", "imp_adviewtype", "wpr"):
        seen = shuffles_up_to_join(plan, column)
        assert seen and all(joins and not n for n, joins in seen), (column, seen)
    drop_event_store(spark, store)


def test_a_bucket_has_half_a_million_rows(spark, src_small):
    """all joins by id of a bucket run in one task."""
    empty = src_small.replace(**{n: getattr(src_small, n).limit(0) for n in STORE_KEYS})
    assert buckets_for(empty.replace(bid_click=spark.range(1_000_001).select(F.col("id").cast("string").alias("response_id"))), 1) == 3


def test_long_texts_are_not_moved_for_cells(random_sources):
    """Addresses and coordinates are worked out before the shuffles, apps are named at the requests."""
    events = context.fact_events(random_sources, FunnelRequest(TEST_DAY)).select(*context.CELL_EVENTS)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[:plan.index("Relation") if "Relation" in plan else plan.index("LogicalRDD")]
    first = joined.split("Join LeftOuter, ((response_id")[0]
    assert "curl" not in first and "geo_lat" not in first
