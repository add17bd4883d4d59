"""The fact's cube: rolled-up levels equal the fact's own aggregates, gantts and whole reports."""

import pytest
from pyspark.sql import functions as F

from bidscope.operators.cube import DERIVED_KEYS, KEYS, STATES, Levels, as_cells, fact_cube, finest, measure, roll_up
from bidscope.plans import basic, bidding, spend
from bidscope.plans.context import ReportContext, write_and_read
from bidscope.plans.report import build_report, open_reports
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.plans.together import run_together
from bidscope.sources.fixture import TEST_DAY, TEST_ORDER
from bidscope.sources.schema import SCHEMAS
from bidscope.sources.tables import FunnelSources
from tests.test_differential import tables

MODULES = {"basic": basic, "spend": spend, "bidding": bidding}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def random_sources(spark):
    return FunnelSources(**{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in tables(5).items()})


def test_finest_sets():
    assert finest([["a"], ["a", "b"], ["b"], ["c"], ["b", "a"], ["c"]]) == [["a", "b"], ["c"], ["b", "a"]]


def test_cube_rolls_up_like_the_fact(random_sources):
    """Any keys, from the responses, from the cube and from a coarser level: the same states."""
    wide = ReportContext(random_sources, FunnelRequest(TEST_DAY)).wide
    cube = fact_cube(wide).persist()
    assert set(cube.columns) == {*KEYS, *DERIVED_KEYS, *STATES}
    assert cube.count() == cube.select(*KEYS).distinct().count()
    for keys in ([], ["hour"], ["order_strategy_creative"], ["target_group", "price_bucket"], ["page_id"], ["app_name", "app_bundle", "hour"]):
        direct = rows(roll_up(as_cells(wide), keys))
        assert rows(roll_up(cube, keys)) == direct
        assert rows(roll_up(roll_up(cube, [*keys, "ad_slot"]), keys)) == direct
    cube.unpersist()


def test_levels_read_their_own_table(spark, random_sources, tmp_path):
    wide = ReportContext(random_sources, FunnelRequest(TEST_DAY)).wide
    levels = Levels([["hour"], ["hour", "price_bucket"], ["ad_slot"]])
    assert levels.sets == [["hour", "price_bucket"], ["ad_slot"]] and levels.get(["hour"]) is None
    levels.tables = run_together(spark, levels.jobs(fact_cube(wide), lambda df, name: write_and_read(df, str(tmp_path / name))))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["level_0", "level_1"]
    cells, exact = levels.get(["price_bucket", "hour"])
    assert exact and rows(cells.select(*STATES)) == rows(roll_up(as_cells(wide), ["hour", "price_bucket"]).select(*STATES))
    cells, exact = levels.get(["hour"])
    assert not exact and rows(roll_up(cells, ["hour"])) == rows(roll_up(as_cells(wide), ["hour"]))
    assert levels.get(["page_id"]) is None
    one = levels.aggregate(fact_cube(wide))
    for i, ks in enumerate(levels.sets):
        assert rows(one.filter(F.col("level") == i).select(*ks, *STATES)) == rows(levels.tables[i])


def test_jobs_side_by_side(spark):
    assert run_together(spark, [lambda i=i: spark.range(i).count() for i in range(9)], width=3) == list(range(9))
    with pytest.raises(ZeroDivisionError):
        run_together(spark, [lambda: 1, lambda: 1 // 0, lambda: 2])
    assert run_together(spark, []) == []


def test_measures_of_merged_states(spark):
    cells = spark.createDataFrame([(3, 250.0, 10.0, 4, 5), (1, None, None, 0, None)], "bids long, spend_raw double, price_sum double, price_n long, hour_mask int")
    got = cells.select(*[measure(m, Rules()) for m in ("spend_yuan", "avg_bid_price", "active_hours")]).collect()
    assert tuple(got[0]) == (0.0025, 2.5, 2) and tuple(got[1]) == (None, None, 0)


@pytest.mark.parametrize("order", [None, TEST_ORDER])
def test_whole_reports_equal_single_tables(spark, random_sources, order, tmp_path):
    """Every table of the three reports from one cube, on random rows with nulls, against the table on its own."""
    req = FunnelRequest(TEST_DAY, "basic", order)
    with open_reports(random_sources, req, scratch=str(tmp_path)) as reports:
        for analysis, module in MODULES.items():
            alone = ReportContext(random_sources, req.with_analysis(analysis))
            for name, fn in module.TABLES.items():
                if name in reports[analysis]:
                    got = reports[analysis][name]
                    assert rows(got.drop(*[c for c in got.columns if c.startswith("flag_")])) == rows(fn(alone)), (analysis, name)
    assert not list((tmp_path / "bidscope-tables").iterdir()), "intermediate tables are deleted"


def test_the_fact_is_read_once(spark, random_sources, tmp_path):
    """A materialised report scans no event table but the responses of the final basic gantt."""
    with ReportContext(random_sources, FunnelRequest(TEST_DAY)).materialize(str(tmp_path)) as ctx:
        for name, df in build_report(random_sources, ctx.req, ctx=ctx).items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            if name != "gantt_bids":
                assert "bid_seat_id" not in plan, name


def test_failed_materialisation_leaves_nothing(spark, random_sources, tmp_path):
    broken = random_sources.replace(bid_result=random_sources.bid_result.withColumn("wpr", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        ReportContext(broken, FunnelRequest(TEST_DAY)).materialize(str(tmp_path))
    assert not list((tmp_path / "bidscope-tables").iterdir())


def test_partitions_grow_with_the_rows(spark):
    """Raised for many rows while the report's tables are written, then as before; a larger number is kept."""
    from bidscope.plans.context import TASK_ROWS, partitions_for
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with partitions_for(spark, 50 * TASK_ROWS + 1):
        assert spark.conf.get(name) == "51"
    assert spark.conf.get(name) == before
    with partitions_for(spark, 1):
        assert spark.conf.get(name) == before
