"""Staged reports: a version becomes the report only after its checks, and never in part."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bidscope.operators import checks
from bidscope.plans.report import run_report
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.fixture import TEST_DAY
from bidscope.sources.sinks import (
    PUBLISHED, VERSIONS, discard, publish, published_path, published_versions, read_report, report_path, stage_report, write_report,
)

REQ = FunnelRequest(TEST_DAY, "bidding")


def _tables(spark, n: int):
    return {"bid_kpi": spark.range(n).withColumn("bids", F.lit(n)), "bid_compare": spark.range(0)}


def test_rows_and_columns_are_observed(spark, tmp_path):
    staged = stage_report(_tables(spark, 7), str(tmp_path), REQ)
    assert staged.rows == {"bid_kpi": 7, "bid_compare": 0} and staged.columns == {"bid_kpi": 2, "bid_compare": 1}
    manifest = [json.loads(line) for p in Path(staged.path, "_manifest").glob("*.json") for line in p.read_text().splitlines()]
    assert sorted((r["seq"], r["table"], r["rows"]) for r in manifest) == [(0, "bid_kpi", 7), (1, "bid_compare", 0)]


def test_unpublished_versions_are_not_seen(spark, tmp_path):
    root = str(tmp_path)
    assert published_path(spark, root, REQ) is None
    with pytest.raises(FileNotFoundError):
        read_report(spark, root, REQ)
    first = write_report(_tables(spark, 3), root, REQ)
    staged = stage_report(_tables(spark, 4), root, REQ)
    assert published_path(spark, root, REQ) == first and read_report(spark, root, REQ)["bid_kpi"].count() == 3
    assert publish(spark, staged) == staged.path == published_path(spark, root, REQ)
    assert list(read_report(spark, root, REQ)) == ["bid_kpi", "bid_compare"] and read_report(spark, root, REQ)["bid_kpi"].count() == 4


def test_a_killed_write_leaves_the_report(spark, tmp_path):
    root = str(tmp_path)
    write_report(_tables(spark, 3), root, REQ)
    broken = _tables(spark, 5) | {"bid_app": spark.range(3).select(F.raise_error(F.lit("lost")).alias("x"))}
    with pytest.raises(Exception, match="lost"):
        stage_report(broken, root, REQ)
    # a publication that stops before its last step
    (tmp_path / "x").mkdir()
    folder = Path(report_path(root, REQ)) / PUBLISHED
    (folder / ".99999999T000000000000-aaaaaaaa.draft").write_text("{}")
    assert len(published_versions(spark, root, REQ)) == 1 and read_report(spark, root, REQ)["bid_kpi"].count() == 3


def test_old_versions_are_deleted(spark, tmp_path):
    root = str(tmp_path)
    paths = [write_report(_tables(spark, n), root, REQ) for n in (1, 2, 3, 4)]
    assert [Path(p).exists() for p in paths] == [False, False, True, True]
    assert len(published_versions(spark, root, REQ)) == 2 and read_report(spark, root, REQ)["bid_kpi"].count() == 4
    other = write_report(_tables(spark, 9), root, FunnelRequest(TEST_DAY, "bidding", 218))
    assert Path(other).exists() and published_path(spark, root, REQ) == paths[-1]


def test_a_failing_check_keeps_the_report(spark, src_small, tmp_path):
    root = str(tmp_path)
    path, result = run_report(src_small, REQ, root)
    assert result.ok and path == published_path(spark, root, REQ)
    before = read_report(spark, root, REQ)["bid_app"].count()
    seen = {(c["check"], c["table"]): c["value"] for c in result.checks}
    assert seen["rows", "bid_app"] == before and seen["columns", "bid_app"] == len(read_report(spark, root, REQ)["bid_app"].columns)
    assert ("apps_outside_top", "x_app_hour") in seen
    # more apps than the check allows
    strict = Rules(bid_app_rows=before)
    original = checks.staged_checks
    again, failed = run_report(src_small, REQ, root, Rules(bid_app_rows=before - 1, cross_limit=0))
    assert not failed.ok and any(e.startswith("rows x_app_hour=0") for e in failed.errors)
    assert again == path and read_report(spark, root, REQ)["bid_app"].count() == before
    assert len(list((tmp_path / VERSIONS).iterdir())) == 1, "the failed version is deleted"
    assert strict.bid_app_rows == before and original is checks.staged_checks


def test_first_report_that_fails(spark, src_small, tmp_path):
    path, result = run_report(src_small, REQ, str(tmp_path), Rules(cross_limit=0))
    assert path is None and not result.ok


def test_no_job_counts_a_written_table(spark, src_small, tmp_path):
    """Row counts come from the writes: but for the apps outside the table, checks of a staged report run no job."""
    staged = stage_report(_tables(spark, 3), str(tmp_path), REQ)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checks", "checks of a staged report")
    try:
        rows = checks.staged_checks(spark, staged, "bidding")
        assert ("rows", "bid_kpi", 3, True) in rows and ("rows", "bid_compare", 0, True) in rows and ("present", "bid_app", 0, False) in rows
        assert len(tracker.getJobIdsForGroup("checks")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    discard(spark, staged)
    assert not list((tmp_path / VERSIONS).iterdir())


def test_csv_report(spark, tmp_path):
    write_report(_tables(spark, 3), str(tmp_path), REQ, fmt="csv")
    assert read_report(spark, str(tmp_path), REQ)["bid_kpi"].count() == 3
