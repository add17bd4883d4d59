"""Whole reports: guards, the tables of an analysis in sheet order, checks, writing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from bidscope.operators.checks import (
    EXPECTED_TABLES, assert_day, assert_delivered, staged_checks, validate, with_flags,
)
from bidscope.plans import basic, bidding, spend
from bidscope.plans.context import ReportContext
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.sources.sinks import discard, notes, publish, published_path, stage_report
from bidscope.sources.tables import FunnelSources

MODULES = {"basic": basic, "spend": spend, "bidding": bidding}


def build_report(src: FunnelSources, req: FunnelRequest, rules: Rules = Rules(),
                 materialize: bool = True, flags: bool = True, ctx: ReportContext | None = None,
                 scratch: str | None = None) -> dict[str, DataFrame]:
    """All tables of ``req.analysis`` (sheet order), lazily planned.

    FLT7 runs first (an undelivered order stops the report); spend and
    bidding also require a KPI row for the day (FLT8).  With ``materialize`` the fact is
    reduced to its cube once (under ``scratch``) and every table reads the cube's levels;
    a caller that passes its own ``ctx`` can delete them with ``ctx.release()``.
    """
    if ctx is None:
        assert_delivered(src, req)
        ctx = ReportContext(src, req, rules)
        if materialize:
            ctx.materialize(scratch)
    if req.analysis in ("spend", "bidding"):
        assert_day(ctx.kpi, req)
    mod = MODULES[req.analysis]
    total = ctx.total("spend_yuan")
    tables = {}
    for name in EXPECTED_TABLES[req.analysis]:
        if name == "notes":
            tables[name] = notes(src.bid_response.sparkSession, req, rules)
            continue
        df = mod.TABLES[name](ctx)
        tables[name] = with_flags(df, req.analysis, total, rules) if flags else df
    return tables


@contextmanager
def open_reports(src: FunnelSources, req: FunnelRequest, analyses=("basic", "spend", "bidding"),
                 rules: Rules = Rules(), scratch: str | None = None) -> Iterator[dict[str, dict[str, DataFrame]]]:
    """``build_reports`` for a ``with`` block: the intermediate tables are deleted when it ends."""
    with _shared_context(src, req, analyses, rules, scratch) as base:
        yield _reports(base, src, analyses, rules)


def _shared_context(src, req, analyses, rules, scratch) -> ReportContext:
    assert_delivered(src, req)
    return ReportContext(src, req.with_analysis(analyses[0]), rules).materialize_all(scratch, analyses)


def _reports(base: ReportContext, src: FunnelSources, analyses, rules: Rules) -> dict[str, dict[str, DataFrame]]:
    contexts = {a: base if a == base.analysis else base.share_with(a) for a in analyses}
    return {a: build_report(src, ctx.req, rules, ctx=ctx) for a, ctx in contexts.items()}


def build_reports(src: FunnelSources, req: FunnelRequest, analyses=("basic", "spend", "bidding"),
                  rules: Rules = Rules(), scratch: str | None = None) -> dict[str, dict[str, DataFrame]]:
    """Several analyses of one day/scope from ONE cube of the fact, one request set
    and one KPI superset (the reference runs one script, and one set of
    warehouse queries, per analysis). The tables read intermediate ones that stay under
    ``scratch``; ``open_reports`` deletes them."""
    return _reports(_shared_context(src, req, analyses, rules, scratch), src, analyses, rules)


def run_report(src: FunnelSources, req: FunnelRequest, root: str, rules: Rules = Rules(),
               fmt: str = "parquet", scratch: str | None = None):
    """Build one report, write it as a new version, check it, and publish it if the checks hold.

    Returns (path of the published report, ValidationResult). A failed check publishes
    nothing and deletes the version: the path is then that of the report published before,
    or None. Rows and columns are counted while the tables are written. The
    intermediate tables, by default under the report's root, are deleted.
    """
    assert_delivered(src, req)
    spark = src.bid_response.sparkSession
    with ReportContext(src, req, rules).materialize(scratch or f"{root.rstrip('/')}/_scratch") as ctx:
        tables = build_report(src, req, rules, ctx=ctx)
        staged = stage_report(tables, root, req, fmt, order=[n for n in EXPECTED_TABLES[req.analysis] if n in tables])
        result = validate(staged_checks(spark, staged, req.analysis, rules))
    if not result.ok:
        discard(spark, staged)
        return published_path(spark, root, req), result
    return publish(spark, staged), result
