"""Shared inputs of one report: the wide fact and its cube, the two-day KPI, the day's requests."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.exprs import ad_slot, app_label, geo_region, hours_seen
from bidscope.operators.cube import CELL_EVENTS, Levels, as_cells, fact_cube, measure, roll_up
from bidscope.operators.daily import KPI_COLUMNS, daily_kpi
from bidscope.operators.facts import (
    app_names, creative_key, day_requests, day_responses, fact_events, latest_strategy, wide_fact, with_dimensions,
)
from bidscope.operators.metrics import MEASURES, funnel_agg, keep_apps, request_agg
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.plans.together import run_together, shuffles_deleted
from bidscope.sources.tables import FunnelSources


def request_labels(rules: Rules) -> dict:
    """Label expressions the request aggregates group by."""
    return {
        "app_bundle": app_label("app_bundle"),
        "hour": F.hour("request_time"),
        "geo_region": geo_region("geo_lat", "geo_lon", rules.wuhan_box),
        "ad_slot": ad_slot("imp_adviewtype", rules.ad_slot_names),
    }


def scratch_table_root(spark, root: str | None = None) -> str:
    """A fresh folder for this report's intermediate tables under ``root``, else
    under the shared checkpoint folder (which only a local master may lack). What its
    report does not delete goes when the driver ends."""
    import uuid

    from bidscope.session import ensure_checkpoint_dir
    folder = f"{(root or ensure_checkpoint_dir(spark)).rstrip('/')}/bidscope-tables/{uuid.uuid4().hex}"
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def delete_folder(spark, folder: str) -> None:
    """Delete a folder of the session's file systems, if it is there."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Responses of the day that one task of a shuffle joins and reduces: a partition of so many takes some hundred MB.
TASK_ROWS = 200_000


#: Responses of a creative from which it is hot: its rows are not left to one task.
HOT_CREATIVE_ROWS = TASK_ROWS
#: Levels rolled up at a time: the shuffle of each holds up to a row of all states for every cell of the cube.
LEVELS_AT_ONCE = 1


@contextmanager
def partitions_for(spark, rows: int) -> Iterator[None]:
    """At least so many shuffle partitions that ``rows`` come to ``TASK_ROWS`` each, while the block runs; the session's
    number is kept if it is larger, and adaptive execution unites those that are small."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    wanted = -(-rows // TASK_ROWS)
    raised = [n for n, v in before.items() if v is not None and int(v) < wanted]
    for n in raised:
        spark.conf.set(n, str(wanted))
    try:
        yield
    finally:
        for n in raised:
            spark.conf.set(n, before[n])


# The gantts' level: strategies under all their names by request hour (AG12, AG16, AG17).
GANTT_KEYS = ["order_id", "strategy_id", "order_name", "strategy_name", "hour"]


class ReportContext:
    """Lazily built frames shared by the tables of one report.

    A single table aggregates the wide fact, seen as cells (``operators/cube.py``), with
    only the columns it needs. A whole report reads the fact once: ``materialize()``
    reduces it to the cube, and every table rolls up from the cube's written levels.
    """

    def __init__(self, src: FunnelSources, req: FunnelRequest, rules: Rules = Rules()):
        self.src, self.req, self.rules = src, req, rules
        self._scratch = None
        self._levels: Levels | None = None

    @property
    def analysis(self) -> str:
        return self.req.analysis

    @cached_property
    def wide(self) -> DataFrame:
        return wide_fact(self.src, self.req, self.rules)

    def materialize(self, root: str | None = None, analyses=None) -> "ReportContext":
        """Write the cube's levels, the two-row KPI frame, the requests' levels and (with an
        order scope) the order-limited requests, for ``analyses`` (default: this one).

        They are parquet tables under ``root`` (default: the cluster's
        ``spark.checkpoint.dir``): every later aggregate reads only its level and a lost
        executor re-reads instead of recomputing joins. The fact is joined and reduced in steps, whose
        shuffles and tables are deleted when the next one has read them: the joins by response id (only the
        columns that cells need are kept), the names with the cube, the levels. Jobs that need nothing of each
        other run side by side, with shuffle partitions in proportion to the day's responses. ``release``
        deletes the tables once the report's are written; the context is also a context manager that does so.
        """
        base = self._scratch = scratch_table_root(self.src.bid_response.sparkSession, root)
        try:
            levels = Levels([ks for a in analyses or [self.analysis] for ks in self.LEVELS[a]])
            spark = self.src.bid_response.sparkSession

            def store(df: DataFrame, name: str) -> DataFrame:
                return write_and_read(df, f"{base}/{name}")

            def by_requests() -> None:
                if self.req.order_id is not None:
                    self.__dict__["requests"] = store(self.requests, "requests")
                self._materialize_request_levels(base)

            def by_fact() -> None:
                events = store(fact_events(self.src, self.req, self.rules).select(*CELL_EVENTS), "events")
                cube = store(self._cube(events, store), "cube")
                delete_folder(spark, f"{base}/events")
                levels.tables = run_together(spark, levels.jobs(cube, store), LEVELS_AT_ONCE)
                delete_folder(spark, f"{base}/cube")

            def by_day() -> None:
                self.__dict__["kpi"] = store(self.kpi, "kpi")

            with shuffles_deleted(spark), partitions_for(spark, day_responses(self.src, self.req).count()):
                run_together(spark, [by_fact, by_requests, by_day])
            self._levels = levels
        except BaseException:
            self.release()
            raise
        return self

    def _cube(self, events: DataFrame, store) -> DataFrame:
        """The cube of written events. The join with the creatives deals them by creative, as their cells are grouped,
        so the cube needs no shuffle of its own; hot creatives are told apart and shuffled by all keys. The strategies'
        newest rows are written first, so that it is known from the start whether they can be broadcast."""
        creative = creative_key("creative_id")
        strategies = store(latest_strategy(self.src.dim_strategy), "strategies")
        hot = store(events.groupBy(creative.alias("_hot")).agg(F.count(F.lit(1)).alias("n"))
                    .filter(F.col("n") > F.lit(HOT_CREATIVE_ROWS)).select("_hot"), "hot_creatives")
        if hot.limit(1).count() == 0:
            return fact_cube(with_dimensions(events, self.src, self.rules, strategies), self.rules, dealt_by=creative)
        # at most one row for each HOT_CREATIVE_ROWS responses
        hot = F.broadcast(hot)
        is_hot = creative.eqNullSafe(F.col("_hot"))
        theirs = self.src.replace(dim_creative=self.src.dim_creative.join(hot, F.col("creative_id").cast("string") == F.col("_hot"), "left_semi"))
        even = with_dimensions(events.join(hot, is_hot, "left_anti"), self.src, self.rules, strategies)
        apart = with_dimensions(events.join(hot, is_hot, "left_semi"), theirs, self.rules, strategies)
        return fact_cube(even, self.rules, dealt_by=creative).unionByName(fact_cube(apart, self.rules))

    def __enter__(self) -> "ReportContext":
        return self

    def __exit__(self, *error) -> None:
        self.release()

    def release(self) -> None:
        """Delete the intermediate tables of this report."""
        if self._scratch:
            delete_folder(self.src.bid_response.sparkSession, self._scratch)
            self._scratch = None

    @cached_property
    def kpi(self) -> DataFrame:
        """Both days (current and previous) of the analysis's KPI counts."""
        return daily_kpi(self.src, self.req, self.rules, self.analysis)

    @cached_property
    def requests(self) -> DataFrame:
        return day_requests(self.src, self.req)

    @cached_property
    def app_names(self) -> DataFrame:
        return app_names(self.src.app_mapping)

    # Every key set the tables of an analysis need; sets that another one holds are rolled up from it.
    _OSC8 = ["order_id", "strategy_id", "creative_id", "order_name", "strategy_name", "creative_name",
             "material_id", "material_type"]
    _OSC9 = _OSC8 + ["order_strategy_creative"]
    _APP = ["app_name", "app_bundle"]
    LEVELS = {
        "basic": [GANTT_KEYS, _OSC8, [*_APP, "hour"], [*_APP, "order_strategy_creative"],
                  ["hour", "order_strategy_creative"], ["page_id"]],
        "spend": [GANTT_KEYS, _OSC9, _APP, ["geo_region"], ["target_group"], ["strategy_id", "strategy_name", "ad_slot"], ["page_id"]],
        "bidding": [GANTT_KEYS, _OSC9, [*_APP, "hour"], [*_APP, "order_strategy_creative"], [*_APP, "price_bucket"],
                    ["hour", "order_strategy_creative"], ["hour", "price_bucket"], ["order_strategy_creative", "price_bucket"]],
    }

    def _holding(self, keys) -> tuple[DataFrame, bool]:
        found = self._levels.get(keys) if self._levels else None
        return found or (as_cells(self.wide), False)

    def cells(self, keys) -> DataFrame:
        """Cells that hold ``keys``: of the smallest written level, else the responses of the fact."""
        return self._holding(keys)[0]

    def level(self, keys) -> DataFrame:
        """Cells of exactly ``keys``, all states."""
        cells, exact = self._holding(keys)
        return cells if exact else roll_up(cells, keys)

    def funnel(self, keys, apps: DataFrame | None = None) -> DataFrame:
        """This analysis's measures by ``keys`` (AG10), of the cells whose app is in ``apps``."""
        cells, exact = self._holding(keys)
        if apps is not None:
            cells = keep_apps(cells, apps)
        measures = MEASURES[self.analysis]
        if not exact:
            return funnel_agg(cells, keys, measures, self.rules)
        return cells.select(*keys, *[measure(m, self.rules) for m in measures])

    def memo(self, name: str, build) -> DataFrame:
        """A small frame shared by several tables of the report (e.g. the top
        apps behind three cross tables); written once when materialised."""
        cache = self.__dict__.setdefault("_memo", {})
        if name not in cache:
            df = build()
            if self._scratch:
                df = write_and_read(df, f"{self._scratch}/{name}_{self.analysis}")
            cache[name] = df
        return cache[name]

    def request_counts(self, key: str, avg_floor: bool = False, active_hours: bool = False) -> DataFrame:
        """Request aggregate by one label (AG15): ``app_bundle`` (blank -> (空)),
        ``hour``, ``geo_region`` or ``ad_slot``.  After ``materialize`` every
        label comes from ONE grouping-sets pass over the day's requests."""
        cols = [key, "invites"] + (["avg_floor"] if avg_floor else []) + (["active_hours"] if active_hours else [])
        levels = self.__dict__.get("_request_levels")
        if levels is not None:
            return levels[key].select(*cols)
        return request_agg(self.requests, request_labels(self.rules)[key], key, avg_floor=avg_floor,
                           active_hours=active_hours)

    def _materialize_request_levels(self, base: str) -> None:
        labels = request_labels(self.rules)
        keys = list(labels)
        rows = self.requests.select(*[c.alias(k) for k, c in labels.items()],
                                    F.hour("request_time").alias("_h"), "imp_bidfloor")
        agg = rows.groupingSets([[k] for k in keys], *keys).agg(
            F.count(F.lit(1)).alias("invites"), F.round(F.avg("imp_bidfloor"), 6).alias("avg_floor"),
            hours_seen("_h").alias("active_hours"), F.grouping_id().alias("_gid"))
        agg = write_and_read(agg, f"{base}/request_levels")
        self.__dict__["_request_levels"] = {
            k: agg.filter(F.col("_gid") == F.lit(sum(1 << (len(keys) - 1 - j) for j in range(len(keys)) if j != i)))
            for i, k in enumerate(keys)}

    def share_with(self, analysis: str) -> "ReportContext":
        """A context for another analysis of the same day and scope on this one's tables."""
        other = ReportContext(self.src, self.req.with_analysis(analysis), self.rules)
        other._scratch, other._levels = self._scratch, self._levels
        for name in ("wide", "requests", "_request_levels"):
            if name in self.__dict__:
                other.__dict__[name] = self.__dict__[name]
        if "kpi_all" in self.__dict__:
            other.__dict__["kpi"] = self.__dict__["kpi_all"].select(*KPI_COLUMNS[analysis])
        return other

    def materialize_all(self, root: str | None = None, analyses=tuple(LEVELS)) -> "ReportContext":
        """Like :meth:`materialize`, with the levels and the KPI superset of several analyses."""
        self.__dict__["kpi"] = daily_kpi(self.src, self.req, self.rules, "all")
        self.materialize(root, analyses)
        self.__dict__["kpi_all"] = self.__dict__["kpi"]
        self.__dict__["kpi"] = self.__dict__["kpi_all"].select(*KPI_COLUMNS[self.analysis])
        return self

    def current(self) -> DataFrame:
        return self.kpi.filter(F.col("d") == F.lit(self.req.day))

    def total(self, col: str) -> Column:
        """The current day's KPI value as a scalar subquery (SC18 denominator)."""
        return self.current().select(F.max(col)).scalar()

    def with_app_name(self, df: DataFrame, bundle_col: str = "app_bundle") -> DataFrame:
        """SC14/JN12: mapped app name, else the bundle itself."""
        m = self.app_names.select(F.col("app_package_name").alias("_pkg"), F.col("app_name").alias("_name"))
        return (df.join(m, F.col(bundle_col) == F.col("_pkg"), "left")
                .withColumn("app_name", F.coalesce(F.col("_name"), F.col(bundle_col))).drop("_pkg", "_name"))
