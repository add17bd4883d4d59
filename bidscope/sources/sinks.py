"""SNK1-SNK3: report location, the definitions table, staging and publishing a report.

A report is written as a *version* of its own, one dataset per table plus a
``_manifest`` dataset with the table order, under

    <root>/_versions/<version>/analysis=<a>/day=<d>/order=<o|all>/

Readers do not look there. A version becomes the report when a small file that names
it appears under

    <root>/analysis=<a>/day=<d>/order=<o|all>/_published/<version>.json

which is the last step, after the checks; it is written under another name first and
renamed, so it is there as a whole or not at all. The newest published version is the
report: a failed check, a lost driver or a killed write leaves the one before as it was.
Writes are Spark writes, so a lost executor only retries its own tasks, and rows are
counted while they are written.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bidscope.plans.request import FunnelRequest, Rules
from bidscope.plans.together import run_together, shuffles_deleted
from bidscope.sources.schema import LABELS

SPEND_COLUMNS = ("spend_yuan",)
VERSIONS, PUBLISHED = "_versions", "_published"


def labelled(df: DataFrame, analysis: str, spend_last: bool = True) -> DataFrame:
    """SC27: report presentation of a table -- the reference's column labels
    (``LABELS``) and, for the basic report (``cost_column_at_end``), spend as
    the last column.  The basic report calls spend 花销(元), the others 花费(元)."""
    cols = list(df.columns)
    if spend_last and analysis == "basic":
        cols = [c for c in cols if c not in SPEND_COLUMNS] + [c for c in cols if c in SPEND_COLUMNS]
    names = dict(LABELS)
    if analysis == "basic":
        names["spend_yuan"] = "花销(元)"
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in cols])


def report_path(root: str, req: FunnelRequest) -> str:
    order = "all" if req.order_id is None else str(req.order_id)
    return f"{root.rstrip('/')}/analysis={req.analysis}/day={req.day:%Y-%m-%d}/order={order}"


def notes(spark: SparkSession, req: FunnelRequest, rules: Rules = Rules()) -> DataFrame:
    """SNK3: definitions of the report under its rules (the order line varies)."""
    scope = (f"order {req.order_id} only; invites are requests with a response of that order "
             "within one day" if req.order_id is not None else "all orders")
    rows = [
        ("funnel", "invites -> bids -> wins -> clicks -> landing-page exposure (pageExp) -> jumps (jumpButton)"),
        ("spend", f"sum(wpr) / {rules.spend_divisor:g}, attributed by the win table"),
        ("order scope", scope),
        ("track join", "rid / pyck parsed from the event URL, else root_id / parent_event_id; "
                       + ("tracks count only for clicked responses" if rules.landing_page_requires_click
                          else "tracks count with or without a click")),
        ("keys", "request_id = response_id and imp_id = bid_imp_id; wins and clicks by response_id + bid_seat_id"),
    ]
    if req.analysis == "basic":
        rows.append(("direct jump", "a bid with a click address but no landing page, and no landing-page exposure"))
        rows.append(("time", "invites by request time, bids by response time, wins and clicks by their own time, "
                             "tracks by the day of the click"))
    if req.analysis == "spend":
        rows.append(("region", "lat/lon box; missing coordinates form their own group"))
    if req.analysis == "bidding":
        bounds = ", ".join(f"{b:g}" for b in rules.price_bounds)
        rows.append(("price buckets", f"upper-inclusive bid price bounds {bounds}"))
        rows.append(("strategy names", "the strategy's newest dimension row, else the creative's, else the id"))
    return spark.createDataFrame(rows, "item string, text string")


@dataclass(frozen=True)
class StagedReport:
    """A written version that is not the report yet: where it is, and what was seen while it was written."""

    root: str
    request: FunnelRequest
    version: str
    path: str
    fmt: str
    tables: list[str]
    rows: dict[str, int] = field(default_factory=dict)
    columns: dict[str, int] = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return _read(spark, self.path, name, self.fmt, self.schemas[name])


def _read(spark: SparkSession, path: str, name: str, fmt: str, schema=None) -> DataFrame:
    r = spark.read.format(fmt).option("header", fmt == "csv")
    return (r.schema(schema) if schema is not None else r).load(f"{path}/{name}")


def _hadoop(spark: SparkSession, path: str):
    """The path as a Hadoop path, and its file system."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def _new_version() -> str:
    """Versions sort by the time they were begun."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def stage_report(tables: dict[str, DataFrame], root: str, req: FunnelRequest, fmt: str = "parquet",
                 order: list[str] | None = None, labels: bool = False) -> StagedReport:
    """SNK1: write every table of one report as a new version, counting rows on the way.

    ``labels=True`` writes the presentation form (SC27); CSV gets a header.
    """
    version, names = _new_version(), order or list(tables)
    path = report_path(f"{root.rstrip('/')}/{VERSIONS}/{version}", req)
    staged = StagedReport(root.rstrip("/"), req, version, path, fmt, names)
    spark = next(iter(tables.values())).sparkSession

    def write(name: str) -> tuple[int, int, object]:
        df = labelled(tables[name], req.analysis) if labels else tables[name]
        seen = Observation(f"{name}-{version}")
        w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(f"{path}/{name}")
        return seen.get["rows"], len(df.columns), df.schema

    with shuffles_deleted(spark):
        written = run_together(spark, [lambda name=name: write(name) for name in names])
    for name, (rows, columns, schema) in zip(names, written):
        staged.rows[name], staged.columns[name], staged.schemas[name] = rows, columns, schema
    manifest = spark.createDataFrame([(i, n, staged.rows[n], staged.columns[n]) for i, n in enumerate(names)],
                                     "seq int, table string, rows bigint, columns int")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
    return staged


def publish(spark: SparkSession, staged: StagedReport, keep: int = 2) -> str:
    """Make a staged version the report; older ones beyond the newest ``keep`` are deleted afterwards."""
    folder = f"{report_path(staged.root, staged.request)}/{PUBLISHED}"
    text = json.dumps({"version": staged.version, "format": staged.fmt, "tables": staged.tables,
                       "rows": staged.rows, "columns": staged.columns}, ensure_ascii=False)
    draft, fs = _hadoop(spark, f"{folder}/.{staged.version}.draft")
    final, _ = _hadoop(spark, f"{folder}/{staged.version}.json")
    out = fs.create(draft, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not fs.rename(draft, final):
        raise OSError(f"cannot publish {staged.path}")
    for old in published_versions(spark, staged.root, staged.request)[:-keep]:
        fs.delete(_hadoop(spark, f"{folder}/{old}.json")[0], False)
        fs.delete(_hadoop(spark, f"{staged.root}/{VERSIONS}/{old}")[0], True)
    return staged.path


def discard(spark: SparkSession, staged: StagedReport) -> None:
    """Delete a version that is not to be published."""
    path, fs = _hadoop(spark, f"{staged.root}/{VERSIONS}/{staged.version}")
    fs.delete(path, True)


def published_versions(spark: SparkSession, root: str, req: FunnelRequest) -> list[str]:
    """Versions of a report that were published and are kept, oldest first."""
    folder, fs = _hadoop(spark, f"{report_path(root, req)}/{PUBLISHED}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))


def published_path(spark: SparkSession, root: str, req: FunnelRequest) -> str | None:
    """Folder of the newest published version of a report; None if there is none."""
    versions = published_versions(spark, root, req)
    return report_path(f"{root.rstrip('/')}/{VERSIONS}/{versions[-1]}", req) if versions else None


def read_report(spark: SparkSession, root: str, req: FunnelRequest) -> dict[str, DataFrame]:
    """The tables of the newest published version, in report order."""
    versions = published_versions(spark, root, req)
    if not versions:
        raise FileNotFoundError(f"no published report under {report_path(root, req)}")
    note = spark.read.text(f"{report_path(root, req)}/{PUBLISHED}/{versions[-1]}.json", wholetext=True).first().value
    about = json.loads(note)
    path = report_path(f"{root.rstrip('/')}/{VERSIONS}/{versions[-1]}", req)
    return {name: _read(spark, path, name, about["format"]) for name in about["tables"]}


def write_report(tables: dict[str, DataFrame], root: str, req: FunnelRequest, fmt: str = "parquet",
                 order: list[str] | None = None, labels: bool = False) -> str:
    """Stage and publish without checks; the folder of the written version."""
    staged = stage_report(tables, root, req, fmt, order, labels)
    return publish(next(iter(tables.values())).sparkSession, staged)
