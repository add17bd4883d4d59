"""SRC1/SRC4: reading the input tables and scanning a day window.

Tables can come from parquet folders, the catalog, or a MySQL-protocol
warehouse over JDBC.  Every reader casts to the declared schema so that the
rest of the library sees one set of types; ``rejects`` counts what the casts lose.
Tasks that lose their connection are retried by Spark (``spark.task.maxFailures``), the
driver's schema reads by ``retry`` (SRC2).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.sources.rejects import check_rejects, reject_ledger
from bidscope.sources.retry import ATTEMPTS, with_retry
from bidscope.sources.schema import SCHEMAS, TIME_COLUMNS

EVENT_TABLES = ("bid_request", "bid_response", "bid_result", "bid_click", "track_event")
DIM_TABLES = ("dim_strategy", "dim_creative")


@dataclass(frozen=True)
class TableSource:
    """Where the tables live.

    kind: ``parquet`` (``location/<name>``), ``catalog`` (``location.<name>``
    or a bare table name), or ``jdbc`` (``location`` is the JDBC URL).
    ``names`` maps a logical table name to the physical one.  ``attempts`` is how often a
    JDBC read is planned before a lost connection is raised.  ``day_column``
    names the day partition column of stored event tables, if they have one, and
    ``lateness_days`` how many days after its event time a row may be stored;
    only then are partitions pruned.
    """

    kind: str = "parquet"
    location: str = ""
    names: dict = field(default_factory=dict)
    options: dict = field(default_factory=dict)
    jdbc_partitions: int = 64
    day_column: str | None = None
    lateness_days: int = 0
    attempts: int = ATTEMPTS

    def physical(self, name: str) -> str:
        return self.names.get(name, name)


# Day partition column that ``write_event_table`` makes (``dt=YYYY-MM-DD`` folders).
PARTITION_COLUMN = "dt"
# The same column inside the library, with the allowed lateness as metadata.
_STORED_DAY = "_stored_day"
# Columns that feed no report; a source may lack them.
OPTIONAL_COLUMNS = {
    "bid_request": {"geo_city", "imp_adlocation", "imp_templateid"},
    "bid_response": {"dpl_url"},
    "app_mapping": {"is_verified", "request_count", "etl_time"},
}


def conform(df: DataFrame, name: str, day_column: str | None = None, lateness_days: int = 0) -> DataFrame:
    """Cast to the declared schema; optional columns the source lacks become typed nulls.

    A missing column that reports need raises.  A named day partition column is
    kept so ``day_window`` can prune partitions.
    """
    schema = SCHEMAS[name]
    have = set(df.columns)
    missing = {f.name for f in schema.fields} - have - OPTIONAL_COLUMNS.get(name, set())
    if day_column and name in TIME_COLUMNS and day_column not in have:
        missing.add(day_column)
    if missing:
        raise ValueError(f"table {name} lacks the columns {sorted(missing)}")
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if day_column and name in TIME_COLUMNS:
        cols.append(F.col(day_column).cast("date").alias(_STORED_DAY, metadata={"lateness_days": lateness_days}))
    return df.select(*cols)


def read_table(spark: SparkSession, name: str, source: TableSource,
               window: tuple[dt.date, int] | None = None) -> DataFrame:
    """One logical table as it is stored.

    For JDBC event tables ``window=(start_day, n_days)`` is required: it sets the
    strides by which the read is split into ``jdbc_partitions`` ranges of the time
    column.  What is read is limited by ``day_window``, whose range Spark passes on
    in the WHERE clause.
    """
    phys = source.physical(name)
    if source.kind == "parquet":
        return spark.read.options(**source.options).parquet(f"{source.location.rstrip('/')}/{phys}")
    if source.kind == "catalog":
        return spark.read.table(f"{source.location}.{phys}" if source.location else phys)
    if source.kind == "jdbc":
        reader = spark.read.format("jdbc").options(**jdbc_options(name, source, window))
        return with_retry(reader.load, source.attempts)
    raise ValueError(f"unknown source kind {source.kind!r}")


def load_table(spark: SparkSession, name: str, source: TableSource,
               window: tuple[dt.date, int] | None = None) -> DataFrame:
    """SRC1: read one logical table and cast it to its declared schema."""
    return conform(read_table(spark, name, source, window), name, source.day_column, source.lateness_days)


def jdbc_options(name: str, source: TableSource, window: tuple[dt.date, int] | None) -> dict[str, str]:
    """Reader options of one JDBC table; event tables are split by time."""
    out = {"url": source.location, "dbtable": source.physical(name), "fetchsize": "10000", **source.options}
    if name in TIME_COLUMNS:
        if window is None:
            raise ValueError(f"a JDBC read of {name} needs the window (start day, days) to be split by time")
        start, days = window
        out |= {"partitionColumn": TIME_COLUMNS[name], "lowerBound": f"{start:%Y-%m-%d} 00:00:00",
                "upperBound": f"{start + dt.timedelta(days=days):%Y-%m-%d} 00:00:00",
                "numPartitions": str(source.jdbc_partitions)}
    return out


def _ts_literal(day: dt.date, dtype: T.DataType) -> Column:
    text = f"{day:%Y-%m-%d} 00:00:00"
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(dtype, T.DateType):
        return F.lit(day)
    return F.expr(f"TIMESTAMP '{text}'")


def day_window(df: DataFrame, time_col: str, start: dt.date, days: int = 1) -> DataFrame:
    """SRC4: half-open ``[start, start + days)`` on the raw time column.

    Written as a plain range on the stored column (literal of the column's own
    type), so it reaches the parquet scan as ``PushedFilters`` / partition
    pruning and, for JDBC, the warehouse's WHERE clause.
    """
    dtype = df.schema[time_col].dataType
    end = start + dt.timedelta(days=days)
    c = F.col(time_col)
    out = df.filter((c >= _ts_literal(start, dtype)) & (c < _ts_literal(end, dtype)))
    if _STORED_DAY in df.columns:
        # stored tables partitioned by day: prune folders, with room for late rows
        late = dt.timedelta(days=df.schema[_STORED_DAY].metadata.get("lateness_days", 0))
        p = F.col(_STORED_DAY)
        out = out.filter((p >= F.lit(start)) & (p < F.lit(end + late)))
    return out


def write_event_table(df: DataFrame, path: str, time_col: str) -> None:
    """Store an event table partitioned by day (``dt``), ranges of each day in
    files of their own (many tasks a day) and rows sorted by time inside them, so
    parquet min/max statistics prune files and row groups too."""
    (df.withColumn(PARTITION_COLUMN, F.to_date(time_col))
       .repartitionByRange(PARTITION_COLUMN, time_col).sortWithinPartitions(PARTITION_COLUMN, time_col)
       .write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(path))


@dataclass(frozen=True)
class FunnelSources:
    """The eight inputs of every report.

    ``parts``: the same rows cut by response id, if they are stored so; joins by that id are
    made part by part. ``buckets``: of the response id in which the tables are stored, if they are.
    """

    bid_request: DataFrame
    bid_response: DataFrame
    bid_result: DataFrame
    bid_click: DataFrame
    track_event: DataFrame
    dim_strategy: DataFrame
    dim_creative: DataFrame
    app_mapping: DataFrame
    parts: tuple["FunnelSources", ...] = ()
    buckets: int = 0

    def by_id(self) -> tuple["FunnelSources", ...]:
        """The sources to join by response id, one after the other."""
        return self.parts or (self,)

    def replace(self, **kw) -> "FunnelSources":
        return replace(self, **kw)


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def load_sources(spark: SparkSession, source: TableSource, app_mapping: DataFrame | None = None,
                 window: tuple[dt.date, int] | None = None, reject_limit: float | None = None) -> FunnelSources:
    """All eight inputs from one location; the app mapping may come from a CSV.

    With ``reject_limit`` (a share, 0 for none at all) the stored tables are checked first: a column of
    the window with more values that its type rejects raises ``RejectedValues``.
    """
    stored = {n: read_table(spark, n, source, window) for n in EVENT_TABLES + DIM_TABLES}
    if reject_limit is not None:
        check_rejects(reject_ledger(stored, window), reject_limit)
    tables = {n: conform(df, n, source.day_column, source.lateness_days) for n, df in stored.items()}
    if app_mapping is None:
        try:
            app_mapping = load_table(spark, "app_mapping", source)
        except AnalysisException as e:  # a missing mapping is an empty mapping (SRC3); any other error is one
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            app_mapping = empty_table(spark, "app_mapping")
    return FunnelSources(app_mapping=app_mapping, **tables)
