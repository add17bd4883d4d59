"""SRC1, SC6: the reject ledger -- stored values that the declared types cannot hold.

``conform`` turns such values into nulls (and an unreadable ``wpr`` counts as 0), as the reports
need; the ledger counts them by table and column, so that a broken feed is seen before
its nulls are taken for missing data.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.sources.schema import SCHEMAS, TIME_COLUMNS

LEDGER_SCHEMA = "table string, column string, stored string, declared string, filled bigint, rejected bigint"
# Texts that reports read as numbers.
NUMBER_TEXTS = {"bid_result": ("wpr",)}


class RejectedValues(ValueError):
    """A column has a larger share of unreadable values than allowed."""


def _casts(df: DataFrame, name: str) -> dict[str, tuple[T.DataType, Column, Column]]:
    """Columns whose values may be lost: declared type, whether a value is filled in, whether it is unreadable."""
    out = {}
    for f in SCHEMAS[name].fields:
        if f.name not in df.columns:
            continue
        stored, kind = df.schema[f.name].dataType, f.dataType
        if f.name in NUMBER_TEXTS.get(name, ()):
            kind = T.DoubleType()
        if stored == kind or isinstance(kind, T.StringType):
            continue
        c = F.col(f.name)
        filled = c.isNotNull() & (c.cast("string") != "") if isinstance(stored, T.StringType) else c.isNotNull()
        out[f.name] = (kind, filled, filled & c.try_cast(kind).isNull())
    return out


def reject_ledger(tables: dict[str, DataFrame], window: tuple[dt.date, int] | None = None) -> DataFrame:
    """One row for each column that is cast: filled values, and those that the declared type rejects.

    ``tables`` are stored tables by logical name, as read. Each is read once, only its cast
    columns; tables that are stored in their declared types are not read. ``window`` (start day,
    days) limits event tables to rows of that time and rows without a readable time. Blank texts
    are not filled, so they are no rejects.
    """
    parts = []
    for name, df in tables.items():
        casts = _casts(df, name)
        if not casts:
            continue
        if window and name in TIME_COLUMNS:
            start, days = window
            t = F.col(TIME_COLUMNS[name]).try_cast("timestamp_ntz")
            end = start + dt.timedelta(days=days)
            df = df.filter(t.isNull() | ((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz"))))
        sums = df.agg(*[F.count(F.when(hit, 1)).alias(f"{kind}_{c}") for c, (_, filled, bad) in casts.items()
                        for kind, hit in (("filled", filled), ("rejected", bad))])
        rows = [F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("stored"),
                         F.lit(kind.simpleString()).alias("declared"), F.col(f"filled_{c}").alias("filled"), F.col(f"rejected_{c}").alias("rejected"))
                for c, (kind, _, _) in casts.items()]
        parts.append(sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    if not parts:
        return next(iter(tables.values())).sparkSession.createDataFrame([], LEDGER_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def check_rejects(ledger: DataFrame, limit: float) -> list[dict]:
    """The ledger's rows (one a column); raises if a column rejects more than the share ``limit`` of its filled values."""
    rows = [r.asDict() for r in ledger.collect()]
    over = [r for r in rows if r["rejected"] > limit * r["filled"]]
    if over:
        raise RejectedValues("; ".join(f"{r['table']}.{r['column']}: {r['rejected']} of {r['filled']} values are no {r['declared']}" for r in over))
    return rows
