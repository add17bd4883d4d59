"""SRC3: the app package -> app name mapping file (CSV, UTF-8 with BOM).

Fields may be quoted, with doubled quotes, commas and line breaks inside; texts that
stand for a missing value are nulls, and white space around names is cut off later
(``app_names``). A missing file, or one without the two required columns, is an empty
mapping.  The three ranking columns are optional (defaults: 0, 0, null).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.sources.schema import SCHEMAS

REQUIRED = ("app_package_name", "app_name")
OPTIONAL = ("is_verified", "request_count", "etl_time")
CORRUPT = "_corrupt_record"
# Texts that the reference's CSV reader takes as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# One file is one task, whatever its line breaks: a mapping is a dimension, far below an event table.
DIALECT = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "multiLine": "true", "inferSchema": "false",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE"}


def read_mapping(spark: SparkSession, path: str) -> DataFrame | None:
    """All columns of the file as text, and ``_corrupt_record``: the text of rows with too few or too many fields.

    None if the file is missing.
    """
    try:
        header = spark.read.options(**DIALECT).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    names = [c.lstrip("\ufeff").strip() for c in header.columns]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header.columns, CORRUPT]])
    rows = spark.read.options(**DIALECT, columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(path)
    return rows.toDF(*names, CORRUPT)


def load_app_mapping(spark: SparkSession, path: str | None, strict: bool = False) -> DataFrame:
    """The mapping's five columns as text; ``strict``: rows with a wrong number of fields raise a ``ValueError``."""
    empty = spark.createDataFrame([], SCHEMAS["app_mapping"])
    raw = read_mapping(spark, path) if path else None
    if raw is None or not set(REQUIRED).issubset(raw.columns):
        return empty
    if strict:
        bad = raw.select(*[c for c in raw.columns if c in REQUIRED], CORRUPT).filter(F.col(CORRUPT).isNotNull()).limit(1).collect()
        if bad:
            raise ValueError(f"a row of {path} has a wrong number of fields: {bad[0][CORRUPT]!r}")
    out = [F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in REQUIRED]
    for c in OPTIONAL:
        out.append((F.col(c) if c in raw.columns else F.lit(None).cast("string")).alias(c))
    return raw.select(*out)
