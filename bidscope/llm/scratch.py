"""Intermediate tables in the folder that the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Of a batch of rows on its way to a Python worker and back; a row longer than that is a batch of its own.
BATCH_BYTES = 4 << 20


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only for a local master that has none set."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table, in the application's folder, which goes when the driver ends."""
    sc = spark.sparkContext
    folder = f"{scratch_root(spark)}/llm/{sc.applicationId}"
    if folder not in _marked:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _marked.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the scratch folder and read it back: lineage ends there, lost executors reread files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    # Shuffle files go when the driver collects the frames that made them: ask for it, so disks hold one step's.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession) -> None:
    """Texts go to the Python workers in batches of at most ``BATCH_BYTES``, whatever the rows' lengths; a session's lower bound is kept."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(bound).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(bound, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have the repository on their path."""
    bound_batches(spark)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    packed = Path(tempfile.mkdtemp(prefix="llm-code-")) / "bidscope_llm.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted((root / "bidscope").rglob("*.py")):
            out.write(source, source.relative_to(root))
    sc.addPyFile(str(packed))
    _shipped.add(sc.applicationId)


_shipped: set[str] = set()
_marked: set[str] = set()
