"""SRC1 with JN1, JN2, JN7: event tables stored together by response id.

Requests, responses, wins and clicks meet by one id. ``write_event_store`` buckets all
four by it, so that joining them on the id and a second key shuffles none of them (the
session needs ``spark.sql.requireAllClusterKeysForCoPartition=false``; ``get_session``
sets it). Days are folders, as in ``write_event_table``, and rows of a file are sorted by id.

A bucket cannot be split while it is joined, so an id that holds a large part of the rows
(a blank one, for example) must not be in one. Ids with more than ``hot_rows`` rows in any
of the tables are *hot*: their rows go to plain tables of the same names (``_hot``) in all four,
and their joins shuffle as usual, where the adaptive planner splits hot partitions. An id
is hot in all tables or in none, so joins of the two parts are the join of the whole.
Tables are written one after the other and their shuffles deleted, so that the disk holds the store and the
shuffles of one table: that by id which makes the buckets, then that which finds the hot rows.
``load_event_store`` gives both: whole tables, and the two parts that are joined apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.plans.together import shuffle_partitions, shuffles_deleted
from bidscope.sources.schema import TIME_COLUMNS
from bidscope.sources.tables import PARTITION_COLUMN, FunnelSources, conform

# The id that each table is stored by. Page tracks name theirs inside a text, by report rules, and stay as they are.
STORE_KEYS = {"bid_request": "request_id", "bid_response": "response_id", "bid_result": "response_id", "bid_click": "response_id"}
# What is written while the disk is emptiest.
LARGEST_FIRST = ("bid_response", "bid_request", "bid_result", "bid_click")


@dataclass(frozen=True)
class EventStore:
    """Where a store is and how it is cut.

    ``database``: of the catalog; ``root``: folder of its tables; ``buckets``: of every table, about one
    for each 256 MB of the largest table's day; ``hot_rows``: rows from which an id is hot, well below a bucket's.
    """

    database: str
    root: str
    buckets: int = 256
    hot_rows: int = 1_000_000
    prefix: str = ""

    def table(self, name: str) -> str:
        return f"{self.database}.{self.prefix}{name}"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}{name}"


def buckets_for(src: FunnelSources, least: int, rows: int = 500_000) -> int:
    """So many buckets that those of the largest table hold about ``rows`` rows, and ``least`` or more: the tasks
    that write and join buckets then stay of one size, however large the tables are."""
    counts = [getattr(src, name).agg(F.count(F.lit(1)).alias("n")) for name in STORE_KEYS]
    most = reduce(DataFrame.unionByName, counts).agg(F.max("n")).first()[0]
    return max(least, -(-most // rows))


def hot_ids(src: FunnelSources, store: EventStore) -> DataFrame:
    """(id, n): ids of more than ``hot_rows`` rows in one of the tables, null among them if it is, and the most rows.

    At most one id for each ``hot_rows`` rows. Counts are combined map-side.
    """
    counts = [getattr(src, name).groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > F.lit(store.hot_rows)) for name, key in STORE_KEYS.items()]
    return reduce(DataFrame.unionByName, counts).groupBy("id").agg(F.max("n").alias("n"))


def _same_id(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("id"))


#: The hottest ids, whose rows are left out before the rows of a table are dealt to buckets: an id
#: that goes to its bucket, to be left out there, has less than one of so many parts of the rows.
HOTTEST = 10_000


def write_event_store(src: FunnelSources, store: EventStore) -> None:
    """Write the five event tables; existing tables of these names are replaced.

    One after the other, the largest first, so that the disk holds the shuffle of one table at a time: it is
    deleted when the table is written.
    """
    spark = src.bid_response.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {store.database}")

    def dated(name: str) -> DataFrame:
        return getattr(src, name).withColumn(PARTITION_COLUMN, F.to_date(TIME_COLUMNS[name]))

    def even(name: str, key: str) -> None:
        # The shuffle that deals the rows to the writer's buckets, so that every bucket of a day is one file, is that of the
        # join too. An anti join would be moved below it and have one of its own.
        cold = dated(name).join(F.broadcast(hottest), _same_id(key), "left_anti").repartition(store.buckets, key)
        (cold.join(others, F.col(key) == F.col("id"), "left").filter(~F.coalesce("_hot", F.lit(False))).drop("id", "_hot")
         .write.mode("overwrite").partitionBy(PARTITION_COLUMN).bucketBy(store.buckets, key).sortBy(key)
         .option("path", store.path(name)).saveAsTable(store.table(name)))

    def by_time(dated: DataFrame, name: str, time: str) -> None:
        (dated.repartitionByRange(PARTITION_COLUMN, time)
         .write.mode("overwrite").partitionBy(PARTITION_COLUMN).option("path", store.path(name)).saveAsTable(store.table(name)))

    with shuffles_deleted(spark):
        hot_ids(src, store).write.mode("overwrite").parquet(store.path("hot_ids"))
        ids = spark.read.parquet(store.path("hot_ids"))
        hot = ids.select("id")
        # null first: it is in no bucket's join
        hottest = ids.orderBy(F.col("id").isNull().desc(), F.col("n").desc(), "id").limit(HOTTEST).select("id")
        others = hot.withColumn("_hot", F.lit(True)).repartition(store.buckets, "id").hint("shuffle_hash")
        for name in LARGEST_FIRST:
            key = STORE_KEYS[name]
            with shuffle_partitions(spark, store.buckets):      # a join with fewer buckets than that would have a shuffle
                even(name, key)
            by_time(dated(name).join(hot, _same_id(key), "left_semi"), f"{name}_hot", TIME_COLUMNS[name])
        by_time(dated("track_event"), "track_event", TIME_COLUMNS["track_event"])


def load_event_store(spark: SparkSession, store: EventStore, dims: FunnelSources, lateness_days: int = 0) -> FunnelSources:
    """The stored event tables with the dimensions of ``dims``, in two parts that are joined apart."""
    def read(name: str, suffix: str = "") -> DataFrame:
        return conform(spark.read.table(store.table(name + suffix)), name, PARTITION_COLUMN, lateness_days)

    tracks = read("track_event")
    even = dims.replace(track_event=tracks, buckets=store.buckets, **{n: read(n) for n in STORE_KEYS})
    hot = dims.replace(track_event=tracks, **{n: read(n, "_hot") for n in STORE_KEYS})
    whole = {n: getattr(even, n).unionByName(getattr(hot, n)) for n in STORE_KEYS}
    return dims.replace(track_event=tracks, parts=(even, hot), **whole)


def drop_event_store(spark: SparkSession, store: EventStore) -> None:
    """Forget the store's tables and delete their files."""
    for name in [*STORE_KEYS, *[f"{n}_hot" for n in STORE_KEYS], "track_event"]:
        spark.sql(f"DROP TABLE IF EXISTS {store.table(name)}")
    sc = spark.sparkContext
    for name in [*STORE_KEYS, *[f"{n}_hot" for n in STORE_KEYS], "track_event", "hot_ids"]:
        path = sc._jvm.org.apache.hadoop.fs.Path(store.path(name))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
