"""Independent Spark jobs submitted side by side.

The jobs of a report are many and small beside its one pass over the fact: each alone leaves
most of a cluster idle while its last tasks run. Submitted together they share it (the
scheduler runs the tasks of all of them); what each one computes is unchanged. Settings of the
session for a block of jobs are here too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

R = TypeVar("R")
WIDTH = 6


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], R]], width: int = WIDTH) -> list[R]:
    """The results of ``jobs`` in their order, at most ``width`` at a time; the first failure is raised when all have ended.

    Threads take the session's local properties (job group, scheduler pool) with them.
    """
    jobs = list(jobs)
    if len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(min(width, len(jobs))) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [d.result() for d in done]


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Jobs of the block delete their shuffles when they end. Otherwise these stay on the executors' disks until the driver
    collects its garbage. For jobs whose results are written: what is planned here and run again would shuffle again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Shuffles that are planned in the block have ``n`` partitions."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {k: v for k in names if (v := spark.conf.get(k, None)) is not None}
    for k in before:
        spark.conf.set(k, str(n))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
