"""Small helpers of the operators: scratch tables and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_scratch_dir

#: Rows of a few numbers that make up a task.
TASK_ROWS = 1 << 16
#: Bytes that go to a Python worker at once; less than the steps of texts in which keys are made, so as not to cut them anew.
BATCH_BYTES = 7 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the session's shared scratch folder and read it again.

    Cuts the lineage: a lost executor costs the tasks it ran and nothing before them. What
    is read has no known partitioning, so that joins shuffle it and skewed joins can split it. The shuffles
    that led to it are removed once it is written.
    """
    path = new_scratch_dir(df.sparkSession, label)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    was = spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_CLEANED)
        else:
            spark.conf.set(_CLEANED, was)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def few(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df``, worth about ``rows`` rows, in no more tasks than one for ``each`` of them, but for all cores at least.

    A task that writes a file costs far more than a handful of rows, so that a small table in many partitions takes the
    longer the more of them there are. Tables with rows for all partitions stay as they are. Partitions follow each other whole
    and in their order within a task.
    """
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends rows to Python workers in batches of about ``BATCH_BYTES``, or a single row.

    Spark's own limit is 10,000 rows or 64 MB. Each task holds a batch of texts in the JVM, in buffers outside the heap, and another one in its
    worker, and both keep most of that memory for later tasks. A limit that the session has been given stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_LIMIT, None) is None:
        conf.set(_LIMIT, str(BATCH_BYTES))
    return df


def smallest_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` indexes that each one reaches over the pairs."""
    low = np.arange(n)
    while True:
        a, b = low[i], low[j]
        hung = low.copy()
        np.minimum.at(hung, a, b)
        np.minimum.at(hung, b, a)
        while (hung[hung] != hung).any():
            hung = hung[hung]
        if (hung == low).all():
            return low
        low = hung


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """The smallest node that each node of ``edges (a, b)`` can reach, as ``(node, component)``.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each step hangs the
    neighbours of a node under the smallest of them, so that paths halve and the edges
    end as stars. A minimum per node is combined before the shuffle; the joins that bring it back
    have both sides in stored tables, so a node with very many edges is split. Each step is
    written to the shared folder, few edges to few files; ``edges`` are counted first, so they had better be stored. Nodes without edges are not in the result.
    """
    rows = edges.count()  # later steps have no more
    edges = stored(
        few(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), rows),
        label,
    )
    while not _are_stars(edges, rows):
        # large star: larger neighbours of a node under the smallest one
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = stored(few(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), rows), label)
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = stored(few(large, rows), label)
        # small star: a node and its smaller neighbours under the smallest one
        lowest = stored(few(large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n")), rows), label)
        moved = large.join(lowest.where("n > 1").drop("n"), "a").where("b <> low").select(F.col("b").alias("a"), "low")
        small = moved.union(lowest.select("a", "low")).withColumnRenamed("low", "b").distinct()
        edges = stored(few(small, rows), label)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _are_stars(edges: DataFrame, rows: int) -> bool:
    """Whether each node hangs under one node only, which hangs under none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return few(nodes, rows).where("up + down > 1").isEmpty()
