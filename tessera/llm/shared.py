"""Scratch tables, reserved columns and connected components shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, ship, stored

__all__ = ["bucketed", "components", "partitions", "picked", "ship", "sorted_buckets", "stored", "trimmed", "unused", "without"]


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving freed memory back to the system when a task ends: Python workers live on and serve later stages."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it
                ctypes.CDLL(None).malloc_trim(0)

    return whole


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucketed(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """df written to the scratch folder in buckets by key, each sorted by it, and read back: joins on the key move no row.

    There are as many buckets as shuffle partitions, so a df that is dealt out by key gives a file a bucket. The name in the
    catalogue goes at once, the files stay like those of `stored`. The second table reads the same files without their
    buckets, for unions: Spark 4.1 takes a union of bucketed tables for dealt out by key, but doesn't zip its buckets
    (spark.sql.unionOutputPartitioning), so that a sum by key over it is wrong.
    """
    spark, name = df.sparkSession, f"tessera_{uuid.uuid4().hex}"
    at = f"{scratch_dir(spark)}/{name}"
    df.write.format("parquet").bucketBy(partitions(spark), key).sortBy(key).option("path", at).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out, spark.read.schema(df.schema).parquet(at)


@contextlib.contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """While it lasts, plans trust the order of buckets that are one file each, so merge joins don't sort them again."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unused(table: DataFrame, name: str) -> str:
    """name, or with underscores before it if the table has such a column."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(table: DataFrame, *names: str) -> DataFrame:
    """table without columns of these names, in any case."""
    gone = {n.lower() for n in names}
    return table.select(*(table[f"`{c}`"] for c in table.columns if c.lower() not in gone))


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, whatever else the table holds."""
    ship(df.sparkSession)
    return df.select(*(df[f"`{old}`"].alias(new) for new, old in columns.items()))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) for each node, root the smallest node reachable.

    Alternating large-star and small-star rounds; each round is two aggregations of pairs, so no
    neighbourhood is ever gathered into one row, and the pairs never come to the driver.
    """
    e = stored(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct())
    before = None
    while True:
        both = e.union(e.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b AS a", "m AS b").union(low.selectExpr("a", "m AS b")).where("a <> b").distinct()
        e = stored(small)
        now = e.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(a, b)), 0)"), F.expr("coalesce(sum(xxhash64(a, b) & 4294967295), 0)")).first()
        if now == before:
            return e.selectExpr("a AS node", "b AS root").union(e.selectExpr("b AS node", "b AS root").distinct())
        before = now
