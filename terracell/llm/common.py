"""What several of the operators share: cut lineage, running sums, components, text access."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; a folder of this machine only in local mode (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ckpt-"))


BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of at most 1000 rows or 16 MB, from here on in this session,
    unless it has smaller ones: both processes hold a batch several times, in every task."""
    for name, most in BATCH.items():
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) if name.endswith("BytesPerBatch") else int(spark.conf.get(name))
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: what follows reads files that every executor shares."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which goes when the application ends."""
    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return at


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark drops a query's shuffle files at its end


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that start here own their shuffle files, which go when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, as compressed Parquet in the same shared folder: for wide rows, and for the
    disk that shuffles before it hold."""
    spark = df.sparkSession
    at = shared_folder(spark, "stored")
    with own_shuffles(spark):
        df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like those wanted that ``df`` lacks, whatever their case."""
    has, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in has:
            name += "_"
        has.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running(df: DataFrame, key: list[str], order: list[Column], weight: Column, out: str, rows: int) -> DataFrame:
    """Exclusive running sum of ``weight`` within ``key``, where no task holds a whole key.

    Each key is dealt into hash buckets, as many as the square root of the rows; a window sums
    inside a bucket and a second window over a key's bucket totals gives each bucket its base. The
    order is by (bucket, ``order``): any fixed order serves the callers. Key columns must not
    be null. ``rows`` is the row count of ``df``, which must be cheap to read twice.
    """
    b, w, r, s, base_ = fresh(df, "_b", "_w", "_r", "_s", "_base")
    buckets = max(1, math.isqrt(rows))
    dealt = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")).withColumn(w, weight)
    within = Window.partitionBy(*key, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy(*key, b).agg(F.sum(w).alias(s)).select(*key, b, F.coalesce(F.sum(s).over(across), F.lit(0)).alias(base_))
    return (
        dealt.withColumn(r, F.coalesce(F.sum(w).over(within), F.lit(0)))
        .join(base.hint("merge"), [*key, b])  # the bucket totals grow with the rows
        .withColumn(out, (F.col(r) + F.col(base_)).cast("long"))
        .drop(b, w, r, base_)
    )


def matched(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join of two sides that grow with the rows: by sorting, so that no side is ever built on the driver,
    whatever ``spark.sql.autoBroadcastJoinThreshold`` lets through (10 MB of shuffled longs take far more there)."""
    return left.join(right.hint("merge"), on, how)


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of (a, b) rows by alternating large and small stars.

    Returns (node, component) for every node that has an edge, component being its smallest
    reachable node. Each round is two grouped minima and joins, checkpointed; a hub is never
    gathered in one task (minima combine before the shuffle, AQE splits the joins).
    """
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = matched(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = matched(large, low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = cut(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

