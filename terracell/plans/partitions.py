"""Data-driven range partitions over coarse keys, and the rows' way into them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys

RATIO = 0.48


def plan(cells: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(id, lo, hi, size): ordered packing of (h33, size) into ranges [lo, hi).

    Sizes are summed by parent; parents are taken in key order, and a range closes before the
    parent that would bring it to ``ratio`` times the largest parent. Parents number at most
    122 x 49, so folding them in one row is bounded whatever the data.
    """
    by_parent = cells.where(F.col("h33") != keys.SEVERAL).groupBy(keys.parent(F.col("h33")).alias("h2")).agg(F.sum("size").cast("long").alias("sz"))
    one = by_parent.agg(F.array_sort(F.collect_list(F.struct("h2", "sz"))).alias("xs"), F.floor(F.max("sz").cast("double") * F.lit(float(ratio))).alias("most"))
    ranges = "array<struct<lo:int,hi:int,size:bigint>>"
    fold = f"""aggregate(xs, named_struct('lo', {keys.LOWEST}, 'now', 0L, 'out', cast(array() as {ranges})),
      (s, x) -> if(s.now > 0 and s.now + x.sz >= most,
        named_struct('lo', x.h2 & ~7, 'now', x.sz, 'out', concat(s.out, array(named_struct('lo', s.lo, 'hi', x.h2 & ~7, 'size', s.now)))),
        named_struct('lo', s.lo, 'now', s.now + x.sz, 'out', s.out)),
      s -> if(s.now <> 0, concat(s.out, array(named_struct('lo', s.lo, 'hi', {keys.HIGHEST}, 'size', s.now))), s.out))"""
    return one.select(F.posexplode(F.expr(fold)).alias("id", "r")).select("id", "r.lo", "r.hi", "r.size")


def assigned(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with part_id; keys outside every range, SEVERAL among them, go to the default part.

    Ranges break at parents only, so a table of each parent's part, 8192 rows whatever the data, is
    hash-joined on the rows' parents; no row is compared with a range.
    """
    bounded = ranges.select(F.col("id").alias("_part"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    first = rows.sparkSession.range(keys.LOWEST, -keys.LOWEST, 8).select(F.col("id").alias("_first"))
    of = first.join(F.broadcast(bounded), (F.col("_first") >= F.col("_lo")) & (F.col("_first") < F.col("_hi"))).select(F.col("_first").cast("int").bitwiseOR(7).alias("_parent"), "_part", "_hi")
    out = rows.join(F.broadcast(of), keys.parent(F.col("h33")) == F.col("_parent"), "left")
    return out.withColumn("part_id", F.when(F.col("h33") < F.col("_hi"), F.col("_part")).otherwise(F.lit(keys.SEVERAL))).drop("_parent", "_part", "_hi")


def parts_of(ranges: DataFrame, lo: int, hi: int) -> list[int]:
    """The parts that keys from lo to hi can be in: for a filter on part_id that prunes folders."""
    found = ranges.where((F.col("lo") <= hi) & (F.col("hi") > lo)).select("id").collect()
    return [*(r[0] for r in found), keys.SEVERAL]


def chunked(ranges: DataFrame, scripts: int) -> DataFrame:
    """(script, ids): consecutive partitions dealt to import scripts."""
    n = ranges.agg((F.floor(F.count("*") / scripts) + 1).alias("per"))
    placed = ranges.join(F.broadcast(n)).withColumn("script", F.floor(F.col("id") / F.col("per")))
    return placed.groupBy("script").agg(F.array_join(F.array_sort(F.collect_list("id")).cast("array<string>"), ",").alias("ids"))
