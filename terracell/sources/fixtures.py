"""Domain tables derived from the test tables: raw nodes, ways and relations (keys are synthetic)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 512
ENTRIES = "array<struct<k:string,v:string>>"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries(*pairs: tuple[Column | None, str, Column]) -> Column:
    """Entries whose condition holds (None: always), in order."""
    made = [F.struct(F.lit(k).alias("k"), v.alias("v")) for _, k, v in pairs]
    return F.array_compact(F.array(*[m if c is None else F.when(c, m) for (c, _, _), m in zip(pairs, made, strict=True)])).cast(ENTRIES)


def cell(k: Column) -> Column:
    """A synthetic resolution-8 index: base cell k mod 122 and digits below 7."""
    digit = [(31, 7), (17, 3), (13, 5), (11, 1), (7, 2), (5, 4), (3, 6), (19, 0)]
    out = F.lit(0x0880000000000000 | 0x1FFFFF).bitwiseOR(F.shiftleft(k % 122, 45))
    for i, (a, b) in enumerate(digit):
        out = out.bitwiseOR(F.shiftleft((k * a + b) % 7, 42 - 3 * i))
    return out


def raw_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    tags = entries(
        (k % 7 != 0, "segment", F.col("c_mktsegment")), (k % 7 != 0, "name", F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("c_name"))),
        (k % 7 != 0, "segment", F.lit("dup")), (k % 7 != 0, "building", F.when(k % 3 == 0, F.lit("yes")).otherwise(F.lit("\t"))),
    )
    d = F.lit(100000.0)
    return read(spark, sf_dir, "customer").select(
        F.floor(k / BLOCK).alias("block_id"), k.alias("id"), (k * 1000).alias("ts_millis"), ((k * 7919) % 16000001 / d - 80).alias("lat"), ((k * 104729) % 36000001 / d - 180).alias("lon"), cell(k).alias("cell"), tags.alias("entries")
    )


def raw_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways with ordered node ids, every eighth closed; orders without a line have no points and are left out."""
    n = read(spark, sf_dir, "customer").agg(F.count("*").alias("n_nodes"))
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = read(spark, sf_dir, "lineitem").join(F.broadcast(n)).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(place.alias("at"), (F.col("l_partkey") % F.col("n_nodes")).alias("node")))).alias("x"))
    status, kind = F.col("o_orderstatus"), F.col("o_orderpriority")
    tags = entries((status == "F", "building", F.lit("yes")), (status == "P", "Building", F.lit("yes")), (kind.startswith("1"), "highway", kind), (F.col("o_custkey") % 11 == 0, "amenity", F.lit("school")))
    millis = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(o_orderdate as timestamp_ntz)) * 1000L")
    return read(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.floor(F.col("o_orderkey") / BLOCK).alias("block_id"), F.col("o_orderkey").alias("id"), millis.alias("ts_millis"), F.when((F.col("o_orderkey") % 8 == 0) & (F.size("x") > 1), F.concat("x.node", F.slice("x.node", 1, 1))).otherwise(F.col("x.node")).alias("node_ids"), tags.alias("entries")
    )


def raw_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of a part with its orders, in order of (order, line, supplier, price)."""
    at = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    kind = F.when(F.col("l_linenumber") % 3 == 0, "N").when(F.col("l_linenumber") % 3 == 1, "W").otherwise("R")
    member = F.struct(F.col("l_orderkey").alias("member_id"), kind.alias("member_type"), F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_returnflag")).alias("member_role"))
    lines = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct(at.alias("at"), member.alias("member")))).alias("x"))
    k = F.col("p_partkey")
    tags = entries((k % 3 == 0, "type", F.lit("multipolygon")), (k % 3 == 1, "type", F.lit("route")), (None, "name", F.col("p_name")))
    return read(spark, sf_dir, "part").join(lines, k == F.col("l_partkey"), "left").select(F.floor(k / BLOCK).alias("block_id"), k.alias("id"), tags.alias("entries"), F.coalesce("x.member", F.array().cast("array<struct<member_id:bigint,member_type:string,member_role:string>>")).alias("members"))


def near(points: Column, share: float) -> Column:
    """Points drawn together around a place on land, to ``share`` of their distances."""
    move = lambda p: F.struct(p["node_id"].alias("node_id"), (p["lat"] * share + 13.75).alias("lat"), (p["lon"] * share + 100.5).alias("lon"))
    return F.transform(points, move)
