"""Areas of relations, shapes and the coarse cells that they meet, and the view over all tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, grid, keys, shapes

# Base cells that are pentagons; under these no cell has 1 for its first digit other than 0.
PENTAGONS = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)


def cell_bounds(spark: SparkSession) -> DataFrame:
    """(id, h3_0, h3_1, h3_2, bbox, bounds) of all 41162 coarse cells: keys of their parents, and WKB polygons."""
    n = F.col("id")
    base, digits = F.floor(n / 343), [F.floor(n / 49) % 7, F.floor(n / 7) % 7, n % 7]
    first = F.coalesce(*[F.when(d != 0, d) for d in digits], F.lit(0))
    cells = spark.range(0, 122 * 343, 1, 16).where(~(base.isin(*PENTAGONS) & (first == 1)))
    bits = lambda k: sum((digits[i] if i < k else F.lit(7)) * (1 << (6 - 3 * i)) for i in range(3))
    key = lambda k: keys.wrapped((base * 512 + bits(k)).cast("long"), 16).cast("smallint")
    ring = grid.boundary_of(keys.from_coarse(F.col("id")), 3)
    closed = F.concat(F.col("ring"), F.slice("ring", 1, 1))

    @F.pandas_udf("binary")
    def polygon(rings: pd.Series) -> pd.Series:
        return pd.Series([shapes.polygon_wkb([np.array([(p["lon"], p["lat"]) for p in r])]) for r in rings], index=rings.index, dtype=object)

    rows = cells.select(key(3).alias("id"), key(0).alias("h3_0"), key(1).alias("h3_1"), key(2).alias("h3_2")).withColumn("ring", ring)
    return rows.select("id", "h3_0", "h3_1", "h3_2", geometry.box_wkb(geometry.bbox(F.col("ring"))).alias("bbox"), polygon(closed).alias("bounds"))


def cells_of(shape: str, bounds: DataFrame) -> Column:
    """The coarse cells whose area a row's shape meets, in order; empty if there are none, null for null.

    The cells' table (41162 rows whatever the data) goes to every task; a batch of shapes is held against the cells
    whose boxes its own boxes meet, then refined exactly.
    """
    return shapes.cells_met(F.col(shape), [(r["id"], bytes(r["bounds"])) for r in bounds.select("id", "bounds").collect()])


def met_cells(rows: DataFrame, shape: str, bounds: DataFrame) -> DataFrame:
    """(id, cell): the coarse cells whose area each row's shape meets, each once."""
    return rows.select("id", F.explode(cells_of(shape, bounds)).alias("cell")).distinct()


def regions(rows: DataFrame, shape: str, bounds: DataFrame, how: str = "inner") -> DataFrame:
    """(id, regions): the cells each shape meets, in order; with ``left`` rows without any have null."""
    found = rows.select("id", cells_of(shape, bounds).alias("regions"))
    return found.where(F.size("regions") > 0) if how == "inner" else found.select("id", F.when(F.size("regions") > 0, F.col("regions")).alias("regions"))


def ways_of_several(way_rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """The ways over several cells with ``h3_3_multi_regions``, by line: those that meet no cell are left out; one cell alone gives an empty array."""
    found = way_rows.where(F.col("h33") == keys.SEVERAL).withColumn("regions", cells_of("lineStringWkb", bounds)).where(F.size("regions") > 0)
    return found.withColumn("h3_3_multi_regions", F.when(F.size("regions") > 1, F.col("regions")).otherwise(F.array().cast("array<smallint>"))).drop("regions")


def assembled(relations: DataFrame, located_ways: DataFrame) -> DataFrame:
    """(id, wkb, tags): the area of every relation of type multipolygon or boundary, from its member ways.

    Lines are joined at common end nodes and rings nested by place. Relations with a missing way, an
    open ring or one of no area give no row. A relation's members are gathered in one task: the source
    bounds their number.
    """
    wanted = relations.where(F.coalesce(F.col("tags")["type"], F.lit("")).isin("multipolygon", "boundary"))
    members = wanted.select(F.col("id").alias("relation"), F.explode(F.filter("members", lambda m: m["member_type"] == "W")).alias("m")).select("relation", F.col("m.member_id").alias("way")).distinct()
    point = lambda c: F.transform("points", lambda p: p[c]).alias(c)
    places = located_ways.select(F.col("id").alias("way"), F.when(F.col("points").isNotNull(), F.struct(point("node_id"), point("lon"), point("lat"))).alias("at"))
    lines = members.join(places, "way", "left").groupBy("relation").agg(F.array_sort(F.collect_list(F.struct("way", "at"))).alias("lines"))

    @F.arrow_udf("binary")
    def build(column: pa.Array) -> pa.Array:
        n = column.value_lengths().to_numpy(zero_copy_only=False)
        at = column.flatten().field("at")
        known = at.is_valid().to_numpy(zero_copy_only=False)
        ids, lon, lat = (at.field(c) for c in ("node_id", "lon", "lat"))
        sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) * known
        keep = pa.array(known)
        ids, lon, lat = (c.filter(keep).flatten() for c in (ids, lon, lat))
        ids, xy = ids.to_numpy(zero_copy_only=False).tolist(), np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in (lon, lat)], axis=1)
        ends, last = np.cumsum(sizes).tolist(), np.cumsum(n).tolist()
        out, first = [], 0
        for end in last:
            shape = None
            if known[first:end].all():
                shape = shapes.assembled([(ids[ends[k] - sizes[k] : ends[k]], xy[ends[k] - sizes[k] : ends[k]]) for k in range(first, end) if sizes[k]])
            out.append(shapes.multipolygon_wkb(shape) if shape else None)
            first = end
        return pa.array(out, pa.binary())

    made = lines.select(F.col("relation").alias("id"), build(F.col("lines")).alias("wkb")).where("wkb is not null")
    return made.join(wanted.select("id", "tags"), "id")


def multipolygons(areas: DataFrame, bounds: DataFrame) -> DataFrame:
    """The multipolygon table from (id, wkb, tags): keys, scale in metres, box, centre, regions; in order of key."""
    # each row by its own shape: areas are made once, and joined with nothing
    rows = areas.withColumn("regions", cells_of("wkb", bounds)).withColumn("regions", F.when(F.size("regions") > 0, F.col("regions"))).withColumn("c", shapes.circle_of(F.col("wkb")))
    lat, lon = F.col("c.lat"), F.col("c.lon")
    one = F.size("regions") == 1
    return rows.select(
        F.when(one, F.col("regions")[0]).otherwise(F.lit(keys.SEVERAL)).cast("smallint").alias("h3_3"), keys.fine(grid.cell_of(lat, lon, 8)).alias("h3_8"),
        geometry.geodesic(lat, F.col("c.radius").cast("float").cast("double")).cast("float").alias("scale"), "tags", geometry.box_wkb(shapes.bbox_of(F.col("wkb"))).alias("bbox"),
        "id", geometry.line_wkb(F.array(F.struct(lat.alias("lat"), lon.alias("lon")))).alias("centre"), F.col("wkb").alias("polygon"), F.when(F.size("regions") > 1, F.col("regions")).alias("h3_3_multi_regions"),
    )


def global_view(node_rows: DataFrame, way_rows: DataFrame, area_rows: DataFrame) -> DataFrame:
    """(id, h3_3, h3_8, scale, type, centre, geom, tags) of nodes, ways and areas; nodes have scale 0."""
    point = geometry.line_wkb(F.array(F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))))
    n = node_rows.select("id", F.col("h33").alias("h3_3"), F.col("h38").alias("h3_8"), F.lit(0).cast("float").alias("scale"), F.lit("nodes").alias("type"), point.alias("centre"), point.alias("geom"), "tags")
    w = way_rows.select("id", F.col("h33").alias("h3_3"), F.col("h38").alias("h3_8"), "scale", F.lit("ways").alias("type"), point.alias("centre"), F.col("lineStringWkb").alias("geom"), "tags")
    a = area_rows.select("id", "h3_3", "h3_8", "scale", F.lit("multipolygon").alias("type"), "centre", F.col("polygon").alias("geom"), "tags")
    return n.unionByName(w).unionByName(a)


def cells_of_all(node_rows: DataFrame, way_rows: DataFrame, area_rows: DataFrame) -> DataFrame:
    """The distinct (h3_3, h3_8) of the three tables."""
    n, w = (r.select(F.col("h33").alias("h3_3"), F.col("h38").alias("h3_8")) for r in (node_rows, way_rows))
    return n.distinct().union(w).union(area_rows.select("h3_3", "h3_8")).distinct()
