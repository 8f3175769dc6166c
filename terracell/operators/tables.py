"""From raw entities to the tables: node, way and relation enrichment, locations, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, grid, keys, tags

SEVERAL_METRES = 3000


def nodes(raw: DataFrame) -> DataFrame:
    """Raw nodes with their keys: of the column ``cell`` if there is one, or of the cells that hold their positions."""
    lat, lon = F.col("lat"), F.col("lon")
    coarse, fine = (F.col("cell"),) * 2 if "cell" in raw.columns else (grid.cell_of(lat, lon, 3), grid.cell_of(lat, lon, 8))
    return raw.select("block_id", "id", keys.coarse(coarse).alias("h33"), keys.fine(fine).alias("h38"), lat.alias("latitude"), lon.alias("longitude"), tags.tag_map(F.col("entries")).alias("tags"), "entries", "ts_millis")


def node_table(nodes_: DataFrame) -> DataFrame:
    """The columns of the nodes table."""
    return nodes_.select("id", "h33", "h38", "latitude", "longitude", "tags")


def located(raw_ways: DataFrame, nodes_: DataFrame) -> DataFrame:
    """Each way's points (node_id, lat, lon, h33, h38) in order; nodes that are missing are left out.

    One shuffle by node id to look locations up, one by way to gather them: no node table is
    broadcast, and a node of many ways is split by adaptive skew joins.
    """
    at = raw_ways.select("id", F.posexplode("node_ids").alias("at", "node_id"))
    place = nodes_.select(F.col("id").alias("node_id"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "h33", "h38")
    points = at.join(place, "node_id").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "node_id", "lat", "lon", "h33", "h38"))).alias("x"))
    return raw_ways.join(points, "id").withColumn("points", F.transform("x", lambda p: p.dropFields("at"))).drop("x")


def located_in_file(raw_ways: DataFrame) -> DataFrame:
    """The same for ways whose file holds their points' places (lats, lons); others are left out. No shuffle."""
    has = raw_ways.where(F.col("lats").isNotNull() & F.col("lons").isNotNull() & (F.size("lats") == F.size("node_ids")) & (F.size("lons") == F.size("node_ids")) & (F.size("node_ids") > 0))
    cells = has.withColumn("c3", grid.cells_of(F.col("lats"), F.col("lons"), 3)).withColumn("c8", grid.cells_of(F.col("lats"), F.col("lons"), 8))
    zipped = F.arrays_zip(F.col("node_ids").alias("node_id"), F.col("lats").alias("lat"), F.col("lons").alias("lon"), F.col("c3"), F.col("c8"))
    point = lambda p: F.struct(p["node_id"].alias("node_id"), p["lat"].alias("lat"), p["lon"].alias("lon"), keys.coarse(p["c3"]).alias("h33"), keys.fine(p["c8"]).alias("h38"))
    return cells.withColumn("points", F.transform(zipped, point)).drop("lats", "lons", "c3", "c8")


def unwanted(entries: Column, buildings: bool = False, highways: bool = False) -> Column:
    """Ways to skip by the exact keys."""
    named = lambda key: F.exists(entries, lambda e: e["k"] == key)
    return (F.lit(buildings) & named("building")) | (F.lit(highways) & named("highway"))


def ways(located_: DataFrame) -> DataFrame:
    p, box = F.col("points"), geometry.bbox(F.col("points"))
    cells = F.transform(p, lambda x: x["h33"])
    out = located_.select("block_id", "id", "ts_millis", "entries", "points", F.transform(p, lambda x: x["node_id"]).alias("point_ids"), tags.tag_map(F.col("entries")).alias("tags"), keys.common_cell(cells).alias("h33"), geometry.closed(p).alias("closed"), geometry.valid(p).alias("valid"), box.alias("bbox"), geometry.centroid(p).alias("centre"))
    return out.withColumns({"building": tags.has(F.col("tags"), "building"), "highway": tags.has(F.col("tags"), "highway"), "extent": geometry.extent(F.col("bbox"))})


def way_table(ways_: DataFrame, approximate: bool = False) -> DataFrame:
    """The columns of the ways table.

    The centre is that of the smallest circle around the points (of their line, if ``approximate``), and scale its
    radius (the box's extent) in metres along the parallel there. h38Indexes are the fine cells that a way
    below 3000 metres touches.
    """
    circle = F.struct(F.col("centre.lon").alias("lon"), F.col("centre.lat").alias("lat"), F.col("extent").alias("radius")) if approximate else geometry.bounding_circle(F.col("points"))
    lat, lon = F.col("c.lat"), F.col("c.lon")
    rows = ways_.withColumn("c", circle).withColumn("metres", geometry.geodesic(lat, F.col("c.radius").cast("float").cast("double")))
    regions = F.transform(grid.regions_of(F.col("points"), lat, lon, F.col("metres"), F.col("closed"), most=SEVERAL_METRES), keys.fine)
    return rows.select(
        "id", "h33", keys.fine(grid.cell_of(lat, lon, 8)).alias("h38"), lat.alias("latitude"), lon.alias("longitude"), "tags",
        F.col("point_ids").alias("pointIdxs"), keys.coarse(grid.cell_of(lat, lon, 3)).alias("h33Center"), "closed", "building", "highway",
        F.col("metres").cast("float").alias("scale"), geometry.line_wkb(F.col("points")).alias("lineStringWkb"), geometry.box_wkb(F.col("bbox")).alias("bboxWkb"),
        F.array_sort(regions).alias("h38Indexes"), F.col("bbox.min_x").alias("bboxMinX"), F.col("bbox.max_x").alias("bboxMaxX"), F.col("bbox.min_y").alias("bboxMinY"), F.col("bbox.max_y").alias("bboxMaxY"), "valid",
    )


def block_totals(nodes_: DataFrame, raw_ways: DataFrame, raw_relations: DataFrame) -> DataFrame:
    """Per block: nodes, ways (skipped ones too), relations, their members, multipolygons."""
    zero = F.lit(0).cast("long")
    one = lambda rows, kind: rows.groupBy("block_id").agg(*[(F.count("*") if k == kind else zero).alias(k) for k in ("nodes", "ways", "relations")], zero.alias("members"), zero.alias("multipolygons"))
    several = F.exists("entries", lambda e: (e["k"] == "type") & (e["v"] == "multipolygon"))
    r = raw_relations.groupBy("block_id").agg(zero.alias("nodes"), zero.alias("ways"), F.count("*").alias("relations"), F.sum(F.size("members")).cast("long").alias("members"), F.count_if(several).alias("multipolygons"))
    rows = one(nodes_, "nodes").unionByName(one(raw_ways, "ways")).unionByName(r)
    return rows.groupBy("block_id").agg(*[F.sum(c).alias(c) for c in ("nodes", "ways", "relations", "members", "multipolygons")])


def block_content(stats: DataFrame, totals: DataFrame) -> DataFrame:
    """Cell statistics of the blocks without relations."""
    return stats.join(totals.where("relations > 0").select("block_id"), "block_id", "left_anti")


def relations(raw: DataFrame) -> DataFrame:
    m = F.col("members")
    return raw.select("block_id", "id", tags.tag_map(F.col("entries")).alias("tags"), F.transform(m, lambda x: x["member_id"]).alias("member_id"), F.transform(m, lambda x: tags.kind_code(x["member_type"])).alias("member_type"), F.transform(m, lambda x: x["member_role"]).alias("member_role"))


def relation_members(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("relation_id"), F.posexplode("members").alias("sequence_id", "m")).select("relation_id", F.col("m.member_id").alias("member_id"), "sequence_id", F.col("m.member_type").alias("member_type"), F.nullif(F.col("m.member_role"), F.lit("")).alias("member_role"))


def cell_stats(rows: DataFrame, size: Column, kind: str) -> DataFrame:
    """Per block and coarse key: count, size, smallest and largest id, latest time (at least 0)."""
    return rows.groupBy("block_id", "h33").agg(F.count("*").alias("count"), F.sum(size).cast("long").alias("size"), F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.greatest(F.lit(0), F.max("ts_millis")).alias("last_modified")).withColumn("object_type", F.lit(kind))


def node_stats(nodes_: DataFrame) -> DataFrame:
    return cell_stats(nodes_, 26 + tags.stored_size(F.col("entries")), "N")


def way_stats(ways_: DataFrame) -> DataFrame:
    return cell_stats(ways_, 10 + 16 * F.size("points") + tags.stored_size(F.col("entries")), "W")
