"""Registered queries over the derived domain tables, each with SQL that says the same independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry, grid, keys, tags
from .operators import areas, tables
from .plans import partitions
from .sources import fixtures, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# --- the domain tables in SQL -------------------------------------------------------------
_CELL = "(CAST(1 AS BIGINT) << 59) + (CAST(8 AS BIGINT) << 52) + ((k % 122) << 45) + (((k*31+7)%7) << 42) + (((k*17+3)%7) << 39) + (((k*13+5)%7) << 36) + (((k*11+1)%7) << 33) + (((k*7+2)%7) << 30) + (((k*5+4)%7) << 27) + (((k*3+6)%7) << 24) + (((k*19)%7) << 21) + 2097151"
NODES = f"""
n0 AS (SELECT c_custkey AS k, * FROM customer),
n1 AS (SELECT k, c_name, c_mktsegment, {_CELL} AS cell FROM n0),
nodes AS (
  SELECT k // 512 AS block_id, k AS id, k * 1000 AS ts_millis, cell,
    (k*7919)%16000001/CAST(100000 AS DOUBLE) - 80 AS latitude, (k*104729)%36000001/CAST(100000 AS DOUBLE) - 180 AS longitude,
    CASE WHEN (k%122) >= 64 THEN (k%122)*512 + ((k*31+7)%7)*64 + ((k*17+3)%7)*8 + (k*13+5)%7 - 65536 ELSE (k%122)*512 + ((k*31+7)%7)*64 + ((k*17+3)%7)*8 + (k*13+5)%7 END AS h33,
    CASE WHEN (cell // 1048576) % 4294967296 >= 2147483648 THEN (cell // 1048576) % 4294967296 - 4294967296 ELSE (cell // 1048576) % 4294967296 END AS h38,
    CASE WHEN k%7 = 0 THEN NULL ELSE concat_ws(',', CASE WHEN k%3 = 0 THEN '"building"=>"yes"' END, CASE WHEN k%5 <> 0 THEN '"name"=>"' || c_name || '"' END, '"segment"=>"' || c_mktsegment || '"') END AS tags,
    CASE WHEN k%7 = 0 THEN 0 ELSE 7+1+length(c_mktsegment) + 4+1+(CASE WHEN k%5=0 THEN 1 ELSE length(c_name) END) + 7+1+3 + 8+1+(CASE WHEN k%3=0 THEN 3 ELSE 1 END) END AS tag_bytes,
    c_mktsegment, c_name
  FROM n1)"""
WAYS = f"""{NODES},
w0 AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, l_partkey % (SELECT count(*) FROM customer) AS node_id FROM lineitem),
w1 AS (SELECT * FROM w0 UNION ALL SELECT id, max(pos) + 1, arg_min(node_id, pos) FROM w0 WHERE id % 8 = 0 GROUP BY id HAVING count(*) > 1),
pts AS (SELECT w1.id, pos, node_id, latitude AS lat, longitude AS lon, h33, h38 FROM w1 JOIN nodes n ON n.id = w1.node_id),
w2 AS (SELECT id, count(*) AS n, list(node_id ORDER BY pos) AS point_ids, list(lat ORDER BY pos) AS lats, list(lon ORDER BY pos) AS lons, list(h33 ORDER BY pos) AS cells, count(DISTINCT h33) AS n_cells, count(DISTINCT (lat, lon)) AS n_places,
  min(lon) AS min_x, max(lon) AS max_x, min(lat) AS min_y, max(lat) AS max_y, min(h33) AS any_cell FROM pts GROUP BY id),
ways AS (SELECT w2.*, o_orderkey // 512 AS block_id, epoch_ms(o_orderdate) AS ts_millis, CASE WHEN n_cells = 1 THEN any_cell ELSE 32767 END AS h33,
  o_orderstatus = 'F' AS building, o_orderpriority LIKE '1%' AS highway, o_custkey % 11 = 0 AS school, o_orderstatus, o_orderpriority,
  (n > 1 AND lats[1] = lats[n] AND lons[1] = lons[n]) AS closed,
  (CASE WHEN o_orderstatus IN ('F','P') THEN 8+1+3 ELSE 0 END) + (CASE WHEN o_orderpriority LIKE '1%' THEN 7+1+length(o_orderpriority) ELSE 0 END) + (CASE WHEN o_custkey % 11 = 0 THEN 7+1+6 ELSE 0 END) AS tag_bytes
  FROM w2 JOIN orders ON o_orderkey = w2.id)"""
RELATIONS = """
mem AS (SELECT l_partkey AS relation_id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, (CASE WHEN l_linenumber % 3 = 0 THEN 'N' WHEN l_linenumber % 3 = 1 THEN 'W' ELSE 'R' END), l_returnflag) - 1 AS sequence_id,
  l_orderkey AS member_id, CASE WHEN l_linenumber % 3 = 0 THEN 'N' WHEN l_linenumber % 3 = 1 THEN 'W' ELSE 'R' END AS member_type, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS member_role FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)),
rel AS (SELECT p_partkey AS id, p_partkey // 512 AS block_id, p_partkey % 3 = 0 AS multi, p_name FROM part)"""
_STATS = f"""{WAYS},
stats AS (
  SELECT 'N' AS object_type, block_id, h33, count(*) AS count, sum(26 + tag_bytes) AS size, min(id) AS min_id, max(id) AS max_id, greatest(0, max(ts_millis)) AS last_modified FROM nodes GROUP BY ALL
  UNION ALL SELECT 'W', block_id, h33, count(*), sum(10 + 16*n + tag_bytes), min(id), max(id), greatest(0, max(ts_millis)) FROM ways GROUP BY ALL)"""
_PLAN = f"""{_STATS},
par AS (SELECT h33 - ((h33 % 8 + 8) % 8) AS lo8, sum(size) AS sz FROM stats WHERE object_type = 'W' AND h33 <> 32767 GROUP BY 1),
ord AS (SELECT row_number() OVER (ORDER BY lo8) AS i, lo8, CAST(sz AS BIGINT) AS sz, CAST(floor(max(sz) OVER () * CAST(0.48 AS DOUBLE)) AS BIGINT) AS most FROM par),
walk(i, part, lo, now) AS (
  SELECT CAST(1 AS BIGINT), 0, -32768, sz FROM ord WHERE i = 1
  UNION ALL
  SELECT o.i, CASE WHEN w.now > 0 AND w.now + o.sz >= o.most THEN w.part + 1 ELSE w.part END, CASE WHEN w.now > 0 AND w.now + o.sz >= o.most THEN CAST(o.lo8 AS INTEGER) ELSE w.lo END, CASE WHEN w.now > 0 AND w.now + o.sz >= o.most THEN o.sz ELSE w.now + o.sz END
  FROM walk w JOIN ord o ON o.i = w.i + 1),
ranges AS (SELECT part AS id, lo, coalesce(lead(lo) OVER (ORDER BY part), 32695) AS hi, size FROM (SELECT part, min(lo) AS lo, max(now) AS size FROM walk GROUP BY part))"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return tables.nodes(fixtures.raw_nodes(spark, d))


def _ways(spark: SparkSession, d: str) -> DataFrame:
    return tables.ways(tables.located(fixtures.raw_ways(spark, d), _nodes(spark, d)))


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return tables.node_stats(_nodes(spark, d)).unionByName(tables.way_stats(_ways(spark, d)))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    return partitions.plan(tables.way_stats(_ways(spark, d)).select("h33", "size"))


# --- keys ---------------------------------------------------------------------------------
@query(f"WITH {NODES} SELECT id, h33, h38, latitude, longitude FROM nodes")
def h1_h2_encode_keys(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("id", "h33", "h38", "latitude", "longitude")


@query(f"WITH {NODES} SELECT id, (h33 + 65536) % 65536 * 68719476736 + 589971619905011711 AS full3, (h38 + 4294967296) % 4294967296 * 1048576 + 612489549323436031 AS full8 FROM nodes")
def h3_decode_keys(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("id", keys.from_coarse(F.col("h33")).alias("full3"), keys.from_fine(F.col("h38")).alias("full8"))


@query(f"WITH {NODES} SELECT id, h33 - (h33 % 8 + 8) % 8 + 7 AS parent, h33 - (h33 % 8 + 8) % 8 AS first_child, h33 - (h33 % 8 + 8) % 8 + 6 AS last_child FROM nodes")
def h9_parent_and_children(spark: SparkSession, d: str) -> DataFrame:
    first, last = keys.children(F.col("h33"))
    return _nodes(spark, d).select("id", keys.parent(F.col("h33")).alias("parent"), first.alias("first_child"), last.alias("last_child"))


@query()
def h4_cells_of_positions(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the cells that hold each node's position (the other queries' cells are synthetic)."""
    at = fixtures.raw_nodes(spark, d).select("id", *[grid.cell_of(F.col("lat"), F.col("lon"), r).alias(f"c{r}") for r in (3, 8)])
    return at.select("id", keys.coarse(F.col("c3")).alias("h33"), keys.fine(F.col("c8")).alias("h38"))


@query()
def h11_keys_between(spark: SparkSession, d: str) -> DataFrame:
    """Keys of resolutions 4 to 7 in the fine key's bits, without their resolution."""
    at = fixtures.raw_nodes(spark, d)
    return at.select("id", *[keys.fine(grid.cell_of(F.col("lat"), F.col("lon"), r)).alias(f"h3{r}") for r in (4, 5, 6, 7)])


@query()
def h5_centres_of_cells(spark: SparkSession, d: str) -> DataFrame:
    """Centres of the distinct coarse cells of the nodes' positions."""
    cells = fixtures.raw_nodes(spark, d).select(grid.cell_of(F.col("lat"), F.col("lon"), 3).alias("cell")).distinct()
    return cells.select("cell", grid.centre_of(F.col("cell"), 3).alias("c")).select(keys.coarse(F.col("cell")).alias("h33"), "c.*")


@query()
def h8_a17_rings(spark: SparkSession, d: str) -> DataFrame:
    """The fine keys at 1 to 5 steps from each distinct (h33, h38) of the nodes' positions, an array a ring."""
    cells = fixtures.raw_nodes(spark, d).select(*[grid.cell_of(F.col("lat"), F.col("lon"), r).alias(f"c{r}") for r in (3, 8)]).distinct()
    rings = cells.select("c3", "c8", grid.rings_of(F.col("c8"), 5, 8).alias("rings"))
    ring = lambda k: F.array_sort(F.transform(F.col("rings")[k], keys.fine)).alias(f"ring{k}")
    return rings.select(keys.coarse(F.col("c3")).alias("h33"), keys.fine(F.col("c8")).alias("h38"), *[ring(k) for k in range(1, 6)])


@query(f"WITH {WAYS} SELECT id, h33, n_cells FROM ways")
def h10_way_cell(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", "h33", F.size(F.array_distinct(F.col("points.h33"))).cast("long").alias("n_cells"))


# --- joins --------------------------------------------------------------------------------
@query(f"WITH {WAYS} SELECT id, array_to_string(point_ids, ',') AS nodes, n FROM ways")
def j1_locate_way_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", F.array_join(F.col("point_ids").cast("array<string>"), ",").alias("nodes"), F.size("points").cast("long").alias("n"))


@query(f"WITH {WAYS}, several AS (SELECT DISTINCT pts.id, pts.h33 FROM pts JOIN ways ON ways.id = pts.id WHERE ways.h33 = 32767) SELECT id, string_agg(CAST(h33 AS VARCHAR), ',' ORDER BY h33) AS regions, count(*) AS n FROM several GROUP BY id")
def j5_a13_regions_of_several(spark: SparkSession, d: str) -> DataFrame:
    """Ways over several cells, joined back to their distinct cells."""
    w = _ways(spark, d).where(F.col("h33") == keys.SEVERAL)
    regions = w.select("id", F.explode("points.h33").alias("cell")).distinct().groupBy("id").agg(F.array_sort(F.collect_list("cell")).alias("r"))
    return w.select("id").join(regions, "id").select("id", F.array_join(F.col("r").cast("array<string>"), ",").alias("regions"), F.size("r").cast("long").alias("n"))


@query(f"WITH RECURSIVE {_PLAN}, cells AS (SELECT h33, sum(size) AS bytes FROM stats WHERE object_type = 'N' GROUP BY h33) SELECT ranges.id, count(*) AS cells, CAST(sum(bytes) AS BIGINT) AS bytes FROM cells JOIN ranges ON h33 >= lo AND h33 < hi GROUP BY ranges.id")
def j7_node_cells_in_way_ranges(spark: SparkSession, d: str) -> DataFrame:
    cells = tables.node_stats(_nodes(spark, d)).groupBy("h33").agg(F.sum("size").alias("bytes"))
    return partitions.assigned(cells, _plan(spark, d)).where(F.col("part_id") != keys.SEVERAL).groupBy(F.col("part_id").alias("id")).agg(F.count("*").alias("cells"), F.sum("bytes").alias("bytes"))


@query(f"WITH {NODES}, {RELATIONS} SELECT member_type, count(*) AS members, count(coalesce(nodes.id, o_orderkey, p_partkey)) AS resolved FROM mem LEFT JOIN nodes ON member_type = 'N' AND nodes.id = member_id LEFT JOIN orders ON member_type = 'W' AND o_orderkey = member_id LEFT JOIN part ON member_type = 'R' AND p_partkey = member_id GROUP BY member_type")
def j9_member_entities(spark: SparkSession, d: str) -> DataFrame:
    """Members of each kind, and how many of their entities are there."""
    m = tables.relation_members(fixtures.raw_relations(spark, d))
    there = {"N": fixtures.raw_nodes(spark, d), "W": fixtures.read(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "R": fixtures.raw_relations(spark, d)}
    ids = None
    for kind, rows in there.items():
        part = rows.select(F.lit(kind).alias("member_type"), F.col("id").alias("member_id"), F.lit(1).alias("found"))
        ids = part if ids is None else ids.unionByName(part)
    return m.join(ids, ["member_type", "member_id"], "left").groupBy("member_type").agg(F.count("*").alias("members"), F.count("found").alias("resolved"))


@query(f"WITH {NODES}, {RELATIONS} SELECT id FROM nodes WHERE tags IS NOT NULL UNION SELECT id FROM nodes WHERE id IN (SELECT member_id FROM mem WHERE member_type = 'N')")
def f3_retained_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes with tags, and nodes that relations refer to."""
    n = _nodes(spark, d)
    members = tables.relation_members(fixtures.raw_relations(spark, d)).where("member_type = 'N'").select(F.col("member_id").alias("id"))
    return n.where("tags is not null").select("id").unionByName(n.where("tags is null").join(members, "id", "left_semi").select("id"))


# --- statistics ---------------------------------------------------------------------------
_STAT_COLUMNS = ["object_type", "block_id", "h33", "count", "size", "min_id", "max_id", "last_modified"]


@query(f"WITH {_STATS} SELECT * FROM stats WHERE object_type = 'N'")
def a1_node_cell_stats(spark: SparkSession, d: str) -> DataFrame:
    return tables.node_stats(_nodes(spark, d)).select(_STAT_COLUMNS)


@query(f"WITH {_STATS} SELECT * FROM stats WHERE object_type = 'W'")
def a2_way_cell_stats(spark: SparkSession, d: str) -> DataFrame:
    return tables.way_stats(_ways(spark, d)).select(_STAT_COLUMNS)


_TOTALS = f"""{WAYS}, {RELATIONS}, totals AS (SELECT block_id, CAST(sum(nodes) AS BIGINT) AS nodes, CAST(sum(ways) AS BIGINT) AS ways, CAST(sum(relations) AS BIGINT) AS relations, CAST(sum(members) AS BIGINT) AS members, CAST(sum(multipolygons) AS BIGINT) AS multipolygons FROM (
  SELECT block_id, count(*) AS nodes, 0 AS ways, 0 AS relations, 0 AS members, 0 AS multipolygons FROM nodes GROUP BY 1
  UNION ALL SELECT o_orderkey // 512, 0, count(*), 0, 0, 0 FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1
  UNION ALL SELECT block_id, 0, 0, count(*), coalesce(sum(m.n), 0), count(*) FILTER (WHERE multi) FROM rel LEFT JOIN (SELECT relation_id, count(*) AS n FROM mem GROUP BY 1) m ON relation_id = id GROUP BY block_id) GROUP BY 1)"""


def _totals(spark: SparkSession, d: str) -> DataFrame:
    return tables.block_totals(fixtures.raw_nodes(spark, d), fixtures.raw_ways(spark, d), fixtures.raw_relations(spark, d))


@query(f"WITH {_TOTALS} SELECT * FROM totals")
def a3_a5_a6_block_totals(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d)


@query(f"WITH {_TOTALS}, {_STATS.removeprefix(WAYS).lstrip(', ')} SELECT * FROM stats WHERE block_id NOT IN (SELECT block_id FROM totals WHERE relations > 0)")
def f9_block_content(spark: SparkSession, d: str) -> DataFrame:
    """Cell statistics of blocks without relations."""
    return tables.block_content(_stats(spark, d), _totals(spark, d)).select(_STAT_COLUMNS)


@query(f"WITH {_STATS} SELECT object_type, CAST(sum(count) AS BIGINT) AS entities, CAST(sum(size) AS BIGINT) AS bytes, max(last_modified) AS last_modified, count(DISTINCT block_id) AS blocks FROM stats GROUP BY object_type")
def a4_run_totals(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).groupBy("object_type").agg(F.sum("count").alias("entities"), F.sum("size").alias("bytes"), F.max("last_modified").alias("last_modified"), F.countDistinct("block_id").alias("blocks"))


@query(f"WITH {_STATS} SELECT object_type, h33, CAST(sum(size) AS BIGINT) AS bytes FROM stats GROUP BY 1, 2")
def a7_bytes_per_cell(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).groupBy("object_type", "h33").agg(F.sum("size").alias("bytes"))


@query(f"WITH {_STATS} SELECT h33 - (h33 % 8 + 8) % 8 + 7 AS parent, CAST(sum(size) AS BIGINT) AS bytes FROM stats WHERE object_type = 'W' AND h33 <> 32767 GROUP BY 1")
def a8_f5_bytes_per_parent(spark: SparkSession, d: str) -> DataFrame:
    return tables.way_stats(_ways(spark, d)).where(F.col("h33") != keys.SEVERAL).groupBy(keys.parent(F.col("h33")).alias("parent")).agg(F.sum("size").alias("bytes"))


@query(f"WITH RECURSIVE {_PLAN} SELECT id, lo, hi, size FROM ranges")
def a9_a10_range_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d)


@query(f"WITH RECURSIVE {_PLAN} SELECT count(*) AS parts, min(size) // 1000000 AS least_mb, round(avg(size) / 1000000, 6) AS mean_mb FROM ranges")
def a11_plan_summary(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).agg(F.count("*").alias("parts"), F.floor(F.min("size") / 1000000).alias("least_mb"), F.round(F.avg("size") / 1000000, 6).alias("mean_mb"))


@query(f"WITH {_STATS} SELECT object_type, h33, count(*) AS block_rows, CAST(sum(count) AS BIGINT) AS entity_count, CAST(sum(size) AS BIGINT) AS size FROM stats GROUP BY 1, 2")
def a14_cell_tables(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).groupBy("object_type", "h33").agg(F.count("*").alias("block_rows"), F.sum("count").alias("entity_count"), F.sum("size").alias("size"))


@query(f"WITH {WAYS} SELECT h33, count(*) AS n FROM ways GROUP BY h33 ORDER BY n DESC, h33 LIMIT 20")
def a15_li1_top_cells(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: the twenty cells with most ways."""
    return _ways(spark, d).groupBy("h33").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "h33").limit(20)


@query(f"WITH RECURSIVE {_PLAN} SELECT coalesce(r.id, 32767) AS part_id, count(*) AS ways, CAST(sum(n) AS BIGINT) AS points FROM ways LEFT JOIN ranges r ON h33 >= lo AND h33 < hi GROUP BY 1")
def a16_dd1_ways_per_part(spark: SparkSession, d: str) -> DataFrame:
    return partitions.assigned(_ways(spark, d), _plan(spark, d)).groupBy("part_id").agg(F.count("*").alias("ways"), F.sum(F.size("points")).alias("points"))


@query(f"WITH {_STATS} SELECT * FROM stats ORDER BY object_type, h33, block_id")
def so3_sc13_stats_in_order(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select(_STAT_COLUMNS).orderBy("object_type", "h33", "block_id")


# --- filters and flags --------------------------------------------------------------------
@query(f"WITH {WAYS} SELECT id, building, highway, o_orderstatus IN ('F','P') AS building_any_case FROM ways")
def p2_p3_way_flags(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", "building", "highway", tags.has_any_case(F.col("tags"), "building").alias("building_any_case"))


@query(f"WITH {WAYS} SELECT id FROM ways WHERE NOT building AND NOT highway")
def f1_f2_skip_buildings_and_highways(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.raw_ways(spark, d).where(~tables.unwanted(F.col("entries"), buildings=True, highways=True)).select("id")


@query(f"WITH {WAYS} SELECT id, n FROM ways WHERE closed AND building AND school ORDER BY id LIMIT 50")
def f7_p10_school_buildings(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("tags")
    return _ways(spark, d).where("closed").where((t["building"] == "school") | (t["building"].isNotNull() & (t["amenity"] == "school"))).orderBy("id").limit(50).select("id", F.size("points").cast("long").alias("n"))


@query(f"WITH {NODES} SELECT id, coalesce(tags, '\\N') AS hstore FROM nodes")
def p1_p5_f8_tags_as_text(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("id", tags.hstore(F.col("tags")).alias("hstore"))


@query(f"WITH {NODES} SELECT id, c_mktsegment AS segment, CASE WHEN k3 THEN 'yes' END AS building FROM (SELECT *, id % 3 = 0 AS k3 FROM nodes) WHERE tags IS NOT NULL")
def p9_p10_parse_tags(spark: SparkSession, d: str) -> DataFrame:
    parsed = _nodes(spark, d).where("tags is not null").select("id", tags.parse_hstore(tags.hstore(F.col("tags"))).alias("m"))
    return parsed.select("id", F.col("m")["segment"].alias("segment"), F.col("m")["building"].alias("building"))


@query(f"WITH {NODES} SELECT id, '{{' || concat_ws(',', CASE WHEN id%3 = 0 THEN '\"building\":\"yes\"' END, CASE WHEN id%5 <> 0 THEN '\"name\":\"' || c_name || '\"' END, '\"segment\":\"' || c_mktsegment || '\"') || '}}' AS tags_json FROM nodes WHERE tags IS NOT NULL")
def p8_tags_as_json(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).where("tags is not null").select("id", F.to_json("tags").alias("tags_json"))


@query("SELECT event_id, replace(replace(props, '\\', '\\\\'), chr(9), '\\t') AS escaped, replace(props, ',', '|') AS piped, hex(props) AS hexed FROM events")
def p6_p11_p13_text_functions(spark: SparkSession, d: str) -> DataFrame:
    e = fixtures.read(spark, d, "events")
    return e.select("event_id", tags.escaped(F.col("props")).alias("escaped"), F.replace("props", F.lit(","), F.lit("|")).alias("piped"), F.hex(F.encode("props", "UTF-8")).alias("hexed"))


@query(f"WITH {WAYS} SELECT id, '{{' || array_to_string(point_ids, ',') || '}}' AS literal, format('{{:05d}}', block_id) AS block FROM ways")
def p7_p17_literals(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", tags.int_array(F.col("point_ids")).alias("literal"), F.format_string("%05d", "block_id").alias("block"))


# --- relations ----------------------------------------------------------------------------
@query(f"WITH {RELATIONS} SELECT relation_id, sequence_id, member_id, member_type, member_role FROM mem")
def p15_relation_members(spark: SparkSession, d: str) -> DataFrame:
    return tables.relation_members(fixtures.raw_relations(spark, d)).select("relation_id", F.col("sequence_id").cast("long").alias("sequence_id"), "member_id", "member_type", "member_role")


@query(f"WITH {RELATIONS} SELECT rel.id, coalesce(string_agg(CAST(ascii(member_type) AS VARCHAR), ',' ORDER BY sequence_id), '') AS kinds, coalesce(string_agg(coalesce(member_role, ''), ',' ORDER BY sequence_id), '') AS roles FROM rel LEFT JOIN mem ON relation_id = rel.id GROUP BY rel.id")
def p14_relation_arrays(spark: SparkSession, d: str) -> DataFrame:
    r = tables.relations(fixtures.raw_relations(spark, d))
    return r.select("id", F.array_join(F.col("member_type").cast("array<string>"), ",").alias("kinds"), F.array_join("member_role", ",").alias("roles"))


@query(f"WITH {RELATIONS} SELECT count(*) AS repeated FROM (SELECT relation_id, sequence_id FROM mem GROUP BY 1, 2 HAVING count(*) > 1)")
def dd4_member_key_is_unique(spark: SparkSession, d: str) -> DataFrame:
    m = tables.relation_members(fixtures.raw_relations(spark, d))
    return m.groupBy("relation_id", "sequence_id").count().where("count > 1").agg(F.count("*").alias("repeated"))


# --- set operations and shaping -----------------------------------------------------------
@query(f"WITH {WAYS} SELECT id, h33, 'nodes' AS type, tags IS NOT NULL AS tagged, CAST(0 AS FLOAT) AS scale FROM nodes UNION ALL SELECT id, h33, 'ways', building OR highway OR school OR o_orderstatus = 'P', CAST(0 AS FLOAT) FROM ways")
def se1_pr3_global_view(spark: SparkSession, d: str) -> DataFrame:
    part = lambda rows, kind: rows.select("id", "h33", F.lit(kind).alias("type"), F.col("tags").isNotNull().alias("tagged"), F.lit(0).cast("float").alias("scale"))
    return part(_nodes(spark, d), "nodes").unionByName(part(_ways(spark, d), "ways"))


@query(f"WITH {WAYS} SELECT h33, h38 FROM nodes UNION SELECT h33, h38 FROM pts")
def se2_cells_of_all(spark: SparkSession, d: str) -> DataFrame:
    points = _ways(spark, d).select(F.explode("points").alias("p")).select("p.h33", "p.h38")
    return _nodes(spark, d).select("h33", "h38").distinct().union(points).distinct()


@query(f"WITH {WAYS} SELECT id, CASE WHEN n_cells = 1 THEN any_cell ELSE 32767 END AS h3_3, CASE WHEN n_cells > 1 THEN array_to_string(list_sort(list_distinct(cells)), ',') END AS regions FROM ways")
def pr1_pr2_a12_p16_regions(spark: SparkSession, d: str) -> DataFrame:
    cells = F.array_sort(F.array_distinct(F.col("points.h33")))
    return _ways(spark, d).select("id", keys.common_cell(cells).alias("h3_3"), F.when(F.size(cells) > 1, F.array_join(cells.cast("array<string>"), ",")).alias("regions"))


@query(f"WITH RECURSIVE {_PLAN}, per AS (SELECT count(*) // 4 + 1 AS k FROM ranges) SELECT id // k AS script, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM ranges, per GROUP BY 1")
def sk11_script_chunks(spark: SparkSession, d: str) -> DataFrame:
    return partitions.chunked(_plan(spark, d), 4)


# --- geometry -----------------------------------------------------------------------------
@query(f"WITH {WAYS} SELECT id, closed, n > 1 AND n_places > 1 AS valid FROM ways")
def g2_g3_closed_and_valid(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", "closed", "valid")


@query(f"WITH {WAYS} SELECT id, min_x, max_x, min_y, max_y, greatest(max_x - min_x, max_y - min_y) AS extent FROM ways")
def g4_g10_bounding_box(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", "bbox.*", "extent")


@query(f"""WITH {WAYS}, seg AS (SELECT id, sqrt((lon2-lon)*(lon2-lon)+(lat2-lat)*(lat2-lat)) AS w, (lon+lon2)/2 AS x, (lat+lat2)/2 AS y, lon, lat FROM (SELECT id, lat, lon, lead(lat) OVER p AS lat2, lead(lon) OVER p AS lon2 FROM pts WINDOW p AS (PARTITION BY id ORDER BY pos)))
SELECT id, round(CASE WHEN sum(w) > 0 THEN sum(w*x)/sum(w) ELSE avg(lon) END, 6) AS lon, round(CASE WHEN sum(w) > 0 THEN sum(w*y)/sum(w) ELSE avg(lat) END, 6) AS lat FROM seg WHERE id IN (SELECT id FROM ways) GROUP BY id""")
def g7_line_centroid(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", F.round("centre.lon", 6).alias("lon"), F.round("centre.lat", 6).alias("lat"))


@query()
def g6_g8_circle_and_scale(spark: SparkSession, d: str) -> DataFrame:
    """Smallest circle of each way and its radius as metres along the parallel of its centre."""
    c = _ways(spark, d).select("id", geometry.bounding_circle(F.col("points")).alias("c"))
    return c.select("id", "c.*", geometry.geodesic(F.col("c.lat"), F.col("c.radius")).cast("float").alias("scale"))


@query()
def g1_g5_g14_wkb(spark: SparkSession, d: str) -> DataFrame:
    return _ways(spark, d).select("id", F.hex(geometry.line_wkb(F.col("points"))).alias("line"), F.hex(geometry.box_wkb(F.col("bbox"))).alias("box"))


# --- cells of lines and areas -------------------------------------------------------------
_NEAR, _REGION = 0.0002, 0.01  # shares of the fixtures' distances: within some cells, and over some coarse cells


def _near(spark: SparkSession, d: str, share: float) -> DataFrame:
    rows = _ways(spark, d).repartition(spark.sparkContext.defaultParallelism, "id")  # kernels take long for few bytes
    return rows.withColumn("points", fixtures.near(F.col("points"), share)).withColumns({"bbox": geometry.bbox(F.col("points")), "centre": geometry.centroid(F.col("points")), "closed": geometry.closed(F.col("points")), "valid": geometry.valid(F.col("points"))}).withColumn("extent", geometry.extent(F.col("bbox")))


def _areas(spark: SparkSession, d: str) -> DataFrame:
    """An area for each closed way of three corners or more."""
    w = _near(spark, d, _REGION).where("closed and valid")
    member = F.struct(F.col("id").alias("member_id"), F.lit("W").alias("member_type"), F.lit("outer").alias("member_role"))
    return areas.assembled(w.select("id", F.create_map(F.lit("type"), F.lit("multipolygon")).alias("tags"), F.array(member).alias("members")), w)


@query()
def h5_a18_cell_radius(spark: SparkSession, d: str) -> DataFrame:
    """Largest distance, in degrees, from the centre of the fine cell at each latitude of the first meridian to its corners."""
    cell = spark.range(90).select(F.col("id").cast("double").alias("latitude"), grid.cell_of(F.col("id").cast("double"), F.lit(0.0), 8).alias("cell"))
    at = cell.select("latitude", grid.centre_of(F.col("cell"), 8).alias("c"), grid.boundary_of(F.col("cell"), 8).alias("ring"))
    far = F.transform("ring", lambda p: F.sqrt((p["lat"] - F.col("c.lat")) * (p["lat"] - F.col("c.lat")) + (p["lon"] - F.col("c.lon")) * (p["lon"] - F.col("c.lon"))))
    return at.select("latitude", F.array_max(far).alias("radius"))


@query()
def h6_paths(spark: SparkSession, d: str) -> DataFrame:
    """Cells on the line from each way's first point to its last."""
    ends = _near(spark, d, _NEAR).select("id", *[grid.cell_of(p["lat"], p["lon"], 8).alias(c) for c, p in (("a", F.element_at("points", 1)), ("b", F.element_at("points", -1)))])
    return ends.select("id", F.transform(grid.path_of(F.col("a"), F.col("b"), 8), keys.fine).alias("path"))


@query()
def h7_h12_way_table(spark: SparkSession, d: str) -> DataFrame:
    """The ways table with every column, fine cells of lines and of areas among them."""
    return tables.way_table(_near(spark, d, _NEAR))


@query()
def j3_ways_of_several_cells(spark: SparkSession, d: str) -> DataFrame:
    """Ways over several coarse cells with the cells that their line meets."""
    w = _near(spark, d, _REGION).where("valid").select("id", F.lit(keys.SEVERAL).cast("smallint").alias("h33"), geometry.line_wkb(F.col("points")).alias("lineStringWkb"))
    return areas.ways_of_several(w, areas.cell_bounds(spark)).select("id", "h3_3_multi_regions")


@query()
def j2_assembled_areas(spark: SparkSession, d: str) -> DataFrame:
    return _areas(spark, d).select("id", F.hex("wkb").alias("wkb"))


@query()
def j4_j6_g9_g11_multipolygons(spark: SparkSession, d: str) -> DataFrame:
    return areas.multipolygons(_areas(spark, d), areas.cell_bounds(spark))


@query()
def sc9_cell_bounds(spark: SparkSession, d: str) -> DataFrame:
    return areas.cell_bounds(spark)


@query()
def se1_global_view_of_all(spark: SparkSession, d: str) -> DataFrame:
    """Nodes, ways and areas in one view, with scale and shapes."""
    bounds = areas.cell_bounds(spark)
    return areas.global_view(tables.node_table(_nodes(spark, d)), tables.way_table(_near(spark, d, _NEAR)), areas.multipolygons(_areas(spark, d), bounds))


@query()
def sk4_p4_way_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the ways' text table; lines that are not valid carry a tag."""
    w = _near(spark, d, _NEAR)
    return sinks.way_lines(tables.way_table(w).join(w.select("id", "block_id"), "id")).select("h33", "id", "value")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
