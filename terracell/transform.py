"""From PBF files to the tables: the whole way, by options, also as a command line."""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import keys
from .operators import areas, tables
from .plans import partitions, scripts
from .sources import pbf, sinks


@dataclass(frozen=True)
class Options:
    """What a run does. ``arrow_format``: PARQUET, ARROW_IPC or None; text output is on unless switched off."""

    scale_approx_calc: bool = False
    collect_only_statistics: bool = False
    skip_buildings: bool = False
    skip_highway: bool = False
    preserve_all_nodes: bool = False
    arrow_format: str | None = None
    result_in_tsv: bool = True
    columnar_storage: bool = False
    pg_script_count: int = 4
    data_partition_ratio: float = partitions.RATIO


@dataclass(frozen=True)
class Tables:
    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    members: DataFrame
    areas: DataFrame
    statistics: DataFrame
    totals: DataFrame
    ranges: DataFrame


def read(spark: SparkSession, source: str, options: Options = Options()) -> Tables:
    """The tables of a PBF file (or files, by commas), as plans.

    Points of ways come from the file where it holds them, else from a join with its nodes. Without
    ``preserve_all_nodes`` only nodes with tags or in relations become rows, after ways took their places.
    """
    entities = pbf.read(spark, source)
    every, raw_ways, raw_relations = tables.nodes(pbf.nodes(entities)), pbf.ways(entities), pbf.relations(entities)
    raw_nodes = pbf.nodes(entities) if options.preserve_all_nodes else pbf.retained(pbf.nodes(entities), raw_relations)
    wanted = raw_ways.where(~tables.unwanted(F.col("entries"), options.skip_buildings, options.skip_highway))
    told = F.col("lats").isNotNull() & F.col("lons").isNotNull()
    ways = tables.ways(tables.located_in_file(wanted.where(told)).unionByName(tables.located(wanted.where(~told).drop("lats", "lons"), every)))
    nodes = tables.nodes(raw_nodes)
    tagged = tables.relations(raw_relations).select("id", "tags").join(raw_relations.select("id", "members"), "id")
    content = tables.node_stats(nodes).unionByName(tables.way_stats(ways))
    totals = tables.block_totals(raw_nodes, raw_ways, raw_relations)
    return Tables(nodes, ways, tables.relations(raw_relations), tables.relation_members(raw_relations), areas.assembled(tagged, ways), tables.block_content(content, totals), totals, partitions.plan(tables.way_stats(ways).select("h33", "size"), options.data_partition_ratio))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def run(spark: SparkSession, source: str, target: str, options: Options = Options()) -> dict[str, int]:
    """Write the tables of ``source`` below ``target``; milliseconds taken by part."""
    if not options.result_in_tsv and not options.arrow_format and not options.collect_only_statistics:
        raise ValueError("nothing to write: neither text nor Arrow output is asked for")
    sinks.guard(spark, *[f"{target}/{x}" for x in ("nodes", "ways", "relations", "multipolygon", "arrow", "import_related_metadata")])
    began, took = time.time(), {}
    found = read(spark, source, options)
    lines = lambda rows, columns, name: sinks.statistics_lines(rows, columns).write.text(f"{target}/import_related_metadata/{name}")
    lines(found.statistics, sinks.CONTENT_COLUMNS, "osm_file_block_content")
    lines(found.totals, ["block_id", "nodes", "ways", "relations", "members", "multipolygons"], "osm_file_block")
    took["statistics"] = round(1000 * (time.time() - began))
    if not options.collect_only_statistics:
        way_rows = tables.way_table(found.ways, options.scale_approx_calc)
        bounds = areas.cell_bounds(spark)
        multipolygons = areas.multipolygons(found.areas, bounds)
        if options.arrow_format:
            parts = {"nodes": tables.node_table(found.nodes), "ways": way_rows, "relations": found.relations.select("id", "tags", F.col("member_id").alias("memberId"), F.col("member_type").alias("memberType"), F.col("member_role").alias("memberRole")), "multipolygon": multipolygons}
            for name, rows in parts.items():
                if options.arrow_format == "ARROW_IPC":
                    sinks.arrow_files(rows, f"{target}/arrow/{name}")
                elif name in ("nodes", "ways"):
                    sinks.parquet(partitions.assigned(rows, found.ranges), f"{target}/arrow/{name}", by="part_id")
                else:
                    sinks.parquet(rows, f"{target}/arrow/{name}")
        if options.result_in_tsv:
            sinks.text_by_cell(sinks.node_lines(found.nodes), f"{target}/nodes")
            sinks.text_by_cell(sinks.way_lines(way_rows.join(found.ways.select("id", "block_id"), "id")), f"{target}/ways")
            sinks.relation_lines(found.relations).select("value").write.text(f"{target}/relations/relations")
            sinks.member_lines(found.members).select("value").write.text(f"{target}/relations/members")
            n = found.areas.count()
            exported = found.areas.select(F.concat_ws("\t", F.hex("wkb"), F.lit("relation"), F.col("id").cast("string"), sinks.map_text(F.col("tags"))).alias("value"))
            exported.write.option("maxRecordsPerFile", scripts.area_lines_a_file(n, options.pg_script_count)).text(f"{target}/multipolygon")
            for kind in ("nodes", "ways"):
                cells = (found.nodes if kind == "nodes" else found.ways).select("h33").where(F.col("h33") != keys.SEVERAL)
                for name, text in scripts.imports(kind, scripts.cells_of_parts(cells, found.ranges), options.pg_script_count, options.columnar_storage).items():
                    write_text(spark, f"{target}/{name}", text)
            write_text(spark, f"{target}/static/multipolygon_tables.sql", scripts.area_tables(found.ranges, options.columnar_storage))
    took["total"] = round(1000 * (time.time() - began))
    return took


def parser() -> argparse.ArgumentParser:
    """All options of the command line. Those about tools that this engine does without are taken and have no effect."""
    yes = lambda x: str(x).lower() == "true"
    p = argparse.ArgumentParser(prog="python -m terracell.transform", add_help=False)
    p.add_argument("-source_pbf", required=True, help="source file in PBF format")
    p.add_argument("-target", help="folder to write to; beside the source if not given")
    for name, text in (("scale_approx_calc", "scale from the box instead of the smallest circle"), ("collect_only_statistics", "statistics only"), ("skip_buildings", "no ways with key building"), ("skip_highway", "no ways with key highway"), ("preserve_all_nodes", "all nodes, not only those with tags or in relations"), ("columnar_storage", "columnar tables in the scripts")):
        p.add_argument(f"-{name}", action="store_true", help=text)
    p.add_argument("-arrow_format", choices=("PARQUET", "ARROW_IPC"))
    p.add_argument("-result_in_tsv", type=yes, default=True, help="text tables and scripts")
    p.add_argument("-osmium_docker", type=yes, default=True, help="no effect: no such tool is run")
    p.add_argument("-worker_threads", type=int, default=4, help="threads of a local session")
    p.add_argument("-pg_script_count", type=int, default=4)
    p.add_argument("-data_partition_ratio", type=float, default=partitions.RATIO)
    p.add_argument("-help", action="help", help="this text")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    a = vars(parser().parse_args(arguments))
    source, target, threads = a.pop("source_pbf"), a.pop("target"), a.pop("worker_threads")
    a.pop("osmium_docker")
    builder = SparkSession.builder.appName("terracell")
    spark = spark or (builder.getOrCreate() if SparkSession.getActiveSession() else builder.master(f"local[{max(1, threads)}]").getOrCreate())
    return run(spark, source, target or source.removesuffix(".pbf").removesuffix(".osm") + "_loc_ways", Options(**a))


if __name__ == "__main__":
    print(main())
