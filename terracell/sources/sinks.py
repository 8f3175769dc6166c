"""Sinks: Parquet by partition, Arrow files, text tables by cell; and readers of the text forms.

Writers refuse targets that hold something already. Rows are dealt by the column that names
their folder, so that a folder is written by few tasks; large folders are split by rows a file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tags

ROWS_A_FILE, DEALS = 5_000_000, 16
NULL = r"\N"  # fixed value: null in the text tables


def guard(spark: SparkSession, *paths: str) -> None:
    """Raise if any of the folders holds something."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(at) and len(system.listStatus(at)):
            raise FileExistsError(f"{path} is not empty")


def dealt(rows: DataFrame, by: str) -> DataFrame:
    """Rows of one value of ``by`` in DEALS tasks at most: a hot value is not left to one task."""
    return rows.repartition(by, F.pmod(F.xxhash64("id"), F.lit(DEALS)))


def parquet(rows: DataFrame, path: str, by: str | None = None, rows_a_file: int = ROWS_A_FILE) -> None:
    """Zstandard Parquet, in folders by a column if one is named, sorted by key and id within files."""
    guard(rows.sparkSession, path)
    order = [c for c in ("h33", "h38", "id") if c in rows.columns]
    out = dealt(rows, by).sortWithinPartitions(by, *order) if by else rows.sortWithinPartitions(*order) if order else rows
    writer = out.write.option("compression", "zstd").option("maxRecordsPerFile", rows_a_file)
    (writer.partitionBy(by) if by else writer).parquet(path)


def arrow_files(rows: DataFrame, path: str) -> DataFrame:
    """Arrow IPC files, one a task, in a shared folder; (file, rows) of what was written.

    A task writes beside its file and renames it at its end, by its partition's number: a task
    that runs again replaces its own file.
    """
    guard(rows.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        system.create_dir(inner, recursive=True)
        name = f"{context.partitionId():08d}.arrow"
        part, sink, writer, n = f"{inner}/_{name}.{context.taskAttemptId()}", None, None, 0
        for batch in batches:
            if writer is None:
                sink = system.open_output_stream(part)
                writer = pa.ipc.new_file(sink, batch.schema)
            writer.write_batch(batch)
            n += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
            system.move(part, f"{inner}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "rows": [n]})

    made = rows.mapInArrow(run, "file string, rows long").collect()  # one row a file
    return rows.sparkSession.createDataFrame(made, "file string, rows long")


def read_arrow(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a folder of Arrow files, a task a file."""
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    files = sorted(f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(".arrow") and not f.base_name.startswith("_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = fs.FileSystem.from_uri(path)[0] if "://" in path else fs.LocalFileSystem()
        for b in batches:
            for file in b.column(0).to_pylist():
                reader = pa.ipc.open_file(own.open_input_file(file))
                yield from (reader.get_batch(i) for i in range(reader.num_record_batches))

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)), "file")
    return listed.mapInArrow(run, schema)


# --- text tables ---------------------------------------------------------------------------
def cell_text(value: Column) -> Column:
    """A text cell: escaped and in quotes, null and empty as \\N."""
    return F.when(value.isNull() | (value == ""), F.lit(NULL)).otherwise(F.concat(F.lit('"'), tags.escaped(value, True), F.lit('"')))


def map_text(value: Column) -> Column:
    """A cell of tags: hstore text whose quotes and backslashes are escaped once more for the cell, in quotes."""
    twice = lambda t: tags.escaped(F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), True)
    text = lambda t: F.when(t.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit('\\"'), twice(t), F.lit('\\"')))
    pairs = F.transform(F.map_entries(value), lambda e: F.concat(text(e["key"]), F.lit("=>"), text(e["value"])))
    return F.coalesce(F.concat(F.lit('"'), F.array_join(pairs, ","), F.lit('"')), F.lit(NULL))


def plain(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NULL))


def point_ewkb(lon: Column, lat: Column) -> Column:
    """Hexadecimal EWKB of a point in 4326, little-endian."""

    @F.pandas_udf("string")
    def run(x, y):
        import struct

        import pandas as pd

        return pd.Series([None if a != a or b != b else struct.pack("<BIIdd", 1, 0x20000001, 4326, a, b).hex().upper() for a, b in zip(x, y, strict=True)], dtype=object)

    return run(lon, lat)


def node_lines(nodes: DataFrame) -> DataFrame:
    """(h33, block_id, id, value): h33, h38, id, point, tags."""
    value = F.concat_ws("\t", plain(F.col("h33")), plain(F.col("h38")), plain(F.col("id")), F.coalesce(point_ewkb(F.col("longitude"), F.col("latitude")), F.lit(NULL)), map_text(F.col("tags")))
    return nodes.select("h33", "block_id", "id", value.alias("value"))


def shape_ewkb(wkb: Column) -> Column:
    """Hexadecimal EWKB in 4326 of little-endian WKB: the flag and number of the reference system go behind the type."""
    text = F.hex(wkb)
    return F.concat(F.substring(text, 1, 8), F.lit("20"), F.lit("E6100000"), F.substring(text, 11, 1 << 30))


def way_lines(way_rows: DataFrame) -> DataFrame:
    """(h33, block_id, id, value) of the ways table with block_id: keys, id, flags, scale, centre, box, line, points, cells, tags.

    Flags here ignore the case of keys, and lines that are not valid carry a tag that says so.
    """
    flag = lambda c: F.when(c, F.lit("t")).otherwise(F.lit("f"))
    has = lambda key: flag(tags.has_any_case(F.col("tags"), key))
    cells = F.when(F.size("h38Indexes") > 0, tags.int_array(F.col("h38Indexes"))).otherwise(F.lit(NULL))
    noted = tags.marked(F.col("tags"), "is.line_non_valid", "true", ~F.col("valid"))  # fixed value: that tag
    value = F.concat_ws(
        "\t", plain(F.col("h33")), plain(F.col("h38")), plain(F.col("id")), flag(F.col("closed")), has("building"), has("highway"), plain(F.col("scale")), F.coalesce(point_ewkb(F.col("longitude"), F.col("latitude")), F.lit(NULL)),
        shape_ewkb(F.col("bboxWkb")), shape_ewkb(F.col("lineStringWkb")), tags.int_array(F.col("pointIdxs")), cells, map_text(noted),
    )
    return way_rows.select("h33", "block_id", "id", value.alias("value"))


def relation_lines(relations: DataFrame) -> DataFrame:
    return relations.select("id", F.concat_ws("\t", plain(F.col("id")), map_text(F.col("tags"))).alias("value"))


def member_lines(members: DataFrame) -> DataFrame:
    """relation, member, kind, role, place."""
    value = F.concat_ws("\t", plain(F.col("relation_id")), plain(F.col("member_id")), plain(F.col("member_type")), cell_text(F.col("member_role")), plain(F.col("sequence_id")))
    return members.select(F.col("relation_id").alias("id"), value.alias("value"))


def text_by_cell(lines: DataFrame, path: str) -> None:
    """Lines in a folder per coarse key, in order of block and id within a file."""
    guard(lines.sparkSession, path)
    dealt(lines, "h33").sortWithinPartitions("h33", "block_id", "id").select("h33", "value").write.partitionBy("h33").text(path)


def statistics_lines(stats: DataFrame, columns: list[str]) -> DataFrame:
    return stats.select(F.concat_ws("\t", *[plain(F.col(c)) for c in columns]).alias("value"))


def read_text(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated table with \\N for null and quoted cells; compressed files by their suffix."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", '"').option("escape", "\\").option("nullValue", NULL).csv(path)


# The columns of the text statistics.
RUN_COLUMNS = ["multipolygonCount", "dataProcessingTime", "pbfSplitTime", "addLocationsToWaysTime", "multipolygonExportTime", "splitMultipolygonByPartsTime", "totalTime"]
BLOCK_COLUMNS = ["id", "nodeCount", "wayCount", "relationCount", "relationMembersCount", "multipolygonCount", "processingTime", "waitingForSaveTime", "saveTime", "threadTime", "threadStart"]
CONTENT_COLUMNS = ["object_type", "block_id", "h33", "count", "size", "min_id", "max_id", "last_modified"]
EXPORT = "wkb_hex string, kind string, id long, tags string"  # fixed value: exported areas


def read_exported(spark: SparkSession, path: str) -> DataFrame:
    """(wkb_hex, kind, id, tags) of exported areas: no quotes, backslashes escape."""
    return spark.read.schema(EXPORT).option("sep", "\t").option("quote", "").option("nullValue", NULL).csv(path)


def catalogued(rows: DataFrame, name: str, by: str | None = None, comments: dict[str, str] | None = None, not_null: tuple[str, ...] = ()) -> None:
    """A table of the catalog: ordered, commented, with statistics; columns that must not be null are checked first."""
    spark = rows.sparkSession
    if not_null:
        broken = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first().asDict()
        if any(broken.values()):
            raise ValueError(f"{name}: nulls in {sorted(c for c, n in broken.items() if n)}")
    order = [c for c in ("h3_3", "h33", "h38", "id") if c in rows.columns and c != by]
    out = (dealt(rows, by).sortWithinPartitions(by, *order) if by else rows.sortWithinPartitions(*order) if order else rows).write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).saveAsTable(name)
    for column, text in (comments or {}).items():
        quoted = text.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} CHANGE COLUMN {column} COMMENT '{quoted}'")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def areas(exported: DataFrame) -> DataFrame:
    """(id, wkb, tags_json) of exported areas (kind, id, wkb_hex, tags as text) that stem from relations."""
    return exported.where("kind = 'relation'").select(F.col("id").cast("long").alias("id"), F.unhex("wkb_hex").alias("wkb"), F.to_json(tags.parse_hstore(F.col("tags"))).alias("tags_json"))
