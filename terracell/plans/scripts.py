"""Import scripts for a relational database: text made of the partition plan, which is a few thousand rows at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import partitions

# The columns of the text tables, in their order, and the statements around them.
COLUMNS = {"nodes": "h3_3,h3_8,id,geom,tags", "ways": "h3_3,h3_8,id,closed,building,highway,scale,centre,bbox,linestring,points,h3_8_regions,tags"}
HEAD = "SET application_name = 'psql {name}';\n\\timing on\n"
CREATE = 'CREATE TABLE "{table}_{part:03d}" (like {table}) {storage};\n'
COPY = "COPY \"{table}_{part:03d}\"({columns}) FROM '/input/{table}/{cell:05d}.tsv' DELIMITER E'\\t' ESCAPE '\\' NULL '\\N' CSV;\n"
ATTACH = 'ALTER TABLE  {table} ATTACH PARTITION  "{table}_{part:03d}" FOR VALUES FROM ({lo}) TO ({hi});\n'
AREA_TABLE = 'CREATE TABLE  "multipolygon_{part:03d}" PARTITION OF multipolygon FOR VALUES FROM ({lo}) TO ({hi}) {storage};\n'
AREA_COPY = "\\timing on\ncopy preimport_multipolygon FROM '/input/multipolygon/{file}';"
COLUMNAR, HOLE = "USING COLUMNAR", "${substitute}"


def cells_of_parts(cells: DataFrame, ranges: DataFrame) -> list[tuple[int, int, int, list[int]]]:
    """(part, lo, hi, its cells in order) of (h33); parts without cells are left out, and cells outside all parts."""
    placed = partitions.assigned(cells.select("h33").distinct(), ranges).groupBy("part_id").agg(F.array_sort(F.collect_list("h33")).alias("cells"))
    rows = placed.join(ranges.withColumnRenamed("id", "part_id"), "part_id").orderBy("part_id").collect()  # at most one a parent
    return [(r.part_id, r.lo, r.hi, r.cells) for r in rows]


def imports(table: str, parts: list[tuple[int, int, int, list[int]]], scripts: int = 4, columnar: bool = False) -> dict[str, str]:
    """Script names and texts: consecutive parts, each script one transaction."""
    per, storage, out = len(parts) // scripts + 1, COLUMNAR if columnar else "", {}
    for n in range(0, len(parts), per):
        name = f"sql/{table}_import_{n // per:03d}.sql"
        text = HEAD.format(name=name) + "BEGIN;\n"
        for part, _, _, cells in parts[n : n + per]:
            text += CREATE.format(table=table, part=part, storage=storage) + "".join(COPY.format(table=table, part=part, columns=COLUMNS[table], cell=c) for c in cells)
        for part, lo, hi, _ in parts[n : n + per]:
            text += ATTACH.format(table=table, part=part, lo=lo, hi=hi)
        out[name] = text + "COMMIT;"
    return out


def area_tables(ranges: DataFrame, columnar: bool = False) -> str:
    return "".join(AREA_TABLE.format(part=r.id, lo=r.lo, hi=r.hi, storage=COLUMNAR if columnar else "") for r in ranges.orderBy("id").collect())


def area_copies(files: list[str]) -> dict[str, str]:
    """A script for each file of areas, by what follows its first underscore."""
    return {f"sql/y_multipoly_{f.removeprefix('multipolygon_')}.sql": AREA_COPY.format(file=f) for f in files}


def area_lines_a_file(count: int, scripts: int = 4) -> int:
    return count // scripts + 1


def filled(template: str, value: str) -> str:
    return template.replace(HOLE, value)
