"""Cells of many shapes at once: one pass, without shuffles, equal to one pair at a time."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terracell.functions import geometry, shapes
from terracell.operators import areas

P = "array<struct<node_id:bigint,lat:double,lon:double>>"


@pytest.fixture(scope="module")
def bounds(spark):
    return areas.cell_bounds(spark).where("id between 25000 and 27000").cache()


def test_ways_of_several_need_no_shuffle(spark, bounds):
    ways = [(1, [(1, 13.0, 100.0), (2, 15.0, 103.0)]), (2, [(1, 13.7, 100.5), (2, 13.7001, 100.5)]), (3, [(1, -60.0, 0.0), (2, -60.0, 0.1)]), (4, None), (5, []), (6, [(1, 13.7, 100.5)])]
    rows = spark.createDataFrame(ways, f"id long, points {P}").select("id", F.lit(32767).cast("smallint").alias("h33"), geometry.line_wkb(F.col("points")).alias("lineStringWkb"))
    found = areas.ways_of_several(rows, bounds)
    got = {r.id: r.h3_3_multi_regions for r in found.collect()}
    assert sorted(got) == [1, 2, 6] and len(got[1]) > 3 and got[2] == got[6] == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_lines_as_wkb(spark):
    rows = [(0, None), (1, []), (2, [(1, 2.0, 1.0)]), (3, [(1, 2.0, 1.0), (2, 4.0, 3.0), (3, float("nan"), 5.0)]), (4, [(1, 0.0, 0.0)])]
    got = {r.id: r.w for r in spark.createDataFrame(rows, f"id long, points {P}").coalesce(1).select("id", geometry.line_wkb(F.col("points")).alias("w")).collect()}
    pack = lambda *v: np.array(v, "<f8").tobytes()
    assert got[0] is None and got[1] is None and bytes(got[2]) == b"\x01\x01\0\0\0" + pack(1, 2) and bytes(got[4]) == b"\x01\x01\0\0\0" + pack(0, 0)
    assert bytes(got[3]) == b"\x01\x02\0\0\0\x03\0\0\0" + pack(1, 2, 3, 4, 5, np.nan)


def test_batches_equal_pairs():
    rng = np.random.default_rng(8)
    hexagon = np.stack([np.cos(np.arange(6) * np.pi / 3), np.sin(np.arange(6) * np.pi / 3)], axis=1)
    rings = [hexagon * rng.uniform(0.3, 2) + rng.integers(-8, 9, 2) / 2 for _ in range(150)] + [np.array([(-9.0, -9), (9, -9), (9, 9), (-9, 9)]), hexagon[:5] + 0.5]
    cells = shapes.Cells(np.arange(len(rings), dtype=np.int16), rings)
    found = []
    for k in range(120):
        at = rng.integers(-8, 9, 2) / 2  # whole halves: corners and edges are touched
        line = at + rng.integers(-4, 5, (int(rng.integers(2, 6)), 2)) / 2
        ring = np.concatenate([line, line[:1]])
        hole = [(at + hexagon / 4)[[0, 1, 2, 3, 4, 5, 0]]] if k % 2 else []
        found.append([(1, [[at[None]]]), (2, [[line]]), (3, [[ring, *hole]]), (6, [[ring], [*[at + 3 * hexagon[[0, 1, 2, 3, 4, 5, 0]]], *hole]])][k % 4])
    write = lambda kind, s: geometry.struct.pack("<BIdd", 1, 1, *s[0][0][0]) if kind == 1 else geometry.struct.pack("<BII", 1, 2, len(s[0][0])) + s[0][0].tobytes() if kind == 2 else shapes.polygon_wkb(s[0]) if kind == 3 else shapes.multipolygon_wkb(s)
    data = [write(*f) for f in found]
    want = [[c for c, r in enumerate(rings) if shapes.meet(kind, s, r)] for kind, s in found]
    assert shapes.met_by(pa.array([*data, None], pa.binary()), cells).to_pylist() == [*want, None]
    assert shapes.met_by(pa.array([b"", *data[1::4]], pa.binary())[1:], cells).to_pylist() == want[1::4] and sum(map(len, want)) > 1000


def test_areas_are_made_in_batches_and_once(spark, bounds):
    def points(*at):
        return [(n, float(y), float(x)) for n, x, y in at]

    ways = [(k, points((1, 100 + k, 13), (2, 101 + k, 13), (3, 101 + k, 14), (1, 100 + k, 13))) for k in range(3)] + [(8, points((1, 0, 0), (2, 1, 1))), (9, None), (10, [])]
    member = "array<struct<member_id:bigint,member_type:string,member_role:string>>"
    relations = [(k, {"type": "multipolygon"}, [(w, "W", "") for w in of]) for k, of in enumerate([(0,), (1, 10), (0, 9), (8,), (2, 99), (2, 1), (10,)])]
    made = areas.assembled(spark.createDataFrame(relations, f"id long, tags map<string,string>, members {member}"), spark.createDataFrame(ways, f"id long, points {P}"))
    got = {r.id: [len(p) for p in shapes.read_wkb(bytes(r.wkb))[1]] for r in made.collect()}
    assert got == {0: [1], 1: [1], 5: [1, 1]}
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([(r.id, bytes(r.wkb), None) for r in made.collect()], "id long, wkb binary, tags map<string,string>")
    table = areas.multipolygons(rows, bounds)
    assert sorted(r.id for r in table.collect()) == [0, 1, 5] and "Join" not in table._jdf.queryExecution().executedPlan().toString()
