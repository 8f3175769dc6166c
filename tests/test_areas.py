"""Shapes, areas and the cells they meet, against brute force and hand-made cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracell.functions import grid, keys, shapes
from terracell.operators import areas

BOX = np.array([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)])


@pytest.fixture(scope="module")
def bounds(spark):
    return areas.cell_bounds(spark).cache()


def test_wkb_round_trip():
    kind, got = shapes.read_wkb(shapes.multipolygon_wkb([[BOX, BOX / 2 + 0.5], [BOX + 9]]))
    assert kind == shapes.MULTIPOLYGON and [[r.tolist() for r in p] for p in got] == [[BOX.tolist(), (BOX / 2 + 0.5).tolist()], [(BOX + 9).tolist()]]
    import struct

    assert shapes.read_wkb(struct.pack(">BIIdd", 0, 0x20000001, 4326, 1.5, -2.5))[1][0][0].tolist() == [[1.5, -2.5]]


@pytest.mark.parametrize(
    ("kind", "xy", "want"),
    [(shapes.LINE, [(-1, 2), (5, 2)], True), (shapes.LINE, [(-1, -1), (-1, 5)], False), (shapes.LINE, [(1, 1), (2, 2)], True), (shapes.LINE, [(4, 4), (9, 9)], True), (shapes.POLYGON, [(-9, -9), (9, -9), (9, 9), (-9, 9), (-9, -9)], True), (shapes.LINE, [(-2, 5), (5, 12)], False), (shapes.POINT, [(2, 2)], True)],
)
def test_meeting_shapes(kind, xy, want):
    assert shapes.meet(kind, [[np.array(xy, float)]], BOX) is want


def test_holes_do_not_meet():
    hole = BOX / 2 + 1
    assert not shapes.meet(shapes.POLYGON, [[BOX, hole]], BOX / 8 + 1.8)
    assert shapes.meet(shapes.POLYGON, [[BOX, hole]], BOX / 8 + 0.2)


def test_simplified_lines_keep_what_stands_out():
    x = np.linspace(0, 10, 200)
    line = np.stack([x, 0.001 * np.sin(9 * x)], axis=1)
    line[100, 1] = 5
    got = shapes.simplified(line, 0.01)
    assert len(got) < 10 and 5 in got[:, 1] and (got[[0, -1]] == line[[0, -1]]).all()


def test_bounds_of_all_cells(bounds):
    rows = bounds.collect()
    assert len(rows) == 41162 == len({r.id for r in rows})
    some = {r.id: r for r in rows}[25764]
    assert (some.h3_2, some.h3_0) == (25767, (50 << 9) + 511)
    ring = shapes.read_wkb(bytes(some.bounds))[1][0][0]
    assert abs(ring[:, 0].mean() - 100.5) < 1 and abs(ring[:, 1].mean() - 13.7) < 1


def test_cells_met_equal_all_pairs(spark, bounds):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(12):
        at, n = rng.uniform(-60, 60, 2), int(rng.integers(2, 5))
        line = at + rng.uniform(-2.5, 2.5, (n, 2))
        rows.append((k, bytes(np.array([1], "u1").tobytes() + np.array([2, n], "<u4").tobytes() + line.astype("<f8").tobytes())))
    for k in range(12, 18):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 6))
        ring = rng.uniform(-60, 60, 2) + 2 * np.stack([np.cos(turn), np.sin(turn)], axis=1)
        rows.append((k, shapes.multipolygon_wkb([[np.concatenate([ring, ring[:1]])]])))
    rows.append((99, None))
    table = spark.createDataFrame(rows, "id long, wkb binary")
    got = {(r.id, r.cell) for r in areas.met_cells(table, "wkb", bounds).collect()}
    cells = [(r.id, ring) for r in bounds.collect() for ring in shapes.turned(shapes.read_wkb(bytes(r.bounds))[1][0][0])]
    want = {(i, c) for i, w in rows if w for c, ring in cells if shapes.meet(*shapes.read_wkb(w), ring)}
    assert got == want and len(want) > 40
    left = {r.id: r.regions for r in areas.regions(table, "wkb", bounds, "left").collect()}
    assert left[99] is None and left[0] == sorted(c for i, c in want if i == 0)


def points(*at):
    return [{"node_id": n, "lat": float(y), "lon": float(x)} for n, x, y in at]


def test_areas_of_relations(spark, bounds):
    ways = [
        (1, points((1, 0, 0), (2, 4, 0), (3, 4, 4))), (2, points((1, 0, 0), (4, 0, 4), (3, 4, 4))),  # an outer ring in two ways
        (3, points((5, 1, 1), (6, 2, 1), (7, 2, 2), (5, 1, 1))),  # a hole in it
        (4, points((8, 10, 10), (9, 10.01, 10), (10, 10, 10.01), (8, 10, 10))), (5, points((11, 0, 0), (12, 1, 1))), (6, points((13, 0, 0), (14, 1, 0), (13, 0, 0))),
    ]
    member = lambda *ids: [(i, "W", "") for i in ids] + [(77, "N", "label")]
    multi = {"type": "multipolygon", "name": "x"}
    relations = [(1, multi, member(1, 2, 3)), (2, multi, member(4)), (3, multi, member(5)), (4, multi, member(4, 404)), (5, {"type": "route"}, member(4)), (6, multi, member(6)), (7, None, member(4)), (8, {"type": "boundary"}, member(4, 1, 2))]
    r = spark.createDataFrame(relations, "id long, tags map<string,string>, members array<struct<member_id:bigint,member_type:string,member_role:string>>")
    w = spark.createDataFrame(ways, "id long, points array<struct<node_id:bigint,lat:double,lon:double>>")
    made = areas.assembled(r, w)
    got = {x.id: shapes.read_wkb(bytes(x.wkb))[1] for x in made.collect()}
    assert sorted(got) == [1, 2, 8] and [len(p) for p in got[1]] == [2] and sorted(len(p) for p in got[8]) == [1, 1]
    assert {tuple(p) for p in got[1][0][0].tolist()} == {(0, 0), (4, 0), (4, 4), (0, 4)}
    table = {x.id: x for x in areas.multipolygons(made, bounds).collect()}
    assert table[1].h3_3 == keys.SEVERAL and len(table[1].h3_3_multi_regions) > 1
    cell = int(grid.indexes(np.array([10.005]), np.array([10.005]), 3)[0])
    assert table[2].h3_3_multi_regions is None and keys.coarse(F.lit(cell)) is not None
    assert table[2].h3_3 == spark.range(1).select(keys.coarse(F.lit(cell))).first()[0]
    assert 770 < table[2].scale < 790  # half the hypotenuse of 0.01 degrees, in metres along the parallel
    centre = shapes.read_wkb(bytes(table[1].centre))[1][0][0][0]
    assert centre.tolist() == pytest.approx([2, 2])
    assert made.limit(0).count() == areas.multipolygons(made.limit(0), bounds).count() == 0
