"""Cells of positions against published examples, counts of cells and round trips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracell.functions import grid


@pytest.mark.parametrize(
    ("lat", "lon", "res", "cell"),
    [(37.3615593, -122.0553238, 5, 0x85283473FFFFFFF), (37.775938728915946, -122.41795063018799, 9, 0x8928308280FFFFF), (40.689167, -74.044444, 10, 0x8A2A1072B59FFFF), (13.75, 100.5, 0, 0x8065FFFFFFFFFFF)],
)
def test_published_cells(lat, lon, res, cell):
    assert int(grid.indexes(np.array([lat]), np.array([lon]), res)[0]) == cell & ((1 << 63) - 1)


def test_published_centre():
    lat, lon = grid.centres(np.array([0x85283473FFFFFFF]), 5)
    assert lat[0] == pytest.approx(37.34579337536848, abs=1e-9) and lon[0] == pytest.approx(-121.97637597255124, abs=1e-9)


def everywhere(res, n=400_000):
    rng = np.random.default_rng(1)
    return np.unique(grid.indexes(np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n), res))


@pytest.mark.parametrize("res", [0, 1, 2])
def test_all_cells_are_found_and_symmetric(res):
    cells = everywhere(res)
    assert len(cells) == 2 + 120 * 7**res
    around = {int(c): {int(x) for x in row if x >= 0} for c, row in zip(cells, grid.neighbours(cells, res), strict=True)}
    assert sorted(len(v) for v in around.values()) == [5] * 12 + [6] * (len(cells) - 12)
    assert all(c in around[x] and x != c for c, xs in around.items() for x in xs)


@pytest.mark.parametrize("res", [3, 5, 8, 12])
def test_centres_lie_in_their_cells(res):
    cells = everywhere(res, 50_000)
    assert (grid.indexes(*grid.centres(cells, res), res) == cells).all()


def test_rings_grow_by_six():
    cell = int(grid.indexes(np.array([13.75]), np.array([100.5]), 8)[0])
    assert [len(r) for r in grid.disks(np.array([cell, cell]), 4, 8)[1]] == [1, 6, 12, 18, 24]


def test_columns_pass_nulls_on(spark):
    df = spark.createDataFrame([(1, 37.3615593, -122.0553238), (2, None, 1.0), (3, float("nan"), 1.0)], "id int, lat double, lon double")
    cells = df.select("id", grid.cell_of(F.col("lat"), F.col("lon"), 5).alias("c")).select("id", "c", grid.resolution(F.col("c")).alias("r"), grid.centre_of(F.col("c"), 5).alias("at"), grid.rings_of(F.col("c"), 1, 5).alias("rings"))
    one, two, three = cells.orderBy("id").collect()
    assert one.c == 0x85283473FFFFFFF and one.r == 5 and len(one.rings[1]) == 6 and one["at"].lat == pytest.approx(37.345793, abs=1e-6)
    assert two.c is None and two["at"] is None and two.rings is None and three.c is None


def test_published_boundary():
    want = [(37.271355866731895, -121.91508032705622), (37.353926450852256, -121.86222328902491), (37.42834118609435, -121.92354999630156), (37.42012867767778, -122.03773496427027), (37.33755608435298, -122.09042892904397), (37.26319797461824, -122.02910130918998)]
    got = grid.boundaries(np.array([0x85283473FFFFFFF]), 5)[0]
    assert sorted(map(tuple, got.round(9).tolist())) == sorted((round(a, 9), round(b, 9)) for a, b in want)


def test_boundaries_hold_their_cells():
    cells = everywhere(2)
    for cell, ring, around in zip(cells, grid.boundaries(cells, 2), grid.neighbours(cells, 2), strict=True):
        assert len(ring) == (around >= 0).sum()
        lat, lon = (x[0] for x in grid.centres(np.array([cell]), 2))
        if abs(lat) < 75 and abs(lon) < 160:
            assert grid.inside(np.array([lat]), np.array([lon]), [ring])[0]
            inward = ring + 0.02 * (np.array([lat, lon]) - ring)
            assert (grid.indexes(inward[:, 0], inward[:, 1], 2) == cell).mean() > 0.8  # edges of faces bend cells


def test_paths_step_from_cell_to_cell():
    rng = np.random.default_rng(4)
    for _ in range(40):
        lat, lon = rng.uniform(-60, 60), rng.uniform(-170, 170)
        a, b = grid.indexes(np.array([lat, lat + rng.uniform(-0.1, 0.1)]), np.array([lon, lon + rng.uniform(-0.1, 0.1)]), 8).tolist()
        got = grid.path(a, b, 8)
        assert got[0] == a and got[-1] == b and len(set(got)) == len(got)
        near = grid.neighbours(np.array(got), 8)
        skipped = sum(y not in near[k] for k, y in enumerate(got[1:]))
        assert skipped <= 1  # over an edge of a face
        assert len(got) == 1 + min(len(got) - 1, next(k for k in range(80) if b in grid.disks(np.array([a]), k, 8)[0][k])) if a != b and len(got) < 12 else True


def test_covers_are_the_cells_with_centres_inside():
    rng = np.random.default_rng(5)
    for _ in range(10):
        at = np.array([rng.uniform(-60, 60), rng.uniform(-170, 170)])
        turn = np.sort(rng.uniform(0, 2 * np.pi, 7))
        ring = at + 0.05 * np.stack([np.sin(turn), np.cos(turn)], axis=1) * rng.uniform(0.5, 1, (7, 1))
        dots = at + rng.uniform(-0.06, 0.06, (6000, 2))
        near = np.unique(grid.indexes(dots[:, 0], dots[:, 1], 8))
        lat, lon = grid.centres(near, 8)
        assert grid.cover([ring], 8) == sorted(near[grid.inside(lat, lon, [ring])].tolist())


def test_regions_of_ways(spark):
    line = lambda *p: [{"lat": a, "lon": b} for a, b in p]
    square = line((10.0, 10.0), (10.0, 10.03), (10.03, 10.03), (10.03, 10.0), (10.0, 10.0))
    rows = [(1, line((10.0, 10.0), (10.02, 10.02)), 10.01, 10.01, 1500.0, False), (2, line((10.0, 10.0)), 10.0, 10.0, 0.0, False), (3, line((10.0, 10.0), (10.9, 10.0)), 10.4, 10.0, 50000.0, False), (4, square, 10.015, 10.015, 2300.0, True), (5, None, 1.0, 1.0, 1.0, False), (6, square, 10.015, 10.015, 2300.0, False)]
    df = spark.createDataFrame(rows, "id int, points array<struct<lat:double,lon:double>>, lat double, lon double, m double, closed boolean")
    got = {r.id: r.x for r in df.select("id", grid.regions_of(F.col("points"), F.col("lat"), F.col("lon"), F.col("m"), F.col("closed")).alias("x")).collect()}
    assert got[2] is None and got[3] is None and got[5] is None
    a, b = grid.indexes(np.array([10.0, 10.02]), np.array([10.0, 10.02]), 8).tolist()
    assert {a, b} <= set(got[1]) and set(got[6]) < set(got[4])
