"""Shapes as WKB: reading and writing, intersection, simplification, ring assembly; numpy under Arrow UDFs.

A shape is a list of polygons, each a list of rings, each an array of (x, y); lines and points are
polygons of one open ring. All measures are plane ones, in degrees.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import geometry, grid

# WKB types, and the flag of an SRID behind the type.
POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION, SRID = 1, 2, 3, 4, 5, 6, 7, 0x20000000

Ring = np.ndarray
Shape = list[list[Ring]]


def read_wkb(data: bytes) -> tuple[int, Shape]:
    """(type, polygons) of WKB or EWKB of two dimensions, of either byte order."""

    def one(at: int) -> tuple[int, Shape, int]:
        order = "<" if data[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 9 if kind & SRID else 5
        kind &= ~SRID

        def row(at: int, n: int) -> tuple[Ring, int]:
            return np.frombuffer(data, order + "f8", 2 * n, at).reshape(n, 2).astype(np.float64), at + 16 * n

        def count(at: int) -> tuple[int, int]:
            return struct.unpack_from(order + "I", data, at)[0], at + 4

        if kind == POINT:
            ring, at = row(at, 1)
            return kind, [[ring]], at
        n, at = count(at)
        if kind == LINE:
            ring, at = row(at, n)
            return kind, [[ring]], at
        if kind == POLYGON:
            rings = []
            for _ in range(n):
                m, at = count(at)
                ring, at = row(at, m)
                rings.append(ring)
            return kind, [rings], at
        if kind not in (MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION):
            raise ValueError(f"WKB type {kind} is not supported")
        parts: Shape = []
        for _ in range(n):
            _, more, at = one(at)
            parts += more
        return kind, parts, at

    kind, shape, _ = one(0)
    return kind, shape


def polygon_wkb(rings: list[Ring]) -> bytes:
    return struct.pack("<BII", 1, POLYGON, len(rings)) + b"".join(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)


def multipolygon_wkb(shape: Shape) -> bytes:
    return struct.pack("<BII", 1, MULTIPOLYGON, len(shape)) + b"".join(map(polygon_wkb, shape))


def within(points: np.ndarray, rings: list[Ring]) -> np.ndarray:
    return grid.inside(points[:, 1], points[:, 0], [r[:, ::-1] for r in rings])


def segments(ring: Ring) -> np.ndarray:
    return np.concatenate([ring[:-1], ring[1:]], axis=1) if len(ring) > 1 else np.concatenate([ring, ring], axis=1)


def cross(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether any segment (x0, y0, x1, y1) of one set meets one of the other, touching included."""

    def side(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))

    def between(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        return ((np.minimum(p, q) <= r) & (r <= np.maximum(p, q))).all(axis=-1)

    for at in range(0, len(a), 4096):
        p, q = a[at : at + 4096, None, :2], a[at : at + 4096, None, 2:]
        r, s = b[None, :, :2], b[None, :, 2:]
        one, two, three, four = side(p, q, r), side(p, q, s), side(r, s, p), side(r, s, q)
        hit = (one * two < 0) & (three * four < 0)
        for o, x, y, z in ((one, p, q, r), (two, p, q, s), (three, r, s, p), (four, r, s, q)):
            hit |= (o == 0) & between(x, y, z)
        if hit.any():
            return True
    return False


def meet(kind: int, shape: Shape, ring: Ring) -> bool:
    """Whether a shape meets the area of a ring, its edge included."""
    low, high = ring.min(axis=0), ring.max(axis=0)
    edge = segments(ring if (ring[0] == ring[-1]).all() else np.concatenate([ring, ring[:1]]))
    for rings in shape:
        outer = rings[0]
        if (outer.max(axis=0) < low).any() or (outer.min(axis=0) > high).any():
            continue
        if within(outer, [ring]).any() or any(cross(segments(r), edge) for r in rings):
            return True
        if kind in (POLYGON, MULTIPOLYGON) and within(ring[:1], rings)[0]:
            return True
    return False


def turned(ring: Ring) -> list[Ring]:
    """A ring of a cell, on either side where it crosses the antimeridian."""
    if np.ptp(ring[:, 0]) <= 180:
        return [ring]
    east = ring.copy()
    east[east[:, 0] < 0, 0] += 360
    return [east, east - (360, 0)]


class Cells:
    """Areas of cells with the boxes around them in bins of one degree, for many shapes at once.

    An area that crosses the antimeridian stands there twice; shorter rings repeat their last corner.
    """

    def __init__(self, keys: np.ndarray, rings: list[Ring]) -> None:
        own = [r if (r[0] == r[-1]).all() else np.concatenate([r, r[:1]]) for r in rings]
        most = max(map(len, own))
        corners = np.stack([np.concatenate([r, np.repeat(r[-1:], most - len(r), axis=0)]) for r in own])
        self.keys, self.start, self.end = keys, corners[:, :-1], corners[:, 1:]
        self.low, self.high = corners.min(axis=1), corners.max(axis=1)
        self.zero = np.floor(self.low.min(axis=0)).astype(np.int64)
        self.shape = np.floor(self.high.max(axis=0)).astype(np.int64) - self.zero + 1
        row, at = self._bins(self.low, self.high)
        order = np.argsort(at, kind="stable")
        self.held, self.edge = row[order], np.searchsorted(at[order], np.arange(self.shape.prod() + 1))

    def _bin(self, p: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(np.clip(p, -1e6, 1e6)).astype(np.int64) - self.zero, 0, self.shape - 1)

    def _bins(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, bin) of every bin that each box meets."""
        first, n = self._bin(low), self._bin(high) - self._bin(low) + 1
        row, k = spread(n.prod(axis=1))
        x, y = first[row, 0] + k // n[row, 1], first[row, 1] + k % n[row, 1]
        return row, x * self.shape[1] + y

    def near(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(box, area) whose boxes meet, each once."""
        box, at = self._bins(low, high)
        k, n = spread(self.edge[at + 1] - self.edge[at])
        box, at, area = box[k], at[k], self.held[self.edge[at[k]] + n]
        corner = self._bin(np.maximum(low[box], self.low[area]))  # boxes that meet in several bins count in one
        ok = (corner[:, 0] * self.shape[1] + corner[:, 1] == at) & (low[box] <= self.high[area]).all(axis=1) & (high[box] >= self.low[area]).all(axis=1)
        return box[ok], area[ok]


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row as often as its size, and the counts within it from 0."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def even_odd(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the ray from p crosses the edge from a to b."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((a[..., 1] > p[..., 1]) != (b[..., 1] > p[..., 1])) & (p[..., 0] < (b[..., 0] - a[..., 0]) * (p[..., 1] - a[..., 1]) / (b[..., 1] - a[..., 1]) + a[..., 0])


def touch(p: np.ndarray, q: np.ndarray, r: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whether each segment p to q meets the segment r to s, touching included."""

    def side(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.sign((b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0]))

    sides = side(p, q, r), side(p, q, s), side(r, s, p), side(r, s, q)
    hit = (sides[0] * sides[1] < 0) & (sides[2] * sides[3] < 0)
    for o, x, y, z in zip(sides, (p, p, r, r), (q, q, s, s), (r, s, p, q), strict=True):
        at = np.nonzero(o == 0)
        if len(at[0]):
            x, y, z = (np.broadcast_to(v, (*hit.shape, 2))[at] for v in (x, y, z))
            hit[at] |= ((np.minimum(x, y) <= z) & (z <= np.maximum(x, y))).all(axis=-1)
    return hit


_PAIRS, _BINS, _PAD = 1 << 15, 1 << 20, 1e-9  # of corners or segments with areas, of bins, looked at in one go; degrees


def pieces(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows of at most ``most`` in all, or one row."""
    out, end, low = [], np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(end, (end[low - 1] if low else 0) + most, "right")))
        out.append((low, high))
        low = high
    return out


def met(xy: np.ndarray, ring_sizes: np.ndarray, rings_of: np.ndarray, area: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """(polygon, key) of the cells that polygons meet, as ``meet`` says of each pair, each once.

    xy are the corners of all rings, rings_of the number of each polygon's rings, its outer one first; a polygon that is no area is a line.
    """
    first_ring = np.cumsum(rings_of) - rings_of
    begin = np.cumsum(ring_sizes) - ring_sizes
    outer, n_outer = begin[first_ring], ring_sizes[first_ring]
    n_all = np.add.reduceat(ring_sizes, first_ring)
    last = np.zeros(len(xy), bool)
    last[begin + ring_sizes - 1] = True
    after = np.arange(1, len(xy) + 1)
    around = np.where(last, np.repeat(begin, ring_sizes), after)  # the next corner, the first one's after the last
    single = np.repeat(ring_sizes == 1, ring_sizes)
    k, n = spread(n_outer)
    edges = np.cumsum(n_outer) - n_outer
    of_outer = xy[outer[k] + n]
    low, high = np.minimum.reduceat(of_outer, edges), np.maximum.reduceat(of_outer, edges)
    ok = np.flatnonzero(np.isfinite(low).all(axis=1) & np.isfinite(high).all(axis=1))
    spans = (np.minimum(high[ok], 1e6) - np.maximum(low[ok], -1e6) + 2).clip(0, cells.shape).prod(axis=1).astype(np.int64)
    polygon, part = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, y in pieces(spans, _BINS):
        box, a = cells.near(low[ok[x:y]], high[ok[x:y]])
        polygon.append(ok[x:y][box])
        part.append(a)
    polygon, part = np.concatenate(polygon), np.concatenate(part)
    hit = np.zeros(len(polygon), bool)

    def corners(sizes: np.ndarray, start: np.ndarray):
        """Pairs that are not known to meet, with each of their polygon's corners."""
        todo = np.flatnonzero(~hit)
        for x, y in pieces(sizes[polygon[todo]], _PAIRS):
            pair = todo[x:y]
            k, n = spread(sizes[polygon[pair]])
            yield pair[k], start[polygon[pair[k]]] + n, part[pair[k]]

    for pair, at, a in corners(n_outer, outer):
        p = xy[at]
        some = ((p >= cells.low[a] - _PAD) & (p <= cells.high[a] + _PAD)).all(axis=1)
        pair, p, a = pair[some], p[some], a[some]
        inside = np.logical_xor.reduce(even_odd(p[:, None], cells.start[a], cells.end[a]), axis=1)
        hit[pair[inside]] = True
    for pair, at, a in corners(n_all, outer):
        to = np.minimum(np.where(single[at], at, at + 1), len(xy) - 1)
        p, q = xy[at], xy[to]
        some = (single[at] | ~last[at]) & (np.minimum(p, q) <= cells.high[a] + _PAD).all(axis=1) & (np.maximum(p, q) >= cells.low[a] - _PAD).all(axis=1)
        pair, p, q, a = pair[some], p[some], q[some], a[some]
        hit[pair[touch(p[:, None], q[:, None], cells.start[a], cells.end[a]).any(axis=1)]] = True
    odd = np.zeros(len(polygon), np.int64)
    for pair, at, a in corners(np.where(area, n_all, 0), outer):
        odd += np.bincount(pair[even_odd(cells.start[a, 0], xy[at], xy[around[at]])], minlength=len(odd))
    hit |= odd % 2 == 1
    found = pd.DataFrame({"polygon": polygon[hit], "key": cells.keys[part[hit]]}).drop_duplicates()
    return found["polygon"].to_numpy(), found["key"].to_numpy()


def _lines(data: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
    """(corners, sizes) of little-endian line strings without nulls; None if any is something else."""
    if data.null_count or not len(data):
        return None
    wide = pa.types.is_large_binary(data.type)
    at = np.frombuffer(data.buffers()[1], np.int64 if wide else np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    held, size = np.frombuffer(data.buffers()[2] or b"", np.uint8), np.diff(at)
    if (size < 25).any():
        return None
    head = held[at[:-1, None] + np.arange(9)]
    n = np.ascontiguousarray(head[:, 5:]).view("<u4")[:, 0].astype(np.int64)
    if (head[:, :5] != (1, LINE, 0, 0, 0)).any() or (size != 9 + 16 * n).any():
        return None
    k, m = spread(n)
    return held[(at[:-1][k] + 9 + 16 * m)[:, None] + np.arange(16)].view("<f8"), n


def met_by(data: pa.Array, cells: Cells) -> pa.Array:
    """The keys of the cells that each shape of WKB meets, in order; null for null."""
    plain = _lines(data)
    if plain:
        xy, sizes = plain
        row, rings_of, area = np.arange(len(data)), np.ones(len(data), np.int64), np.zeros(len(data), bool)
    else:
        found = [(k, *read_wkb(d)) for k, d in enumerate(data.to_pylist()) if d is not None]
        polygons = [(k, kind in (POLYGON, MULTIPOLYGON), rings) for k, kind, shape in found for rings in shape if len(rings) and len(rings[0])]
        polygons = [(k, is_area, [r for r in rings if len(r)]) for k, is_area, rings in polygons]
        row, area = np.array([k for k, _, _ in polygons], np.int64), np.array([a for _, a, _ in polygons], bool)
        rings_of, sizes = np.array([len(r) for _, _, r in polygons], np.int64), np.array([len(x) for _, _, r in polygons for x in r], np.int64)
        xy = np.concatenate([np.zeros((0, 2)), *(x for _, _, r in polygons for x in r)])
    polygon, key = met(xy, sizes, rings_of, area, cells) if len(row) else (np.zeros(0, np.int64), np.zeros(0, np.int16))
    pairs = pd.DataFrame({"row": row[polygon], "key": key}).drop_duplicates().sort_values(["row", "key"])
    ends = np.searchsorted(pairs["row"].to_numpy(), np.arange(len(data) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs["key"].to_numpy(np.int16)), mask=data.is_null())


def cells_met(wkb: Column, bounds: list[tuple[int, bytes]]) -> Column:
    """array<smallint>: the keys of (key, polygon without holes as WKB) whose area a shape meets, edges included, in order; null for null."""
    held = SparkSession.active().sparkContext.broadcast(bounds)  # as many as there are cells, whatever the data

    @F.arrow_udf("array<smallint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parts = [(key, part) for key, area in held.value for rings in read_wkb(area)[1] for part in turned(rings[0])]
        cells = Cells(np.array([k for k, _ in parts], np.int16), [r for _, r in parts]) if parts else None
        for data in batches:
            yield met_by(data, cells) if cells else pa.array([None if d is None else [] for d in data.to_pylist()], pa.list_(pa.int16()))

    return run(wkb)


def simplified(ring: Ring, tolerance: float) -> Ring:
    """Douglas and Peucker: the points that stand further than ``tolerance`` from the line between kept ones; ends stay."""
    keep = np.zeros(len(ring), bool)
    keep[[0, -1]] = True
    todo = [(0, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, d = ring[a + 1 : b] - ring[a], ring[b] - ring[a]
        length = (d * d).sum()
        t = np.clip(p @ d / length, 0, 1) if length else np.zeros(len(p))
        off = np.hypot(*(p - t[:, None] * d).T)
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return ring[keep]


LARGE = 10_000  # bytes from which shapes are simplified before their circle is sought


def circle_of(wkb: Column) -> Column:
    """struct<lon, lat, radius> of the smallest circle around a shape, large ones simplified to a thousandth of their extent."""

    @F.pandas_udf("lon double, lat double, radius double")
    def run(data: pd.Series) -> pd.DataFrame:
        out = []
        for d in data:
            if d is None:
                out.append((np.nan,) * 3)
                continue
            rings = [r for rings in read_wkb(bytes(d))[1] for r in rings]
            if len(d) >= LARGE:
                xy = np.concatenate(rings)
                rings = [simplified(r, float(np.ptp(xy, axis=0).max()) / 1000) for r in rings]
            out.append(geometry.smallest_circle([tuple(p) for r in rings for p in r.tolist()]))
        return pd.DataFrame(out, columns=["lon", "lat", "radius"], dtype="float64")

    return run(wkb)


def bbox_of(wkb: Column) -> Column:
    """struct<min_x, max_x, min_y, max_y> of a shape; NaN for null."""

    @F.pandas_udf("min_x double, max_x double, min_y double, max_y double")
    def run(data: pd.Series) -> pd.DataFrame:
        out = []
        for d in data:
            xy = np.full((1, 2), np.nan) if d is None else np.concatenate([r for rings in read_wkb(bytes(d))[1] for r in rings])
            (x0, y0), (x1, y1) = xy.min(axis=0), xy.max(axis=0)
            out.append((x0, x1, y0, y1))
        return pd.DataFrame(out, columns=["min_x", "max_x", "min_y", "max_y"], dtype="float64")

    return run(wkb)


# --- areas from lines ----------------------------------------------------------------------
def stitched(lines: list[tuple[list[int], Ring]]) -> list[Ring] | None:
    """Closed rings of lines (node ids, places) joined end to end; None if any is left open or has fewer than four points."""
    rings, open_ = [], list(lines)
    while open_:
        ids, xy = open_.pop()
        ids, xy = list(ids), [xy]
        while ids[0] != ids[-1]:
            k = next((k for k, (other, _) in enumerate(open_) if ids[-1] in (other[0], other[-1])), None)
            if k is None:
                return None
            other, more = open_.pop(k)
            if other[0] != ids[-1]:
                other, more = list(other)[::-1], more[::-1]
            ids += list(other)[1:]
            xy.append(more[1:])
        ring = np.concatenate(xy)
        if len(ring) < 4:
            return None
        rings.append(ring)
    return rings


def assembled(lines: list[tuple[list[int], Ring]]) -> Shape | None:
    """Polygons of rings by how many others hold each: even ones are outer, odd ones holes of the smallest that holds them."""
    rings = stitched(lines)
    if not rings:
        return None
    area = [abs(float(((r[:-1, 0] * r[1:, 1]) - (r[1:, 0] * r[:-1, 1])).sum()) / 2) for r in rings]
    if not all(area):
        return None
    order = sorted(range(len(rings)), key=lambda k: -area[k])
    depth: dict[int, int] = {}
    shape: dict[int, list[Ring]] = {}
    for n, k in enumerate(order):
        middle = (rings[k][:1] + rings[k][1:2]) / 2  # a point of its edge, not a corner that rings may share
        around = [j for j in order[:n] if within(middle, [rings[j]])[0]]
        depth[k] = len(around)
        if depth[k] % 2:
            shape[max((j for j in around if not depth[j] % 2), key=lambda j: depth[j])].append(rings[k])
        else:
            shape[k] = [rings[k]]
    return list(shape.values())
