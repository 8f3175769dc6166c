"""Geometry of ordered points: native measures, and Arrow kernels for bytes and circles.

``points`` is array<struct<node_id, lat, lon>>; all plane measures are in degrees, as stored.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84.
MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563


def closed(points: Column) -> Column:
    first, last = points[0], F.element_at(points, -1)
    return (F.size(points) > 1) & (first["lat"] == last["lat"]) & (first["lon"] == last["lon"])


def valid(points: Column) -> Column:
    """A line: at least two points, not all the same, no NaN."""
    places = F.array_distinct(F.transform(points, lambda p: F.struct(p["lat"], p["lon"])))
    return (F.size(places) > 1) & ~F.exists(points, lambda p: F.isnan(p["lat"]) | F.isnan(p["lon"]))


def bbox(points: Column) -> Column:
    lat, lon = F.transform(points, lambda p: p["lat"]), F.transform(points, lambda p: p["lon"])
    return F.struct(F.array_min(lon).alias("min_x"), F.array_max(lon).alias("max_x"), F.array_min(lat).alias("min_y"), F.array_max(lat).alias("max_y"))


def centroid(points: Column) -> Column:
    """Centre of a line, its segments weighted by length; the mean of the points if it has none."""
    pairs = F.transform(F.slice(points, 1, F.size(points) - 1), lambda p, i: F.struct(p.alias("a"), F.get(points, i + 1).alias("b")))
    start = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        d = F.sqrt((b["lon"] - a["lon"]) * (b["lon"] - a["lon"]) + (b["lat"] - a["lat"]) * (b["lat"] - a["lat"]))
        return F.struct((s["w"] + d).alias("w"), (s["x"] + d * (a["lon"] + b["lon"]) / 2).alias("x"), (s["y"] + d * (a["lat"] + b["lat"]) / 2).alias("y"))

    s = F.aggregate(pairs, start, add)
    mean = lambda f: F.aggregate(points, F.lit(0.0), lambda n, p: n + p[f]) / F.size(points)
    return F.struct(F.when(s["w"] > 0, s["x"] / s["w"]).otherwise(mean("lon")).alias("lon"), F.when(s["w"] > 0, s["y"] / s["w"]).otherwise(mean("lat")).alias("lat"))


def extent(box: Column) -> Column:
    return F.greatest(box["max_x"] - box["min_x"], box["max_y"] - box["min_y"])


def _along(lat: pd.Series, degrees: pd.Series) -> pd.Series:
    """Vincenty's inverse for two points of one latitude, ``degrees`` of longitude apart, on whole columns."""
    phi, dl = lat.to_numpy(np.float64, na_value=np.nan), degrees.to_numpy(np.float64, na_value=np.nan)
    out = np.where(np.isnan(phi) | np.isnan(dl), np.nan, 0.0)
    rows = np.flatnonzero((np.abs(phi) < 90) & (dl != 0) & ~np.isnan(dl))
    b, e2 = MAJOR * (1 - FLATTENING), 1 / (1 - FLATTENING) ** 2 - 1
    u, want = np.arctan((1 - FLATTENING) * np.tan(np.radians(phi[rows]))), np.radians(dl[rows])
    su, cu, lam = np.sin(u), np.cos(u), want
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(cu * sl, cu * su - su * cu * cl)
            cos_s = su * su + cu * cu * cl
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s != 0, cu * cu * sl / sin_s, 0.0)
            cos2 = 1 - sin_a * sin_a
            mid = np.where(cos2 != 0, cos_s - 2 * su * su / cos2, 0.0)
            c = FLATTENING / 16 * cos2 * (4 + FLATTENING * (4 - 3 * cos2))
            old, lam = lam, want + (1 - c) * FLATTENING * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid * mid - 1)))
            if not (np.abs(lam - old) >= 1e-13).any():
                break
        k = cos2 * e2
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        turn = small * sin_s * (mid + small / 4 * (cos_s * (2 * mid * mid - 1) - small / 6 * mid * (4 * sin_s * sin_s - 3) * (4 * mid * mid - 3)))
        out[rows] = np.where(sin_s != 0, b * big * (sigma - turn), 0.0)
    return pd.Series(out)


def geodesic(lat: Column, degrees: Column) -> Column:
    """Metres along the WGS84 ellipsoid between (lon, lat) and (lon + degrees, lat)."""
    return F.pandas_udf(_along, "double")(lat, degrees)


def _line(points: pa.Array) -> pa.Array:
    n, flat = points.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), points.flatten()
    xy = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("lon", "lat")], axis=1).astype("<f8").view(np.uint8)
    head = np.where(n > 1, 9, 5) * (n > 0)
    end = np.cumsum(head + 16 * n)
    begin = end - head - 16 * n
    out = np.zeros(end[-1] if len(end) else 0, np.uint8)
    some, several = begin[n > 0], n > 1
    out[some], out[some + 1] = 1, np.where(several, 2, 1)[n > 0]
    out[begin[several][:, None] + np.arange(5, 9)] = n[several].astype("<u4").view(np.uint8).reshape(-1, 4)
    at = np.repeat(begin + head - 16 * (np.cumsum(n) - n), n) + 16 * np.arange(len(xy))
    out[at[:, None] + np.arange(16)] = xy.reshape(-1, 16)
    none = pa.array(n > 0)
    return pa.Array.from_buffers(pa.large_binary(), len(n), [none.buffers()[1], pa.py_buffer(np.concatenate([[0], end]).astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())


def line_wkb(points: Column) -> Column:
    """Little-endian WKB: a line string, or a point for one point; null without any."""
    return F.arrow_udf(_line, "binary")(points)


def _box(x0: pd.Series, x1: pd.Series, y0: pd.Series, y1: pd.Series) -> pd.Series:
    return pd.Series([struct.pack("<BIII10d", 1, 3, 1, 5, a, c, a, d, b, d, b, c, a, c) for a, b, c, d in zip(x0, x1, y0, y1, strict=True)], dtype=object)


def box_wkb(box: Column) -> Column:
    """The bounding box as a WKB polygon, from its lower left corner upward and around."""
    return F.pandas_udf(_box, "binary")(box["min_x"], box["max_x"], box["min_y"], box["max_y"])


def smallest_circle(points: list[tuple[float, float]]) -> tuple[float, float, float]:
    """(x, y, radius) of the smallest circle around the points: incremental, expected linear time."""
    ps = sorted(set(points))
    order = sorted(range(len(ps)), key=lambda i: (i * 2654435761) & 0xFFFFFFFF)
    ps = [ps[i] for i in order]

    def two(a: tuple, b: tuple) -> tuple[float, float, float]:
        return (a[0] + b[0]) / 2, (a[1] + b[1]) / 2, math.dist(a, b) / 2

    def three(a: tuple, b: tuple, c: tuple) -> tuple[float, float, float]:
        bx, by, cx, cy = b[0] - a[0], b[1] - a[1], c[0] - a[0], c[1] - a[1]
        d = 2 * (bx * cy - by * cx)
        if not d:
            return max((two(p, q) for p, q in ((a, b), (a, c), (b, c))), key=lambda r: r[2])
        x, y = (cy * (bx * bx + by * by) - by * (cx * cx + cy * cy)) / d, (bx * (cx * cx + cy * cy) - cx * (bx * bx + by * by)) / d
        return a[0] + x, a[1] + y, math.hypot(x, y)

    def holds(c: tuple, p: tuple) -> bool:
        return math.dist(c[:2], p) <= c[2] * (1 + 1e-12) + 1e-15

    circle = (*ps[0], 0.0)
    for i, p in enumerate(ps):
        if not holds(circle, p):
            circle = (*p, 0.0)
            for j, q in enumerate(ps[:i]):
                if not holds(circle, q):
                    circle = two(p, q)
                    for r in ps[:j]:
                        if not holds(circle, r):
                            circle = three(p, q, r)
    return circle


def _circle(points: pa.Array) -> pa.Array:
    n, flat = points.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), points.flatten()
    xy = np.stack([flat.field(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("lon", "lat")], axis=1)
    ok, at, out = np.isfinite(xy).all(axis=1).tolist(), 0, []
    places = list(map(tuple, xy.tolist()))
    for m in n.tolist():
        own = [p for p, has in zip(places[at : at + m], ok[at : at + m], strict=True) if has]
        out.append(smallest_circle(own) if own else (math.nan,) * 3)
        at += m
    found = np.array(out, np.float64).reshape(-1, 3)
    return pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], ["lon", "lat", "radius"])


def bounding_circle(points: Column) -> Column:
    """struct<lon, lat, radius> of the smallest circle around the points that have a place; NaN without any."""
    return F.arrow_udf(_circle, "lon double, lat double, radius double")(points)
