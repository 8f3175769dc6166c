"""Hexagonal cells of the sphere: positions to 64-bit indexes, in numpy under an Arrow UDF.

The grid is the public aperture-7 icosahedral one: each of twenty faces is a plane under gnomonic
projection; a position goes to its nearest face, to the nearest lattice point of the resolution
there, and up through the parents, one digit a level. The digits are then turned from the face's
axes to those of the base cell's home face. What each face's base cells are and how far their
digits turn follows from geometry; only the facts that number things are fixed values.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the grid: face centres (latitude, longitude), in radians.
FACES = [
    (0.803582649718989942, 1.248397419617396099), (1.307747883455638156, 2.536945009877921159), (1.054751253523952054, -1.347517358900396623), (0.600191595538186799, -0.450603909469755746),
    (0.491715428198773866, 0.401988202911306943), (0.172745327415618701, 1.678146885280433686), (0.605929321571350690, 2.953923329812411617), (0.427370518328979641, -1.888876200336285401),
    (-0.079066118549212831, -0.733429513380867741), (-0.230961644455383637, 0.506495587332349035), (0.079066118549212831, 2.408163140208925497), (0.230961644455383637, -2.635097066257444203),
    (-0.172745327415618701, -1.463445768309359553), (-0.605929321571350690, -0.187669323777381622), (-0.427370518328979641, 1.252716453253507838), (-0.600191595538186799, 2.690988744120037492),
    (-0.491715428198773866, -2.739604450678486295), (-0.803582649718989942, -1.893195233972397139), (-1.307747883455638156, -0.604647643711872080), (-1.054751253523952054, 1.794075294689396615),
]
# Each face's i axis, as azimuth from its centre; it points to a vertex, so three decimals tell which.
AXES = [5.620, 5.760, 0.780, 0.430, 6.130, 2.693, 2.983, 3.533, 3.494, 3.003, 5.930, 0.138, 0.449, 0.159, 5.892, 2.711, 3.295, 3.805, 3.664, 2.361]
# Home face and (i, j, k) there of each base cell.
HOMES = """
1:100 2:110 1:000 2:100 0:200 1:110 1:001 2:000 0:100 2:010 1:010 1:011 3:100 3:110 11:200 4:100 0:000 6:010 0:001 2:011
7:001 2:001 0:110 6:001 10:200 6:000 3:000 11:100 4:110 3:010 0:011 4:000 5:010 0:010 7:010 11:110 7:000 10:100 12:200 6:101
7:101 4:001 3:001 3:011 4:010 6:100 11:000 8:001 5:001 14:200 5:000 12:100 10:110 4:011 12:110 7:100 11:010 10:000 13:200 10:001
11:001 9:010 8:010 6:200 8:000 9:001 14:100 5:101 16:011 8:101 5:100 12:000 7:200 12:010 10:010 9:000 13:100 16:001 15:011 15:010
16:010 14:110 13:110 5:200 8:100 14:000 9:101 14:001 17:001 12:001 16:000 17:011 15:001 16:101 9:100 15:000 13:000 8:200 13:010 17:101
19:010 14:010 19:011 17:010 13:001 17:000 16:100 9:200 15:101 15:100 18:011 18:001 19:001 17:100 19:000 18:010 18:101 19:200 19:100 18:000
19:101 18:100
"""
# The faces of a pentagon whose digits turn clockwise out of the missing direction.
CLOCKWISE = {14: (2, 6), 24: (1, 5), 38: (3, 7), 49: (0, 9), 58: (4, 8), 63: (11, 15), 72: (12, 16), 83: (10, 19), 97: (13, 17), 107: (14, 18)}
# Half the way from a face's centre to its vertex in the plane; turn between resolutions.
UNIT, TURN = 0.38196601125010500003, 0.333473172251832115336090755351601070065900389

# Directions counter-clockwise from the i axis, as digits: i, ij, j, jk, k, ik.
_AROUND = np.array([4, 6, 2, 3, 1, 5])
_LEFT = np.array([0, *(_AROUND[(list(_AROUND).index(d) + 1) % 6] for d in range(1, 7))])
_RIGHT = np.array([0, *(_AROUND[(list(_AROUND).index(d) - 1) % 6] for d in range(1, 7))])
_DIGIT = np.full((3, 3), 0)  # by step along i and along j, each plus 1
for _step, _d in (((-1, -1), 1), ((0, 1), 2), ((-1, 0), 3), ((1, 0), 4), ((0, -1), 5), ((1, 1), 6)):
    _DIGIT[_step[0] + 1, _step[1] + 1] = _d
_MISSING = 1


def _xyz(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=-1)


def _azimuth(lat: np.ndarray, lon: np.ndarray, to_lat: np.ndarray, to_lon: np.ndarray) -> np.ndarray:
    return np.arctan2(np.cos(to_lat) * np.sin(to_lon - lon), np.cos(lat) * np.sin(to_lat) - np.sin(lat) * np.cos(to_lat) * np.cos(to_lon - lon))


def _latlon(p: np.ndarray) -> tuple[float, float]:
    return float(np.arcsin(np.clip(p[2] / np.linalg.norm(p), -1, 1))), float(np.arctan2(p[1], p[0]))


class _Grid:
    """What follows from the fixed values, computed once in a process."""

    def __init__(self) -> None:
        self.lat, self.lon = (np.array(c) for c in zip(*FACES, strict=True))
        self.centres = _xyz(self.lat, self.lon)
        self.axis = np.array([self._to_vertex(f) for f in range(len(FACES))])
        homes = [(int(f), tuple(map(int, ijk))) for f, ijk in (x.split(":") for x in HOMES.split())]
        self.cells = np.array([self.place(f, *self._plane(ijk)) for f, ijk in homes])
        self.pentagon = np.array([ijk == (2, 0, 0) for _, ijk in homes])
        self.base = np.zeros((len(FACES), 27), np.int64)
        self.turns = np.zeros((len(FACES), 27), np.int64)
        self.clockwise = np.zeros((len(FACES), len(homes)), bool)
        for cell, faces in CLOCKWISE.items():
            self.clockwise[list(faces), cell] = True
        for f in range(len(FACES)):
            for n in range(27):
                ijk = (n // 9, n // 3 % 3, n % 3)
                if min(ijk):
                    continue
                cell = int((self.cells @ self.place(f, *self._plane(ijk))).argmax())
                self.base[f, n] = cell
                self.turns[f, n] = self._sector(f, ijk, cell, homes) if self.pentagon[cell] else self._turned(f, ijk, *homes[cell])

    def _to_vertex(self, f: int) -> float:
        near = np.flatnonzero(self.centres @ self.centres[f] > 0.3)  # the face and those that share an edge or vertex
        best = None
        for a in near:
            for b in near:
                if len({int(a), int(b), f}) == 3:
                    five = np.linalg.solve(self.centres[[f, a, b]], np.ones(3)) if abs(np.linalg.det(self.centres[[f, a, b]])) > 1e-6 else None
                    # a vertex is as far from five faces, and these are its nearest
                    if five is not None and np.isclose(self.centres @ five, 1, atol=1e-9).sum() == 5 and (self.centres @ five).max() < 1 + 1e-9:
                        az = float(_azimuth(self.lat[f], self.lon[f], *_latlon(five)))
                        off = abs((az - AXES[f] + np.pi) % (2 * np.pi) - np.pi)
                        best = min(best or (9.0, 0.0), (off, az))
        if best is None or best[0] > 0.01:
            raise ValueError(f"no vertex along the axis of face {f}")
        return best[1]

    @staticmethod
    def _plane(ijk: tuple[float, ...]) -> tuple[float, float]:
        i, j = ijk[0] - ijk[2], ijk[1] - ijk[2]
        return i - j / 2, j * np.sqrt(3) / 2

    def place(self, f: int, x: float, y: float) -> np.ndarray:
        """The point of the sphere at (x, y) of a face's plane, in units of its lattice."""
        r, az = np.arctan(np.hypot(x, y) * UNIT), self.axis[f] - np.arctan2(y, x)
        lat = np.arcsin(np.clip(np.sin(self.lat[f]) * np.cos(r) + np.cos(self.lat[f]) * np.sin(r) * np.cos(az), -1, 1))
        lon = self.lon[f] + np.arctan2(np.sin(az) * np.sin(r) * np.cos(self.lat[f]), np.cos(r) - np.sin(self.lat[f]) * np.sin(lat))
        return _xyz(lat, lon)

    def _bearing(self, f: int, ijk: tuple[float, ...], step: tuple[float, ...]) -> float:
        at, to = self.place(f, *self._plane(ijk)), self.place(f, *self._plane(tuple(a + 1e-4 * b for a, b in zip(ijk, step, strict=True))))
        return float(_azimuth(*_latlon(at), *_latlon(to)))

    def _turned(self, f: int, ijk: tuple[int, ...], home: int, home_ijk: tuple[int, ...]) -> int:
        along = (1, 0, 0)
        return round((self._bearing(home, home_ijk, along) - self._bearing(f, ijk, along)) / (np.pi / 3)) % 6

    def _sector(self, f: int, ijk: tuple[int, ...], cell: int, homes: list) -> int:
        """Turns for a pentagon: faces lie around it in five sectors, one present direction in each."""
        inward = lambda at: tuple(-a for a in at)
        home, home_ijk = homes[cell]
        sector = round((self._bearing(home, home_ijk, inward(home_ijk)) - self._bearing(f, ijk, inward(ijk))) / (2 * np.pi / 5)) % 5
        first = {(2, 0, 0): 0, (0, 2, 0): 1, (0, 0, 2): 3}.get(ijk, 0)  # where jk, ik, ij come in jk, ik, i, ij, j
        return (sector - first) % 5


@cache
def _grid() -> _Grid:
    return _Grid()


def _lead(digits: np.ndarray) -> np.ndarray:
    some = digits != 0
    return np.where(some.any(axis=0), np.take_along_axis(digits, some.argmax(axis=0)[None], axis=0)[0], 0) if len(digits) else np.zeros(digits.shape[1], np.int64)


def indexes(lat: np.ndarray, lon: np.ndarray, res: int) -> np.ndarray:
    """Cell indexes of positions in degrees, all finite."""
    g = _grid()
    a, o = np.radians(lat), np.radians(lon)
    face = (_xyz(a, o) @ g.centres.T).argmax(axis=1)
    cos = np.clip((_xyz(a, o) * g.centres[face]).sum(axis=1), -1, 1)
    # near the centre the sine tells the angle, by the chord, better than the cosine
    chord = np.linalg.norm(_xyz(a, o) - g.centres[face], axis=1)
    r = chord * np.sqrt(np.maximum(0, 1 - chord * chord / 4)) / cos / UNIT * np.sqrt(7.0) ** res
    theta = g.axis[face] - _azimuth(g.lat[face], g.lon[face], a, o) - (TURN if res % 2 else 0)
    x, y = r * np.cos(theta), r * np.sin(theta)
    q, s = x - y / np.sqrt(3), y / (np.sqrt(3) / 2)  # along i, and along i + j
    rq, rs, rt = np.rint(q), np.rint(s), np.rint(-q - s)
    dq, ds, dt = abs(rq - q), abs(rs - s), abs(rt + q + s)
    rq, rs = np.where((dq > ds) & (dq > dt), -rs - rt, rq), np.where((ds >= dq) & (ds > dt), -rq - rt, rs)
    i, j = (rq + rs).astype(np.int64), rs.astype(np.int64)
    digits = np.zeros((res, len(face)), np.int64)
    for level in range(res, 0, -1):
        m = ((3, -1), (1, 2)) if level % 2 else ((2, 1), (-1, 3))
        up_i, up_j = (np.rint((row[0] * i + row[1] * j) / 7).astype(np.int64) for row in m)
        down_i, down_j = m[1][1] * up_i - m[0][1] * up_j, m[0][0] * up_j - m[1][0] * up_i
        digits[level - 1] = _DIGIT[i - down_i + 1, j - down_j + 1]
        i, j = up_i, up_j
    low = np.minimum(np.minimum(i, j), 0)
    at = np.clip(i - low, 0, 2) * 9 + np.clip(j - low, 0, 2) * 3 + np.clip(-low, 0, 2)
    base, turns = g.base[face, at], g.turns[face, at]
    five = g.pentagon[base]
    missing = five & (_lead(digits) == _MISSING)
    digits = np.where(missing, np.where(g.clockwise[face, base], _RIGHT[digits], _LEFT[digits]), digits)
    for n in range(5):
        digits = np.where(turns > n, _LEFT[digits], digits)
        digits = np.where((turns > n) & five & (_lead(digits) == _MISSING), _LEFT[digits], digits)
    out = np.full(len(face), (1 << 59) | (res << 52) | ((1 << (45 - 3 * res)) - 1), np.int64) | (base << 45)
    for level in range(1, res + 1):
        out |= digits[level - 1] << (45 - 3 * level)
    return out


def cell_of(lat: Column, lon: Column, res: int) -> Column:
    """The index of the cell of resolution ``res`` (0 to 15) that holds a position in degrees; null where either is null or not finite."""
    if not 0 <= res <= 15:
        raise ValueError("resolutions are 0 to 15")

    @F.pandas_udf("long")
    def run(a: pd.Series, o: pd.Series) -> pd.Series:
        ok = np.isfinite(a.to_numpy(np.float64, na_value=np.nan)) & np.isfinite(o.to_numpy(np.float64, na_value=np.nan))
        out = pd.Series(pd.NA, index=a.index, dtype="Int64")
        if ok.any():
            out[ok] = indexes(a[ok].to_numpy(np.float64), o[ok].to_numpy(np.float64), res)
        return out

    return run(lat.cast("double"), lon.cast("double"))


def cells_of(lats: Column, lons: Column, res: int) -> Column:
    """array<long>: the cells of resolution ``res`` that hold positions given as two arrays; null for positions that are not finite."""

    @F.pandas_udf("array<long>")
    def run(a: pd.Series, o: pd.Series) -> pd.Series:
        sizes = [0 if x is None else len(x) for x in a]
        flat = [np.concatenate([np.zeros(0), *(np.asarray(x, np.float64) for x in c if x is not None)]) for c in (a, o)]
        ok = np.isfinite(flat[0]) & np.isfinite(flat[1])
        cells = np.full(len(ok), -1, np.int64)
        if ok.any():
            cells[ok] = indexes(flat[0][ok], flat[1][ok], res)
        parts = np.split(cells, np.cumsum(sizes)[:-1]) if len(sizes) else []
        return pd.Series([None if x is None else [c if c >= 0 else None for c in p.tolist()] for x, p in zip(a, parts, strict=True)], index=a.index, dtype=object)

    return run(lats, lons)


# --- from cells to positions ---------------------------------------------------------------
_STEPS = np.array([(0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1)])  # along i and j, by digit
_CORNERS = np.array([(1.0, 0.0), (-0.5, np.sqrt(3) / 2), (-0.5, -np.sqrt(3) / 2)])


@cache
def _faces() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Corners of each face, the corner across each edge, and for each base cell its faces, planes (i, j) and turns there; -1 where there is none."""
    g = _grid()
    corners = np.array([[g.place(f, *(2 * c)) for c in _CORNERS] for f in range(len(FACES))])
    across = np.zeros_like(corners)
    for f in range(len(FACES)):
        for c in range(3):
            shared = [corners[f, k] for k in range(3) if k != c]
            for other in range(len(FACES)):
                far = [p for p in corners[other] if not any(np.allclose(p, s, atol=1e-9) for s in shared)]
                if other != f and len(far) == 1:
                    across[f, c] = far[0]
    homes = [(int(f), tuple(map(int, ijk))) for f, ijk in (x.split(":") for x in HOMES.split())]
    face, plane, turns = np.full((len(homes), 5), -1), np.zeros((len(homes), 5, 2), np.int64), np.zeros((len(homes), 5), np.int64)
    for cell, (home, ijk) in enumerate(homes):
        at = [(home, ijk)] if not g.pentagon[cell] else [(f, v) for f in range(len(FACES)) for v in ((2, 0, 0), (0, 2, 0), (0, 0, 2)) if g.base[f, v[0] * 9 + v[1] * 3 + v[2]] == cell]
        for k, (f, v) in enumerate(at):
            face[cell, k], plane[cell, k], turns[cell, k] = f, (v[0] - v[2], v[1] - v[2]), g.turns[f, v[0] * 9 + v[1] * 3 + v[2]]
    return corners, across, face, plane, turns


def _inward(plane: np.ndarray) -> np.ndarray:
    """The digit that leads from a face's corner into it."""
    return _DIGIT[1 - np.sign(plane[..., 0]), 1 - np.sign(plane[..., 1])]


def _lattice(cells: np.ndarray, res: int, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Face, i and j there, and the leading digit in the face's frame, of each cell as seen from its ``choice``-th face."""
    _, _, face, plane, turns = _faces()
    base = (cells >> 45) & 127
    digits = np.stack([(cells >> (45 - 3 * level)) & 7 for level in range(1, res + 1)]) if res else np.zeros((0, len(cells)), np.int64)
    five, back = _grid().pentagon[base], turns[base, choice]
    for n in range(5):
        on = five & (back > n)
        digits = np.where(on, _RIGHT[digits], digits)
        digits = np.where(on & (_lead(digits) == _MISSING), _RIGHT[digits], digits)
    i, j = plane[base, choice].T
    for level in range(1, res + 1):
        m = ((3, -1), (1, 2)) if level % 2 else ((2, 1), (-1, 3))
        step = _STEPS[digits[level - 1]]
        i, j = m[1][1] * i - m[0][1] * j + step[:, 0], m[0][0] * j - m[1][0] * i + step[:, 1]
    return face[base, choice], i, j, _lead(digits)


def _shares(i: np.ndarray, j: np.ndarray, res: int) -> np.ndarray:
    """Lattice points of a face as weights of its three corners."""
    z = (i - j / 2 + 1j * (j * np.sqrt(3) / 2)) / np.sqrt(7.0) ** res * np.exp(1j * (TURN if res % 2 else 0))
    return 1 / 3 + (z.real[:, None] * _CORNERS[:, 0] + z.imag[:, None] * _CORNERS[:, 1]) / 3


def _points(face: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Points of the sphere; what lies beyond an edge unfolds onto the face across it."""
    corners, across, *_ = _faces()
    out = share.argmin(axis=1)
    over = share[np.arange(len(out)), out]
    vertices, weight = corners[face].copy(), share.copy()
    rows = np.flatnonzero(over < 0)
    weight[rows] += over[rows, None]
    weight[rows, out[rows]] = -over[rows]
    vertices[rows, out[rows]] = across[face[rows], out[rows]]
    p = (weight[:, :, None] * vertices).sum(axis=1)
    return p / np.linalg.norm(p, axis=1, keepdims=True)


def _degrees(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.degrees(np.arctan2(p[:, 2], np.hypot(p[:, 0], p[:, 1]))), np.degrees(np.arctan2(p[:, 1], p[:, 0]))


def _seen_from(cells: np.ndarray, res: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Face, i, j of each cell on a face where its own part of the base cell lies."""
    _, _, _, plane, _ = _faces()
    base = (cells >> 45) & 127
    chosen = np.zeros(len(cells), np.int64)
    face, i, j, lead = _lattice(cells, res, chosen)
    for k in range(1, 5):
        rows = np.flatnonzero(_grid().pentagon[base] & (lead != 0) & (lead != _inward(plane[base, chosen])))
        chosen[rows] = k
        face[rows], i[rows], j[rows], lead[rows] = _lattice(cells[rows], res, chosen[rows])
    return face, i, j


def centres(cells: np.ndarray, res: int) -> tuple[np.ndarray, np.ndarray]:
    """Latitudes and longitudes, in degrees, of the centres of cells of one resolution."""
    face, i, j = _seen_from(cells, res)
    return _degrees(_points(face, _shares(i, j, res)))


def neighbours(cells: np.ndarray, res: int) -> np.ndarray:
    """(len(cells), 6) cells that share an edge; -1 in a pentagon's sixth place."""
    face, i, j = _seen_from(cells, res)
    out = np.stack([indexes(*_degrees(_points(face, _shares(i + a, j + b, res))), res) for a, b in _STEPS[1:]], axis=1)
    base, below = (cells >> 45) & 127, (1 << 45) - 1
    centre = ((1 << 45) - 1) >> (3 * res)
    for row in np.flatnonzero(_grid().pentagon[base] & ((cells & below) == centre)):
        around = set()
        for k in range(5):
            f, a, b, _ = _lattice(cells[[row]], res, np.array([k]))
            share = _shares(a + _STEPS[1:, 0], b + _STEPS[1:, 1], res)
            own = share.min(axis=1) >= -1e-9
            around |= set(indexes(*_degrees(_points(np.repeat(f, own.sum()), share[own])), res).tolist())
        out[row] = [*sorted(around), *[-1] * 6][:6]
    return out


def disks(cells: np.ndarray, k: int, res: int) -> list[list[list[int]]]:
    """For each of ``cells``, the cells at 0, 1, ... ``k`` steps from it, each ring in order."""
    rings = [pd.DataFrame({"row": np.arange(len(cells)), "cell": cells})]
    for _ in range(k):
        last = rings[-1]
        new = pd.DataFrame({"row": np.repeat(last["row"].to_numpy(), 6), "cell": neighbours(last["cell"].to_numpy(), res).ravel()})
        known = pd.concat([new[new["cell"] >= 0].drop_duplicates(), *rings[-2:], *rings[-2:]])  # a step leads no further back than one ring
        rings.append(known.drop_duplicates(keep=False).sort_values(["row", "cell"]))
    found = [r.groupby("row")["cell"].agg(list).reindex(range(len(cells))) for r in rings]
    return [[x if isinstance(x, list) else [] for x in row] for row in zip(*found, strict=True)]


def resolution(cell: Column) -> Column:
    return F.shiftrightunsigned(cell, 52).bitwiseAND(15).cast("int")


def centre_of(cell: Column, res: int) -> Column:
    """struct<lat, lon> in degrees of the centre of a cell of resolution ``res``; null for null."""

    @F.pandas_udf("lat double, lon double")
    def run(cells: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame(np.nan, index=cells.index, columns=["lat", "lon"])
        ok = cells.notna()
        if ok.any():
            out.loc[ok, "lat"], out.loc[ok, "lon"] = centres(cells[ok].to_numpy(np.int64), res)
        return out

    return F.when(cell.isNotNull(), run(F.coalesce(cell, F.lit(0x0800000000000000 | res << 52 | (1 << (45 - 3 * res)) - 1))))


def rings_of(cell: Column, k: int, res: int) -> Column:
    """array<array<long>>: the cells at 0 to ``k`` steps from a cell of resolution ``res``; null for null."""

    @F.pandas_udf("array<array<long>>")
    def run(cells: pd.Series) -> pd.Series:
        out, ok = pd.Series([None] * len(cells), index=cells.index, dtype=object), cells.notna().to_numpy()
        if ok.any():
            out[ok] = pd.Series(disks(cells[ok].to_numpy(np.int64), k, res), index=cells.index[ok], dtype=object)
        return out

    return run(cell)


# --- boundaries, paths, covers --------------------------------------------------------------
_VERTICES = np.array([(2, 1), (1, 2), (-1, 1), (-2, -1), (-1, -2), (1, -1)]) / 3  # along i and j, counter-clockwise


def boundaries(cells: np.ndarray, res: int) -> list[np.ndarray]:
    """Corners (latitude, longitude) of each cell in order around it, six or a pentagon's five.

    A corner beyond a face's edge unfolds onto the next face; where an edge of a cell crosses an edge of the
    icosahedron no corner is added.
    """
    face, i, j = _seen_from(cells, res)
    corners = np.stack([np.stack(_degrees(_points(face, _shares(i + a, j + b, res))), axis=1) for a, b in _VERTICES], axis=1)
    out = list(corners)
    around = neighbours(cells, res)
    for row in np.flatnonzero((around < 0).any(axis=1)):  # pentagons: between the centre and each two neighbours side by side
        near = around[row][around[row] >= 0]
        own, others = _xyz(*map(np.radians, centres(cells[[row]], res)))[0], _xyz(*map(np.radians, centres(near, res)))
        east = np.cross([0.0, 0.0, 1.0], own)
        north = np.cross(own, east)
        order = np.argsort(np.arctan2(others @ north, others @ east))
        middle = own + others[order] + np.roll(others[order], -1, axis=0)
        out[row] = np.stack(_degrees(middle / np.linalg.norm(middle, axis=1, keepdims=True)), axis=1)
    return out


def _on_face(face: np.ndarray, lat: np.ndarray, lon: np.ndarray, res: int) -> tuple[np.ndarray, np.ndarray]:
    """Fractional i, j of positions in degrees on given faces, which need not be the nearest."""
    g = _grid()
    p = _xyz(np.radians(lat), np.radians(lon))
    cos = (p * g.centres[face]).sum(axis=1)
    r = np.sqrt(np.maximum(0, 1 - cos * cos)) / np.maximum(cos, 1e-9) / UNIT * np.sqrt(7.0) ** res
    theta = g.axis[face] - _azimuth(g.lat[face], g.lon[face], np.radians(lat), np.radians(lon)) - (TURN if res % 2 else 0)
    x, y = r * np.cos(theta), r * np.sin(theta)
    return x + y / np.sqrt(3), y / (np.sqrt(3) / 2)


def _nearest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lattice points nearest to fractional ones (axes at 120 degrees)."""
    q, s = i - j, j
    t = -q - s
    rq, rs, rt = np.rint(q), np.rint(s), np.rint(t)
    dq, ds, dt = abs(rq - q), abs(rs - s), abs(rt - t)
    rq, rs = np.where((dq > ds) & (dq > dt), -rs - rt, rq), np.where((ds >= dq) & (ds > dt), -rq - rt, rs)
    return (rq + rs).astype(np.int64), rs.astype(np.int64)


def paths(a: np.ndarray, b: np.ndarray, res: int) -> list[list[int]]:
    """For each pair the cells from ``a`` to ``b``, both included, along the line between them on the face of ``a``.

    Over an edge of that face, or past a pentagon, steps may skip a cell; cells that are the same give one.
    """
    if not len(a):
        return []
    face, i, j = _seen_from(a, res)
    x, y = _nearest(*_on_face(face, *centres(b, res), res))
    di, dj = x - i, y - j
    n = np.where(a == b, 0, np.maximum(np.maximum(abs(di), abs(dj)), abs(di - dj)))
    between = np.maximum(n - 1, 0)
    row, end = np.repeat(np.arange(len(a)), between), np.cumsum(between)
    t = (np.arange(len(row)) - (end - between)[row] + 1) / np.maximum(n[row], 1)
    at = _nearest(i[row] + di[row] * t + 1e-6, j[row] + dj[row] * t + 2e-6)
    cells = indexes(*_degrees(_points(face[row], _shares(*at, res))), res).tolist() if len(row) else []
    return [list(dict.fromkeys([x, *cells[e - k : e], y])) for x, y, k, e in zip(a.tolist(), b.tolist(), between.tolist(), end.tolist(), strict=True)]


def path(a: int, b: int, res: int) -> list[int]:
    return paths(np.array([a]), np.array([b]), res)[0]


def inside(lat: np.ndarray, lon: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Which positions lie in the plane polygon of rings (latitude, longitude), by the even-odd rule."""
    hit = np.zeros(len(lat), bool)
    for ring in rings:
        a, b = ring, np.roll(ring, -1, axis=0)
        for (y0, x0), (y1, x1) in zip(a, b, strict=True):
            if y0 != y1:
                hit ^= ((y0 > lat) != (y1 > lat)) & (lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0)
    return hit


def cover(rings: list[np.ndarray], res: int) -> list[int]:
    """Cells whose centres lie in the plane polygon of rings (latitude, longitude), the first ring around the others.

    Candidates are the lattice points of the face of the polygon's middle between its corners'
    and two steps around.
    """
    outer = rings[0]
    middle = (outer.min(axis=0) + outer.max(axis=0)) / 2
    face = (_xyz(*np.radians(middle))[None] @ _grid().centres.T).argmax(axis=1)
    i, j = _on_face(np.repeat(face, len(outer)), outer[:, 0], outer[:, 1], res)
    found: list[int] = []
    columns = np.arange(int(np.floor(j.min())) - 2, int(np.ceil(j.max())) + 3)
    for row in range(int(np.floor(i.min())) - 2, int(np.ceil(i.max())) + 3):  # a row of the lattice at a time
        p = _points(np.repeat(face, len(columns)), _shares(np.full(len(columns), row), columns, res))
        lat, lon = _degrees(p)
        ok = inside(lat, lon, rings)
        if ok.any():
            cells = np.unique(indexes(lat[ok], lon[ok], res))
            ok = inside(*centres(cells, res), rings)
            found += cells[ok].tolist()
    return sorted(set(found))


_TOGETHER = 200_000  # candidates of polygons that are looked at in one go


def covers(polygons: list[list[np.ndarray]], res: int) -> list[list[int]]:
    """``cover`` of many polygons, small ones together."""
    out: list[list[int] | None] = [None] * len(polygons)
    held: list[tuple[int, int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if not held:
            return
        face = np.concatenate([np.full(len(i), f) for _, f, i, _ in held])
        lat, lon = _degrees(_points(face, _shares(np.concatenate([i for _, _, i, _ in held]), np.concatenate([j for _, _, _, j in held]), res)))
        edges = np.cumsum([0, *(len(i) for _, _, i, _ in held)])
        ok = np.concatenate([inside(lat[x:y], lon[x:y], polygons[k]) for (k, *_), x, y in zip(held, edges, edges[1:], strict=False)])
        which = np.repeat([k for k, *_ in held], np.diff(edges))[ok]
        found = pd.DataFrame({"k": which, "cell": indexes(lat[ok], lon[ok], res) if ok.any() else np.zeros(0, np.int64)}).drop_duplicates()
        if len(found):
            found["lat"], found["lon"] = centres(found["cell"].to_numpy(), res)
        groups = {k: rows for k, rows in found.groupby("k")}
        for k, *_ in held:
            rows = groups.get(k)
            out[k] = [] if rows is None else sorted(rows["cell"].to_numpy()[inside(rows["lat"].to_numpy(), rows["lon"].to_numpy(), polygons[k])].tolist())
        held.clear()

    size = 0
    for k, rings in enumerate(polygons):
        outer = rings[0]
        face = int((_xyz(*np.radians((outer.min(axis=0) + outer.max(axis=0)) / 2)) @ _grid().centres.T).argmax())
        i, j = _on_face(np.full(len(outer), face), outer[:, 0], outer[:, 1], res)
        spans = [np.arange(int(np.floor(v.min())) - 2, int(np.ceil(v.max())) + 3) for v in (i, j)]
        if len(spans[0]) * len(spans[1]) > _TOGETHER:
            out[k] = cover(rings, res)
            continue
        held.append((k, face, np.repeat(spans[0], len(spans[1])), np.tile(spans[1], len(spans[0]))))
        size += len(held[-1][2])
        if size > _TOGETHER:
            flush()
            size = 0
    flush()
    return out  # type: ignore[return-value]


def boundary_of(cell: Column, res: int) -> Column:
    """array<struct<lat, lon>>: the corners of a cell of resolution ``res``; null for null."""

    @F.pandas_udf("array<struct<lat: double, lon: double>>")
    def run(cells: pd.Series) -> pd.Series:
        out, ok = pd.Series([None] * len(cells), index=cells.index, dtype=object), cells.notna().to_numpy()
        if ok.any():
            out[ok] = pd.Series([[{"lat": a, "lon": o} for a, o in ring.tolist()] for ring in boundaries(cells[ok].to_numpy(np.int64), res)], index=cells.index[ok], dtype=object)
        return out

    return run(cell)


def path_of(a: Column, b: Column, res: int) -> Column:
    """array<long>: the cells on the line between two cells; null where either is."""

    @F.pandas_udf("array<long>")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out, ok = pd.Series([None] * len(x), index=x.index, dtype=object), (x.notna() & y.notna()).to_numpy()
        if ok.any():
            out[ok] = pd.Series(paths(x[ok].to_numpy(np.int64), y[ok].to_numpy(np.int64), res), index=x.index[ok], dtype=object)
        return out

    return run(a, b)


def regions_of(points: Column, lat: Column, lon: Column, metres: Column, closed: Column, res: int = 8, most: float = 3000.0) -> Column:
    """array<long>: the cells that a way touches, of ways below ``most`` metres with a point outside the centre's cell.

    Cells of the points, of the lines between them and, for closed ways, of the area inside. Null where the way is
    large, lies in the centre's cell, or touches only that.
    """

    @F.pandas_udf("array<long>")
    def run(ps: pd.Series, a: pd.Series, o: pd.Series, m: pd.Series, c: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(ps), index=ps.index, dtype=object)
        want = [k for k in range(len(ps)) if ps.iloc[k] is not None and len(ps.iloc[k]) and np.isfinite(a.iloc[k]) and np.isfinite(o.iloc[k]) and m.iloc[k] < most]
        if not want:
            return out
        sizes = [len(ps.iloc[k]) for k in want]
        flat = np.array([(p["lat"], p["lon"]) for k in want for p in ps.iloc[k]], np.float64)
        cells, at = indexes(flat[:, 0], flat[:, 1], res), 0
        middle = indexes(a.iloc[want].to_numpy(np.float64), o.iloc[want].to_numpy(np.float64), res)
        found: dict[int, set[int]] = {}
        pairs, rings = [], []
        for k, n, centre in zip(want, sizes, middle.tolist(), strict=True):
            own, ring = cells[at : at + n].tolist(), flat[at : at + n]
            at += n
            if all(x == centre for x in own):
                continue
            found[k] = set(own)
            pairs += [(k, x, y) for x, y in dict.fromkeys(zip(own, own[1:], strict=False)) if x != y]
            if c.iloc[k]:
                rings.append((k, [ring]))
        of, x, y = (np.array(v, np.int64) for v in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
        for k, more in zip(of.tolist(), paths(x, y, res), strict=True):
            found[k] |= set(more)
        for (k, _), more in zip(rings, covers([r for _, r in rings], res), strict=True):
            found[k] |= set(more)
        centre_of_ = dict(zip(want, middle.tolist(), strict=True))
        for k, x in found.items():
            if x != {centre_of_[k]}:
                out.iloc[k] = sorted(x)
        return out

    return run(points, lat, lon, metres, closed)
