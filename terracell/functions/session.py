"""Functions of a session for SQL: native ones as SQL functions, kernels as Arrow ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import geometry, grid, keys, shapes

# Names, arguments and results of the native functions; all are null for null.
NATIVE = {
    "to_short_h3_3": ("cell BIGINT", "SMALLINT", "cast(shiftright(shiftleft(shiftrightunsigned(cell, 36), 48), 48) as smallint)"),
    "to_short_h3_8": ("cell BIGINT", "INT", "cast(shiftright(shiftleft(shiftrightunsigned(cell, 20), 32), 32) as int)"),
    "to_full_from_short_h3_3": ("k SMALLINT", "BIGINT", f"shiftleft(cast(k as bigint) & 65535L, 36) | {keys.BASE3}L"),
    "to_full_short_h3_8": ("k INT", "BIGINT", f"shiftleft(cast(k as bigint) & 4294967295L, 20) | {keys.BASE8}L"),
    "to_ha_arrays_text": ("t STRING", "STRING", "replace(t, ',', '|')"),
}


def _cell(lat: pd.Series, lon: pd.Series, res: pd.Series) -> pd.Series:
    out = pd.Series(pd.NA, index=lat.index, dtype="Int64")
    ok = np.isfinite(lat.to_numpy(np.float64, na_value=np.nan)) & np.isfinite(lon.to_numpy(np.float64, na_value=np.nan)) & res.notna().to_numpy()
    for r in res[ok].unique():
        at = ok & (res == r).to_numpy()
        out[at] = grid.indexes(lat[at].to_numpy(np.float64), lon[at].to_numpy(np.float64), int(r))
    return out


def _disk(cell: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(c) or pd.isna(n) else [x for ring in grid.disks(np.array([int(c)]), int(n), (int(c) >> 52) & 15)[0] for x in ring] for c, n in zip(cell, k, strict=True)], index=cell.index, dtype=object)


def _path(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or pd.isna(y) else grid.path(int(x), int(y), (int(x) >> 52) & 15) for x, y in zip(a, b, strict=True)], index=a.index, dtype=object)


def _cover(wkb: pd.Series, res: pd.Series) -> pd.Series:
    out = []
    for w, r in zip(wkb, res, strict=True):
        out.append(None if w is None or pd.isna(r) else sorted({c for rings in shapes.read_wkb(bytes(w))[1] for c in grid.cover([x[:, ::-1] for x in rings], int(r))}))
    return pd.Series(out, index=wkb.index, dtype=object)


def _meet(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else any(shapes.meet(*shapes.read_wkb(bytes(x)), ring) for rings in shapes.read_wkb(bytes(y))[1] for ring in shapes.turned(rings[0])) for x, y in zip(a, b, strict=True)], index=a.index, dtype=object)


KERNELS = {"h3_latlng_to_cell": (_cell, "long"), "h3_grid_disk": (_disk, "array<long>"), "h3_grid_path": (_path, "array<long>"), "h3_polygon_to_cells": (_cover, "array<long>"), "geo_intersects": (_meet, "boolean"), "geo_geodesic_m": (geometry._along, "double")}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL."""
    for name, (arguments, result, body) in NATIVE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, (run, kind) in KERNELS.items():
        spark.udf.register(name, F.pandas_udf(run, kind))

    def circle(wkb: pd.Series) -> pd.DataFrame:
        rows = [(np.nan,) * 3 if w is None else geometry.smallest_circle([tuple(p) for rings in shapes.read_wkb(bytes(w))[1] for r in rings for p in r.tolist()]) for w in wkb]
        return pd.DataFrame(rows, columns=["lon", "lat", "radius"], dtype="float64")

    spark.udf.register("geo_mbc", F.pandas_udf(circle, "lon double, lat double, radius double"))


def geometry_type(wkb: Column, srid: int = 4326) -> Column:
    """WKB as Spark's own geometry type; the session must have spark.sql.geospatial.enabled."""
    return F.call_function("st_setsrid", F.call_function("st_geomfromwkb", wkb), F.lit(srid))


def views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
