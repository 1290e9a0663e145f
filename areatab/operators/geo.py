"""Spatial column operators for area geometry.

Reprojection, bounding boxes and web-map tile assignment are closed-form
math on columns and stay in the JVM, rings included (higher-order functions).
Only reading and writing WKB needs Python: Arrow-batched ``pandas_udf``s that
read each ring's coordinates with one numpy view of its bytes.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: WGS84 / Web Mercator sphere radius (EPSG:3857), metres.
EARTH_RADIUS = 6378137.0
# Latitude limit of the square Web Mercator world (tiles cover +-this).
MAX_LAT = 85.0511287798066
MAX_ZOOM = 10


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mercator_to_lonlat(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    """EPSG:3857 metres -> EPSG:4326 degrees."""
    lon = F.degrees(_c(x) / F.lit(EARTH_RADIUS))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(_c(y) / F.lit(EARTH_RADIUS))) - F.lit(3.141592653589793 / 2))
    return lon, lat


def lonlat_to_mercator(lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
    """EPSG:4326 degrees -> EPSG:3857 metres."""
    x = F.lit(EARTH_RADIUS) * F.radians(_c(lon))
    y = F.lit(EARTH_RADIUS) * F.ln(F.tan(F.lit(3.141592653589793 / 4) + F.radians(_c(lat)) / F.lit(2.0)))
    return x, y


def reproject(df: DataFrame, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add ``lon``/``lat`` columns computed from Web Mercator ``x``/``y``."""
    lo, la = mercator_to_lonlat(x, y)
    return df.withColumns({lon: lo, lat: la})


def bbox(df: DataFrame, by: list[str] | None = None, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Bounding box, overall or per group."""
    aggs = [
        F.min(lon).alias("min_lon"),
        F.min(lat).alias("min_lat"),
        F.max(lon).alias("max_lon"),
        F.max(lat).alias("max_lat"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def tile_xy(lon: Column | str, lat: Column | str, z: Column | str) -> tuple[Column, Column]:
    """Slippy-map tile of a point at zoom ``z`` (clamped to the tile grid)."""
    n = F.pow(F.lit(2.0), _c(z))
    lat_c = F.greatest(F.least(_c(lat), F.lit(MAX_LAT)), F.lit(-MAX_LAT))
    lat_r = F.radians(lat_c)
    tx = F.floor((_c(lon) + F.lit(180.0)) / F.lit(360.0) * n)
    ty = F.floor((F.lit(1.0) - F.ln(F.tan(lat_r) + F.lit(1.0) / F.cos(lat_r)) / F.lit(3.141592653589793)) / F.lit(2.0) * n)
    top = n.cast("long") - F.lit(1)
    clamp = lambda v: F.least(F.greatest(v.cast("long"), F.lit(0).cast("long")), top)
    return clamp(tx), clamp(ty)


def tile_counts(df: DataFrame, lon: str = "lon", lat: str = "lat", min_zoom: int = 0, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """Features per tile for every zoom level: ``(z, tx, ty, n)``.

    Points are counted once, on the finest level; a coarser tile is the finest
    one's with its last bits dropped (the grid doubles exactly), so the levels
    above are sums over tiles, not over points. Partial aggregation collapses
    the few, very hot tiles of the low levels map side.
    """
    tx, ty = tile_xy(lon, lat, F.lit(max_zoom))
    finest = df.select(tx.alias("_tx"), ty.alias("_ty")).groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("_n"))
    levels = finest.select("*", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom))).alias("z"))
    up = lambda c: F.expr(f"shiftright({c}, {max_zoom} - z)")
    tiles = levels.select("z", up("_tx").alias("tx"), up("_ty").alias("ty"), "_n")
    return tiles.groupBy("z", "tx", "ty").agg(F.sum("_n").alias("n"))


# --------------------------------------------------------------------------
# WKB
# --------------------------------------------------------------------------

POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS_TYPE = T.ArrayType(T.ArrayType(POINT_TYPE))
# ``part`` tells which part (polygon, line, point) each ring belongs to; the
# first ring of a polygon's part is its outer one, the others are holes
GEOM_TYPE = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("rings", RINGS_TYPE),
    T.StructField("part", T.ArrayType(T.IntegerType())), T.StructField("srid", T.IntegerType()),
])

_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
# Flag bits of extended WKB.
_HAS_Z, _HAS_M, _HAS_SRID = 0x80000000, 0x40000000, 0x20000000


def _parse(buf: bytes, off: int) -> tuple[str, list[list[np.ndarray]], int | None, int]:
    """(kind, parts with their rings, srid, end) of the geometry at ``off``; Z and M are read over."""
    order = {0: ">", 1: "<"}.get(buf[off])
    if order is None:
        raise ValueError(f"WKB byte order {buf[off]}")
    (code,) = struct.unpack_from(order + "I", buf, off + 1)
    off += 5
    flags, code = code & 0xF0000000, code & 0x0FFFFFFF
    srid = None
    if flags & _HAS_SRID:
        (srid,) = struct.unpack_from(order + "i", buf, off)
        off += 4
    iso, code = divmod(code, 1000)
    kind = _KINDS.get(code)
    if kind is None or iso > 3 or flags & 0x10000000:
        raise ValueError(f"unsupported WKB geometry type {flags + 1000 * iso + code}")
    stride = 2 + bool(flags & _HAS_Z or iso in (1, 3)) + bool(flags & _HAS_M or iso in (2, 3))

    def count(o: int) -> int:
        return struct.unpack_from(order + "I", buf, o)[0]

    def points(n: int, o: int) -> tuple[np.ndarray, int]:
        end = o + 8 * stride * n
        if end > len(buf):
            raise ValueError("WKB ends inside a ring")
        return np.frombuffer(buf, order + "f8", n * stride, o).reshape(n, stride)[:, :2], end

    if kind == "Point":
        ring, off = points(1, off)
        return kind, [[ring]], srid, off
    if kind == "LineString":
        ring, off = points(count(off), off + 4)
        return kind, [[ring]], srid, off
    if kind == "Polygon":
        rings, n = [], count(off)
        off += 4
        for _ in range(n):
            ring, off = points(count(off), off + 4)
            rings.append(ring)
        return kind, [rings], srid, off
    parts, n = [], count(off)
    off += 4
    for _ in range(n):
        _, sub, _, off = _parse(buf, off)
        parts += sub
    return kind, parts, srid, off


def parse_wkb(buf: bytes | None) -> dict | None:
    """``{'kind', 'rings'}`` for one WKB value; rings are lists of (x, y). See :func:`parse_geometry`."""
    found = parse_geometry(buf)
    return found and {k: found[k] for k in ("kind", "rings")}


def parse_geometry(buf: bytes | None) -> dict | None:
    """``{'kind', 'rings', 'part', 'srid'}`` for one WKB value.

    Plain, extended (SRID, Z, M flags) and ISO (1001 to 3006) codes are read;
    anything else, and a value with bytes missing or left over, is an error.
    """
    if buf is None:
        return None
    buf = bytes(buf)
    kind, parts, srid, end = _parse(buf, 0)
    if end != len(buf):
        raise ValueError(f"{len(buf) - end} bytes after the WKB geometry")
    return {
        "kind": kind,
        "rings": [[{"x": x, "y": y} for x, y in ring.tolist()] for rings in parts for ring in rings],
        "part": [i for i, rings in enumerate(parts) for _ in rings],
        "srid": srid,
    }


def wkb_rings(buf: bytes) -> list[np.ndarray]:
    """The rings of a Polygon or MultiPolygon as arrays of points; other kinds have none."""
    kind, parts, _, end = _parse(buf, 0)
    if end != len(buf):
        raise ValueError(f"{len(buf) - end} bytes after the WKB geometry")
    return [ring for rings in parts for ring in rings] if kind.endswith("Polygon") else []


@F.pandas_udf(GEOM_TYPE)
def _decode_wkb(col: pd.Series) -> pd.DataFrame:
    parsed = [parse_geometry(b) or {} for b in col]
    return pd.DataFrame({f: pd.Series([p.get(f) for p in parsed], dtype=object) for f in ("kind", "rings", "part", "srid")})


def decode_wkb(geometry: Column | str) -> Column:
    """WKB binary column -> struct(kind, rings: array<array<struct<x,y>>>); NULL stays NULL."""
    g = _c(geometry)
    return F.when(g.isNotNull(), _decode_wkb(g))


def point_wkb(x: float, y: float) -> bytes:
    """Little-endian WKB of one point (used to build geometry columns)."""
    return struct.pack("<BIdd", 1, 1, x, y)


@F.pandas_udf(T.BinaryType())
def encode_point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    """Point WKB from two double columns."""
    n = len(x)
    out = np.zeros(n, np.dtype([("order", "u1"), ("type", "<u4"), ("x", "<f8"), ("y", "<f8")]))
    out["order"], out["type"], out["x"], out["y"] = 1, 1, x, y
    raw = out.tobytes()
    return pd.Series([raw[21 * i : 21 * i + 21] for i in range(n)])


def polygons_wkb(polygons, srid: int | None = None) -> bytes:
    """Little-endian WKB of polygons (lists of rings of points); one is a Polygon, more a MultiPolygon."""
    def head(code: int, tag: bool) -> bytes:
        return struct.pack("<BI", 1, code | (_HAS_SRID if tag else 0)) + (struct.pack("<i", srid) if tag else b"")

    def polygon(rings, tag: bool) -> bytes:
        body = b"".join(struct.pack("<I", len(r)) + np.array([(p["x"], p["y"]) for p in r], "<f8").tobytes() for r in rings)
        return head(3, tag) + struct.pack("<I", len(rings)) + body

    tagged = srid is not None
    if len(polygons) == 1:
        return polygon(polygons[0], tagged)
    return head(6, tagged) + struct.pack("<I", len(polygons)) + b"".join(polygon(r, False) for r in polygons)


@F.arrow_udf(T.BinaryType())
def encode_polygons_wkb(polygons: pa.Array, srid: pa.Array) -> pa.Array:
    """WKB of an array of polygons (arrays of rings of struct<x,y>); a NULL ``srid`` leaves it out."""
    return pa.array([polygons_wkb(p, s) for p, s in zip(polygons.to_pylist(), srid.to_pylist(), strict=True)], pa.binary())


def reproject_rings(rings: Column | str) -> Column:
    """Rings in EPSG:3857 metres -> the same rings in degrees, point by point, without leaving the JVM."""
    def point(p: Column) -> Column:
        lon, lat = mercator_to_lonlat(p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.transform(_c(rings), lambda ring: F.transform(ring, point))


def rings_box(rings: Column | str) -> dict[str, Column]:
    """Bounding box columns of a geometry's rings; NULL without points."""
    flat = F.flatten(_c(rings))
    xs, ys = F.transform(flat, lambda p: p["x"]), F.transform(flat, lambda p: p["y"])
    return {"min_lon": F.array_min(xs), "min_lat": F.array_min(ys), "max_lon": F.array_max(xs), "max_lat": F.array_max(ys)}


def rings_area(rings: Column | str, part: Column | str) -> Column:
    """Area in the rings' own units: outer rings less their holes, whatever way they turn."""
    def ring_area(ring: Column) -> Column:
        pairs = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring)), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
        return F.abs(F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)) / F.lit(2.0)

    part = _c(part)
    signed = F.transform(_c(rings), lambda r, i: F.when((i == 0) | (F.get(part, i) != F.get(part, i - 1)), ring_area(r)).otherwise(-ring_area(r)))
    return F.aggregate(signed, F.lit(0.0), lambda s, v: s + v)
