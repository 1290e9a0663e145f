import struct

from areatab.operators.geo import bbox, decode_wkb, lonlat_to_mercator, mercator_to_lonlat, parse_wkb, point_wkb, tile_counts


def test_reproject_roundtrip(spark):
    df = spark.createDataFrame([(-58.38, -34.6), (-68.3, -54.8), (0.0, 0.0), (-70.0, -89.0)], "lon double, lat double")
    x, y = lonlat_to_mercator("lon", "lat")
    m = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lo, la = mercator_to_lonlat("x", "y")
    for r in m.select("lon", "lat", lo.alias("lo"), la.alias("la")).collect():
        assert abs(r.lon - r.lo) < 1e-9 and abs(r.lat - r.la) < 1e-9


def test_tiles_and_bbox(spark):
    df = spark.createDataFrame([(-58.38, -34.6), (-58.39, -34.61)], "lon double, lat double")
    t = {(r.z, r.tx, r.ty): r.n for r in tile_counts(df, max_zoom=2).collect()}
    assert t[(0, 0, 0)] == 2
    assert sum(v for (z, _, _), v in t.items() if z == 2) == 2
    b = bbox(df).first()
    assert b.min_lon == -58.39 and b.max_lat == -34.6


def _poly(rings, order="<"):
    out = struct.pack(order + "BII", 1 if order == "<" else 0, 3, len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring))
        for x, y in ring:
            out += struct.pack(order + "dd", x, y)
    return out


def test_wkb_point_polygon_multipolygon(spark):
    sq = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    poly = _poly([sq])
    multi = struct.pack("<BII", 1, 6, 2) + poly + _poly([sq], ">")
    assert parse_wkb(point_wkb(1.5, -2.5)) == {"kind": "Point", "rings": [[{"x": 1.5, "y": -2.5}]]}
    df = spark.createDataFrame([(bytearray(point_wkb(1.5, -2.5)),), (bytearray(poly),), (bytearray(multi),), (None,)], "g binary")
    out = df.select(decode_wkb("g").alias("d")).collect()
    assert out[0].d.kind == "Point" and out[0].d.rings[0][0].x == 1.5
    assert out[1].d.kind == "Polygon" and len(out[1].d.rings[0]) == 4
    assert out[2].d.kind == "MultiPolygon" and len(out[2].d.rings) == 2
    assert out[3].d is None


def test_extended_and_iso_wkb(spark):
    import pytest

    from areatab.operators.geo import parse_geometry

    xy = lambda g: [[(p["x"], p["y"]) for p in r] for r in g["rings"]]
    srid = struct.pack("<BIidd", 1, 1 | 0x20000000, 4326, 1.5, -2.5)
    assert xy(parse_geometry(srid)) == [[(1.5, -2.5)]] and parse_geometry(srid)["srid"] == 4326
    want = [[(1.0, 2.0), (3.0, 4.0)]]
    for code, extra in ((2 | 0x80000000, 1), (2 | 0x40000000, 1), (2 | 0xC0000000, 2), (1002, 1), (2002, 1), (3002, 2)):
        pts = b"".join(struct.pack("<dd", x, y) + struct.pack("<d", 9.0) * extra for x, y in want[0])
        assert xy(parse_geometry(struct.pack("<BII", 1, code, 2) + pts)) == want
    for bad in (struct.pack("<BI", 1, 17), struct.pack("<BIdd", 1, 1, 1.0, 2.0) + b"x", struct.pack("<BIId", 1, 2, 5, 1.0), b"\x07"):
        with pytest.raises((ValueError, struct.error)):
            parse_geometry(bad)


def test_parts_holes_and_round_trip():
    from areatab.operators.geo import parse_geometry, polygons_wkb

    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    outer, hole = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 1))
    for srid in (None, 3857):
        one = parse_geometry(polygons_wkb([[outer, hole]], srid))
        assert (one["kind"], one["part"], one["srid"], one["rings"]) == ("Polygon", [0, 0], srid, [outer, hole])
        two = parse_geometry(polygons_wkb([[outer, hole], [outer]], srid))
        assert (two["kind"], two["part"], two["rings"]) == ("MultiPolygon", [0, 0, 1], [outer, hole, outer])
