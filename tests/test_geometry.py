import json
import random

import pytest
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators.spatial import spatial_join

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]


def geo(kind, coordinates):
    return json.dumps({"type": kind, "coordinates": coordinates})


CASES = {
    "point": (geo("Point", [31.5, 6.8]), True),
    "line": (geo("LineString", [[0, 0], [1, 1]]), True),
    "flat line": (geo("LineString", [[1, 1], [1, 1]]), False),
    "square": (geo("Polygon", [SQUARE]), True),
    "hole": (geo("Polygon", [SQUARE, HOLE]), True),
    "hole outside": (geo("Polygon", [HOLE, [[5, 5], [6, 5], [6, 6], [5, 5]]]), False),
    "bowtie": (geo("Polygon", [[[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]]]), False),
    "open ring": (geo("Polygon", [[[0, 0], [1, 0], [1, 1], [0, 1]]]), False),
    "no area": (geo("Polygon", [[[0, 0], [1, 0], [2, 0], [0, 0]]]), False),
    "spike": (geo("Polygon", [[[0, 0], [4, 0], [4, 4], [6, 4], [4, 4], [0, 4], [0, 0]]]), False),
    "touches itself": (geo("Polygon", [[[0, 0], [2, 0], [1, 1], [2, 2], [0, 2], [1, 1], [0, 0]]]), False),
    "two parts": (geo("MultiPolygon", [[SQUARE], [[[10, 10], [11, 10], [11, 11], [10, 10]]]]), True),
    "nested parts": (geo("MultiPolygon", [[SQUARE], [HOLE]]), False),
    "repeated point": (geo("Polygon", [[[0, 0], [4, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]), True),
    "many points": (geo("MultiPoint", [[0, 0], [1, 1]]), True),
    "many lines": (geo("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]), True),
}


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(n, t) for n, (t, _) in CASES.items()]
    return spark.createDataFrame(rows, "name string, text string").withColumn("g", G.from_geojson("text"))


def test_validity(shapes):
    got = {r[0]: r[1] for r in shapes.select("name", G.is_valid("g")).collect()}
    assert got == {n: ok for n, (_, ok) in CASES.items()}


def test_long_rings_agree_with_short_ones():
    import numpy as np

    rng = random.Random(5)
    for n in (5, 8, 12):
        for _ in range(200):
            pts = [(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(n)]
            pts.append(pts[0])
            x, y = (np.array(v, float) for v in zip(*pts))
            swept = bool(G._proper_crossings(*G._segments(x, y, [len(x)])))
            plain = G._short_rings_meet(x.tolist(), y.tolist(), [len(x)])
            assert swept == plain, pts
            if not ((x[1:] == x[:-1]) & (y[1:] == y[:-1])).any() and G._area(x, y) != 0:
                assert bool(G._small_rings_valid(x[None], y[None])[0]) == (not plain), pts


def test_wkb_round_trip(shapes):
    back = shapes.withColumn("w", G.to_wkb("g")).withColumn("b", G.from_hex_wkb(F.hex("w")))
    assert back.where(~G.geometry_key("g").eqNullSafe(G.geometry_key("b"))).count() == 0


def test_wkb_with_embedded_srid_and_height():
    import struct

    blob = struct.pack("<BII3d", 1, 1 | 0x20000000 | 0x80000000, 4326, 1.0, 2.0, 3.0)
    assert json.loads(G.wkb_to_geojson(blob)) == {"type": "Point", "coordinates": [1.0, 2.0]}
    assert G.wkb_to_geojson(None) is None


def test_repair(shapes):
    fixed = shapes.select("name", G.make_valid("g").alias("m")).select("name", "m.gtype", G.is_valid("m").alias("ok"))
    got = {r[0]: (r[1], r[2]) for r in fixed.collect()}
    assert got["bowtie"] == ("MultiPolygon", True)
    assert got["open ring"] == ("Polygon", True)
    assert got["square"] == ("Polygon", True)
    assert got["no area"] == ("Polygon", False)  # cannot be mended, returned as it was


def test_contains_excludes_boundary_and_holes(spark):
    df = spark.createDataFrame([(geo("Polygon", [SQUARE, HOLE]),)], "t string").select(G.from_geojson("t").alias("g"))
    points = spark.createDataFrame([(3.0, 3.0), (1.5, 1.5), (0.0, 2.0), (4.0, 4.0), (5.0, 1.0), (1.0, 1.5)], "x double, y double")
    got = [r[0] for r in points.crossJoin(df).select(G.contains("g", "x", "y")).collect()]
    assert got == [True, False, False, False, False, False]


def test_unusable(spark):
    texts = [None, geo("Polygon", []), '{"type":"GeometryCollection","geometries":[]}', geo("Point", [1, 2])]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(G.from_geojson("t").alias("g"))
    assert [r[0] for r in df.select(G.is_unusable("g")).collect()] == [True, True, True, False]


@pytest.mark.parametrize("small", [True, False])
def test_spatial_join_against_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr("terrasift.operators.spatial.fits_broadcast", lambda df: False)
    rng = random.Random(3)
    polygons = []
    for i in range(12):
        x, y = rng.uniform(0, 8), rng.uniform(0, 8)
        polygons.append((i, geo("Polygon", [[[x, y], [x + 3, y], [x + 1, y + 1], [x, y + 3], [x, y]]])))
    # A third of the points sits on one spot.
    points = [(i, 2.5, 2.5) if i % 3 == 0 else (i, rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(300)]
    poly = spark.createDataFrame(polygons, "pid int, t string").select("pid", G.from_geojson("t").alias("geometry"))
    pts = spark.createDataFrame(points, "id int, lon double, lat double")
    got = {tuple(r) for r in spatial_join(pts, "lon", "lat", poly, cell=0.7).select("id", "pid").collect()}
    brute = pts.crossJoin(poly).where(G.contains("geometry", "lon", "lat")).select("id", "pid").collect()
    assert got == {tuple(r) for r in brute} and got
