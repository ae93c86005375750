import pytest
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators import gate as V


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def good(spark):
    return frame(spark, [(1, "a"), (2, "b"), (3, "c")], "id int, name string")


def test_valid_frame(good):
    r = V.validate(good)
    assert (r.is_valid, r.errors, r.warnings, r.checked_rows) == (True, [], [], 3)


def test_missing_values_only_warn(spark):
    r = V.validate(frame(spark, [(1, None), (2, "x")], "id int, notes string"))
    assert r.is_valid and r.errors == [] and any("notes" in w for w in r.warnings)


def test_all_nan_column_and_large_numbers(spark):
    r = V.validate(frame(spark, [(5_000_000_000, float("nan")), (1, float("nan"))], "population bigint, opt double"))
    assert r.is_valid and any("opt" in w for w in r.warnings)


def test_none_and_empty(spark, good):
    r = V.validate(None)
    assert not r.is_valid and "None" in r.errors[0] and r.checked_rows == 0
    r = V.validate(good.limit(0))
    assert not r.is_valid and any("empty" in e for e in r.errors)
    r = V.validate(good.select())
    assert not r.is_valid and any("no columns" in e for e in r.errors)


def test_duplicate_columns(spark):
    df = frame(spark, [(1, 2)], "id int, id2 int").toDF("id", "id")
    r = V.validate(df)
    assert not r.is_valid and any("Duplicate column" in e for e in r.errors)
    r = V.validate(frame(spark, [(1, 2)], "id0 int, id1 int"), header=["id", "id"])
    assert not r.is_valid and any("Duplicate column" in e for e in r.errors)


def test_range_rule_and_scope(spark):
    df = frame(spark, [(500.0, 500.0), (4.0, 31.0)], "latitude double, longitude double")
    r = V.validate(df, {"latitude": {"min": -90, "max": 90}})
    assert r.errors == ["Column 'latitude' has 1 value(s) above maximum 90"]
    assert V.validate(df).is_valid
    assert V.validate(df, {"absent": {"min": 0, "unique": True}}).is_valid


def test_range_ignores_text(spark):
    df = frame(spark, [("7",), ("x",), (None,), ("-2",)], "v string")
    assert V.validate(df, {"v": {"min": 0}}).errors == ["Column 'v' has 1 value(s) below minimum 0"]


def test_nan_never_breaks_a_range(spark):
    df = frame(spark, [(float("nan"),), (3.0,)], "v double")
    assert V.validate(df, {"v": {"min": 0, "max": 5}}).is_valid


def test_unique_rule_counts_null_as_a_value(spark):
    df = frame(spark, [(1,), (2,), (2,), (3,), (None,), (None,)], "record_id int")
    r = V.validate(df, {"record_id": {"unique": True}})
    assert r.errors == ["Column 'record_id' violates uniqueness rule: 2 duplicate value(s)"]


# --- geometry ------------------------------------------------------------------


def ring(points):
    return G.make_polygon(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points]))


SQUARE = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
BOWTIE = ((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))


def features(spark, exprs, names=None):
    """One feature per geometry expression."""
    names = names or [f"f{i}" for i in range(len(exprs))]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    g = F.when(F.lit(False), G.make_point(F.lit(0.0), F.lit(0.0)))
    for i, e in enumerate(exprs):
        g = g.when(F.col("id") == i, e)
    return df.withColumn("geometry", g)


def pt(x, y, srid=4326):
    return G.make_point(F.lit(float(x)), F.lit(float(y)), srid)


def test_valid_points_and_polygons(spark):
    assert V.validate(features(spark, [pt(31, 6), pt(30, 4)])) == V.ValidationResult(True, [], [], 2)
    assert V.validate(features(spark, [ring(SQUARE)])).is_valid


def test_all_null_geometry(spark):
    df = features(spark, [pt(1, 1)]).withColumn("geometry", F.when(F.lit(False), F.col("geometry")))
    r = V.validate(df)
    assert not r.is_valid and any("empty" in e for e in r.errors)


def test_some_invalid_geometry_lists_keys(spark):
    r = V.validate(features(spark, [ring(SQUARE), ring(BOWTIE)]), key="id")
    assert r.is_valid and any("invalid geometry (indices: [1])" in w for w in r.warnings)


def test_all_invalid_geometry(spark):
    r = V.validate(features(spark, [ring(BOWTIE)]))
    assert not r.is_valid and any("structurally invalid" in e for e in r.errors)


def test_null_mixed_crs_range(spark):
    df = features(spark, [pt(31, 6), pt(30, 5)])
    some = df.withColumn("geometry", F.when(F.col("id") == 0, F.col("geometry")))
    assert any("null or empty geometry" in w for w in V.validate(some).warnings)
    assert any("mixed geometry types" in w for w in V.validate(features(spark, [pt(1, 1), ring(SQUARE)])).warnings)
    assert any("no CRS" in w for w in V.validate(features(spark, [pt(1, 1, 0)])).warnings)
    r = V.validate(features(spark, [pt(400, 4.8), pt(31, 5)]), key="id")
    assert r.is_valid and any("outside the valid geographic range" in w and "[0]" in w for w in r.warnings)
    assert not V.validate(features(spark, [pt(400, 4.8)])).is_valid


def test_expected_type_and_crs(spark):
    df = features(spark, [pt(31, 6)])
    r = V.validate(df, {"geometry": {"expected_geometry_type": "Polygon"}})
    assert not r.is_valid and any("geometry type mismatch" in e for e in r.errors)
    assert V.validate(df, {"geometry": {"expected_crs": "EPSG:4326"}}).is_valid
    r = V.validate(df, {"geometry": {"expected_crs": "EPSG:32636"}})
    assert not r.is_valid and any("CRS mismatch" in e for e in r.errors)


def test_duplicates_and_empty_properties(spark):
    df = features(spark, [pt(31, 6), pt(31, 6)], ["a", "a"]).drop("id")
    assert any("duplicate feature" in w for w in V.validate(df).warnings)
    blank = features(spark, [pt(31, 6), pt(30, 6)], [" ", "x"]).drop("id")
    assert any("1 feature(s) have empty properties" in w for w in V.validate(blank).warnings)


def test_split(spark):
    df = frame(spark, [(1.0,), (99.0,), (None,)], "lat double")
    ok, bad = V.split(df, {"lat": {"max": 90}})
    assert ok.count() == 2
    assert [tuple(r) for r in bad.collect()] == [(99.0, ["above_max:lat"])]
