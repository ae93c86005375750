import hashlib
import math

import pytest
from pyspark.sql import functions as F

from terrasift.functions import keys, numeric, places, text
from terrasift.sources import typing


def column(spark, values, kind, *exprs):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [tuple(r) for r in df.select(*[e("v") for e in exprs]).collect()]


def test_clean_text(spark):
    got = column(spark, [" a ​ b ", "﻿", "  ", None, "Keep Case"], "string", text.clean_text)
    assert got == [("a b",), (None,), (None,), (None,), ("Keep Case",)]


def test_word_initcap_starts_after_every_mark(spark):
    got = column(spark, ["o'NEIL wad_medani", "al-jazira", "", None, "élan 2nd"], "string", text.word_initcap)
    assert got == [("O'Neil Wad_Medani",), ("Al-Jazira",), ("",), (None,), ("Élan 2nd",)]


def test_placeholder_tokens(spark):
    got = column(spark, [" n/a ", "-", "Unknown", "", "real  name"], "string", lambda c: text.placeholder_to_null(c, case="initcap"))
    assert [r[0] for r in got] == [None, None, None, None, "Real Name"]


@pytest.mark.parametrize("value,expected", [("12", 12), ("-3.5", -3.5), ("1e5", None), ("+5", None), (".5", None), ("12\n", None), ("1,234", None)])
def test_safe_decimal_accepts_plain_numbers_only(spark, value, expected):
    got = column(spark, [value], "string", numeric.safe_decimal)[0][0]
    assert got == expected if expected is None else float(got) == expected


def test_number_text_drops_thousands(spark):
    assert column(spark, ["1,234.5", "N/A"], "string", text.number_text) == [("1234.5",), (None,)]


def test_severity_overflow_becomes_null(spark):
    got = column(spark, ["9.99", "12.5"], "string", lambda c: numeric.safe_decimal(c, 3, 2))
    assert float(got[0][0]) == 9.99 and got[1][0] is None


def test_surrogate_and_entity_keys(spark):
    df = spark.createDataFrame([(None, " Name ", None, "C1 ")], "a string, n string, p string, c string")
    row = df.select(keys.surrogate_key("a"), keys.entity_key("n", "p", "c"), keys.entity_key("a", "c")).first()
    assert row[0] == hashlib.md5(keys.NULL_KEY_SENTINEL.encode()).hexdigest()
    assert row[1] == hashlib.md5(b"nameunknownC1").hexdigest()
    assert row[2] is None


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    got = [r[0] for r in df.select(numeric.guarded_ratio(F.col("n"), F.col("d"), 8, 4)).collect()]
    assert float(got[0]) == 0.3333 and got[1:] == [None, None]


def test_coordinate_quality_is_inclusive(spark):
    df = spark.createDataFrame([(3.0, 36.0), (2.9, 30.0), (None, 30.0)], "lat double, lon double")
    got = [r[0] for r in df.select(places.coordinate_quality("lat", "lon")).collect()]
    assert got == ["VALID", "SUSPICIOUS", "MISSING"]


def test_distance(spark):
    df = spark.createDataFrame([(5.0, 30.0, 6.0, 31.0)], "a double, b double, c double, d double")
    got = df.select(places.distance_km(*[F.col(x) for x in "abcd"])).first()[0]
    assert math.isclose(got, math.hypot(111.32, 111.32 * math.cos(math.radians(5))))


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, y int")
    assert [tuple(r) for r in numeric.nan_to_null(df).collect()] == [(None, 1), (2.0, None)]


def test_normalized_names_refuse_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, `a_b` int")
    with pytest.raises(ValueError):
        typing.normalize_column_names(df)


def test_row_key_tells_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("null", "a"), (None, "a")], "x string, y string")
    assert df.select(keys.row_key(df).alias("k")).distinct().count() == 2


def test_value_key_covers_whole_text(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(long + "a",), (long + "b",), (long + "a",)], "v string")
    assert df.select(keys.value_key(df, "v").alias("k")).distinct().count() == 2
