from pyspark.sql import functions as F

from terrasift.operators import profiling as R


def test_completeness_with_and_without_null_placeholders(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" N/A ",), ("x",)], "t string")
    row = R.completeness(df).first()
    assert (row["null_count"], row["blank"], row["whitespace_only"], row["placeholder_count"], row["filled"]) == (1, 1, 1, 1, 3)
    assert R.completeness(df, pandas_compat=True).first()["placeholder_count"] == 2


def test_numeric_profile(spark):
    df = spark.createDataFrame([(float(i % 5),) for i in range(40)] + [(1000.0,), (None,), (float("nan"),)], "v double")
    row = R.numeric_profile(df).first()
    assert (row["total"], row["outliers_3std"], row["zeros"], row["max"]) == (41, 1, 8, 1000.0)
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert R.numeric_profile(flat).first()["outliers_3std"] == 0


def test_top_values_return_the_whole_text(spark):
    long = "y" * 300
    df = spark.createDataFrame([(long,)] * 3 + [("a",)] * 2 + [(None,)], "t string")
    assert [(r["value"], r["n"]) for r in R.top_values(df, "t", 1).collect()] == [(long, 3)]


def test_top_values_break_ties_by_text_of_any_length(spark):
    texts = ["a", "b" * 70, "c", "d" * 80]
    df = spark.createDataFrame([(t,) for t in texts * 2], "t string")
    assert [r["value"] for r in R.top_values(df, "t", 2).collect()] == texts[:2]
    assert R.top_values(df.where("false"), "t", 2).collect() == []


def test_unicode_blanks_count_as_white_space(spark):
    df = spark.createDataFrame([("\u00a0",), ("\u3000x\u2003",), ("a\u00a0\u00a0b",), ("\u00a0 N/A\u3000",)], "t string")
    row = R.completeness(df).first()
    assert (row["blank"], row["whitespace_only"], row["placeholder_count"]) == (0, 1, 1)
    row = R.text_profile(df).first()
    assert (row["lead_ws"], row["trail_ws"], row["multi_sp"]) == (3, 3, 2)
    assert [r["value"] for r in R.unknown_values(df.limit(1), "t", ["x"]).collect()] == [""]


def test_structural_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, t string")
    row = R.structural(df, "x").first()
    assert (row["row_count"], row["column_count"], row["duplicate_rows"], row["key_candidates"]) == (3, 2, 0, "id")


def test_coordinate_names():
    cols = ["county", "Latitude", "lon_dd", "y", "XCoord", "plate"]
    assert R.latitude_named(cols) == ["Latitude", "y", "plate"]
    assert R.longitude_named(cols) == ["lon_dd", "XCoord"]


def test_swapped_coordinates(spark):
    df = spark.createDataFrame([(-80.0, 5.0), (80.0, 6.0)], "lat double, lon double")
    assert "LIKELY_SWAPPED" in R.coordinate_profile(df).first()["flags"]


def test_fk_and_hierarchy(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,)], "k int")
    assert tuple(R.fk_check(a, "k", b, "k").first()) == ("FAIL", 1, "2")
    assert R.fk_check(b, "k", a, "k").first()["status"] == "OK"
    assert R.fk_check(a, "zz", b, "k").first()["status"].startswith("SKIP")
    h = spark.createDataFrame([("c", "p"), ("c", None), ("d", "p"), ("d", "q")], "child string, parent string")
    assert [tuple(r) for r in R.hierarchy_check(h, "child", "parent").collect()] == [("d", 2)]


def test_flags_sorted_by_priority(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a")], "`unnamed:_1` string, b string")
    got = [r["priority"] for r in R.quality_flags({"t": df}).orderBy("sort_order").collect()]
    assert got == ["CRITICAL", "HIGH", "MEDIUM"]


def test_duplicate_rows_counts_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert tuple(R.duplicate_rows(df).first()) == (3, 2, 1)
    assert R.text_profile(df.select(F.col("b"))).first()["issues"] == "Clean"
