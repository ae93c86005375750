"""Suites of declared tests: counts of each kind, odd input, and one scan of the model."""

import pytest

from terrasift.operators import suites as U
from terrasift.plans.suites import SUITES, judge_all, judge_model

FIELDS = "k string, g string, v double, test string, weight int, parent string"
ROWS = [
    ("a", "x", 1.0, None, 1, None), ("a", "x", -2.0, "", 1, None), ("b", None, None, " ", 1, None), ("b", None, 4.0, "z", 1, None),
    (None, "y", float("nan"), "z", 1, None), (None, "y", 9.0, "z", 1, None), ("c", "q", 5.0, "z", 1, None),
]


@pytest.fixture(scope="module")
def model(spark):
    # Columns have the names of the records inside.
    return spark.createDataFrame(ROWS, FIELDS)


def failures(df):
    return {r["test"]: (r["failures"], r["status"]) for r in df.collect()}


def test_kinds(spark, model):
    parents = spark.createDataFrame([("x", 3.0), ("x", 3.0), (None, 1.0), ("q", 4.0)], "name string, v double")
    tests = [
        *U.not_null("k"), U.unique("k"), U.unique("k", "g", severity="warn"), *U.not_empty("test"), U.in_range("v", 0, 5),
        U.accepted("g", "x", "y"), U.accepted("k", "b", where="g is not null"), U.share("g", 0.8), U.Share("enough", column="g", at_least=0.7), U.Share("some", column="v", at_least=0.6, where="k = 'b'"),
        U.related("g", "p", "name"), U.DistinctCount("three", column="g", expected=3), U.DistinctCount("two", "warn", "k is not null", column="g", expected=3),
        U.SameRows("same", other="p"), U.is_true("positive", "v > 0", severity="warn"),
        U.NotAboveParent("below", key="g", measure="v", parent="up"),
    ]
    up = parents.where("name is not null").distinct().withColumnRenamed("name", "g")
    got = failures(U.run_suite(model, tests, {"p": parents, "up": up}))
    assert got == {
        "not_null_k": (2, "error"), "unique_k": (2, "error"), "unique_k_g": (3, "warn"), "not_empty_string_test": (2, "error"),
        # NaN is above every number, as in the engine's comparisons.
        "accepted_range_v": (3, "error"), "accepted_values_g": (1, "error"), "accepted_values_k": (2, "error"),
        "not_null_proportion_g": (1, "error"), "enough": (0, "pass"), "some": (1, "error"), "relationships_g": (2, "error"), "three": (0, "pass"), "two": (1, "warn"),
        "same": (3, "error"), "positive": (1, "warn"), "below": (1, "error"),
    }


def test_names_must_differ(model):
    with pytest.raises(ValueError, match="one name"):
        U.run_suite(model, [*U.not_null("k"), *U.not_null("k")])
    with pytest.raises(KeyError, match="needs the table"):
        U.run_suite(model, [U.related("g", "p", "name")])


def test_empty_model_and_parents(spark, model):
    none = model.limit(0)
    tests = [*U.not_null("k"), U.unique("k"), U.share("g", 0.8), U.related("g", "p", "g"), U.SameRows("same", other="p"), U.DistinctCount("three", column="g", expected=3)]
    got = failures(U.run_suite(none, tests, {"p": none}))
    assert got == {"not_null_k": (0, "pass"), "unique_k": (0, "pass"), "not_null_proportion_g": (0, "pass"), "relationships_g": (0, "pass"), "same": (0, "pass"), "three": (1, "error")}
    got = failures(U.run_suite(model, tests, {"p": none}))
    assert got["relationships_g"] == (5, "error") and got["same"] == (7, "error")


def test_one_scan_of_the_model(spark, model, tmp_path):
    model.write.parquet(str(tmp_path / "model"))
    stored = spark.read.parquet(str(tmp_path / "model"))
    tests = [*U.not_null("k", "g", "v"), U.unique("k"), U.unique("g", "k"), U.accepted("g", "x"), U.share("v", 0.5), U.in_range("v", 0), U.DistinctCount("n", column="g", expected=1)]
    plan = U.run_suite(stored, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Python" not in plan


def test_declared_suites(spark):
    assert {len({t.name for t in tests}) == len(tests) for tests in SUITES.values()} == {True}
    frame = spark.createDataFrame([(" 1", None), (" 1", "n")], "id string, name string").selectExpr(
        "id", "name", *[f"name as {c}" for c in ("adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name", "adm3_pcode", "adm3_name", "name_latin", "geometry")]
    )
    got = failures(judge_model("cleaned_education_facilities", frame))
    assert got["unique_id"] == (1, "error") and got["not_null_name"] == (1, "error") and got["not_null_id"] == (0, "pass")
    assert judge_all({"cleaned_education_facilities": frame}).where("model = 'cleaned_education_facilities'").count() == 11
    with pytest.raises(ValueError, match="no suite"):
        judge_all({"other": frame})
