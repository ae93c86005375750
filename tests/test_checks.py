"""Every assertion fires on a planted fault and stays silent on good rows."""

import pytest
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators import assertions as A
from terrasift.plans import check_sets as CS

HEALTH = {
    "facility_hash": "h1", "facility_name": "Clinic", "state": "unity", "state_code": "SS01", "county": "rubkona",
    "county_code": "SS0101", "payam": "bentiu", "payam_code": "SS010101", "state_raw": "unity", "county_raw": "rubkona",
    "payam_raw": "bentiu", "has_valid_state_code": True, "has_valid_county_code": True, "latitude": 9.0,
    "longitude": 29.0, "coordinate_quality": "VALID", "completeness_score": 100, "location_confidence": "HIGH",
}
HEALTH_FAULTS = {
    "H01": [{}, {"state": "other"}],
    "H02": [{}, {"county": "other"}],
    "H03": [{}, {"payam": "other"}],
    "H04": [{}, {"county_code": "SS0102"}],
    "H05": [{}, {"state_code": "SS02"}],
    "H06": [{}, {"facility_hash": "h2"}],
    "H07": [{}, {"latitude": 8.0}],
    "H08": [{"coordinate_quality": "SUSPICIOUS"}],
    "H09": [{"location_confidence": "LOW"}],
    "H10": [{"payam": None}],
    "H11": [{"payam_code": None}],
    "H12": [{}, {"state_raw": "unity state"}],
    "H13": [{}, {"county_raw": "rub kona"}],
    "H14": [{"has_valid_state_code": False}],
    "H15": [{"has_valid_county_code": False}],
}


def health(spark, changes):
    kinds = {str: "string", bool: "boolean", float: "double", int: "int"}
    ddl = ", ".join(f"{k} {kinds[type(v)]}" for k, v in HEALTH.items())
    return spark.createDataFrame([tuple((HEALTH | c).values()) for c in changes], ddl)


def test_health_checks(spark):
    assert CS.health_report(health(spark, [{}, {}])).count() == 0
    issues = {i: c.issue for i, c in CS.health_checks().items()}
    for i, changes in HEALTH_FAULTS.items():
        got = CS.health_report(health(spark, changes), [i]).collect()
        assert [r["issue"] for r in got] == [issues[i]], i


def test_health_checks_together(spark):
    every = [c for i, changes in HEALTH_FAULTS.items() for c in changes]
    got = {r["issue"] for r in CS.health_report(health(spark, every)).collect()}
    assert got == {c.issue for c in CS.health_checks().values()}


def test_health_null_keys(spark):
    nulls = [{"state_code": None}, {"state_code": None, "state": "x"}]
    got = CS.health_report(health(spark, nulls), ["H01"]).collect()
    assert [(r[0], int(r[2])) for r in got] == [(None, 2)]
    assert CS.health_report(health(spark, [{"payam_code": None}, {"payam_code": None, "county_code": "z"}]), ["H04"]).count() == 0
    assert CS.health_report(health(spark, [{"has_valid_state_code": False, "state_code": "SS00"}]), ["H14"]).count() == 0


GROUPS = dict.fromkeys(CS.AGE_SEX_GROUPS, 100.0)
SHARES = {f"pct_{g}": 0.125 for g in CS.AGE_SEX_GROUPS}
POPULATION = {
    "admin1_pcode": "SS01", "admin2_pcode": "SS0101", "is_country_total": False, "population_2025": 800.0, **GROUPS, **SHARES,
    "children_under_5": 200.0, "children_5_17": 200.0, "working_age_population": 200.0, "elderly_population": 200.0,
    "male_population": 400.0, "female_population": 400.0, "dependency_ratio": 3.0, "working_age_ratio": 0.25,
    "record_type": "ADMIN2_LEVEL",
}
COUNTRY = {"admin1_pcode": None, "admin2_pcode": None, "is_country_total": True, "record_type": "COUNTRY_TOTAL"}
POPULATION_FAULTS = {
    "B01": [{}, {}],
    "B02": [{"population_2025": 950.0}],
    "B03": [{"male_population": 600.0}],
    "B04": [{"children_under_5": 300.0}],
    "B05": [{"pct_male_under_5": 0.2}],
    "B06": [{"male_18_60": -1.0}],
    "B07": [{"pct_female_5_17": 1.2}],
    "B08": [{"female_over_60": 900.0}],
    "B09": [{"working_age_population": 300.0}],
    "B10": [{"elderly_population": 300.0}],
    "B11": [{"dependency_ratio": 2.5}],
    "B12": [{"record_type": "INCOMPLETE_ADMIN"}],
    "B13": [{"working_age_ratio": 1.5}],
    "B14": [{"children_5_17": 300.0}],
    "B15": [{"male_population": 500.0}],
    "B16": [{"female_population": 500.0}],
    "B17": [{"is_country_total": True, "record_type": "COUNTRY_TOTAL"}],
    "B18": [{}],
}


def population(spark, changes):
    kinds = {str: "string", bool: "boolean", float: "double"}
    ddl = ", ".join(f"{k} {kinds[type(v)]}" for k, v in POPULATION.items())
    df = spark.createDataFrame([tuple((POPULATION | c).values()) for c in changes], ddl)
    return df.select(*[F.col(f.name).cast("decimal(18,4)").alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema.fields])


def test_population_checks(spark):
    assert CS.population_report(population(spark, [{}, COUNTRY])).count() == 0
    issues = {i: c.issue for i, c in CS.population_checks().items()}
    for i, changes in POPULATION_FAULTS.items():
        got = {r["issue"] for r in CS.population_report(population(spark, changes), [i]).collect()}
        assert got == {issues[i]}, i


def test_population_nulls_never_fail_a_sum(spark):
    assert CS.population_report(population(spark, [{"male_under_5": None}]), ["B02", "B04", "B15"]).count() == 0


def test_dependency_definitions(spark):
    two = population(spark, [{"dependency_ratio": 2.0}, COUNTRY])
    assert CS.population_report(two, ["B11"]).count() == 1
    assert CS.population_report(two, ["B11"], dependency="model").count() == 0


def education(spark, changes):
    base = {"facility_id": "1", "facility_name": "School", "adm1_pcode": "SS01", "adm1_name": "a", "adm2_pcode": "SS0101",
            "adm2_name": "b", "adm3_pcode": "SS010101", "adm3_name": "c", "shape": "point"}
    df = spark.createDataFrame([tuple((base | c).values()) for c in changes], ", ".join(f"{k} string" for k in base))
    star = ((0, 3), (2, -3), (-3, 1), (3, 1), (-2, -3), (0, 3))
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in star])
    shape = F.when(F.col("shape") == "star", G.make_polygon(ring)).otherwise(G.make_point(F.lit(30.0), F.lit(5.0)))
    return df.withColumn("geometry", shape)


@pytest.mark.parametrize(
    "check,changes",
    [
        ("E01", [{}, {"adm1_name": "x"}]),
        ("E02", [{}, {"adm2_name": "x"}]),
        ("E03", [{}, {"adm3_name": "x"}]),
        ("E04", [{}, {"adm2_pcode": "SS0102"}]),
        ("E05", [{}, {"facility_id": "2"}]),
        ("E06", [{"shape": "star"}]),
    ],
)
def test_education_checks(spark, check, changes):
    issue = CS.education_checks()[check].issue
    assert issue in {r["issue"] for r in CS.education_report(education(spark, changes)).collect()}
    assert CS.education_report(education(spark, [{}])).count() == 0


def test_needs_checks(spark):
    needs = spark.createDataFrame(
        [("Unity", "SS01", "Rubkona", "SS0101"), (" unity", "SS01", "Other", "SS0101"), ("X", "SS02", None, "SS0101"), ("Y", "SS09", "Z", None)],
        "admin_1 string, admin_1_p_code string, admin_2 string, admin_2_p_code string",
    )
    states = spark.createDataFrame([("SS01", "unity"), ("SS02", "lakes")], "state_code string, state_name string")
    counties = spark.createDataFrame([("SS0101", "rubkona", "SS01")], "county_code string, county_name string, state_code string")
    got = {tuple(r) for r in CS.needs_report(needs, states, counties).select("check_name", "model_value", "lookup_value").collect()}
    assert got == {
        ("admin_1_pcode_name_mismatch", "X", "lakes"),
        ("admin_2_pcode_name_mismatch", "Other", "rubkona"),
        ("admin_2_pcode_name_mismatch", None, "rubkona"),
        ("admin_2_not_child_of_admin_1", "SS02", "SS01"),
    }


def test_generic_assertions(spark):
    df = spark.createDataFrame([(1, "A", 5.0), (2, "b ", None), (2, "", 50.0), (None, None, 7.0)], "id int, code string, v double")
    count = lambda d: d.count()
    assert count(A.not_null(df, "id")) == 1
    assert [tuple(r) for r in A.unique(df, "id").collect()] == [(2, 2)]
    assert count(A.accepted_values(df, "code", ["A"])) == 2
    assert count(A.accepted_range(df, "v", 6, 40)) == 2
    assert count(A.accepted_range(df, "v", 5, None, inclusive=False)) == 1
    assert count(A.not_empty_string(df, "code")) == 1
    assert count(A.matches(df, "code", "^[A-Z]$")) == 2
    assert count(A.not_null_proportion(df, "v", 0.8)) == 1
    assert count(A.not_null_proportion(df, "v", 0.75)) == 0
    assert count(A.expression_is_true(df, "v < 10")) == 1
    assert count(A.equal_rowcount(df, df)) == 0
    assert [tuple(r) for r in A.equal_rowcount(df, df.limit(0)).collect()] == [(4, 0)]
    assert count(A.scalar_expectation(df, F.countDistinct("id"), "=", 2)) == 0
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert count(A.relationships(df, "id", parent, "k")) == 2
    assert A.verdict(A.not_null(df, "id"), "t", "warn").first()["status"] == "warn"
    assert A.verdict(A.not_null(df, "id", F.col("v") < 6), "t").first()["status"] == "pass"
    title = spark.createDataFrame([("Al-Jazira",), ("al-jazira",)], "n string")
    assert count(A.title_case(title, "n")) == 1
