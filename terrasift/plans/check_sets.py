"""The 42 table assertions: health (H), population (B), education (E) and needs (I) checks."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions.geometry import geometry_key, is_valid
from terrasift.functions.places import missing_coordinates
from terrasift.operators.assertions import mismatch
from terrasift.operators.checks import Check, Count, Distinct, PerRow, Total, check_report

# The eight age-sex groups of the population table.
AGE_SEX_GROUPS = (
    "male_under_5", "female_under_5", "male_5_17", "female_5_17",
    "male_18_60", "female_18_60", "male_over_60", "female_over_60",
)


def health_checks() -> dict[str, Check]:
    c = F.col
    place = F.concat_ws(
        "",
        c("payam_code"),
        F.lit("|"),
        c("latitude").cast("decimal(12,6)").cast("string"),
        F.lit("|"),
        c("longitude").cast("decimal(12,6)").cast("string"),
    )
    has_coordinates = ~missing_coordinates("latitude", "longitude")
    return {
        "H01": Distinct("state_code_multiple_names", c("state_code"), c("state")),
        "H02": Distinct("county_code_multiple_names", c("county_code"), c("county")),
        "H03": Distinct("payam_code_multiple_names", c("payam_code"), c("payam")),
        "H04": Distinct(
            "payam_in_multiple_counties", c("payam_code"), c("county_code"), where=c("payam_code").isNotNull()
        ),
        "H05": Distinct(
            "county_in_multiple_states", c("county_code"), c("state_code"), where=c("county_code").isNotNull()
        ),
        "H06": Distinct(
            "duplicate_facility_same_location",
            c("facility_name"),
            c("facility_hash"),
            group=(c("payam_code"), c("latitude"), c("longitude")),
            where=has_coordinates,
        ),
        "H07": Distinct("duplicate_facility_different_location", c("facility_name"), place),
        "H08": Count("suspicious_coordinates", c("facility_name"), c("coordinate_quality") == "SUSPICIOUS"),
        "H09": Count("low_location_confidence", c("facility_name"), c("location_confidence") == "LOW"),
        "H10": Count("payam_code_without_name", c("payam_code"), c("payam_code").isNotNull() & c("payam").isNull()),
        "H11": Count("payam_name_without_code", c("payam"), c("payam").isNotNull() & c("payam_code").isNull()),
        "H12": Distinct("state_raw_mismatch", c("state_code"), c("state_raw"), where=c("has_valid_state_code")),
        "H13": Distinct("county_raw_mismatch", c("county_code"), c("county_raw"), where=c("has_valid_county_code")),
        "H14": Count("invalid_state_code", c("state_code"), ~c("has_valid_state_code") & (c("state_code") != "SS00")),
        "H15": Count("invalid_county_code", c("county_code"), ~c("has_valid_county_code")),
    }


def _any(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _total(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(x) for x in cols])


def _gap(issue: str, total: Column, parts: Column, tolerance: float) -> PerRow:
    gap = F.abs(total - parts)
    return PerRow(issue, F.col("admin2_pcode"), gap, gap > tolerance)


def population_checks(dependency: str = "assert") -> dict[str, Check]:
    """``dependency`` picks the numerator the ratio check compares with.

    ``assert`` adds the 5-17 group as the published assertion does, ``model``
    uses the formula of the table itself.
    """
    c, key = F.col, F.col("admin2_pcode")
    shares = [f"pct_{g}" for g in AGE_SEX_GROUPS]
    country = c("is_country_total")
    dependants = c("children_under_5") + c("elderly_population")
    if dependency == "assert":
        dependants = dependants + c("children_5_17")
    ratio = dependants.cast("double") / F.nullif(c("working_age_population").cast("double"), F.lit(0.0))
    ratio_gap = F.abs(c("dependency_ratio").cast("double") - ratio)
    no_admin = c("admin1_pcode").isNull() | c("admin2_pcode").isNull()
    wrong_type = _any(
        [
            country & (c("record_type") != "COUNTRY_TOTAL"),
            ~country & ~no_admin & (c("record_type") != "ADMIN2_LEVEL"),
            ~country & no_admin & (c("record_type") != "INCOMPLETE_ADMIN"),
        ]
    )
    men = [g for g in AGE_SEX_GROUPS if g.startswith("male")]
    women = [g for g in AGE_SEX_GROUPS if g.startswith("female")]
    return {
        "B01": Count("admin2_pcode_duplicate", key, ~country & key.isNotNull(), above=1),
        "B02": _gap("population_age_sum_mismatch", c("population_2025"), _total(AGE_SEX_GROUPS), 100),
        "B03": _gap(
            "population_sex_sum_mismatch", c("population_2025"), c("male_population") + c("female_population"), 100
        ),
        "B04": _gap(
            "child_under_5_sum_mismatch", c("children_under_5"), c("male_under_5") + c("female_under_5"), 50
        ),
        "B05": _gap("percentages_sum_deviation", _total(shares), F.lit(1.0).cast("decimal(8,6)"), 0.01),
        "B06": Count(
            "negative_population_value", key, _any(c(x) < 0 for x in ("population_2025", *AGE_SEX_GROUPS))
        ),
        "B07": Count("invalid_percentage", key, _any((c(x) < 0) | (c(x) > 1) for x in shares)),
        "B08": Count("population_less_than_subgroup", key, _any(c("population_2025") < c(x) for x in AGE_SEX_GROUPS)),
        "B09": _gap("working_age_sum_mismatch", c("working_age_population"), c("male_18_60") + c("female_18_60"), 50),
        "B10": _gap("elderly_sum_mismatch", c("elderly_population"), c("male_over_60") + c("female_over_60"), 50),
        "B11": PerRow(
            "dependency_ratio_mismatch",
            key,
            ratio_gap,
            ~country & (c("working_age_population") > 0) & (ratio_gap > 0.001),
        ),
        "B12": Count("invalid_record_type", key, wrong_type),
        "B13": Count("invalid_working_age_ratio", key, (c("working_age_ratio") < 0) | (c("working_age_ratio") > 1)),
        "B14": _gap("child_5_17_sum_mismatch", c("children_5_17"), c("male_5_17") + c("female_5_17"), 50),
        "B15": _gap("male_population_sum_mismatch", c("male_population"), _total(men), 50),
        "B16": _gap("female_population_sum_mismatch", c("female_population"), _total(women), 50),
        "B17": Total(
            "admin2_present_on_country_row",
            "country_has_admin_code",
            country & (c("admin1_pcode").isNotNull() | key.isNotNull()),
        ),
        "B18": Total("country_total_count_mismatch", "country_total_count", country, expected=1),
    }


def education_checks() -> dict[str, Check]:
    c = F.col
    return {
        "E01": Distinct("adm1_pcode_multiple_names", c("adm1_pcode"), c("adm1_name")),
        "E02": Distinct("adm2_pcode_multiple_names", c("adm2_pcode"), c("adm2_name")),
        "E03": Distinct("adm3_pcode_multiple_names", c("adm3_pcode"), c("adm3_name")),
        "E04": Distinct("adm3_pcode_multiple_adm2_parents", c("adm3_pcode"), c("adm2_pcode")),
        "E05": Distinct(
            "duplicate_facility_same_location",
            c("facility_name"),
            c("facility_id"),
            group=(c("adm3_pcode"), geometry_key("geometry")),
        ),
        "E06": PerRow("geometry_invalid_after_repair", c("facility_id"), F.lit(1), c("_geometry_broken")),
    }


def _pick(checks: dict[str, Check], only: Iterable[str] | None) -> list[Check]:
    return list(checks.values()) if only is None else [checks[i] for i in only]


def health_report(facilities: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    return check_report(facilities, _pick(health_checks(), only))


def population_report(
    estimates: DataFrame, only: Iterable[str] | None = None, dependency: str = "assert"
) -> DataFrame:
    return check_report(estimates, _pick(population_checks(dependency), only))


def education_report(facilities: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    picked = list(education_checks()) if only is None else list(only)
    if "E06" in picked:
        facilities = facilities.withColumn("_geometry_broken", F.coalesce(~is_valid("geometry"), F.lit(False)))
    return check_report(facilities, _pick(education_checks(), picked))


def needs_report(
    needs: DataFrame, states: DataFrame, counties: DataFrame, only: Iterable[str] | None = None
) -> DataFrame:
    """Code and name pairs, and parent codes, that disagree with the lookups."""
    plans = {
        "I01": ("admin_1_pcode_name_mismatch", "admin_1_p_code", "admin_1", states, "state_code", "state_name", True),
        "I02": ("admin_2_pcode_name_mismatch", "admin_2_p_code", "admin_2", counties, "county_code", "county_name", True),
        "I03": (
            "admin_2_not_child_of_admin_1", "admin_2_p_code", "admin_1_p_code", counties, "county_code", "state_code", False,
        ),
    }
    branches = []
    for i in plans if only is None else only:
        name, code, value, lookup, lookup_code, lookup_value, as_names = plans[i]
        failing = mismatch(needs, code, value, lookup, lookup_code, lookup_value, as_names)
        branches.append(
            failing.select(
                F.lit(name).alias("check_name"),
                F.col(code).alias("p_code"),
                F.col(value).alias("model_value"),
                F.col("lookup_value"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), branches)
