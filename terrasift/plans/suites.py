"""The test suites declared for each staged model and cleaned table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.functions.geometry import contains, is_valid
from terrasift.operators import suites as U
from terrasift.plans.check_sets import AGE_SEX_GROUPS
from terrasift.plans.staging import NEEDS_SECTORS

# The codes, domains, ranges and severities of the declared tests.
STATE_CODES = ("SS01", "SS02", "SS03", "SS04", "SS05", "SS06", "SS07", "SS08", "SS09", "SS10")
NEEDS_COUNTS = ("affected_population_projection_2026", *NEEDS_SECTORS, "preliminary_pin", "final_pin")


def _boundary(level: str, lower: str) -> list[U.Expectation]:
    code = f"{level}_code"
    return [
        *U.not_null(code), U.unique(code), *U.not_empty(code), *U.not_null(f"{level}_name"), *U.not_empty(f"{level}_name"),
        *U.not_null("country_code", "country_name", "geometry", "center_lat", "center_lon", "_staged_at"),
        U.accepted("country_code", "SS", severity="warn"), U.accepted("country_name", "South Sudan", severity="warn"),
        U.in_range("center_lat", 0, 15, severity="warn"), U.in_range("center_lon", 20, 40, severity="warn"),
        U.SameRows(f"{level}_boundary_row_count_unchanged", "warn", other=f"{level}_boundary"),
        U.is_true(f"{level}_code_format_valid", f"{code} rlike '^SS[0-9]{{{lower}}}$'", severity="warn"),
        U.Rows("geometry_valid", "warn", fails=lambda: ~is_valid("geometry")),
        U.Rows("center_point_within_geometry", "warn", fails=lambda: ~contains("geometry", "center_lon", "center_lat")),
    ]


SUITES: dict[str, list[U.Expectation]] = {
    "cleaned_health_facilities": U.not_null("state", "state_code", "county", "county_code", "facility_name"),
    "cleaned_education_facilities": [
        U.unique("id"),
        *U.not_null("id", "name", "adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name", "adm3_pcode", "adm3_name", "name_latin", "geometry"),
    ],
    "health_facilities": [
        U.unique("facility_hash"),
        *U.not_null(
            "facility_hash", "facility_name", "state", "state_code", "county", "county_code", "state_raw", "county_raw",
            "has_valid_state_code", "has_valid_county_code",
        ),
        U.accepted("coordinate_quality", "VALID", "MISSING", "SUSPICIOUS", severity="warn"),
        U.accepted("location_confidence", "HIGH", "MEDIUM", "LOW", severity="warn"),
    ],
    "population_estimates": [
        U.unique("population_sk"),
        *U.not_null(
            "population_sk", "population_2025", *AGE_SEX_GROUPS, "children_under_5", "children_5_17", "working_age_population",
            "elderly_population", "male_population", "female_population",
        ),
        *[U.share(c, 0.98) for c in ("admin1", "admin1_pcode", "admin2", "admin2_pcode")],
        *[U.in_range(f"pct_{g}", 0.0, 1.0, severity="warn") for g in AGE_SEX_GROUPS],
        U.accepted("record_type", "COUNTRY_TOTAL", "ADMIN2_LEVEL", "INCOMPLETE_ADMIN", severity="warn"),
        U.SameRows("equal_rowcount", other="population_estimates_2024_clean"),
    ],
    "educational_facilities": [
        U.unique("facility_id"),
        *U.not_null(
            "facility_id", "facility_name", "facility_name_latin", "adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name",
            "adm3_pcode", "adm3_name", "geometry",
        ),
        U.accepted("amenity_type", "school", "college", "university", "kindergarten", severity="warn", where="amenity_type is not null"),
        U.accepted("geometry_srid", 4326, severity="warn"),
        U.accepted("geometry_type", "ST_Point", "ST_Polygon", "ST_MultiPolygon", severity="warn"),
    ],
    "jiaf_south_sudan_2026": [
        U.unique("admin_1_p_code", "admin_2_p_code", "population_group"),
        U.Rows("final_pin_within_population", fails="round(final_pin, 0) > round(affected_population_projection_2026, 0)"),
        U.Rows("sectors_within_final_pin", fails="final_pin is not null and not (" + " and ".join(f"coalesce({s}, 0) <= final_pin" for s in NEEDS_SECTORS) + ")"),
        U.is_true("admin_1_p_code_format", "admin_1_p_code rlike '^SS[0-9]{2}$'", severity="warn"),
        U.is_true("admin_2_p_code_format", "admin_2_p_code rlike '^SS[0-9]{4}$'", severity="warn"),
        *[U.share(c, 0.99, severity="warn") for c in ("admin_1", "admin_1_p_code", "admin_2", "admin_2_p_code", "population_group")],
        U.related("admin_1_p_code", "int_state_lookup", "state_code", severity="warn"),
        U.related("admin_2_p_code", "int_county_lookup", "county_code", severity="warn"),
        *U.not_null("population_group"),
        *[U.share(c, 0.5, severity="warn") for c in NEEDS_SECTORS],
        *[U.in_range(c, 0) for c in NEEDS_COUNTS],
        U.in_range("severity", 1, 100, severity="warn"),
    ],
    "stg_state_boundary": _boundary("state", "2"),
    "stg_county_boundary": [
        *_boundary("county", "4"),
        *U.not_null("state_code", "state_name", "area_sqkm"), *U.not_empty("state_code", "state_name"),
        U.related("state_code", "stg_state_boundary", "state_code", severity="warn"),
        U.in_range("area_sqkm", 100, 70000, severity="warn"),
        U.is_true("state_code_valid", "state_code in ('" + "', '".join(STATE_CODES) + "')", severity="warn"),
        U.DistinctCount("all_states_have_counties", "warn", column="state_code", expected=10),
        U.NotAboveParent("county_area_less_than_state", "warn", key="state_code", measure="area_sqkm", parent="stg_state_boundary"),
    ],
}


def judge_model(name: str, model: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The verdicts of the suite declared for a model; ``tables`` holds what its tests compare with."""
    return U.run_suite(model, SUITES[name], tables)


def judge_all(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, test, severity, failures, status) of the suites of all given models, one scan each.

    Models stand in for each other as parents; a suite whose tables are not given is an error.
    """
    parts = [judge_model(n, models[n], models).select(F.lit(n).alias("model"), "*") for n in SUITES if n in models]
    if not parts:
        raise ValueError("no suite is declared for any of the models")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
