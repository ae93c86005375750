"""Cleaned tables, staging tables and lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.functions import numeric as N
from terrasift.functions import places as P
from terrasift.functions import text as X
from terrasift.functions.keys import entity_key, surrogate_key
from terrasift.operators.joins import lookup_join
from terrasift.plans.check_sets import AGE_SEX_GROUPS

# Fixed value: a state code that is valid although no state row carries it.
SPECIAL_STATE = "SS00"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project the listed columns under their new names, dropping the rest."""
    return df.select(*[_c(old).alias(new) for old, new in names.items()])


# --- cleaned tables ----------------------------------------------------------

# Source column -> cleaned column.
HEALTH_COLUMNS = {
    "old_state": "state", "state_code": "state_code", "county": "county", "county_code": "county_code",
    "payam": "payam", "payam_code": "payam_code", "site": "facility_name",
    "latitude": "latitude", "longitude": "longitude",
}
FACILITY_TYPE_COLUMNS = {
    "State": "State", "State_Code": "State_Code", "County": "County", "County_Code": "County_Code",
    "Payam": "Payam", "Payam_Code ": "Payam_Code ", "Facility_Name": "Facility_Name",
    "Type": "Facility_type", "Facilities_Code": "Facilities_Code", "Latitude": "Latitude", "Longitude": "Longitude",
}
EDUCATION_COLUMNS = (
    "id", "name", "amenity", "adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name",
    "adm3_pcode", "adm3_name", "name_latin", "geometry",
)
POPULATION_COLUMNS = {
    "admin1": "admin1", "admin1_pcode": "admin1_pcode", "admin2": "admin2", "admin2_pcode": "admin2_pcode",
    "population_-_2025": "population_2025",
    "%_male_children__under_5": "pct_male_under_5",
    "no._of_male_children_under_5": "male_under_5",
    "%_female_children_under_5": "pct_female_under_5",
    "no._of_female_children_under_5": "female_under_5",
    "%_male_children__aged_5_-_17_years": "pct_male_5_17",
    "no._of_male_children__aged_5_-_17_years": "male_5_17",
    "%_female_children__aged_5_-_17_years": "pct_female_5_17",
    "no._of_female__children_aged_5_-_17_years": "female_5_17",
    "%_male_adults__aged_18_-_60": "pct_male_18_60",
    "no._of__male__adults_aged_18_-_60": "male_18_60",
    "%_female_adults__aged_18_-_60": "pct_female_18_60",
    "no._of_female__adults_aged_18_-_60": "female_18_60",
    "%_male_adults__aged_over_60": "pct_male_over_60",
    "no._of_male_adults__aged_over_60": "male_over_60",
    "%_female_adults__aged_over_60": "pct_female_over_60",
    "no._female_adults__aged_over_60": "female_over_60",
}
NEEDS_RAW_COLUMNS = {
    "location": "col_1", "unnamed:_1": "col_2", "unnamed:_2": "col_3", "unnamed:_3": "col_4",
    "populaton": "col_5", "unnamed:_8": "col_6", "sectoral_pin_(number)": "sectoral_pin_number",
    "unnamed:_10": "col_7", "unnamed:_11": "col_8", "unnamed:_12": "col_9", "unnamed:_13": "col_10",
    "unnamed:_14": "col_11", "unnamed:_15": "col_12", "unnamed:_16": "col_13", "unnamed:_17": "col_14",
    "unnamed:_18": "col_15", "unnamed:_19": "col_16",
}
NEEDS_COLUMNS = {
    "col_1": "admin_1", "col_2": "admin_1_p_code", "col_3": "admin_2", "col_4": "admin_2_p_code",
    "col_5": "affected_population_projection_2026", "col_6": "population_group", "sectoral_pin_number": "cccm",
    "col_7": "education", "col_8": "nutrition", "col_9": "food_security", "col_10": "health",
    "col_11": "overarching_protection", "col_12": "shelter", "col_13": "wash", "col_14": "severity",
    "col_15": "preliminary_pin", "col_16": "final_pin",
}
NEEDS_HEADER = "Admin 1"
NEEDS_SECTORS = (
    "cccm", "education", "nutrition", "food_security", "health", "overarching_protection", "shelter", "wash",
)
NEEDS_TEXT_CASE = {
    "admin_1": "initcap", "admin_1_p_code": "upper", "admin_2": "initcap", "admin_2_p_code": "upper",
    "population_group": "initcap",
}


def clean_health(raw: DataFrame) -> DataFrame:
    """M10."""
    return rename(raw, HEALTH_COLUMNS).withColumn(
        "missing_coordinates", P.missing_coordinates("latitude", "longitude")
    )


def clean_population(raw: DataFrame) -> DataFrame:
    """M11."""
    return rename(raw, POPULATION_COLUMNS)


def clean_education(raw: DataFrame) -> DataFrame:
    """Named facilities only."""
    return raw.where(F.col("name").isNotNull()).select(*EDUCATION_COLUMNS)


def clean_facility_type(raw: DataFrame) -> DataFrame:
    """M13."""
    return rename(raw, FACILITY_TYPE_COLUMNS).withColumn(
        "missing_coordinates", P.missing_coordinates("Latitude", "Longitude")
    )


def clean_needs(raw: DataFrame) -> DataFrame:
    """M14."""
    return rename(raw, NEEDS_RAW_COLUMNS)


def _percent(flag: Column) -> Column:
    return F.round(F.lit(100.0) * F.count_if(flag) / F.count(F.lit(1)), 2)


def verify_health(cleaned: DataFrame) -> DataFrame:
    """M15 / A1."""
    missing = F.col("missing_coordinates")
    return cleaned.agg(
        F.lit("health_facilities").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("facility_name").alias("unique_facilities"),
        F.count_if(missing).alias("missing_coords_count"),
        _percent(missing).alias("missing_coords_percent"),
    )


def verify_population(cleaned: DataFrame) -> DataFrame:
    """M16 / A1."""
    return cleaned.agg(
        F.lit("population_estimates_2024_clean").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("admin2_pcode").alias("unique_admin2"),
        F.countDistinct("admin1_pcode").alias("unique_admin1"),
        F.round(F.avg("population_2025"), 0).alias("avg_population"),
    )


def verify_education(cleaned: DataFrame) -> DataFrame:
    """M17 / A1."""
    return cleaned.agg(
        F.lit("education_facilities").alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("id").alias("unique_ids"),
    )


def verify_facility_type(cleaned: DataFrame) -> DataFrame:
    """M18 / A1."""
    missing = F.col("missing_coordinates")
    return cleaned.agg(
        F.lit("health_facility_type").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("Facility_Name").alias("unique_facilities"),
        F.countDistinct("Facility_type").alias("unique_types"),
        F.count_if(missing).alias("missing_coords_count"),
        _percent(missing).alias("missing_coords_percent"),
    )


def verify_needs(cleaned: DataFrame) -> DataFrame:
    """M19 / A1."""
    missing = F.col("sectoral_pin_number").isNull()
    return cleaned.agg(
        F.lit("jiaf_south_sudan_2026_clean").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("col_1").alias("unique_locations"),
        F.count_if(missing).alias("missing_sectoral_pin"),
        _percent(missing).alias("sectoral_pin_missing_pct"),
    )


# --- boundaries and lookups --------------------------------------------------


def _boundary(raw: DataFrame, own: Mapping[str, str], key: str) -> DataFrame:
    shared = {"adm1_pcode": "state_code", "adm1_name": "state_name", "adm0_pcode": "country_code", "adm0_name": "country_name"}
    names = {**own, **{k: v for k, v in shared.items() if v not in own.values()}}
    return raw.where(
        (F.trim(F.col(key)) != "")
        & F.col("geometry").isNotNull()
        & F.col("center_lat").isNotNull()
        & F.col("center_lon").isNotNull()
    ).select(
        *[F.trim(F.col(old)).alias(new) for old, new in names.items()],
        "geometry",
        "center_lat",
        "center_lon",
        "area_sqkm",
        F.trim(F.col("version")).alias("version"),
        F.trim(F.col("lang")).alias("language"),
        "valid_on",
        "valid_to",
        F.current_timestamp().alias("_staged_at"),
    )


def stage_counties(raw: DataFrame) -> DataFrame:
    """M5: P11, P26, P27."""
    return _boundary(
        raw, {"adm2_pcode": "county_code", "adm2_ref_name": "county_name", "adm2_name": "county_name_alt"}, "adm2_pcode"
    )


def stage_states(raw: DataFrame) -> DataFrame:
    """M6: P11, P26, P27."""
    return _boundary(
        raw, {"adm1_pcode": "state_code", "adm1_ref_name": "state_name", "adm1_name": "state_name_alt"}, "adm1_pcode"
    )


_LOOKUP_TAIL = ("country_code", "country_name", "geometry", "center_lat", "center_lon", "version", "valid_on", "valid_to", "_staged_at")


def county_lookup(counties: DataFrame) -> DataFrame:
    """M7: lean projection; order it with ``write_ordered`` when materialising."""
    return counties.select("county_code", "county_name", "state_code", "state_name", *_LOOKUP_TAIL)


def state_lookup(states: DataFrame) -> DataFrame:
    """M8."""
    return states.select("state_code", "state_name", *_LOOKUP_TAIL)


def orphan_counties(counties: DataFrame, states: DataFrame) -> DataFrame:
    """Counties whose state has no row of its own."""
    return lookup_join(counties, states.select("state_code").distinct(), "state_code", "left_anti")


# --- staging tables ----------------------------------------------------------


def stage_health(
    cleaned: DataFrame,
    states: DataFrame,
    counties: DataFrame,
    special: tuple[str, ...] = (SPECIAL_STATE,),
    box: P.Box = P.MODEL_BOX,
) -> DataFrame:
    """M1: facilities with canonical names, code validity and location quality.

    The lookups are joined on the codes as they came, before trimming, so a
    code with stray spaces stays invalid.
    """
    state_keys = states.select("state_code", F.col("state_name").alias("_state"), F.lit(True).alias("_state_hit"))
    county_keys = counties.select("county_code", F.col("county_name").alias("_county"), F.lit(True).alias("_county_hit"))
    joined = lookup_join(cleaned, state_keys, "state_code")
    joined = lookup_join(joined, county_keys, "county_code")
    c = F.col
    has_place = c("latitude").isNotNull() & c("longitude").isNotNull()
    score = N.weighted_score(
        [
            (has_place, 40),
            (c("payam_code").isNotNull(), 30),
            (c("county_code").isNotNull(), 20),
            (c("state_code").isNotNull(), 10),
        ]
    )
    # Scores come in their own projection so that later labels read them instead of recomputing them.
    tidy = joined.select(
        entity_key("facility_name", "payam_code", "county_code").alias("facility_hash"),
        X.clean_text("facility_name").alias("facility_name"),
        P.canonical_name("_state", "state").alias("state"),
        F.trim(c("state_code")).alias("state_code"),
        P.canonical_name("_county", "county").alias("county"),
        F.trim(c("county_code")).alias("county_code"),
        X.lower_name("payam").alias("payam"),
        F.trim(c("payam_code")).alias("payam_code"),
        X.lower_name("state").alias("state_raw"),
        X.lower_name("county").alias("county_raw"),
        X.lower_name("payam").alias("payam_raw"),
        P.valid_code("state_code", "_state_hit", special).alias("has_valid_state_code"),
        P.valid_code("county_code", "_county_hit").alias("has_valid_county_code"),
        "latitude",
        "longitude",
        P.coordinate_quality("latitude", "longitude", box).alias("coordinate_quality"),
        score.alias("completeness_score"),
    )
    return tidy.withColumn("location_confidence", P.location_confidence("completeness_score", "coordinate_quality"))


def stage_population(cleaned: DataFrame) -> DataFrame:
    """M2."""
    d = {g: F.col(g).cast("decimal(28,10)") for g in AGE_SEX_GROUPS}
    count = lambda e: e.cast("decimal(18,2)")
    under5 = d["male_under_5"] + d["female_under_5"]
    school = d["male_5_17"] + d["female_5_17"]
    working = d["male_18_60"] + d["female_18_60"]
    elderly = d["male_over_60"] + d["female_over_60"]
    men = d["male_under_5"] + d["male_5_17"] + d["male_18_60"] + d["male_over_60"]
    women = d["female_under_5"] + d["female_5_17"] + d["female_18_60"] + d["female_over_60"]
    # Ratios divide doubles, whatever numeric type the counts arrived in.
    real = lambda e: e.cast("double")
    country = F.col("admin1_pcode").isNull() & F.col("admin2_pcode").isNull()
    staged = cleaned.select(
        surrogate_key("admin2_pcode").alias("population_sk"),
        X.null_if_blank(F.trim("admin1")).alias("admin1"),
        X.upper_code("admin1_pcode").alias("admin1_pcode"),
        X.null_if_blank(F.trim("admin2")).alias("admin2"),
        X.upper_code("admin2_pcode").alias("admin2_pcode"),
        country.alias("is_country_total"),
        N.as_decimal("population_2025", 18, 2).alias("population_2025"),
        *[N.as_decimal(g, 18, 2).alias(g) for g in AGE_SEX_GROUPS],
        *[N.as_decimal(f"pct_{g}", 8, 6).alias(f"pct_{g}") for g in AGE_SEX_GROUPS],
        count(under5).alias("children_under_5"),
        count(school).alias("children_5_17"),
        count(working).alias("working_age_population"),
        count(elderly).alias("elderly_population"),
        count(men).alias("male_population"),
        count(women).alias("female_population"),
        N.guarded_ratio(real(under5 + elderly), real(working), 8, 4).alias("dependency_ratio"),
        N.guarded_ratio(real(under5 + school), real(working), 8, 4).alias("child_dependency_ratio"),
        N.guarded_ratio(real(elderly), real(working), 8, 4).alias("elderly_dependency_ratio"),
        N.guarded_ratio(real(working), F.col("population_2025").cast("double"), 8, 6).alias("working_age_ratio"),
    )
    no_admin = F.col("admin1_pcode").isNull() | F.col("admin2_pcode").isNull()
    return staged.withColumn(
        "record_type",
        N.label_first([("COUNTRY_TOTAL", F.col("is_country_total")), ("INCOMPLETE_ADMIN", no_admin)], "ADMIN2_LEVEL"),
    )


def stage_education(cleaned: DataFrame) -> DataFrame:
    """M3: text cleaning plus geometry type, validity and bounded repair."""
    tidy = cleaned.select(
        F.trim("id").alias("facility_id"),
        X.clean_text("name").alias("facility_name"),
        X.clean_text("name_latin").alias("facility_name_latin"),
        X.category("amenity").alias("amenity_type"),
        *[
            e
            for level in (1, 2, 3)
            for e in (
                F.trim(f"adm{level}_pcode").alias(f"adm{level}_pcode"),
                X.collapse_spaces(f"adm{level}_name").alias(f"adm{level}_name"),
            )
        ],
        F.col("geometry").alias("_raw"),
        G.is_valid("geometry").alias("was_geometry_valid_before_repair"),
    )
    fixed = G.make_valid("_raw", valid=F.coalesce(F.col("was_geometry_valid_before_repair"), F.lit(True)))
    return tidy.select(
        "facility_id", "facility_name", "facility_name_latin", "amenity_type",
        "adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name", "adm3_pcode", "adm3_name",
        fixed.alias("geometry"),
        G.srid_of("_raw").alias("geometry_srid"),
        G.type_name("_raw").alias("geometry_type"),
        "was_geometry_valid_before_repair",
    )


def stage_needs(cleaned: DataFrame) -> DataFrame:
    """M4: header and roll-up rows out, positional names in, text cleaned, numbers cast when safe."""
    kept = cleaned.where(~F.col("col_1").eqNullSafe(F.lit(NEEDS_HEADER)) & F.col("col_2").isNotNull())
    named = rename(kept, NEEDS_COLUMNS)
    text = named.select(
        *[
            (X.placeholder_to_null(n, case=NEEDS_TEXT_CASE[n]) if n in NEEDS_TEXT_CASE else X.number_text(n)).alias(n)
            for n in NEEDS_COLUMNS.values()
        ]
    )
    return text.select(
        *[
            F.col(n)
            if n in NEEDS_TEXT_CASE
            else (N.safe_decimal(n, 3, 2) if n == "severity" else N.safe_decimal(n)).alias(n)
            for n in NEEDS_COLUMNS.values()
        ]
    )
