"""Declared suites (T): each model's tests in one scan, compared with one SQL text for each test."""

from __future__ import annotations

from terrasift.plans import staging as S
from terrasift.plans.check_sets import AGE_SEX_GROUPS
from terrasift.plans.suites import judge_model
from workload.q_assertions import county_stage, state_stage
from workload.q_columns import staged_education, staged_health, staged_needs, staged_population
from workload.registry import query


def _rows(name, table, where, severity="error"):
    return f"select '{name}' as test, '{severity}' as severity, count(*) as failures from {table} where {where}"


def _null(table, *cols):
    return [_rows(f"not_null_{c}", table, f"{c} is null") for c in cols]


def _empty(table, *cols):
    return [_rows(f"not_empty_string_{c}", table, f"trim({c}) = ''") for c in cols]


def _range(table, c, low, high, severity="error"):
    return _rows(f"accepted_range_{c}", table, " or ".join([f"{c} < {low}"] + ([f"{c} > {high}"] if high is not None else [])), severity)


def _twice(name, table, keys, where="true"):
    return f"select '{name}', 'error', count(*) from (select 1 from {table} where {where} group by {keys} having count(*) > 1)"


def _other(c, table, values, severity="warn"):
    return f"select 'accepted_values_{c}', '{severity}', count(distinct {c}) from {table} where {c} not in ({values})"


def _share(c, table, least, severity="error"):
    return f"select 'not_null_proportion_{c}', '{severity}', cast(count(*) > 0 and count({c}) < {least} * count(*) as bigint) from {table}"


def _orphans(c, table, parent, key):
    return _rows(f"relationships_{c}", f"{table} k", f"{c} is not null and not exists (select 1 from {parent} p where p.{key} = k.{c})", "warn")


def _same(name, table, other, severity):
    return f"select '{name}', '{severity}', abs((select count(*) from {table}) - (select count(*) from {other}))"


def _suite(*tests):
    flat = [x for t in tests for x in (t if isinstance(t, list) else [t])]
    return f"select test, severity, failures, case when failures = 0 then 'pass' else severity end as status from ({' union all '.join(flat)}) r(test, severity, failures)"


def _boundary(level, digits, outside):
    t = f"{level}_stage"
    return [
        *_null(t, f"{level}_code"), _twice(f"unique_{level}_code", t, f"{level}_code"), *_empty(t, f"{level}_code", f"{level}_name"),
        *_null(t, f"{level}_name", "country_code", "country_name", "center_lat", "center_lon"),
        *[f"select 'not_null_{c}', 'error', 0" for c in ("geometry", "_staged_at")],
        _other("country_code", t, "'SS'"), _other("country_name", t, "'South Sudan'"),
        _range(t, "center_lat", 0, 15, "warn"), _range(t, "center_lon", 20, 40, "warn"),
        _same(f"{level}_boundary_row_count_unchanged", t, f"{level}_raw", "warn"),
        _rows(f"{level}_code_format_valid", t, f"not regexp_matches({level}_code, '^SS[0-9]{{{digits}}}$')", "warn"),
        "select 'geometry_valid', 'warn', 0",
        _rows("center_point_within_geometry", t, outside, "warn"),
    ]


@query("t_suite_health", _suite(
    _twice("unique_facility_hash", "health_stage", "facility_hash", "facility_hash is not null"),
    _null("health_stage", "facility_hash", "facility_name", "state", "state_code", "county", "county_code", "state_raw", "county_raw", "has_valid_state_code", "has_valid_county_code"),
    _other("coordinate_quality", "health_stage", "'VALID', 'MISSING', 'SUSPICIOUS'"), _other("location_confidence", "health_stage", "'HIGH', 'MEDIUM', 'LOW'"),
))
def _(t):
    return judge_model("health_facilities", staged_health(t))


@query("t_suite_cleaned_health", _suite(*[_rows(f"not_null_{c}", "facility_a_raw", f"{old} is null") for c, old in (("state", "old_state"), ("state_code", "state_code"), ("county", "county"), ("county_code", "county_code"), ("facility_name", "site"))]))
def _(t):
    return judge_model("cleaned_health_facilities", S.clean_health(t.facility_a_raw))


@query("t_suite_cleaned_education", _suite(
    _twice("unique_id", "(select * from education_raw where name is not null)", "id"),
    _null("(select *, x as geometry from education_raw where name is not null)", "id", "name", "adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name", "adm3_pcode", "adm3_name", "name_latin", "geometry"),
))
def _(t):
    return judge_model("cleaned_education_facilities", S.clean_education(t.education))


@query("t_suite_population", _suite(
    _twice("unique_population_sk", "population_stage", "population_sk", "population_sk is not null"),
    _null("population_stage", "population_sk", "population_2025", *AGE_SEX_GROUPS, "children_under_5", "children_5_17", "working_age_population", "elderly_population", "male_population", "female_population"),
    [_share(c, "population_stage", 0.98) for c in ("admin1", "admin1_pcode", "admin2", "admin2_pcode")],
    [_range("population_stage", f"pct_{g}", 0, 1, "warn") for g in AGE_SEX_GROUPS],
    _other("record_type", "population_stage", "'COUNTRY_TOTAL', 'ADMIN2_LEVEL', 'INCOMPLETE_ADMIN'"),
    _same("equal_rowcount", "population_stage", "population_raw", "error"),
))
def _(t):
    return judge_model("population_estimates", staged_population(t), {"population_estimates_2024_clean": t.population_raw})


@query("t_suite_education", _suite(
    _twice("unique_facility_id", "education_stage", "facility_id", "facility_id is not null"),
    _null("(select *, x as geometry from education_stage)", "facility_id", "facility_name", "facility_name_latin", "adm1_pcode", "adm1_name", "adm2_pcode", "adm2_name", "adm3_pcode", "adm3_name", "geometry"),
    _other("amenity_type", "education_stage", "'school', 'college', 'university', 'kindergarten'"),
    "select 'accepted_values_geometry_srid', 'warn', 0", _other("geometry_type", "education_stage", "'ST_Point', 'ST_Polygon', 'ST_MultiPolygon'"),
))
def _(t):
    return judge_model("educational_facilities", staged_education(t))


@query("t_suite_needs", _suite(
    _twice("unique_admin_1_p_code_admin_2_p_code_population_group", "needs_stage", "admin_1_p_code, admin_2_p_code, population_group"),
    _rows("final_pin_within_population", "needs_stage", "round(final_pin, 0) > round(affected_population_projection_2026, 0)"),
    _rows("sectors_within_final_pin", "needs_stage", "final_pin is not null and (" + " or ".join(f"coalesce({s}, 0) > final_pin" for s in S.NEEDS_SECTORS) + ")"),
    _rows("admin_1_p_code_format", "needs_stage", "not regexp_matches(admin_1_p_code, '^SS[0-9]{2}$')", "warn"),
    _rows("admin_2_p_code_format", "needs_stage", "not regexp_matches(admin_2_p_code, '^SS[0-9]{4}$')", "warn"),
    [_share(c, "needs_stage", 0.99, "warn") for c in ("admin_1", "admin_1_p_code", "admin_2", "admin_2_p_code", "population_group")],
    _orphans("admin_1_p_code", "needs_stage", "state_stage", "state_code"), _orphans("admin_2_p_code", "needs_stage", "county_stage", "county_code"),
    _null("needs_stage", "population_group"),
    [_share(c, "needs_stage", 0.5, "warn") for c in S.NEEDS_SECTORS],
    [_range("needs_stage", c, 0, None) for c in ("affected_population_projection_2026", *S.NEEDS_SECTORS, "preliminary_pin", "final_pin")],
    _range("needs_stage", "severity", 1, 100, "warn"),
))
def _(t):
    lookups = {"int_state_lookup": S.state_lookup(state_stage(t)), "int_county_lookup": S.county_lookup(county_stage(t))}
    return judge_model("jiaf_south_sudan_2026", staged_needs(t), lookups)


@query("t_suite_states", _suite(*_boundary("state", 2, "not (center_lon > x0 and center_lon < x0 + 5 and center_lat > y0 and center_lat < y0 + 2 and not (center_lon > x0 + 2 and center_lat > y0 + 1))")))
def _(t):
    return judge_model("stg_state_boundary", state_stage(t), {"state_boundary": t.states})


@query("t_suite_counties", _suite(
    *_boundary("county", 4, "not (center_lon > x0 and center_lon < x0 + 0.5 and center_lat > y0 and center_lat < y0 + 0.5)"),
    _null("county_stage", "state_code", "state_name", "area_sqkm"), _empty("county_stage", "state_code", "state_name"),
    _orphans("state_code", "county_stage", "state_stage", "state_code"), _range("county_stage", "area_sqkm", 100, 70000, "warn"),
    _rows("state_code_valid", "county_stage", "state_code not in ('SS01', 'SS02', 'SS03', 'SS04', 'SS05', 'SS06', 'SS07', 'SS08', 'SS09', 'SS10')", "warn"),
    "select 'all_states_have_counties', 'warn', cast(count(distinct state_code) <> 10 as bigint) from county_stage",
    "select 'county_area_less_than_state', 'warn', count(*) from county_stage k join state_stage s using (state_code) where k.area_sqkm > s.area_sqkm",
))
def _(t):
    return judge_model("stg_county_boundary", county_stage(t), {"county_boundary": t.counties, "stg_state_boundary": state_stage(t)})
