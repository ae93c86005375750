"""Assertions, joins, aggregates, orderings and set operations (T, H, B, E, I, J, A, W, O, U)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from terrasift.operators import assertions as T
from terrasift.operators import catalog as C
from terrasift.operators import profiling as R
from terrasift.operators import reconcile as X
from terrasift.operators.checks import Count, check_report
from terrasift.operators.joins import lookup_join, salted_join
from terrasift.operators.quantiles import exact_medians
from terrasift.plans import check_sets as CS
from terrasift.plans import staging as S
from workload.inputs import BASE
from workload.q_columns import initcap, real, staged_education, staged_health, staged_needs, staged_population
from workload.registry import query, view

c = F.col


def _issue(sql):
    return re.search(r"'(\w+)' as issue", sql).group(1)


def county_stage(t):
    return S.stage_counties(t.counties)


def state_stage(t):
    return S.stage_states(t.states)


# --- T ------------------------------------------------------------------------


@query("t01_not_null", "select row_id, county from facility_a_raw where county_code is null")
def _(t):
    return T.not_null(t.facility_a_raw, "county_code").select("row_id", "county")


@query("t02_unique", "select payam_code, count(*) as n_rows from facility_a_raw where payam_code is not null group by 1 having count(*) > 1")
def _(t):
    return T.unique(t.facility_a_raw, "payam_code")


@query("t03_accepted_values", "select type as value, count(*) as n_rows from facility_b_raw where type not in ('PHCU', 'PHCC', 'Hospital') and latitude is not null group by 1")
def _(t):
    return T.accepted_values(t.facility_b_raw, "type", ["PHCU", "PHCC", "Hospital"], where=c("latitude").isNotNull())


@query("t04_relationships", "select row_id, county_code from facility_a_raw f where county_code is not null and latitude > 5 and not exists (select 1 from county_stage k where k.county_code = f.county_code)")
def _(t):
    return T.relationships(t.facility_a_raw, "county_code", county_stage(t), "county_code", where=c("latitude") > 5).select("row_id", "county_code")


@query("t05_not_null_proportion", "select p as not_null_proportion from (select avg(case when payam_code is not null then 1.0 else 0.0 end) p from facility_a_raw) where p < 0.98")
def _(t):
    return T.not_null_proportion(t.facility_a_raw, "payam_code", 0.98)


@query("t06_accepted_range", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity < 2 or l_quantity > 48")
def _(t):
    return T.accepted_range(t.lineitem, "l_quantity", 2, 48).select("l_orderkey", "l_linenumber", "l_quantity")


@query("t07_unique_combination", "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return T.unique(t.lineitem, "l_orderkey", "l_linenumber")


@query("t08_expression_is_true", "select row_id from facility_a_raw where not (latitude < 8)")
def _(t):
    return T.expression_is_true(t.facility_a_raw, "latitude < 8").select("row_id")


@query("t09_equal_rowcount", "select a as rows_a, b as rows_b from (select (select count(*) from facility_a_raw) a, (select count(*) from facility_b_raw) b) where a <> b")
def _(t):
    return T.equal_rowcount(t.facility_a_raw, t.facility_b_raw)


@query("t10_not_empty_string", "select row_id, site from facility_a_raw where trim(site) = ''")
def _(t):
    return T.not_empty_string(t.facility_a_raw, "site").select("row_id", "site")


@query("t11_rounded_not_above", "select admin_2_p_code, cast(final_pin as double) final_pin from needs_stage where round(final_pin, 0) > round(affected_population_projection_2026, 0)")
def _(t):
    return real(T.rounded_not_above(staged_needs(t), "final_pin", "affected_population_projection_2026").select("admin_2_p_code", "final_pin"))


@query("t12_sectors_within_total", f"select admin_2_p_code, cast(final_pin as double) final_pin from needs_stage where final_pin is not null and ({' or '.join(f'coalesce({s}, 0) > final_pin' for s in S.NEEDS_SECTORS)})")
def _(t):
    return real(T.sectors_within_total(staged_needs(t), S.NEEDS_SECTORS, "final_pin").select("admin_2_p_code", "final_pin"))


@query("t13_code_format", "select admin_1_p_code, admin_2_p_code from needs_stage where not regexp_matches(admin_1_p_code, '^SS0[0-9]$') union all select admin_1_p_code, admin_2_p_code from needs_stage where not regexp_matches(admin_2_p_code, '^SS[0-9]{7}[0-8]$')")
def _(t):
    codes = staged_needs(t).select("admin_1_p_code", "admin_2_p_code")
    return T.report(T.matches(codes, "admin_1_p_code", "^SS0[0-9]$"), T.matches(codes, "admin_2_p_code", "^SS[0-9]{7}[0-8]$"))


_CLOSED = [f"SS{i:02d}" for i in range(1, 11)]


@query("t14_closed_code_list", f"select state_code as value, count(*) as n_rows from county_stage where state_code not in ({', '.join(repr(x) for x in _CLOSED)}) and state_code <> 'SS00' group by 1")
def _(t):
    return T.accepted_values(county_stage(t), "state_code", _CLOSED, where=c("state_code") != "SS00")


@query("t15_distinct_parents", "select n as measured from (select count(distinct state_code) n from county_stage where state_code <> 'SS00') where n <> 11")
def _(t):
    return T.scalar_expectation(county_stage(t).where(c("state_code") != "SS00"), F.countDistinct("state_code"), "=", 11)


@query("t16_special_code", "select 'one' as test, n as measured from (select count(*) n from county_stage where state_code = 'SS00') where n <> 99 union all select 'absent', count(*) from state_stage where state_code = 'SS07'")
def _(t):
    one = T.scalar_expectation(county_stage(t), F.count_if(c("state_code") == "SS00"), "=", 99).select(F.lit("one").alias("test"), "measured")
    gone = T.absent_from(state_stage(t), "state_code", "SS07").agg(F.lit("absent").alias("test"), F.count(F.lit(1)).alias("measured"))
    return T.report(one, gone)


@query("t17_title_case", f"select county_code, county_name from county_stage where county_name <> {initcap('county_name')}")
def _(t):
    return T.title_case(county_stage(t), "county_name").select("county_code", "county_name")


@query("t18_geometry_valid", "select id, name from education_raw where kind in (2, 3, 4)")
def _(t):
    return T.geometry_valid(t.education, "geometry").select("id", "name")


@query("t19_centroid_inside", "select county_code from county_stage where not (center_lon > x0 and center_lon < x0 + 0.5 and center_lat > y0 and center_lat < y0 + 0.5)")
def _(t):
    return T.centroid_inside(county_stage(t), "geometry", "center_lon", "center_lat").select("county_code")


@query("t20_area_within_parent", "select county_code, k.area_sqkm, s.area_sqkm as parent_measure from county_stage k join state_stage s using (state_code) where k.area_sqkm > s.area_sqkm - 49000 and k.state_code <> 'SS00'")
def _(t):
    parents = state_stage(t).select("state_code", (c("area_sqkm") - 49000).alias("area_sqkm"))
    out = T.not_above_parent(county_stage(t), parents, "state_code", "area_sqkm", where=c("state_code") != "SS00")
    return out.select("county_code", "area_sqkm", (c("parent_measure") + 49000).alias("parent_measure"))


@query("t21_centroid_ranges", "select county_code, 'lat' as what from county_stage where center_lat < 4 or center_lat > 11 union all select county_code, 'lon' from county_stage where center_lon < 25 or center_lon > 33 union all select county_code, 'area' from county_stage where area_sqkm < 100 or area_sqkm > 50000")
def _(t):
    k = county_stage(t)
    return T.report(
        *[
            T.accepted_range(k, col, lo, hi).select("county_code", F.lit(what).alias("what"))
            for what, col, lo, hi in (("lat", "center_lat", 4, 11), ("lon", "center_lon", 25, 33), ("area", "area_sqkm", 100, 50000))
        ]
    )


@query("t22_verdicts", "select 'county_code not null' as test, count(*) as failures, case when count(*) = 0 then 'pass' else 'warn' end as status from facility_a_raw where county_code is null union all select 'type known', count(*), case when count(*) = 0 then 'pass' else 'error' end from facility_b_raw where type = 'none'")
def _(t):
    return T.report(
        T.verdict(T.not_null(t.facility_a_raw, "county_code"), "county_code not null", "warn"),
        T.verdict(t.facility_b_raw.where(c("type") == "none"), "type known", "error"),
    )


# --- H ------------------------------------------------------------------------


def _fd(issue, key, value, where="true", group=None):
    return f"select {key} as failing_key, '{issue}' as issue, cast(count(distinct {value}) as double) as detail_count from health_stage where {where} group by {group or key} having count(distinct {value}) > 1"


def _n(issue, key, where, table="health_stage"):
    return f"select {key} as failing_key, '{issue}' as issue, cast(count(*) as double) as detail_count from {table} where {where} group by {key}"


_PLACE = "concat(payam_code, '|', cast(latitude as decimal(12,6)), '|', cast(longitude as decimal(12,6)))"
H_SQL = {
    "H01": _fd("state_code_multiple_names", "state_code", "state"),
    "H02": _fd("county_code_multiple_names", "county_code", "county"),
    "H03": _fd("payam_code_multiple_names", "payam_code", "payam"),
    "H04": _fd("payam_in_multiple_counties", "payam_code", "county_code", "payam_code is not null"),
    "H05": _fd("county_in_multiple_states", "county_code", "state_code", "county_code is not null"),
    "H06": _fd("duplicate_facility_same_location", "facility_name", "facility_hash", "latitude is not null and longitude is not null", "facility_name, payam_code, latitude, longitude"),
    "H07": _fd("duplicate_facility_different_location", "facility_name", _PLACE),
    "H08": _n("suspicious_coordinates", "facility_name", "coordinate_quality = 'SUSPICIOUS'"),
    "H09": _n("low_location_confidence", "facility_name", "location_confidence = 'LOW'"),
    "H10": _n("payam_code_without_name", "payam_code", "payam_code is not null and payam is null"),
    "H11": _n("payam_name_without_code", "payam", "payam is not null and payam_code is null"),
    "H12": _fd("state_raw_mismatch", "state_code", "state_raw", "has_valid_state_code"),
    "H13": _fd("county_raw_mismatch", "county_code", "county_raw", "has_valid_county_code"),
    "H14": _n("invalid_state_code", "state_code", "not has_valid_state_code and state_code <> 'SS00'"),
    "H15": _n("invalid_county_code", "county_code", "not has_valid_county_code"),
}
for _i, _sql in H_SQL.items():
    query(f"{_i.lower()}_{_issue(_sql)}", _sql)(lambda t, i=_i: real(CS.health_report(staged_health(t), [i])))


@query("h_report", " union all ".join(H_SQL.values()))
def _(t):
    return real(CS.health_report(staged_health(t)))


# --- B ------------------------------------------------------------------------


def _gap(issue, expr, tol):
    return f"select admin2_pcode as failing_key, '{issue}' as issue, cast(abs({expr}) as double) as detail_count from population_stage where abs({expr}) > {tol}"


_ALL = " + ".join(CS.AGE_SEX_GROUPS)
_SHARES = [f"pct_{g}" for g in CS.AGE_SEX_GROUPS]
_RATIO = "cast(dependency_ratio as double) - cast(children_under_5 + children_5_17 + elderly_population as double) / nullif(cast(working_age_population as double), 0)"
_COUNTRY = "is_country_total"
B_SQL = {
    "B01": "select admin2_pcode as failing_key, 'admin2_pcode_duplicate' as issue, cast(count(*) as double) as detail_count from population_stage where not is_country_total and admin2_pcode is not null group by 1 having count(*) > 1",
    "B02": _gap("population_age_sum_mismatch", f"population_2025 - ({_ALL})", 100),
    "B03": _gap("population_sex_sum_mismatch", "population_2025 - (male_population + female_population)", 100),
    "B04": _gap("child_under_5_sum_mismatch", "children_under_5 - (male_under_5 + female_under_5)", 50),
    "B05": _gap("percentages_sum_deviation", f"{' + '.join(_SHARES)} - 1", 0.01),
    "B06": _n("negative_population_value", "admin2_pcode", " or ".join(f"{x} < 0" for x in ("population_2025", *CS.AGE_SEX_GROUPS)), "population_stage"),
    "B07": _n("invalid_percentage", "admin2_pcode", " or ".join(f"{x} < 0 or {x} > 1" for x in _SHARES), "population_stage"),
    "B08": _n("population_less_than_subgroup", "admin2_pcode", " or ".join(f"population_2025 < {x}" for x in CS.AGE_SEX_GROUPS), "population_stage"),
    "B09": _gap("working_age_sum_mismatch", "working_age_population - (male_18_60 + female_18_60)", 50),
    "B10": _gap("elderly_sum_mismatch", "elderly_population - (male_over_60 + female_over_60)", 50),
    "B11": f"select admin2_pcode as failing_key, 'dependency_ratio_mismatch' as issue, cast(cast(abs({_RATIO}) as decimal(38,6)) as double) as detail_count from population_stage where not is_country_total and working_age_population > 0 and abs({_RATIO}) > 0.001",
    "B12": _n("invalid_record_type", "admin2_pcode", "(is_country_total and record_type <> 'COUNTRY_TOTAL') or (not is_country_total and admin1_pcode is not null and admin2_pcode is not null and record_type <> 'ADMIN2_LEVEL') or (not is_country_total and (admin1_pcode is null or admin2_pcode is null) and record_type <> 'INCOMPLETE_ADMIN')", "population_stage"),
    "B13": _n("invalid_working_age_ratio", "admin2_pcode", "working_age_ratio < 0 or working_age_ratio > 1", "population_stage"),
    "B14": _gap("child_5_17_sum_mismatch", "children_5_17 - (male_5_17 + female_5_17)", 50),
    "B15": _gap("male_population_sum_mismatch", "male_population - (male_under_5 + male_5_17 + male_18_60 + male_over_60)", 50),
    "B16": _gap("female_population_sum_mismatch", "female_population - (female_under_5 + female_5_17 + female_18_60 + female_over_60)", 50),
    "B17": "select * from (select 'country_has_admin_code' as failing_key, 'admin2_present_on_country_row' as issue, cast(count(*) as double) as detail_count from population_stage where is_country_total and (admin1_pcode is not null or admin2_pcode is not null)) where detail_count <> 0",
    "B18": "select * from (select 'country_total_count' as failing_key, 'country_total_count_mismatch' as issue, cast(count(*) - 1 as double) as detail_count from population_stage where is_country_total) where detail_count <> 0",
}


# Derived sums and labels thrown off on some rows: the checks that stay silent on consistent data must speak here.
_DERIVED = ("children_under_5", "working_age_population", "elderly_population", "children_5_17", "male_population", "female_population")
view(
    "population_broken",
    f"select * replace ({', '.join(f'{d} + case when length(admin2) % 2 = 0 then 6000 else 0 end as {d}' for d in _DERIVED)}, case when admin2 like '%7' then 'ADMIN1' else record_type end as record_type, is_country_total or admin2 like '%5' as is_country_total) from population_stage",
)
_BROKEN = ("B04", "B09", "B10", "B12", "B14", "B15", "B16", "B17", "B18")


def broken_population(t):
    off = F.when(F.length("admin2") % 2 == 0, F.lit(6000)).otherwise(F.lit(0))
    return staged_population(t).withColumns(
        {
            **{d: (c(d) + off) for d in _DERIVED},
            "record_type": F.when(c("admin2").like("%7"), F.lit("ADMIN1")).otherwise(c("record_type")),
            "is_country_total": c("is_country_total") | F.coalesce(c("admin2").like("%5"), F.lit(False)),
        }
    )


for _i, _sql in B_SQL.items():
    if _i in _BROKEN:
        _sql = _sql.replace("population_stage", "population_broken")
    query(f"{_i.lower()}_{_issue(_sql)}", _sql)(
        lambda t, i=_i: real(CS.population_report((broken_population if i in _BROKEN else staged_population)(t), [i]))
    )


@query("b_report", " union all ".join(B_SQL.values()))
def _(t):
    return real(CS.population_report(staged_population(t)))


@query("b11_model_definition", "select admin2_pcode as failing_key, 'dependency_ratio_mismatch' as issue, cast(cast(d as decimal(38,6)) as double) as detail_count from (select admin2_pcode, abs(cast(dependency_ratio as double) - cast(children_under_5 + elderly_population as double) / nullif(cast(working_age_population as double), 0)) d from population_broken where not is_country_total and working_age_population > 0) where d > 0.001")
def _(t):
    return real(CS.population_report(broken_population(t), ["B11"], dependency="model"))


# --- E ------------------------------------------------------------------------


def _efd(issue, key, value):
    return f"select {key} as failing_key, '{issue}' as issue, cast(count(distinct {value}) as double) as detail_count from education_stage group by {key} having count(distinct {value}) > 1"


_SHAPE = "case when kind in (0, 5) then 0 else kind end, x, y"
E_SQL = {
    "E01": _efd("adm1_pcode_multiple_names", "adm1_pcode", "adm1_name"),
    "E02": _efd("adm2_pcode_multiple_names", "adm2_pcode", "adm2_name"),
    "E03": _efd("adm3_pcode_multiple_names", "adm3_pcode", "adm3_name"),
    "E04": _efd("adm3_pcode_multiple_adm2_parents", "adm3_pcode", "adm2_pcode"),
    "E05": f"select facility_name as failing_key, 'duplicate_facility_same_location' as issue, cast(count(distinct facility_id) as double) as detail_count from education_stage group by facility_name, adm3_pcode, {_SHAPE} having count(distinct facility_id) > 1",
    "E06": "select facility_id as failing_key, 'geometry_invalid_after_repair' as issue, cast(1 as double) as detail_count from education_stage where kind = 3",
}
for _i, _sql in E_SQL.items():
    query(f"{_i.lower()}_{_issue(_sql)}", _sql)(lambda t, i=_i: real(CS.education_report(staged_education(t), [i])))


@query("e_report", " union all ".join(E_SQL.values()))
def _(t):
    return real(CS.education_report(staged_education(t)))


# --- I ------------------------------------------------------------------------

I_SQL = {
    "I01": "select 'admin_1_pcode_name_mismatch' as check_name, m.admin_1_p_code as p_code, m.admin_1 as model_value, s.state_name as lookup_value from needs_stage m join state_stage s on m.admin_1_p_code = s.state_code where lower(trim(m.admin_1)) is distinct from lower(trim(s.state_name))",
    "I02": "select 'admin_2_pcode_name_mismatch' as check_name, m.admin_2_p_code as p_code, m.admin_2 as model_value, k.county_name as lookup_value from needs_stage m join county_stage k on m.admin_2_p_code = k.county_code where lower(trim(m.admin_2)) is distinct from lower(trim(k.county_name))",
    "I03": "select 'admin_2_not_child_of_admin_1' as check_name, m.admin_2_p_code as p_code, m.admin_1_p_code as model_value, k.state_code as lookup_value from needs_stage m join county_stage k on m.admin_2_p_code = k.county_code where m.admin_1_p_code is distinct from k.state_code",
}
_I_NAMES = {"I01": "admin1_name_mismatch", "I02": "admin2_name_mismatch", "I03": "admin2_not_child"}
for _i, _sql in I_SQL.items():
    query(f"{_i.lower()}_{_I_NAMES[_i]}", _sql)(lambda t, i=_i: CS.needs_report(staged_needs(t), state_stage(t), county_stage(t), [i]))


@query("i_report", " union all ".join(I_SQL.values()))
def _(t):
    return CS.needs_report(staged_needs(t), state_stage(t), county_stage(t))


# --- J ------------------------------------------------------------------------


@query("j01_lookup_left_join", "select l_orderkey, l_linenumber, s_name, s_acctbal from lineitem left join (select * from supplier where s_suppkey % 9 <> 0) on l_suppkey = s_suppkey")
def _(t):
    s = t.supplier.where(c("s_suppkey") % 9 != 0).select(c("s_suppkey").alias("l_suppkey"), "s_name", "s_acctbal")
    return lookup_join(t.lineitem, s, "l_suppkey").select("l_orderkey", "l_linenumber", "s_name", "s_acctbal")


@query("j01_lookup_left_join_salted", "select l_orderkey, l_linenumber, s_name from lineitem left join (select * from supplier where s_suppkey % 9 <> 0) on l_suppkey = s_suppkey")
def _(t):
    s = t.supplier.where(c("s_suppkey") % 9 != 0).select(c("s_suppkey").alias("l_suppkey"), "s_name")
    return salted_join(t.lineitem, s, ["l_suppkey"], "left", salts=4).select("l_orderkey", "l_linenumber", "s_name")


@query("j02_left_anti", "select county_code from county_stage c where not exists (select 1 from state_stage s where s.state_code = c.state_code)")
def _(t):
    return S.orphan_counties(county_stage(t), state_stage(t)).select("county_code")


@query("j03_join_with_residual", "select o_orderkey, c_mktsegment as lookup_value from orders join customer on o_custkey = c_custkey where o_orderpriority is distinct from c_mktsegment")
def _(t):
    return T.mismatch(t.orders, "o_custkey", "o_orderpriority", t.customer, "c_custkey", "c_mktsegment", False).select("o_orderkey", "lookup_value")


@query("j04_referential_existence", "select o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_custkey % 10 <> 3)")
def _(t):
    return T.relationships(t.orders, "o_custkey", t.customer.where(c("c_custkey") % 10 != 3), "c_custkey").select("o_orderkey")


@query("j05_measure_within_parent", "select l_orderkey, l_linenumber from lineitem join orders on l_orderkey = o_orderkey where l_extendedprice > o_totalprice")
def _(t):
    parents = t.orders.select(c("o_orderkey").alias("l_orderkey"), c("o_totalprice").alias("l_extendedprice"))
    return T.not_above_parent(t.lineitem, parents, "l_orderkey", "l_extendedprice").select("l_orderkey", "l_linenumber")


@query("j10_containment", "select distinct a.value_a, b.value_b from (select distinct old_state value_a from facility_a_raw where length(old_state) > 0) a, (select distinct state value_b from facility_b_raw where length(state) > 0) b where contains(upper(value_a), upper(value_b)) or contains(upper(value_b), upper(value_a))")
def _(t):
    return X.containment_matches(t.facility_a_raw, "old_state", t.facility_b_raw, "state")


@query("j11_case_insensitive_match", "select value_a, coalesce(min(b.state), 'NO MATCH') as value_b from (select distinct old_state value_a from facility_a_raw where old_state is not null) left join facility_b_raw b on upper(b.state) = upper(value_a) group by 1")
def _(t):
    return X.variant_mapping(t.facility_a_raw, "old_state", t.facility_b_raw, "state")


@query("j12_first_row_per_key", "select facility_name as key, arg_min_null(latitude, row_id) as lat_b, arg_min_null(longitude, row_id) as lon_b from facility_b_raw where facility_name is not null group by 1")
def _(t):
    return X.first_places(t.facility_b_raw, "facility_name", "latitude", "longitude", "row_id", "b")


@query("j13_catalogue_with_counts", " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in BASE))
def _(t):
    return C.row_counts({n: getattr(t, n) for n in BASE})


@query("j14_fk_check", "select case when count(*) = 0 then 'OK' else 'FAIL' end as status, count(*) as missing_values, (select string_agg(v, ', ' order by v) from (select cast(k as varchar) v from (select distinct o_custkey k from orders where o_custkey not in (select c_custkey from customer where c_custkey % 10 <> 3)) order by v limit 5)) as samples from (select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_custkey % 10 <> 3))")
def _(t):
    return R.fk_check(t.orders, "o_custkey", t.customer.where(c("c_custkey") % 10 != 3), "c_custkey")


# --- A ------------------------------------------------------------------------


@query("a01_conditional_aggregates", "select count(*) as n, count(distinct l_suppkey) as suppliers, count(*) filter (l_returnflag = 'R') as returned, round(100.0 * count(*) filter (l_returnflag = 'R') / count(*), 2) as pct, round(avg(l_quantity), 0) as avg_q from lineitem")
def _(t):
    returned = c("l_returnflag") == "R"
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_suppkey").alias("suppliers"), F.count_if(returned).alias("returned"), S._percent(returned).alias("pct"), F.round(F.avg("l_quantity"), 0).alias("avg_q"))


@query("a02_functional_dependency", "select l_suppkey as key, count(distinct l_returnflag) as n_values from lineitem group by 1 having count(distinct l_returnflag) > 1")
def _(t):
    return T.functional_dependency(t.lineitem, "l_suppkey", "l_returnflag")


@query("a03_repeated_keys", "select cast(l_orderkey as varchar) as failing_key, 'repeated' as issue, cast(count(*) as double) as detail_count from lineitem group by l_orderkey having count(*) > 1")
def _(t):
    return real(check_report(t.lineitem, [Count("repeated", c("l_orderkey"), above=1)]))


@query("a04_repeated_places", "select facility_name, count(distinct facility_hash) as n from health_stage where latitude is not null and longitude is not null group by facility_name, latitude, longitude having count(distinct facility_hash) > 1")
def _(t):
    h = staged_health(t).where(c("latitude").isNotNull() & c("longitude").isNotNull())
    return h.groupBy("facility_name", "latitude", "longitude").agg(F.countDistinct("facility_hash").alias("n")).where("n > 1").select("facility_name", "n")


@query("a05_distinct_concatenation", "select o_custkey, count(distinct concat(o_orderstatus, '|', o_orderpriority)) as n from orders group by 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.countDistinct(F.concat_ws("", "o_orderstatus", F.lit("|"), "o_orderpriority")).alias("n"))


@query("a06_count_with_offset", "select count(*) - 1 as surplus from orders where o_orderpriority = '1-URGENT'")
def _(t):
    return t.orders.agg((F.count_if(c("o_orderpriority") == "1-URGENT") - 1).alias("surplus"))


@query("a07_values_per_key", "select county as key, count(distinct state) as n_values, min(state) as first_value, max(state) as last_value from facility_b_raw where county is not null group by 1")
def _(t):
    return X.value_mapping(t.facility_b_raw, "county", "state")


@query("a08_value_counts", "select l_suppkey as value, count(*) as n from lineitem group by 1")
def _(t):
    return R.frequencies(t.lineitem, "l_suppkey")


@query("a09_numeric_summary", "select min(l_extendedprice) as min, max(l_extendedprice) as max, round(avg(l_extendedprice), 4) as mean, round(stddev_samp(l_extendedprice), 4) as std, count(*) filter (l_extendedprice < 0) as negatives, count(*) filter (l_extendedprice = 0) as zeros from dirty_line")
def _(t):
    p = R.numeric_profile(t.dirty_line, ["l_extendedprice"])
    return p.select("min", "max", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "negatives", "zeros")


@query("a10_median_spread", "select l_returnflag, round(avg(l_extendedprice), 4) as mean, median(l_extendedprice) as med, max(l_extendedprice) as top, round(stddev_samp(l_extendedprice), 4) as std from lineitem group by 1")
def _(t):
    p = c("l_extendedprice")
    rest = t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg(p), 4).alias("mean"), F.max(p).alias("top"), F.round(F.stddev_samp(p), 4).alias("std"))
    return rest.join(exact_medians(t.lineitem, "l_extendedprice", ["l_returnflag"], "med"), "l_returnflag")


@query("a11_first_value_per_group", "select state as key, arg_min(state_code, row_id) as value from facility_b_raw where state is not null and state_code is not null group by 1")
def _(t):
    return X.first_value(t.facility_b_raw, "state", "state_code", "row_id")


@query("a12_group_sizes", "select count(*) as n_groups, count(*) filter (n > 1) as n_duplicate_groups, max(n) as max_group_size from (select count(*) n from lineitem group by l_orderkey, l_linenumber)")
def _(t):
    return R.group_sizes(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("a13_duplicate_rows", "select count(*) as total_rows, (select count(*) from (select distinct * exclude (doc_id) from documents)) as distinct_rows, count(*) - (select count(*) from (select distinct * exclude (doc_id) from documents)) as duplicate_rows from documents")
def _(t):
    # The key alone would make every row differ.
    return R.duplicate_rows(t.documents.drop("doc_id"))


@query("a14_length_distribution", "select cast(length(name) as int) as length, count(*) as n_rows from education_raw group by 1")
def _(t):
    return X.length_distribution(t.education_raw, "name")


@query("a15_duplicated_values", "select count(*) - count(distinct facilities_code) as duplicates from facility_b_raw")
def _(t):
    return R.duplicate_rows(t.facility_b_raw.select("facilities_code")).select(c("duplicate_rows").alias("duplicates"))


# --- W, O, U -------------------------------------------------------------------


@query("w00_first_row_per_key", "select o_custkey as key, arg_min(o_orderstatus, o_orderkey) as value from orders group by 1")
def _(t):
    return X.first_value(t.orders, "o_custkey", "o_orderstatus", "o_orderkey")


@query("w00_top_values_per_group", "select l_suppkey, l_quantity, n, rank from (select *, row_number() over (partition by l_suppkey order by n desc, l_quantity) as rank from (select l_suppkey, l_quantity, count(*) n from lineitem group by 1, 2)) where rank <= 3")
def _(t):
    return R.top_per_group(t.lineitem, "l_suppkey", "l_quantity", 3).withColumn("rank", c("rank").cast("bigint"))


@query("o01_order_by", "select county_code, state_name from county_stage order by state_name, county_code")
def _(t):
    return county_stage(t).select("county_code", "state_name").orderBy("state_name", "county_code")


@query("o02_priority_order", "select o_orderkey, o_orderpriority from orders order by case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 else 9 end")
def _(t):
    return C.by_priority(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1})


@query("o03_top_rows", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def _(t):
    return C.top_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query("o04_limit_preview", "select c_custkey, c_name from customer order by c_custkey limit 3")
def _(t):
    return C.preview(t.customer.select("c_custkey", "c_name").orderBy("c_custkey"), 3)


@query("o05_find_one", "select c_custkey, c_name from customer where c_name = 'Customer#000000007' and c_custkey = 7")
def _(t):
    return C.find_one(t.customer.select("c_custkey", "c_name"), c_name="Customer#000000007", c_custkey=7)


@query("u01_union_report", "select 'a' as side, count(*) as n from facility_a_raw union all select 'b', count(*) from facility_b_raw")
def _(t):
    return T.report(*[df.agg(F.lit(s).alias("side"), F.count(F.lit(1)).alias("n")) for s, df in (("a", t.facility_a_raw), ("b", t.facility_b_raw))])


@query("u02_intersection", "select payam from facility_a_raw intersect select payam from facility_b_raw where payam is not null")
def _(t):
    return X.common_keys(t.facility_a_raw, t.facility_b_raw, "payam")


@query("u03_difference", "select payam from facility_a_raw where payam is not null except select payam from facility_b_raw")
def _(t):
    return X.only_in_first(t.facility_a_raw, t.facility_b_raw, "payam")


@query("u04_distinct", "select distinct payam_code from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("payam_code").distinct()
