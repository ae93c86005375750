"""Column expressions and cleaned, staged and lookup tables (P, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.functions import keys as K
from terrasift.functions import numeric as N
from terrasift.functions import places as P
from terrasift.functions import text as X
from terrasift.plans import staging as S
from terrasift.sources.typing import normalize_column_names
from workload.registry import query, view

c = F.col

# --- shared reference formulations --------------------------------------------

_CLEAN = "nullif(regexp_replace(trim(regexp_replace({0}, '[\\x{{200B}}\\x{{200C}}\\x{{200D}}\\x{{FEFF}}\\x{{00A0}}]', ' ', 'g')), '\\s+', ' ', 'g'), '')"
_TOKENS = "('N/A','NA','-','UNKNOWN','NULL','')"


def clean(col: str) -> str:
    return _CLEAN.format(col)


def initcap(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({expr}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def placeholder(col: str) -> str:
    return f"nullif(regexp_replace(trim(case when upper(trim({col})) in {_TOKENS} then '' else {col} end), '\\s+', ' ', 'g'), '')"


def number_text(col: str) -> str:
    return f"nullif(replace(trim(case when upper(trim({col})) in {_TOKENS} then '' else {col} end), ',', ''), '')"


def guarded(col: str, kind: str) -> str:
    return f"case when regexp_matches({col}, '^-?[0-9]+(\\.[0-9]+)?$') then try_cast({col} as {kind}) end"


view(
    "state_stage",
    """select trim(adm1_pcode) state_code, trim(adm1_ref_name) state_name, trim(adm1_name) state_name_alt, trim(adm0_pcode) country_code,
       trim(adm0_name) country_name, center_lat, center_lon, area_sqkm, trim(version) as version, trim(lang) as language, x0, y0
       from state_raw where trim(adm1_pcode) <> '' and geom_ok and center_lat is not null and center_lon is not null""",
)
view(
    "county_stage",
    """select trim(adm2_pcode) county_code, trim(adm2_ref_name) county_name, trim(adm2_name) county_name_alt, trim(adm1_pcode) state_code,
       trim(adm1_name) state_name, trim(adm0_pcode) country_code, trim(adm0_name) country_name, center_lat, center_lon, area_sqkm,
       trim(version) as version, trim(lang) as language, x0, y0
       from county_raw where trim(adm2_pcode) <> '' and geom_ok and center_lat is not null and center_lon is not null""",
)
view(
    "health_stage",
    f"""select *, case when completeness_score >= 90 and coordinate_quality = 'VALID' then 'HIGH'
                 when completeness_score >= 60 then 'MEDIUM' else 'LOW' end location_confidence from (
        select md5(lower(trim(site)) || coalesce(trim(payam_code), 'unknown') || coalesce(trim(f.county_code), 'unknown')) facility_hash,
          {clean("site")} facility_name, coalesce(lower(sl.state_name), lower(trim(old_state))) state, trim(f.state_code) state_code,
          coalesce(lower(cl.county_name), lower(trim(f.county))) county, trim(f.county_code) county_code, lower(trim(payam)) payam,
          trim(payam_code) payam_code, lower(trim(old_state)) state_raw, lower(trim(f.county)) county_raw, lower(trim(payam)) payam_raw,
          coalesce(sl.state_code is not null or f.state_code = 'SS00', false) has_valid_state_code,
          cl.county_code is not null has_valid_county_code, latitude, longitude,
          case when latitude is null or longitude is null then 'MISSING'
               when latitude between 3 and 13 and longitude between 24 and 36 then 'VALID' else 'SUSPICIOUS' end coordinate_quality,
          case when latitude is not null and longitude is not null then 40 else 0 end + case when payam_code is not null then 30 else 0 end
          + case when f.county_code is not null then 20 else 0 end + case when f.state_code is not null then 10 else 0 end completeness_score
        from facility_a_raw f left join state_stage sl on f.state_code = sl.state_code left join county_stage cl on f.county_code = cl.county_code)""",
)
_G = S.AGE_SEX_GROUPS
view(
    "population_stage",
    f"""select *, case when is_country_total then 'COUNTRY_TOTAL' when admin1_pcode is null or admin2_pcode is null then 'INCOMPLETE_ADMIN'
                 else 'ADMIN2_LEVEL' end record_type from (
        select md5(coalesce(admin2_pcode, '{K.NULL_KEY_SENTINEL}')) population_sk, nullif(trim(admin1), '') admin1, upper(trim(admin1_pcode)) admin1_pcode,
          nullif(trim(admin2), '') admin2, upper(trim(admin2_pcode)) admin2_pcode, admin1_pcode is null and admin2_pcode is null is_country_total,
          cast(population_2025 as decimal(18,2)) population_2025,
          {", ".join(f"cast({g} as decimal(18,2)) {g}" for g in _G)}, {", ".join(f"cast(pct_{g} as decimal(8,6)) pct_{g}" for g in _G)},
          cast(male_under_5 + female_under_5 as decimal(18,2)) children_under_5, cast(male_5_17 + female_5_17 as decimal(18,2)) children_5_17,
          cast(male_18_60 + female_18_60 as decimal(18,2)) working_age_population, cast(male_over_60 + female_over_60 as decimal(18,2)) elderly_population,
          cast(male_under_5 + male_5_17 + male_18_60 + male_over_60 as decimal(18,2)) male_population,
          cast(female_under_5 + female_5_17 + female_18_60 + female_over_60 as decimal(18,2)) female_population,
          case when male_18_60 + female_18_60 > 0 then cast((male_under_5 + female_under_5 + male_over_60 + female_over_60) / (male_18_60 + female_18_60) as decimal(8,4)) end dependency_ratio,
          case when male_18_60 + female_18_60 > 0 then cast((male_under_5 + female_under_5 + male_5_17 + female_5_17) / (male_18_60 + female_18_60) as decimal(8,4)) end child_dependency_ratio,
          case when male_18_60 + female_18_60 > 0 then cast((male_over_60 + female_over_60) / (male_18_60 + female_18_60) as decimal(8,4)) end elderly_dependency_ratio,
          case when population_2025 > 0 then cast((male_18_60 + female_18_60) / population_2025 as decimal(8,6)) end working_age_ratio
        from population_raw)""",
)
_TEXTS = S.NEEDS_TEXT_CASE


def _need(old: str, new: str) -> str:
    if _TEXTS.get(new) == "initcap":
        return f"{initcap(placeholder(old))} as {new}"
    if _TEXTS.get(new) == "upper":
        return f"upper({placeholder(old)}) as {new}"
    kind = "decimal(3,2)" if new == "severity" else "decimal(38,10)"
    return f"{guarded(number_text(old), kind)} as {new}"


view(
    "needs_stage",
    f"select {', '.join(_need(o, n) for o, n in S.NEEDS_COLUMNS.items())} from needs_raw where col_1 is distinct from 'Admin 1' and col_2 is not null",
)
view(
    "education_stage",
    f"""select trim(id) facility_id, {clean("name")} facility_name, {clean("name_latin")} facility_name_latin,
        case when trim(amenity) = '' then null else lower(trim(amenity)) end amenity_type,
        {", ".join(f"trim(adm{i}_pcode) adm{i}_pcode, regexp_replace(trim(adm{i}_name), '\\s+', ' ', 'g') adm{i}_name" for i in (1, 2, 3))},
        case when kind in (0, 5) then 'ST_Point' else 'ST_Polygon' end geometry_type, kind not in (2, 3, 4) was_geometry_valid_before_repair,
        kind, x, y from education_raw where name is not null""",
)


def real(df, *skip):
    """Decimals as doubles, so both sides compare plain numbers."""
    return df.select(
        *[
            c(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else c(f.name)
            for f in df.schema.fields
            if f.name not in skip
        ]
    )


def staged_health(t):
    states, counties = S.state_lookup(S.stage_states(t.states)), S.county_lookup(S.stage_counties(t.counties))
    return S.stage_health(S.clean_health(t.facility_a_raw), states, counties)


def staged_population(t):
    return S.stage_population(t.population_raw)


def staged_needs(t):
    return S.stage_needs(t.needs_raw)


def staged_education(t):
    return S.stage_education(S.clean_education(t.education))


# --- P ------------------------------------------------------------------------


@query("p01_projection_rename", "select old_state as state, site as facility_name, latitude from facility_a_raw")
def _(t):
    return S.rename(t.facility_a_raw, {"old_state": "state", "site": "facility_name", "latitude": "latitude"})


@query("p02_missing_coordinates", "select row_id, latitude is null or longitude is null as missing_coordinates from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("row_id", P.missing_coordinates("latitude", "longitude").alias("missing_coordinates"))


@query("p03_not_null_filter", "select id, name from education_raw where name is not null")
def _(t):
    return S.clean_education(t.education).select("id", "name")


@query("p04_header_rollup_removal", "select col_1, col_2, col_3 from needs_raw where col_1 is distinct from 'Admin 1' and col_2 is not null")
def _(t):
    return t.needs_raw.where(~c("col_1").eqNullSafe(F.lit(S.NEEDS_HEADER)) & c("col_2").isNotNull()).select("col_1", "col_2", "col_3")


@query("p05_positional_rename", f"select {', '.join(f'{o} as {n}' for o, n in S.NEEDS_COLUMNS.items())} from needs_raw")
def _(t):
    return S.rename(t.needs_raw, S.NEEDS_COLUMNS)


@query("p06_clean_text", f"select row_id, {clean('site')} as facility_name from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("row_id", X.clean_text("site").alias("facility_name"))


@query("p07_placeholder_to_null", f"select {initcap(placeholder('col_1'))} as name, upper({placeholder('col_4')}) as code, {placeholder('col_6')} as grp from needs_raw")
def _(t):
    return t.needs_raw.select(
        X.placeholder_to_null("col_1", case="initcap").alias("name"),
        X.placeholder_to_null("col_4", case="upper").alias("code"),
        X.placeholder_to_null("col_6").alias("grp"),
    )


@query("p08_thousands_separator", "select col_4, replace(col_5, ',', '') as n from needs_raw")
def _(t):
    return t.needs_raw.select("col_4", X.strip_thousands("col_5").alias("n"))


@query("p09_safe_decimal", ", ".join([f"select cast({guarded(number_text('col_5'), 'decimal(38,10)')} as double) a"] + [f"cast({guarded(x, 'decimal(38,10)')} as double) as {x}_n" for x in ("sectoral_pin_number", "col_8", "col_9", "col_10", "col_11")]) + " from needs_raw")
def _(t):
    return real(t.needs_raw.select(N.safe_decimal(X.number_text("col_5")).alias("a"), *[N.safe_decimal(x).alias(f"{x}_n") for x in ("sectoral_pin_number", "col_8", "col_9", "col_10", "col_11")]))


@query("p10_fixed_precision", "select l_orderkey, l_linenumber, cast(cast(l_extendedprice / 3 as decimal(18,2)) as double) price, cast(cast(l_discount as decimal(8,6)) as double) disc from lineitem")
def _(t):
    return real(t.lineitem.select("l_orderkey", "l_linenumber", N.as_decimal(c("l_extendedprice") / 3, 18, 2).alias("price"), N.as_decimal("l_discount", 8, 6).alias("disc")))


@query("p11_code_normalisation", "select nullif(trim(admin1), '') a, upper(trim(admin1_pcode)) b, lower(trim(admin2)) c, upper(trim(admin2_pcode)) d from population_raw")
def _(t):
    return t.population_raw.select(X.null_if_blank(F.trim("admin1")).alias("a"), X.upper_code("admin1_pcode").alias("b"), X.lower_name("admin2").alias("c"), X.upper_code("admin2_pcode").alias("d"))


@query("p12_nan_to_null", "select l_orderkey, l_linenumber, case when l_orderkey % 7 = 0 then null else l_tax end as l_tax from lineitem")
def _(t):
    dirty = t.lineitem.select("l_orderkey", "l_linenumber", F.when(c("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(c("l_tax")).alias("l_tax"))
    return N.nan_to_null(dirty)


@query("p13_normalize_column_names", "select c_custkey as customer_key, c_name as full_name, c_mktsegment as payam_code from customer")
def _(t):
    return normalize_column_names(t.customer.select(c("c_custkey").alias("Customer Key"), c("c_name").alias("Full\nName"), c("c_mktsegment").alias("Payam_Code ")))


@query("p14_entity_key", "select row_id, md5(lower(trim(site)) || coalesce(trim(payam_code), 'unknown') || coalesce(trim(county_code), 'unknown')) k from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("row_id", K.entity_key("site", "payam_code", "county_code").alias("k"))


@query("p15_surrogate_key", f"select row_id, md5(coalesce(county_code, '{K.NULL_KEY_SENTINEL}')) one, md5(coalesce(state_code, '{K.NULL_KEY_SENTINEL}') || '-' || coalesce(payam_code, '{K.NULL_KEY_SENTINEL}')) two from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("row_id", K.surrogate_key("county_code").alias("one"), K.surrogate_key("state_code", "payam_code").alias("two"))


@query("p16_country_total_flag", "select admin2, admin1_pcode is null and admin2_pcode is null as is_country_total from population_raw")
def _(t):
    return staged_population(t).select("admin2", "is_country_total")


@query("p17_row_sums", "select admin2, male_under_5 + female_under_5 as children, male_under_5 + male_5_17 + male_18_60 + male_over_60 as men from population_raw")
def _(t):
    return t.population_raw.select("admin2", N.row_sum("male_under_5", "female_under_5").alias("children"), N.row_sum("male_under_5", "male_5_17", "male_18_60", "male_over_60").alias("men"))


@query("p18_guarded_ratios", "select population_sk, cast(dependency_ratio as double) a, cast(child_dependency_ratio as double) b, cast(elderly_dependency_ratio as double) c, cast(working_age_ratio as double) d from population_stage")
def _(t):
    return real(staged_population(t).select("population_sk", c("dependency_ratio").alias("a"), c("child_dependency_ratio").alias("b"), c("elderly_dependency_ratio").alias("c"), c("working_age_ratio").alias("d")))


@query("p19_record_type", "select population_sk, record_type from population_stage")
def _(t):
    return staged_population(t).select("population_sk", "record_type")


@query("p20_coordinate_quality", "select row_id, case when latitude is null or longitude is null then 'MISSING' when latitude between 3 and 13 and longitude between 24 and 36 then 'VALID' else 'SUSPICIOUS' end q from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("row_id", P.coordinate_quality("latitude", "longitude").alias("q"))


@query("p21_completeness_score", "select facility_hash, completeness_score from health_stage")
def _(t):
    return staged_health(t).select("facility_hash", "completeness_score")


@query("p22_location_confidence", "select facility_hash, location_confidence from health_stage")
def _(t):
    return staged_health(t).select("facility_hash", "location_confidence")


@query("p23_valid_codes", "select facility_hash, has_valid_state_code, has_valid_county_code from health_stage")
def _(t):
    return staged_health(t).select("facility_hash", "has_valid_state_code", "has_valid_county_code")


@query("p24_canonical_names", "select facility_hash, state, county from health_stage")
def _(t):
    return staged_health(t).select("facility_hash", "state", "county")


@query("p25_category", "select id, case when trim(amenity) = '' then null else lower(trim(amenity)) end as amenity_type from education_raw")
def _(t):
    return t.education_raw.select("id", X.category("amenity").alias("amenity_type"))


@query("p26_audit_timestamp", "select county_code, true as stamped from county_stage")
def _(t):
    return S.stage_counties(t.counties).select("county_code", c("_staged_at").isNotNull().alias("stamped"))


@query("p27_reference_row_filter", "select id from county_raw where trim(adm2_pcode) <> '' and geom_ok and center_lat is not null and center_lon is not null")
def _(t):
    return S.stage_counties(t.counties.withColumn("version", c("id").cast("string"))).select(c("version").cast("bigint").alias("id"))


@query("p28_match_name", "select row_id, replace(upper(trim(facility_name)), '  ', ' ') as n from facility_b_raw")
def _(t):
    return t.facility_b_raw.select("row_id", X.match_name("facility_name").alias("n"))


@query("p29_prefix_equals", "select row_id, coalesce(substr(facilities_code, 1, 4) = state_code, false) as same from facility_b_raw")
def _(t):
    return t.facility_b_raw.select("row_id", X.prefix_equals("facilities_code", "state_code").alias("same"))


@query("p30_patterns", "select row_id, coalesce(contains(type, 'PHC'), false) phc, coalesce(regexp_matches(facility_name, 'PHCU|PHCC|Hospital|Clinic|Health', 'i'), false) named from facility_b_raw")
def _(t):
    return t.facility_b_raw.select("row_id", X.has_text("type", "PHC").alias("phc"), X.has_pattern("facility_name", "PHCU|PHCC|Hospital|Clinic|Health").alias("named"))


@query("p31_range_and_membership", "select l_orderkey, l_linenumber, l_quantity between 5 and 30 as in_range, l_returnflag in ('A', 'R') as known from lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", N.in_range("l_quantity", 5, 30).alias("in_range"), c("l_returnflag").isin("A", "R").alias("known"))


ABBREVIATIONS = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}


@query("p32_abbreviations", "select o_orderkey, case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high' when '5-LOW' then 'low' end as full_name from orders")
def _(t):
    return t.orders.select("o_orderkey", X.expand_abbreviation("o_orderpriority", ABBREVIATIONS).alias("full_name"))


# --- M ------------------------------------------------------------------------


@query("m01_stage_health", "select * from health_stage")
def _(t):
    return staged_health(t)


def _reals(names):
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


_POP_DEC = ["population_2025", *_G, *[f"pct_{g}" for g in _G], "children_under_5", "children_5_17", "working_age_population", "elderly_population", "male_population", "female_population", "dependency_ratio", "child_dependency_ratio", "elderly_dependency_ratio", "working_age_ratio"]


@query("m02_stage_population", f"select population_sk, admin1, admin1_pcode, admin2, admin2_pcode, is_country_total, {_reals(_POP_DEC)}, record_type from population_stage")
def _(t):
    return real(staged_population(t))


@query("m03_stage_education", "select * exclude (kind, x, y), 4326 as geometry_srid, case when kind = 2 then 'MULTIPOLYGON' when kind in (0, 5) then 'POINT' else 'POLYGON' end as repaired_type from education_stage")
def _(t):
    return staged_education(t).withColumn("repaired_type", G.bare_type_name("geometry")).drop("geometry")


@query("m04_stage_needs", f"select {', '.join(n if n in _TEXTS else f'cast({n} as double) as {n}' for n in S.NEEDS_COLUMNS.values())} from needs_stage")
def _(t):
    return real(staged_needs(t))


@query("m05_stage_counties", "select * exclude (x0, y0), x0 as minx from county_stage")
def _(t):
    return S.stage_counties(t.counties).withColumn("minx", G.bounds("geometry")["minx"]).drop("geometry", "_staged_at", "valid_on", "valid_to")


@query("m06_stage_states", "select * exclude (x0, y0), y0 as miny from state_stage")
def _(t):
    return S.stage_states(t.states).withColumn("miny", G.bounds("geometry")["miny"]).drop("geometry", "_staged_at", "valid_on", "valid_to")


@query("m07_county_lookup", "select county_code, county_name, state_code, state_name, country_code, country_name, center_lat, center_lon, version from county_stage order by state_name, county_name")
def _(t):
    return S.county_lookup(S.stage_counties(t.counties)).drop("geometry", "valid_on", "valid_to", "_staged_at").orderBy("state_name", "county_name")


@query("m08_state_lookup", "select state_code, state_name, country_code, country_name, center_lat, center_lon, version from state_stage order by state_name")
def _(t):
    return S.state_lookup(S.stage_states(t.states)).drop("geometry", "valid_on", "valid_to", "_staged_at").orderBy("state_name")


@query("m09_orphan_counties", "select county_code, state_code from county_stage c where not exists (select 1 from state_stage s where s.state_code = c.state_code)")
def _(t):
    return S.orphan_counties(S.stage_counties(t.counties), S.stage_states(t.states)).select("county_code", "state_code")


@query("m10_clean_health", "select old_state as state, state_code, county, county_code, payam, payam_code, site as facility_name, latitude, longitude, latitude is null or longitude is null as missing_coordinates from facility_a_raw")
def _(t):
    return S.clean_health(t.facility_a_raw)


def raw_population(t):
    """The sheet as it lands, under its long column names."""
    back = {new: old for old, new in S.POPULATION_COLUMNS.items()}
    return t.population_raw.select(*[c(x).alias(back[x]) for x in t.population_raw.columns])


@query("m11_clean_population", "select * from population_raw")
def _(t):
    return S.clean_population(raw_population(t))


@query("m12_clean_education", "select id, name, amenity, adm1_pcode, adm1_name, adm2_pcode, adm2_name, adm3_pcode, adm3_name, name_latin from education_raw where name is not null")
def _(t):
    return S.clean_education(t.education).drop("geometry")


def raw_facility_type(t):
    b = t.facility_b_raw
    names = {"state": "State", "state_code": "State_Code", "county": "County", "county_code": "County_Code", "payam": "Payam", "payam_code": "Payam_Code ", "facility_name": "Facility_Name", "type": "Type", "facilities_code": "Facilities_Code", "latitude": "Latitude", "longitude": "Longitude"}
    return b.select(*[c(o).alias(n) for o, n in names.items()])


@query("m13_clean_facility_type", 'select state as "State", state_code as "State_Code", county as "County", county_code as "County_Code", payam as "Payam", payam_code as "Payam_Code ", facility_name as "Facility_Name", type as "Facility_type", facilities_code as "Facilities_Code", latitude as "Latitude", longitude as "Longitude", latitude is null or longitude is null as missing_coordinates from facility_b_raw')
def _(t):
    return S.clean_facility_type(raw_facility_type(t))


def raw_needs(t):
    back = {new: old for old, new in S.NEEDS_RAW_COLUMNS.items()}
    return t.needs_raw.select(*[c(x).alias(back[x]) for x in t.needs_raw.columns])


@query("m14_clean_needs", "select * from needs_raw")
def _(t):
    return S.clean_needs(raw_needs(t))


_PCT = "round(100.0 * count(*) filter ({0}) / count(*), 2)"
_NOXY = "latitude is null or longitude is null"


@query("m15_verify_health", f"select 'health_facilities' as table_name, count(*) as total_rows, count(distinct site) as unique_facilities, count(*) filter ({_NOXY}) as missing_coords_count, {_PCT.format(_NOXY)} as missing_coords_percent from facility_a_raw")
def _(t):
    return S.verify_health(S.clean_health(t.facility_a_raw))


@query("m16_verify_population", "select 'population_estimates_2024_clean' as table_name, count(*) as total_rows, count(distinct admin2_pcode) as unique_admin2, count(distinct admin1_pcode) as unique_admin1, round(avg(population_2025), 0) as avg_population from population_raw")
def _(t):
    return S.verify_population(S.clean_population(raw_population(t)))


@query("m17_verify_education", "select 'education_facilities' as table_name, count(*) as row_count, count(distinct id) as unique_ids from education_raw where name is not null")
def _(t):
    return S.verify_education(S.clean_education(t.education))


@query("m18_verify_facility_type", f"select 'health_facility_type' as table_name, count(*) as total_rows, count(distinct facility_name) as unique_facilities, count(distinct type) as unique_types, count(*) filter ({_NOXY}) as missing_coords_count, {_PCT.format(_NOXY)} as missing_coords_percent from facility_b_raw")
def _(t):
    return S.verify_facility_type(S.clean_facility_type(raw_facility_type(t)))


@query("m19_verify_needs", f"select 'jiaf_south_sudan_2026_clean' as table_name, count(*) as total_rows, count(distinct col_1) as unique_locations, count(*) filter (sectoral_pin_number is null) as missing_sectoral_pin, {_PCT.format('sectoral_pin_number is null')} as sectoral_pin_missing_pct from needs_raw")
def _(t):
    return S.verify_needs(S.clean_needs(raw_needs(t)))
