"""Two-dataset comparison and geometry queries (X, J6-J9, J15, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.functions.places import RULE_BOX
from terrasift.functions.text import match_name
from terrasift.operators import reconcile as X
from terrasift.operators.overview import described
from terrasift.operators import spatial as SP
from workload.inputs import NOTCHED, polygon
from workload.q_columns import real
from workload.registry import query, view

c = F.col

# --- inputs --------------------------------------------------------------------

_COLS = ("row_id", "state", "state_code", "county", "payam", "facility_name", "latitude", "longitude")


def side_a(t):
    a = t.facility_a_raw.select("row_id", c("old_state").alias("state"), "state_code", "county", "payam", c("site").alias("facility_name"), "latitude", "longitude")
    return _keyed(a)


def side_b(t):
    return _keyed(t.facility_b_raw.select(*_COLS, c("type").alias("facility_type"), c("facilities_code").alias("facility_code")))


def _keyed(df):
    return df.withColumn("name_key", match_name("facility_name")).withColumn("state_key", F.upper("state")).withColumn("county_key", F.upper("county"))


_KEYED = "replace(upper(regexp_replace(facility_name, '^\\s+|\\s+$', '', 'g')), '  ', ' ') name_key, upper(state) state_key, upper(county) county_key"
view("side_a", f"select *, {_KEYED} from (select row_id, old_state state, state_code, county, payam, site facility_name, latitude, longitude from facility_a_raw)")
view("side_b", f"select *, {_KEYED} from (select row_id, state, state_code, county, payam, facility_name, latitude, longitude, type facility_type, facilities_code facility_code from facility_b_raw)")

KEY_SETS = {"name": ["name_key"], "name+state": ["name_key", "state_key"], "name+state+county": ["name_key", "state_key", "county_key"]}


def pct(part, whole, digits=1):
    return f"round_even(100.0 * cast({part} as double) / nullif({whole}, 0), {digits})"


# --- X -------------------------------------------------------------------------


def _over(x, kind, numeric):
    v = f"cast({x} as double)" if numeric else "cast(null as double)"
    return f"select 'supplier' as \"table\", '{x}' as column, '{kind}' as data_type, count(*) as n_rows, count({x}) as n_values, round(avg({v}), 4) as mean, round(stddev_samp({v}), 4) as std, min({v}) as min, max({v}) as max from supplier"


@query("x01_overview", " union all ".join([_over("s_suppkey", "bigint", True), _over("s_name", "string", False), _over("s_nationkey", "int", True), _over("s_acctbal", "double", True)]))
def _(t):
    return X.overview(t.supplier, "supplier").withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


def _text_column(table, c, kind):
    n = f"from (select {c} v, count(*) n from {table} where {c} is not null group by 1)"
    return f"select '{table}' as \"table\", '{c}' as \"column\", '{kind}' as data_type, (select count(*) from {table}) as n_rows, (select count({c}) from {table}) as n_values, (select count(*) {n}) as \"unique\", (select v {n} order by n desc, v limit 1) as top, (select max(n) {n}) as freq, null as mean, null as std, null as min, null as q25, null as q50, null as q75, null as max"


def _number_column(table, c, kind):
    quartiles = ", ".join(f"quantile_cont(cast({c} as double), {q}) as q{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    return f"select '{table}', '{c}', '{kind}', count(*), count({c}), null, null, null, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4), min(cast({c} as double)), {quartiles}, max(cast({c} as double)) from {table}"


@query("x01_describe_all", " union all ".join(
    [_text_column("facility_b_raw", c, "string") for c in ("state", "state_code", "county", "county_code", "payam", "payam_code", "facility_name", "type", "facilities_code")]
    + [_number_column("facility_b_raw", *c) for c in (("row_id", "bigint"), ("latitude", "double"), ("longitude", "double"))]
    + [_number_column("lineitem", *c) for c in (("l_orderkey", "bigint"), ("l_quantity", "double"), ("l_linenumber", "int"), ("l_extendedprice", "double"))]
    + [_text_column("lineitem", c, k) for c, k in (("l_returnflag", "string"), ("l_shipdate", "timestamp_ntz"))]
))
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    both = described(t.facility_b_raw, "facility_b_raw").unionByName(described(lines, "lineitem"))
    return both.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("x02_mapping_summary", "select count(*) as n_keys, count(*) filter (n > 1) as n_ambiguous from (select state_code, count(distinct state) n from side_a where state_code is not null group by 1)")
def _(t):
    return X.mapping_summary(side_a(t), "state_code", "state")


@query("x02_mapping_values", "select state_code as key, state as value, count(*) as n_rows from side_a where state is not null and state_code in (select state_code from side_a where state_code is not null group by 1 having count(distinct state) > 1) group by 1, 2")
def _(t):
    return X.mapping_values(side_a(t), "state_code", "state")


@query("x03_level_completeness", " union all ".join(f"select '{x}' as column, count(*) filter ({x} is null) as missing, {pct(f'count(*) filter ({x} is null)', 'count(*)')} as missing_percent from side_a" for x in ("payam", "state_code")))
def _(t):
    return X.level_completeness(side_a(t), ["payam", "state_code"])


@query("x04_overlap", f"select *, {pct('n_common', 'n_a')} as pct_a_in_b, {pct('n_common', 'n_b')} as pct_b_in_a from (select count(*) filter (a) as n_a, count(*) filter (b) as n_b, count(*) filter (a and b) as n_common, count(*) filter (a and not b) as n_only_a, count(*) filter (b and not a) as n_only_b from (select k, bool_or(s = 1) a, bool_or(s = 2) b from (select name_key k, 1 s from side_a union all select name_key, 2 from side_b) where k is not null group by 1))")
def _(t):
    return X.overlap(side_a(t), side_b(t), "name_key")


def _agree(x):
    return f"select '{x}' as attribute, count(*) as matched, count(*) filter (upper(a.{x}) = upper(b.{x})) as agree, {pct(f'count(*) filter (upper(a.{x}) = upper(b.{x}))', 'count(*)')} as agree_percent, count(*) - count(*) filter (upper(a.{x}) = upper(b.{x})) as disagree from side_a a join side_b b using (name_key)"


@query("x05_agreement", " union all ".join(_agree(x) for x in ("state", "county", "payam")))
def _(t):
    return X.agreement(side_a(t), side_b(t), "name_key", [("state", "state"), ("county", "county"), ("payam", "payam")])


@query("x05_disagreeing_keys", "select name_key as key, count(*) as pairs, count(*) filter (not coalesce(upper(a.state) = upper(b.state), false)) as disagree from side_a a join side_b b using (name_key) group by 1 having count(*) filter (not coalesce(upper(a.state) = upper(b.state), false)) > 0")
def _(t):
    return X.disagreeing_keys(side_a(t), side_b(t), "name_key", "state", "state")


@query("x06_casing", "select 'state' as column, bool_and(state = lower(state)) as all_lower from side_a union all select 'county', bool_and(county = lower(county)) from side_a")
def _(t):
    return X.casing(side_a(t), ["state", "county"])


@query("x06_variant_mapping", "select value_a, coalesce(min(b.county), 'NO MATCH') as value_b from (select distinct county value_a from side_a where county is not null) left join side_b b on upper(b.county) = upper(value_a) group by 1")
def _(t):
    return X.variant_mapping(side_a(t), "county", side_b(t), "county")


@query("x07_name_standardisation", "select distinct a.value_a, b.value_b from (select distinct 'x' || county value_a from side_a) a, (select distinct county value_b from side_b) b where contains(upper(value_a), upper(value_b)) or contains(upper(value_b), upper(value_a))")
def _(t):
    return X.containment_matches(side_a(t).select(F.concat(F.lit("x"), "county").alias("county")), "county", side_b(t), "county")


# A holds abbreviations, B the names spelled out in several ways.
_SHORT = f"(array[{', '.join(repr(x) for x in X.STATE_NAMES)}, 'jong', 'Upper Nile', 'x'])"
_LONG = f"(array[{', '.join(repr(x) for x in X.STATE_NAMES.values())}, 'Nile', 'Bahr El'])"
_SPELLED = " ".join(f"when '{k}' then '{v}'" for k, v in X.STATE_NAMES.items())


@query("x07_abbreviations", f"""
    select name, full_name, exists (select 1 from b where value = full_name) as found_in_b,
           (select count(*) from b where contains(upper(value), upper(full_name))) as n_containing,
           (select count(*) from b where contains(upper(full_name), upper(value)) and upper(value) <> upper(full_name)) as n_contained,
           (select min(value) from b where contains(upper(value), upper(full_name)) or contains(upper(full_name), upper(value))) as first_match
    from (select distinct name, case name {_SPELLED} else name end as full_name from (select {_SHORT}[1 + o_orderkey % 14] || case when o_orderkey % 50 = 0 then ' ' || o_orderkey else '' end as name from orders)) a
""".replace("from b", "from (select distinct value from (select case when c_custkey % 5 = 0 then upper(v) when c_custkey % 7 = 0 then v || ' State' when c_custkey % 60 = 1 then v || ' ' || c_custkey else v end as value from (select c_custkey, " + _LONG + "[1 + c_custkey % 13] as v from customer)))"))
def _(t):
    def pick(k, n, words):
        return F.element_at(F.array(*[F.lit(x) for x in words]), (1 + F.col(k) % n).cast("int"))

    short = pick("o_orderkey", 14, (*X.STATE_NAMES, "jong", "Upper Nile", "x"))
    key, v = F.col("c_custkey"), pick("c_custkey", 13, (*X.STATE_NAMES.values(), "Nile", "Bahr El"))
    a = t.orders.select(F.concat(short, F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))).otherwise("")).alias("state"))
    b = t.customer.select(F.when(key % 5 == 0, F.upper(v)).when(key % 7 == 0, F.concat(v, F.lit(" State"))).when(key % 60 == 1, F.concat(v, F.lit(" "), key.cast("string"))).otherwise(v).alias("state"))
    return X.containment_summary(a, "state", b, "state", X.STATE_NAMES)


@query("x08_business_key", f"select cast(sum(n) as bigint) as total_rows, count(k) as unique_keys, {pct('(sum(n) - count(k))', 'sum(n)')} as duplicate_rate, sum(n) = count(k) as is_business_key, count(*) filter (k is not null and n > 1) as duplicate_keys, max(n) filter (k is not null) as max_per_key from (select facility_code k, count(*) n from side_b group by 1)")
def _(t):
    return X.business_key(side_b(t), "facility_code")


@query("x08_prefix_agreement", f"select count(*) as total_rows, count(*) filter (substr(facility_code, 1, 4) = state_code) as prefix_matches, {pct('count(*) filter (substr(facility_code, 1, 4) = state_code)', 'count(*)')} as match_percent from side_b")
def _(t):
    return X.prefix_agreement(side_b(t), "facility_code", "state_code")


@query("x08_code_lengths", "select cast(length(facility_code) as int) as length, count(*) as n_rows from side_b group by 1")
def _(t):
    return X.length_distribution(side_b(t), "facility_code")


_GONE = "count(*) filter (latitude is null or longitude is null)"


@query("x09_coordinate_coverage", f"select 'A' as dataset, count(*) - {_GONE} as with_coordinates, {pct(f'(count(*) - {_GONE})', 'count(*)')} as coverage_percent, {_GONE} as missing, {pct(_GONE, 'count(*)')} as missing_percent from side_a")
def _(t):
    return X.coordinate_coverage(side_a(t), "latitude", "longitude", "A")


def _first(s):
    return f"(select name_key, arg_min_null(latitude, row_id) lat, arg_min_null(longitude, row_id) lon from side_{s} where name_key is not null group by 1)"


_DIST = f"(select name_key, a.lat lat_a, a.lon lon_a, b.lat lat_b, b.lon lon_b, sqrt(pow((a.lat - b.lat) * 111.32, 2) + pow((a.lon - b.lon) * 111.32 * cos(radians(a.lat)), 2)) km from {_first('a')} a join {_first('b')} b using (name_key) where a.lat is not null and a.lon is not null and b.lat is not null and b.lon is not null)"
_BANDS = {"exact_match": "km < 0.001", "minor_diff": "km >= 0.001 and km < 1", "major_diff": "km >= 5"}


@query("x10_coordinate_compare", f"select count(*) as n_common, round(avg(lat_a - lat_b), 6) as mean_lat_diff, round(avg(lon_a - lon_b), 6) as mean_lon_diff, round(avg(km), 6) as mean_km, round(median(km), 6) as median_km, round(max(km), 6) as max_km, round(stddev_samp(km), 6) as std_km, {', '.join(f'count(*) filter ({v}) as {k}, {pct(f'count(*) filter ({v})', 'count(*)')} as {k}_percent' for k, v in _BANDS.items())} from {_DIST}")
def _(t):
    out = X.coordinate_compare(side_a(t), side_b(t), "name_key", "latitude", "longitude", "row_id")
    return out.withColumns({x: F.round(x, 6) for x in ("mean_lat_diff", "mean_lon_diff", "mean_km", "median_km", "max_km", "std_km")})


@query("x10_coordinate_distances", f"select name_key as key, round(km, 6) as distance_km, case when km < 0.001 then 'exact' when km < 1 then 'minor' when km >= 5 then 'major' else 'moderate' end as band from {_DIST}")
def _(t):
    out = X.coordinate_distances(side_a(t), side_b(t), "name_key", "latitude", "longitude", "row_id")
    return out.select("key", F.round("distance_km", 6).alias("distance_km"), "band")


@query("x11_duplicate_coordinates", "select round_even(latitude, 4) as lat, round_even(longitude, 4) as lon, count(*) as n_rows from side_a where latitude is not null and longitude is not null group by 1, 2 having count(*) > 1")
def _(t):
    return X.duplicate_coordinates(side_a(t), "latitude", "longitude")


@query("x11_duplicate_summary", "select count(*) as n_clusters, max(n) as max_per_place from (select count(*) n from side_b where latitude is not null and longitude is not null group by round_even(latitude, 1), round_even(longitude, 1) having count(*) > 1)")
def _(t):
    return X.duplicate_coordinate_summary(side_b(t), "latitude", "longitude", 1)


def _ws(x):
    a, b, d = f"count(*) filter (starts_with({x}, ' '))", f"count(*) filter (suffix({x}, ' '))", f"count(*) filter (contains({x}, '  '))"
    return f"select '{x}' as column, {a} as leading, {b} as trailing, {d} as multiple, {a} + {b} + {d} as total from side_a"


@query("x12_whitespace_issues", " union all ".join(_ws(x) for x in ("state", "county", "payam", "facility_name")))
def _(t):
    return X.whitespace_issues(side_a(t), ["state", "county", "payam", "facility_name"])


@query("x13_category_distribution", f"select facility_type as category, count(*) as n_rows, {pct('count(*)', '(select count(*) from side_b)')} as percent from side_b where contains(facility_type, 'PHC') group by 1")
def _(t):
    return X.category_distribution(side_b(t), "facility_type", c("facility_type").contains("PHC"))


@query("x13_pattern_share", f"select count(*) as total_rows, count(*) filter (regexp_matches(facility_name, 'PHCU|PHCC|Hospital|Clinic|Health', 'i')) as with_pattern, {pct("count(*) filter (regexp_matches(facility_name, 'PHCU|PHCC|Hospital|Clinic|Health', 'i'))", 'count(*)')} as percent from side_b")
def _(t):
    return X.pattern_share(side_b(t), "facility_name", "PHCU|PHCC|Hospital|Clinic|Health")


def _strategy(name, keys):
    n = f"(select count(*) from side_a join side_b using ({', '.join(keys)}))"
    return f"select '{name}' as strategy, {n} as matched, {pct(n, '(select count(*) from side_a)')} as rate_a, {pct(n, '(select count(*) from side_b)')} as rate_b"


@query("x14_join_strategies", " union all ".join(_strategy(n, k) for n, k in KEY_SETS.items()))
def _(t):
    return X.strategies(side_a(t), side_b(t), KEY_SETS)


for _q, (_n, _k) in zip(("j06_match_on_name", "j07_match_on_name_state", "j08_match_on_name_state_county"), KEY_SETS.items()):
    query(_q, _strategy(_n, _k))(lambda t, n=_n, k=_k: X.strategies(side_a(t), side_b(t), {n: k}))


@query("j06_match_null_safe", f"select 'name' as strategy, n as matched, {pct('n', '(select count(*) from side_a)')} as rate_a, {pct('n', '(select count(*) from side_b)')} as rate_b from (select count(*) n from side_a a join side_b b on a.name_key is not distinct from b.name_key)")
def _(t):
    return X.strategies(side_a(t), side_b(t), {"name": ["name_key"]}, null_safe_keys=True)


def _un(a, b):
    return f"select '{a}' as side, row_id from side_{a} x where not exists (select 1 from side_{b} y where x.name_key is not distinct from y.name_key and x.state_key is not distinct from y.state_key)"


@query("x15_unmatched", f"{_un('a', 'b')} union all {_un('b', 'a')}")
def _(t):
    a, b, keys = side_a(t), side_b(t), ["name_key", "state_key"]
    one, two = X.unmatched_sides(a, b, keys)
    return one.select(F.lit("a").alias("side"), "row_id").unionByName(two.select(F.lit("b").alias("side"), "row_id"))


@query("j09_unmatched_first_side", "select row_id from side_a x where not exists (select 1 from side_b y where x.name_key = y.name_key and x.county_key = y.county_key)")
def _(t):
    return X.unmatched(side_a(t), side_b(t), ["name_key", "county_key"], null_safe_keys=False).select("row_id")


@query("x16_match_risk", "select name_key as key, count(*) as matches from side_a join side_b using (name_key, state_key) group by 1 having count(*) > 1")
def _(t):
    return X.match_risk(side_a(t), side_b(t), ["name_key", "state_key"], "name_key")


def _rules(s, name):
    dep = lambda rule, key, attr: f"select '{rule}' as rule, count(*) filter (n > 1) as violations, count(*) as total from (select {key}, count(distinct {attr}) n from side_{s} where {key} is not null group by 1)"
    gone = "(latitude is null or longitude is null)"
    box = f"latitude between {RULE_BOX.lat_min} and {RULE_BOX.lat_max} and longitude between {RULE_BOX.lon_min} and {RULE_BOX.lon_max}"
    one = lambda rule, v, total="count(*)": f"select '{rule}' as rule, count(*) filter ({v}) as violations, {total} as total from side_{s}"
    parts = [
        one("1 every facility has coordinates", gone),
        one("2 every facility has a payam", "payam is null"),
        dep("3 one code per state", "state", "state_code"),
        dep("4 one state per county", "county", "state"),
        dep("5 one county per payam", "payam", "county"),
        f"select '6 names unique within a payam', count(*) filter (n > 1), count(*) from (select count(*) n from side_{s} where payam is not null and facility_name is not null group by payam, facility_name)",
        one("7 coordinates within bounds", f"not {gone} and not ({box})", f"count(*) filter (not {gone})"),
    ]
    if s == "b":
        parts.append(one("8 facility type is valid", "coalesce(facility_type not in ('PHCU', 'PHCC', 'Hospital'), true)"))
        parts.append("select '9 facility code is unique', count(*) - count(distinct facility_code), count(*) from side_b")
    return f"select rule, '{name}' as dataset, violations, total, case when violations = 0 then 'PASS' else 'VIOLATION' end as verdict from ({' union all '.join(parts)})"


@query("x17_business_rules", f"{_rules('a', 'A')} union all {_rules('b', 'B')}")
def _(t):
    return X.facility_rules(side_a(t), "A", RULE_BOX).unionByName(X.facility_rules(side_b(t), "B", RULE_BOX))


def _keys(s):
    return f"(select count(distinct name_key) from side_{s})"


_COMMON = "(select count(*) from (select name_key from side_a intersect select name_key from side_b) where name_key is not null)"


def _cov(s):
    return f"(select {pct(f'(count(*) - {_GONE})', 'count(*)')} from side_{s})"


def _failed(s):
    return f"(select cast(count(*) filter (verdict = 'VIOLATION') as double) from ({_rules(s, '')}))"


@query("x18_scorecard", f"select 'overlap' as investigation, {pct(_COMMON, _keys('a'))} as result_a, {pct(_COMMON, _keys('b'))} as result_b union all select 'match rate ' || strategy, rate_a, rate_b from ({' union all '.join(_strategy(n, k) for n, k in KEY_SETS.items())}) union all select 'coordinate coverage', {_cov('a')}, {_cov('b')} union all select 'business rules violated', {_failed('a')}, {_failed('b')}")
def _(t):
    return X.scorecard(side_a(t), side_b(t), "name_key", KEY_SETS, RULE_BOX)


# --- G -------------------------------------------------------------------------


@query("g01_type_and_srid", "select id, case when kind in (0, 5) then 'ST_Point' else 'ST_Polygon' end as full_name, case when kind in (0, 5) then 'POINT' else 'POLYGON' end as bare, 4326 as srid from education_raw")
def _(t):
    return t.education.select("id", G.type_name("geometry").alias("full_name"), G.bare_type_name("geometry").alias("bare"), G.srid_of("geometry").alias("srid"))


@query("g02_validity", "select id, kind not in (2, 3, 4) as valid from education_raw")
def _(t):
    return t.education.select("id", G.is_valid("geometry").alias("valid"))


@query("g03_repair", "select id, case when kind = 2 then 'MultiPolygon' when kind in (0, 5) then 'Point' else 'Polygon' end as gtype, kind <> 3 as valid from education_raw")
def _(t):
    fixed = t.education.select("id", G.make_valid("geometry").alias("g"))
    return fixed.select("id", c("g.gtype").alias("gtype"), G.is_valid("g").alias("valid"))


_DX = {0: (0, 0), 1: (0, 0.5), 2: (0, 1), 3: (-3, 3), 4: (0, 1), 5: (0, 0)}
_DY = {0: (0, 0), 1: (0, 0.5), 2: (0, 1), 3: (-3, 3), 4: (0, 1), 5: (0, 0)}


def _case(offsets, i):
    return "case kind " + " ".join(f"when {k} then cast({v[i]} as double)" for k, v in offsets.items()) + " end"


@query("g04_bounds", f"select id, x + {_case(_DX, 0)} as minx, y + {_case(_DY, 0)} as miny, x + {_case(_DX, 1)} as maxx, y + {_case(_DY, 1)} as maxy from education_raw")
def _(t):
    return t.education.select("id", G.bounds("geometry").alias("b")).select("id", "b.*")


@query("g05_make_point", "select row_id, longitude as x, latitude as y, 3857 as srid from facility_a_raw where latitude is not null and longitude is not null")
def _(t):
    p = t.facility_a_raw.select("row_id", G.make_point("longitude", "latitude", 3857).alias("g")).where(c("g").isNotNull())
    return p.select("row_id", G.point_x("g").alias("x"), G.point_y("g").alias("y"), G.srid_of("g").alias("srid"))


_RAY = "(select count(*) from (select x0 + dx1 ax, y0 + dy1 ay, x0 + dx2 ex, y0 + dy2 ey from (values (0,0,5,0), (5,0,5,1), (5,1,2,1), (2,1,2,2), (2,2,0,2), (0,2,0,0)) v(dx1, dy1, dx2, dy2)) where (ay > latitude) <> (ey > latitude) and longitude < (ex - ax) * (latitude - ay) / (ey - ay) + ax) % 2 = 1"
_EDGE = "(select count(*) from (select x0 + dx1 ax, y0 + dy1 ay, x0 + dx2 ex, y0 + dy2 ey from (values (0,0,5,0), (5,0,5,1), (5,1,2,1), (2,1,2,2), (2,2,0,2), (0,2,0,0)) v(dx1, dy1, dx2, dy2)) where (ex - ax) * (latitude - ay) = (ey - ay) * (longitude - ax) and longitude between least(ax, ex) and greatest(ax, ex) and latitude between least(ay, ey) and greatest(ay, ey)) > 0"


@query("g06_contains", f"select row_id, {_RAY} and not {_EDGE} as inside from (select *, 26.0 as x0, 5.0 as y0 from facility_a_raw where latitude is not null and longitude is not null)")
def _(t):
    shape = polygon(F.lit(26.0), F.lit(5.0), NOTCHED)
    p = t.facility_a_raw.where(c("latitude").isNotNull() & c("longitude").isNotNull()).withColumn("g", shape)
    return p.select("row_id", G.contains("g", "longitude", "latitude").alias("inside"))


@query("g07_accessors", "select row_id, longitude as x, latitude as y from facility_b_raw where latitude is not null and longitude is not null")
def _(t):
    p = t.facility_b_raw.select("row_id", G.make_point("longitude", "latitude").alias("g")).where(c("g").isNotNull())
    return p.select("row_id", G.point_x("g").alias("x"), G.point_y("g").alias("y"))


@query("g08_wkb_round_trip", "select id, true as same, case when kind in (0, 5) then 21 when kind = 4 then 9 + 4 + 4 * 16 when kind = 3 then 9 + 4 + 6 * 16 else 9 + 4 + 5 * 16 end as n_bytes from education_raw")
def _(t):
    w = t.education.select("id", "geometry", G.to_wkb("geometry").alias("w"))
    back = w.withColumn("back", G.from_hex_wkb(F.hex("w")))
    return back.select("id", (G.geometry_key("geometry") == G.geometry_key("back")).alias("same"), F.octet_length("w").alias("n_bytes"))


@query("g09_empty", "select row_id, latitude is null or longitude is null as unusable from facility_a_raw")
def _(t):
    return t.facility_a_raw.select("row_id", G.is_unusable(G.make_point("longitude", "latitude")).alias("unusable"))


@query("g10_geometry_key", "select count(distinct (x, y, case when kind in (0, 5) then 0 else kind end)) as shapes from education_raw")
def _(t):
    return t.education.agg(F.countDistinct(G.geometry_key("geometry")).alias("shapes"))


@query("g11_distance", "select row_id, round(sqrt(pow((latitude - 5) * 111.32, 2) + pow((longitude - 30) * 111.32 * cos(radians(latitude)), 2)), 6) as km from facility_a_raw")
def _(t):
    from terrasift.functions.places import distance_km

    return t.facility_a_raw.select("row_id", F.round(distance_km(c("latitude"), c("longitude"), F.lit(5.0), F.lit(30.0)), 6).alias("km"))


_PIP = f"select row_id, s.id as state_id from facility_a_raw f join (select * from state_raw where geom_ok) s on f.longitude between x0 and x0 + 5 and f.latitude between y0 and y0 + 2 where {_RAY} and not {_EDGE}"


@query("j15_spatial_join", _PIP)
def _(t):
    states = t.states.select(c("id").alias("state_id"), "geometry")
    return SP.spatial_join(t.facility_a_raw, "longitude", "latitude", states).select("row_id", "state_id")


@query("j15_spatial_join_fine_grid", _PIP)
def _(t):
    states = t.states.select(c("id").alias("state_id"), "geometry")
    return SP.spatial_join(t.facility_a_raw, "longitude", "latitude", states, cell=0.4).select("row_id", "state_id")
