"""Gate, profiles and catalogue queries (V, F, S8-S10, L5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.functions.places import PROFILE_BOX
from terrasift.operators import catalog as C
from terrasift.operators import gate as V
from terrasift.operators import profiling as R
from workload.inputs import BASE, spread
from workload.registry import query

c = F.col

# --- V ------------------------------------------------------------------------

RULES = {
    "l_quantity": {"min": 3, "max": 47},
    "l_extendedprice": {"min": 0},
    "code": {"min": 10, "max": 40},
    "l_discount": {"max": 0.08},
    "no_such_column": {"min": 0, "unique": True},
}


def findings(df, rules=None, geometry=None, *checks):
    out = V.gate_report(df, rules, geometry)
    if checks:
        out = out.where(c("check").isin(*checks))
    return out.select("severity", "check", "column", "violations", "checked_rows")


def _f(severity, check, column, count, table):
    col = f"'{column}'" if column else "cast(null as varchar)"
    return f"select * from (select '{severity}' as severity, '{check}' as check, {col} as column, {count} as violations, count(*) as checked_rows from {table}) where violations > 0"


def _cf(cond):
    return f"count(*) filter ({cond})"


_NUM = "try_cast(code as double)"
_RANGE = [
    _f("error", "below_min", "l_quantity", _cf("l_quantity < 3"), "dirty_line"),
    _f("error", "above_max", "l_quantity", _cf("l_quantity > 47"), "dirty_line"),
    _f("error", "below_min", "l_extendedprice", _cf("l_extendedprice < 0"), "dirty_line"),
    _f("error", "below_min", "code", _cf(f"{_NUM} < 10"), "dirty_line"),
    _f("error", "above_max", "code", _cf(f"{_NUM} > 40"), "dirty_line"),
    _f("error", "above_max", "l_discount", _cf("l_discount > 0.08"), "dirty_line"),
]
_NULLS = [_f("warning", "missing_values", x, _cf(f"{x} is null"), "dirty_line") for x in ("l_quantity", "code")]


@query("v03_no_rows", _f("error", "no_rows", None, "case when count(*) = 0 then 1 else 0 end", "(select * from lineitem where l_quantity < 0)"))
def _(t):
    return findings(t.lineitem.where("l_quantity < 0"))


@query("v05_missing_values", " union all ".join(_NULLS))
def _(t):
    return findings(t.dirty_line, None, None, "missing_values")


@query("v06_min_rule", " union all ".join(x for x in _RANGE if "below_min" in x))
def _(t):
    return findings(t.dirty_line, RULES, None, "below_min")


@query("v07_max_rule", " union all ".join(x for x in _RANGE if "above_max" in x))
def _(t):
    return findings(t.dirty_line, RULES, None, "above_max")


_UNIQUE = [_f("error", "not_unique", x, f"count(*) - count(distinct {x}) - max(case when {x} is null then 1 else 0 end)", "dirty_line") for x in ("code", "l_orderkey")]


@query("v08_unique_rule", " union all ".join(_UNIQUE))
def _(t):
    return findings(t.dirty_line, {"code": {"unique": True}, "l_orderkey": {"unique": True}}, None, "not_unique")


@query("v09_absent_rule_column", " union all ".join(_NULLS))
def _(t):
    return findings(t.dirty_line, {"no_such_column": {"min": 0, "unique": True}})


_SHAPES = "(select *, case when kind = 5 and y > 8 then null else kind end as k, kind = 0 and x > 30 as far from education_raw)"
_PROPS = "id is null and name is null"


def shapes(t):
    """Features with gaps: some without geometry, some far outside the world, some without attributes."""
    far = (c("geometry.gtype") == "Point") & (G.point_x("geometry") > 30) & (c("p") % 6 == 0)
    lost = (c("geometry.gtype") == "Point") & (G.point_y("geometry") > 8) & (c("p") % 6 == 5)
    e = t.education.withColumn("p", F.trim("id").cast("bigint"))
    moved = F.when(lost, F.lit(None)).when(far, G.make_point(G.point_x("geometry") + 400, G.point_y("geometry"))).otherwise(c("geometry"))
    blank = c("p") % 10 == 0
    return e.select(
        F.when(~blank, c("amenity")).alias("amenity"), F.when(~blank, c("adm1_name")).otherwise(F.lit(" ")).alias("adm1_name"), moved.alias("geometry")
    )


_KIND = "case when kind in (0, 5) then 'Point' else 'Polygon' end"
_GEO = {
    "some_unusable": ("warning", _cf("k is null")),
    "some_invalid": ("warning", _cf("k in (2, 3, 4)")),
    "mixed_types": ("warning", f"count(distinct {_KIND}) filter (k is not null)"),
    "some_outside": ("warning", _cf("far")),
}
_COL = {n: _f(s, n, "geometry", v, _SHAPES) for n, (s, v) in _GEO.items()}
_BLANK = _f("warning", "empty_properties", None, _cf("cast(trim(id) as bigint) % 10 = 0"), "education_raw")
_DUP_KEY = f"(case when p % 10 <> 0 then amenity end, case when p % 10 <> 0 then adm1_name else ' ' end, case when k is null then null when k in (0, 5) then 0 else k end, case when k is not null then x end, case when k is not null then y end, far)"
_DUP = f"select 'warning' as severity, 'duplicate_features' as check, cast(null as varchar) as column, count(*) - count(distinct {_DUP_KEY}) as violations, count(*) as checked_rows from (select *, cast(trim(id) as bigint) p from {_SHAPES})"


@query("v10_unusable_geometry", _COL["some_unusable"])
def _(t):
    return findings(shapes(t), None, "geometry", "some_unusable", "all_unusable")


@query("v11_invalid_geometry", _COL["some_invalid"])
def _(t):
    return findings(shapes(t), None, "geometry", "some_invalid", "all_invalid")


@query("v12_geometry_types", _COL["mixed_types"])
def _(t):
    return findings(shapes(t), None, "geometry", "mixed_types")


@query("v12_expected_type", _f("error", "type_mismatch", "geometry", "1", _SHAPES))
def _(t):
    return findings(shapes(t), {"geometry": {"expected_geometry_type": "Polygon"}}, "geometry", "type_mismatch")


@query("v13_expected_crs", _f("error", "crs_mismatch", "geometry", "1", _SHAPES))
def _(t):
    return findings(shapes(t), {"geometry": {"expected_crs": "EPSG:32636"}}, "geometry", "crs_mismatch", "no_crs")


@query("v14_outside_world", _COL["some_outside"])
def _(t):
    return findings(shapes(t), None, "geometry", "some_outside", "all_outside")


@query("v14_outside_world_of_another_system", _COL["some_outside"])
def _(t):
    adindan = F.when(F.col("geometry").isNotNull(), F.col("geometry").withField("srid", F.lit(4201)))
    return findings(shapes(t).withColumn("geometry", adindan), None, "geometry", "some_outside", "all_outside")


@query("v15_duplicate_features", _DUP)
def _(t):
    return findings(shapes(t), None, "geometry", "duplicate_features")


@query("v16_empty_properties", _BLANK)
def _(t):
    return findings(shapes(t), None, "geometry", "empty_properties")


@query("v17_plain_frame", " union all ".join([*_NULLS, *_RANGE]))
def _(t):
    return findings(spread(t.dirty_line), RULES)


@query("v18_result", "select false as is_valid, cast(6 as bigint) as errors, cast(1 as bigint) as warnings, count(*) as checked_rows from dirty_line")
def _(t):
    r = V.validate(t.dirty_line, RULES)
    return t.spark.createDataFrame([(r.is_valid, len(r.errors), len(r.warnings), r.checked_rows)], "is_valid boolean, errors bigint, warnings bigint, checked_rows bigint")


_BAD = f"[case when l_quantity < 3 then 'below_min:l_quantity' end, case when l_quantity > 47 then 'above_max:l_quantity' end, case when l_extendedprice < 0 then 'below_min:l_extendedprice' end, case when {_NUM} < 10 then 'below_min:code' end, case when {_NUM} > 40 then 'above_max:code' end, case when l_discount > 0.08 then 'above_max:l_discount' end]"


@query("l05_quarantine_split", f"select l_orderkey, l_linenumber, v <> '' as quarantined, v as violations from (select *, array_to_string(list_filter({_BAD}, lambda x: x is not null), ',') v from dirty_line)")
def _(t):
    good, bad = V.split(spread(t.dirty_line), RULES)
    keys = ["l_orderkey", "l_linenumber"]
    g = good.select(*keys, F.lit(False).alias("quarantined"), F.lit("").alias("violations"))
    return g.unionByName(bad.select(*keys, F.lit(True).alias("quarantined"), F.array_join("_violations", ",").alias("violations")))


# --- F ------------------------------------------------------------------------

_LINE = ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "code", "flag", "l_discount")
_LINE_TYPES = ("bigint", "int", "bigint", "double", "double", "string", "string", "double")


def _pct(part, whole, digits):
    return f"round_even(100.0 * cast({part} as double) / {whole}, {digits})"


def _profile(name, cols, table):
    missing = " + ".join(f"count(*) filter ({x} is null)" for x in cols)
    return f"""select '{name}' as "table", count(*) as total_rows, cast({len(cols)} as bigint) as total_columns,
        count(*) - count(distinct ({', '.join(cols)})) as duplicate_rows, {missing} as missing_cells,
        {_pct(missing, f'(count(*) * {len(cols)})', 2)} as missing_percent from {table}"""


_TEXT_COLUMNS = ("doc_id", "lang", "source", "text", "label", "n_text")
_F01 = _profile("dirty_line", _LINE, "dirty_line")
_F03 = f"{_F01} union all {_profile('dirty_text', _TEXT_COLUMNS, 'dirty_text')}"


@query("f01_table_profile", _F01)
def _(t):
    return R.table_profile(t.dirty_line, "dirty_line")


@query("f02_column_profile", " union all ".join(f"""select 'dirty_line' as "table", cast({i} as int) as position, '{x}' as column, '{ty}' as data_type, count(*) filter ({x} is null) as missing_count, {_pct(f"count(*) filter ({x} is null)", "count(*)", 2)} as missing_percent, count(distinct {x}) as unique_values from dirty_line""" for i, (x, ty) in enumerate(zip(_LINE, _LINE_TYPES))))
def _(t):
    return R.column_profile(t.dirty_line, "dirty_line")


@query("f03_tables_summary", _F03)
def _(t):
    return R.tables_summary({"dirty_line": t.dirty_line, "dirty_text": t.dirty_text})


def gappy(t):
    """Orders with an empty column, a mostly empty one and unlucky names."""
    return t.orders.select(
        "o_custkey",
        F.lit(None).cast("string").alias("remark"),
        F.when(c("o_orderkey") % 3 == 0, c("o_orderstatus")).alias("unnamed:_1"),
        c("o_orderpriority").alias("prio\nrity"),
    )


_GAPPY = "(select o_custkey, null as remark, case when o_orderkey % 3 = 0 then o_orderstatus end as u, o_orderpriority as p from orders)"
_UPCT = f"(select {_pct('count(*) filter (u is null)', 'count(*)', 2)} v from {_GAPPY})"
_DUPS = f"(select count(*) - count(distinct (o_custkey, remark, u, p)) d, {_pct('count(*) filter (u is null) + count(*)', '(count(*) * 4)', 2)} m from {_GAPPY})"


@query("f04_quality_flags_basic", f"select 'gappy' as \"table\", 'High missing data: remark (100.0% missing)' as issue, 'High' as priority union all select 'gappy', printf('High missing data: unnamed:_1 (%.1f%% missing)', v), 'High' from {_UPCT} union all select 'gappy', format('Contains {{:,}} duplicate rows', d), 'Medium' from {_DUPS} where d > 0 union all select 'gappy', printf('Overall %.1f%% missing data', m), 'Low' from {_DUPS}")
def _(t):
    return R.quality_flags_basic({"gappy": gappy(t)})


@query("f05_quality_flags", f"select 'gappy' as \"table\", 'EMPTY COLUMN: remark (100% missing)' as issue, 'CRITICAL' as priority, 0 as sort_order union all select 'gappy', printf('High missing: unnamed:_1 (%.1f%% missing)', v), 'HIGH', 1 from {_UPCT} union all select 'gappy', format('Contains {{:,}} duplicate rows', d), 'MEDIUM', 2 from {_DUPS} where d > 0 union all select 'gappy', 'Column names need cleaning (''unnamed:_1'', etc.)', 'HIGH', 1 from region where r_regionkey = 0 union all select 'gappy', 'Column names contain newline characters (\\n) - needs cleaning', 'MEDIUM', 2 from region where r_regionkey = 0")
def _(t):
    return R.quality_flags({"gappy": gappy(t)})


@query("f06_observations", "select 'gappy' as \"table\", o as observation, v as value from (values ('top_missing_columns', 'unnamed:_1'), ('empty_columns', 'remark'), ('column_types', 'bigint:1, string:3'), ('spatial_data', 'no'), ('coordinates', 'no'), ('admin_codes', 'no')) x(o, v)")
def _(t):
    return R.observations(gappy(t), "gappy")


_ORDER = ('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority')
_KEYS = " || ".join(f"case when count(distinct {x}) = count(*) then ', {x}' else '' end" for x in _ORDER)


@query("f07_structural", f"select 'orders' as \"table\", count(*) as row_count, count(*) - (select count(*) from (select distinct * from orders)) as duplicate_rows, cast({len(_ORDER)} as bigint) as column_count, substr({_KEYS}, 3) as key_candidates from orders")
def _(t):
    return R.structural(t.orders, "orders")


def _complete(i, x, is_text):
    null = f"count(*) filter ({x} is null)"
    blank = f"count(*) filter ({x} = '')" if is_text else "cast(0 as bigint)"
    space = f"count(*) filter (trim({x}) = '' and {x} <> '')" if is_text else "cast(0 as bigint)"
    tokens = ", ".join(f"'{p}'" for p in R.PLACEHOLDERS)
    ph = f"count(*) filter (trim(lower({x})) in ({tokens}))" if is_text else "cast(0 as bigint)"
    filled = f"count(*) - {null} - {blank}"
    p = lambda e: _pct(f"({e})", "count(*)", 1)
    return f"select {i} as position, '{x}' as column, count(*) as total, {null} as null_count, {p(null)} as null_pct, {blank} as blank, {p(blank)} as blank_pct, {space} as whitespace_only, {ph} as placeholder_count, {p(ph)} as placeholder_pct, {filled} as filled, {p(filled)} as filled_pct from dirty_text"


@query("f08_completeness", " union all ".join(_complete(i, x, x != "doc_id") for i, x in enumerate(("doc_id", "lang", "source", "text", "label", "n_text"))))
def _(t):
    return R.completeness(t.dirty_text, ["doc_id", "lang", "source", "text", "label", "n_text"])


def _uniq(i, x, table):
    return f"select {i} as position, '{x}' as column, count(*) filter (v is not null) as \"distinct\", cast(sum(n) as bigint) as total_rows, {_pct('count(*) filter (v is not null)', 'sum(n)', 1)} as unique_pct, count(*) filter (v is not null) = sum(n) as is_unique, count(*) filter (v is not null and n > 1) as duplicate_values, cast(coalesce(sum(n) filter (v is not null and n > 1), 0) as bigint) as rows_with_duplicates from (select {x} v, count(*) n from {table} group by 1)"


@query("f09_uniqueness", " union all ".join(_uniq(i, x, "dirty_text") for i, x in enumerate(("doc_id", "lang", "source", "text", "label", "n_text"))))
def _(t):
    return R.uniqueness(t.dirty_text, ["doc_id", "lang", "source", "text", "label", "n_text"])


@query("f09_duplicate_examples", " union all ".join(f"select '{x}' as column, v as value, n from (select {x} v, count(*) n from dirty_text where {x} is not null group by 1 having count(*) > 1 order by n desc, v limit 5)" for x in ("lang", "source", "text", "label", "n_text")))
def _(t):
    return R.duplicate_examples(t.dirty_text, ["lang", "source", "text", "label", "n_text"])


_TEXTS = ("text", "label", "n_text")


def _text(x):
    m = lambda p: f"count(*) filter (regexp_matches({x}, '{p}'))"
    return f"""select '{x}' as column, count({x}) as total, {m('^[ \\t\\n\\r\\f\\v]')} as lead_ws, {m('[ \\t\\n\\r\\f\\v]$')} as trail_ws, {m('[ \\t\\n\\r\\f\\v][ \\t\\n\\r\\f\\v]')} as multi_sp,
        count(*) filter (regexp_matches({x}, '[A-Z]') and regexp_matches({x}, '[a-z]')) as mixed_case, {m('[^\\x00-\\x7F]')} as non_ascii,
        max(length({x})) as max_length, count({x}) > 0 and count(*) filter (try_cast({x} as double) is not null and regexp_matches({x}, '[0-9]')) = count({x}) as numeric_text from dirty_text"""


_ISSUES = "case when total = 0 then '-' else coalesce(nullif(concat_ws(', ', case when lead_ws > 0 then 'lead_ws' end, case when trail_ws > 0 then 'trail_ws' end, case when multi_sp > 0 then 'multi_sp' end, case when mixed_case > 0 then 'mixed_case' end, case when non_ascii > 0 then 'non_ascii' end, case when max_length > 100 then 'long_vals' end, case when numeric_text then 'numeric_text' end), ''), 'Clean') end"


@query("f10_text_profile", f"select *, {_ISSUES} as issues from ({' union all '.join(_text(x) for x in _TEXTS)})")
def _(t):
    return R.text_profile(t.dirty_text, _TEXTS)


@query("f10_text_top_values", " union all ".join(f"select '{x}' as column, v as value, n from (select {x} v, count(*) n from dirty_text where {x} is not null group by 1 order by n desc, v limit 10)" for x in ("label", "lang", "text")))
def _(t):
    return R.text_top_values(t.dirty_text, ["label", "lang", "text"])


def _numeric(x):
    return f"select '{x}' as column, count({x}) as total, min(cast({x} as double)) as min, max(cast({x} as double)) as max, round(avg({x}), 4) as mean, round(stddev_samp({x}), 4) as std, count(*) filter ({x} < 0) as negatives, count(*) filter ({x} = 0) as zeros, count(*) filter (abs(({x} - m) / nullif(s, 0)) > 3) as outliers_3std from dirty_line, (select avg({x}) m, stddev_samp({x}) s from dirty_line)"


@query("f11_numeric_profile", " union all ".join(_numeric(x) for x in ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    return R.numeric_profile(spread(t.dirty_line)).withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


def _category(x):
    return f"select '{x}' as column, count(*) as \"distinct\", cast(sum(n) as bigint) as total, count(*) filter (n = 1) as singletons, concat_ws(', ', case when bool_and(try_cast(v as double) is not null) then 'NumericText' end, case when count(*) > 50 then 'HighCard' end, case when count(*) filter (n = 1) > 0 then 'S:' || count(*) filter (n = 1) end) as flags from (select {x} v, count(*) n from dirty_text where {x} is not null group by 1)"


@query("f12_categorical_profile", " union all ".join(_category(x) for x in ("lang", "source", "text", "label", "n_text")))
def _(t):
    return R.categorical_profile(t.dirty_text, ["lang", "source", "text", "label", "n_text"])


@query("f12_frequencies", "select label as value, count(*) as n from dirty_text where label is not null group by 1")
def _(t):
    return R.frequencies(t.dirty_text, "label")


_FLAG = "coalesce(nullif(concat_ws(', ', case when lat_max > 90 or lat_min < -90 then 'LAT_OUT_OF_GLOBAL_RANGE' end, case when lon_max > 180 or lon_min < -180 then 'LON_OUT_OF_GLOBAL_RANGE' end, case when lat_max > 13 or lat_min < 3 then 'LAT_OUTSIDE_SS' end, case when lon_max > 36 or lon_min < 23 then 'LON_OUTSIDE_SS' end, case when zero_zero > 0 then 'ZERO_ZERO:' || zero_zero end), ''), 'OK')"


@query("f13_coordinate_profile", f"select *, {_FLAG} as flags from (select 'latitude' as lat_col, 'longitude' as lon_col, count(*) filter (latitude is null) as lat_null, count(*) filter (longitude is null) as lon_null, min(latitude) as lat_min, max(latitude) as lat_max, min(longitude) as lon_min, max(longitude) as lon_max, count(*) filter (latitude = 0 and longitude = 0) as zero_zero from (select case when row_id % 45 = 1 then 0 else latitude end latitude, case when row_id % 45 = 1 then 0 else longitude end longitude from facility_a_raw))")
def _(t):
    zero = c("row_id") % 45 == 1
    a = t.facility_a_raw.select(*[F.when(zero, F.lit(0.0)).otherwise(c(x)).alias(x) for x in ("latitude", "longitude")])
    return R.coordinate_profile(a, PROFILE_BOX)


_WKT = "(select case when o_orderkey % 9 = 0 then null when o_orderkey % 11 = 0 then '  ' when o_orderkey % 13 = 0 then 'empty' when o_orderkey % 2 = 0 then 'POINT (1 2)' else 'Polygon ((0 0))' end as wkt from orders)"


def wkt(t):
    k = c("o_orderkey")
    return t.orders.select(F.when(k % 9 == 0, F.lit(None)).when(k % 11 == 0, F.lit("  ")).when(k % 13 == 0, F.lit("empty")).when(k % 2 == 0, F.lit("POINT (1 2)")).otherwise(F.lit("Polygon ((0 0))")).alias("wkt"))


@query("f13_geometry_text", f"select 'wkt' as column, count(*) as total, count(*) filter (wkt is null) as null_count, count(*) filter (trim(wkt) = '') as blank, count(*) filter (lower(wkt) = 'empty') as empty, count(*) - count(*) filter (wkt is null) - count(*) filter (trim(wkt) = '') as filled from {_WKT}")
def _(t):
    return R.geometry_text_profile(wkt(t), "wkt")


@query("f13_geometry_types", f"select g as geom_type, count(*) as n from (select regexp_extract(wkt, '^([A-Za-z]+)', 1) g from {_WKT}) where g <> '' group by 1")
def _(t):
    return R.geometry_type_counts(wkt(t), "wkt")


@query("f14_fk_check", "select 'OK' as status, cast(0 as bigint) as missing_values, '' as samples from region where r_regionkey = 0 union all select 'SKIP: nope not in source', 0, '' from region where r_regionkey = 0")
def _(t):
    return R.fk_check(t.orders, "o_custkey", t.customer, "c_custkey").withColumn("samples", F.coalesce("samples", F.lit(""))).unionByName(R.fk_check(t.orders, "nope", t.customer, "c_custkey"))


@query("f15_hierarchy_check", "select county as child, count(distinct old_state) as n_parents from facility_a_raw where county is not null and old_state is not null group by 1 having count(distinct old_state) > 1")
def _(t):
    return R.hierarchy_check(t.facility_a_raw, "county", "old_state")


@query("f16_constant_check", "select l_linestatus as value, count(*) as n_rows from lineitem where l_linestatus is distinct from 'F' group by 1")
def _(t):
    return R.constant_check(t.lineitem, "l_linestatus", "F")


@query("f17_business_rules", "select r as rule, v as violations, v = 0 as holds from (select 'price positive' r, count(*) filter (not l_extendedprice > 0) v from dirty_line union all select 'discount is a share', count(*) filter (l_discount < 0 or l_discount > 1) from dirty_line union all select 'quantity present', count(*) filter (l_quantity is null) from dirty_line)")
def _(t):
    return R.rule_counts(t.dirty_line, {"price positive": ~(c("l_extendedprice") > 0), "discount is a share": (c("l_discount") < 0) | (c("l_discount") > 1), "quantity present": c("l_quantity").isNull()})


@query("f17_unknown_values", "select lower(trim(type)) as value, count(*) as n_rows from facility_b_raw where lower(trim(type)) not in ('phcu', 'hospital') group by 1")
def _(t):
    return R.unknown_values(t.facility_b_raw, "type", ["phcu", "hospital"])


@query("f18_coverage", "select count(*) filter (a and b) as in_both, count(*) filter (a and not b) as missing_in_b, count(*) filter (b and not a) as extra_in_b from (select k, bool_or(s = 'a') a, bool_or(s = 'b') b from (select county_code k, 'a' s from facility_a_raw union all select trim(adm2_pcode), 'b' from county_raw where trim(adm2_pcode) <> '') where k is not null group by 1)")
def _(t):
    counties = t.counties.select(F.trim("adm2_pcode").alias("code")).where("code <> ''")
    return R.coverage(t.facility_a_raw, "county_code", counties, "code")


# --- S8-S10 --------------------------------------------------------------------


@query("s08_preview", "select * from orders order by o_orderkey limit 3")
def _(t):
    return C.preview(t.orders.orderBy("o_orderkey"), 3)


@query("s09_column_catalogue", " union all ".join(f"select 'dirty_line' as table_name, {i} as ordinal_position, '{x}' as column_name, '{ty}' as data_type, 'YES' as is_nullable, count({x}) as n_values from dirty_line" for i, (x, ty) in enumerate(zip(_LINE, _LINE_TYPES), start=1)))
def _(t):
    return C.column_catalogue(t.dirty_line, "dirty_line")


@query("s10_table_counts", " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {n}" for n in BASE))
def _(t):
    return C.row_counts({n: getattr(t, n) for n in BASE})
