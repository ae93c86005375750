"""Pre-load validation gate (V1-V18) and the row-level split.

Every counting rule is compiled into one aggregate over one scan. Uniqueness
and duplicate-feature rules add one pre-aggregated grouping each.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasift.functions import geometry as G
from terrasift.functions.keys import row_key, value_key
from terrasift.functions.text import strip_blanks

Rules = Mapping[str, Mapping[str, Any]]

# Fixed value: how many offending keys a warning lists.
SAMPLE_KEYS = 10

# Wording of the findings.
MESSAGES = {
    "none": "DataFrame is None",
    "no_columns": "DataFrame has no columns",
    "no_rows": "DataFrame is empty (no rows)",
    "duplicate_columns": "Duplicate column names create ambiguity: {detail}",
    "missing_values": "Missing values present in columns: {detail}",
    "below_min": "Column '{column}' has {count} value(s) below minimum {detail}",
    "above_max": "Column '{column}' has {count} value(s) above maximum {detail}",
    "not_unique": "Column '{column}' violates uniqueness rule: {count} duplicate value(s)",
    "all_unusable": "Column '{column}' has no usable geometry: all {count} feature(s) are null or empty",
    "some_unusable": "Column '{column}' has {count} feature(s) with null or empty geometry",
    "all_invalid": "Column '{column}' has no usable geometry: all {count} present geometrie(s) are structurally invalid",
    "some_invalid": "Column '{column}' has {count} feature(s) with invalid geometry{detail}",
    "type_mismatch": "Column '{column}' geometry type mismatch: expected {detail}",
    "mixed_types": "Column '{column}' contains mixed geometry types: {detail}",
    "no_crs": "Column '{column}' has no CRS defined",
    "crs_mismatch": "Column '{column}' CRS mismatch: expected {detail}",
    "all_outside": "Column '{column}' has no usable geometry: all {count} feature(s) fall outside the valid geographic coordinate range (lon -180..180, lat -90..90)",
    "some_outside": "Column '{column}' has {count} feature(s) with coordinates outside the valid geographic range (lon -180..180, lat -90..90){detail}",
    "duplicate_features": "{count} duplicate feature(s) detected (matching geometry and attributes)",
    "empty_properties": "{count} feature(s) have empty properties",
}

# EPSG numbers of reference systems measured in degrees.
GEOGRAPHIC_SRIDS = (
    4326, 4979, 4322,  # world
    4201, 4209, 4210, 4148, 4222,  # Africa: Adindan, Arc 1950, Arc 1960, Hartebeesthoek 94, Cape
    4258, 4230, 4277, 4171, 4275, 4289, 4312, 4313, 4314, 4124, 4619, 4284, 4178,  # Europe
    4269, 4267, 4617, 4674, 4618,  # Americas
    4490, 4610, 4214, 4612, 6668, 4301, 4737, 4240, 4755,  # Asia
    4283, 7844, 4167, 4272,  # Australia, New Zealand
)


class DataQualityError(Exception):
    """Raised when an invalid frame must not be loaded."""

    def __init__(self, errors: list[str]):
        super().__init__("; ".join(errors))
        self.errors = list(errors)


@dataclass
class ValidationResult:
    """V18."""

    is_valid: bool
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    checked_rows: int = 0


def geometry_columns(df: DataFrame) -> list[str]:
    """Columns holding the geometry struct."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StructType) and {"gtype", "srid", "parts"} <= set(f.dataType.names)
    ]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _number(df: DataFrame, name: str) -> Column:
    """Text that is no number never violates a range."""
    c = _q(name)
    return c.cast("double") if isinstance(df.schema[name].dataType, T.NumericType) else c.cast("string").try_cast("double")


def _missing(df: DataFrame, name: str) -> Column:
    c = _q(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _range_tests(df: DataFrame, rules: Rules) -> list[tuple[str, str, Any, Column]]:
    tests = []
    for name, rule in rules.items():
        if name not in df.columns:  # V9
            continue
        # NaN counts as missing, and Spark orders it above every number.
        value = _number(df, name)
        value = F.when(~F.isnan(value), value)
        if rule.get("min") is not None:
            tests.append(("below_min", name, rule["min"], value < rule["min"]))
        if rule.get("max") is not None:
            tests.append(("above_max", name, rule["max"], value > rule["max"]))
    return tests


def _finding(severity: str, check: str, column: str | None, count: Column, detail: Column | str | None) -> Column:
    text = detail if isinstance(detail, Column) else F.lit(detail)
    return F.struct(
        F.lit(severity).alias("severity"),
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        count.cast("bigint").alias("violations"),
        text.cast("string").alias("detail"),
    )


def _blank(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return _q(name).isNull() | strip_blanks(_q(name)).eqNullSafe(F.lit(""))
    return _missing(df, name)


def _expected_srid(value: Any) -> int | None:
    digits = str(value).rsplit(":", 1)[-1]
    return int(digits) if digits.isdigit() else None


def gate_report(df: DataFrame, rules: Rules | None = None, geometry: str | None = None) -> DataFrame:
    """V3-V16 as rows (severity, check, column, violations, detail, checked_rows).

    Only findings with at least one violation appear. ``geometry`` names the
    geometry column; left out, a geometry struct column is used if there is one.
    """
    rules = dict(rules or {})
    geometry = geometry or next(iter(geometry_columns(df)), None)
    plain = [c for c in df.columns if c != geometry]

    source, aggs, findings = df, [F.count(F.lit(1)).alias("rows")], []

    def measure(name: str, expr: Column) -> Column:
        aggs.append(expr.alias(name))
        return F.col(name)

    rows = F.col("rows")
    findings.append(_finding("error", "no_rows", None, (rows == 0).cast("int"), None))
    for i, name in enumerate(df.columns):  # V5
        n = measure(f"null_{i}", F.count_if(_missing(df, name)))
        findings.append(_finding("warning", "missing_values", name, n, None))
    for i, (check, name, limit, test) in enumerate(_range_tests(df, rules)):  # V6, V7
        n = measure(f"range_{i}", F.count_if(test))
        findings.append(_finding("error", check, name, n, str(limit)))

    if geometry is not None:
        findings += _geometry_findings(df, rules.get(geometry, {}), geometry, plain, measure)
        # Validity is computed once per row, below the aggregate.
        source = df.withColumn("_valid", F.coalesce(G.is_valid(_q(geometry)), F.lit(False)))

    measured = source.agg(*aggs)
    out = measured.select(rows.alias("checked_rows"), F.inline(F.array(*findings)))
    for name, rule in rules.items():  # V8
        if rule.get("unique") and name in df.columns:
            out = out.unionByName(_surplus(df, [value_key(df, name)], "error", "not_unique", name))
    if geometry is not None:  # V15
        keys = [G.geometry_key(_q(geometry))] + ([row_key(df, plain)] if plain else [])
        out = out.unionByName(_surplus(df, keys, "warning", "duplicate_features", None))
    cols = ["severity", "check", "column", "violations", "detail", "checked_rows"]
    return out.where(F.col("violations") > 0).select(*cols)


def _surplus(df: DataFrame, keys: list[Column], severity: str, check: str, column: str | None) -> DataFrame:
    """Rows beyond the first of each key, NULL being a value."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    groups = df.select(*named).groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("n"))
    total, kinds = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return groups.agg(
        total.cast("bigint").alias("checked_rows"),
        _finding(severity, check, column, total - kinds, None).alias("f"),
    ).select("checked_rows", "f.*")


def _geometry_findings(df: DataFrame, rule: Mapping[str, Any], geometry: str, plain: list[str], measure) -> list[Column]:
    g, rows = _q(geometry), F.col("rows")
    usable_row, valid_row = ~G.is_unusable(g), F.col("_valid")
    usable = measure("usable", F.count_if(usable_row))
    valid = measure("valid", F.count_if(usable_row & valid_row))
    # Types and reference systems are small closed domains, so the sets stay tiny.
    types = measure("types", F.sort_array(F.collect_set(F.when(usable_row, g["gtype"]))))
    srids = measure("srids", F.sort_array(F.collect_set(g["srid"])))
    geographic = g["srid"].isin(*GEOGRAPHIC_SRIDS)
    outside = measure("outside", F.count_if(usable_row & valid_row & geographic & G.outside_world(g)))
    unusable, invalid = rows - usable, usable - valid
    go_on = (usable > 0) & (valid > 0)
    zero = F.lit(0)
    listed = F.concat(F.lit("["), F.array_join(types, ", "), F.lit("]"))

    out = [
        _finding("error", "all_unusable", geometry, F.when((usable == 0) & (rows > 0), rows).otherwise(zero), None),
        _finding("warning", "some_unusable", geometry, F.when(usable > 0, unusable).otherwise(zero), None),
        _finding("error", "all_invalid", geometry, F.when((usable > 0) & (valid == 0), usable).otherwise(zero), None),
        _finding("warning", "some_invalid", geometry, F.when(valid > 0, invalid).otherwise(zero), None),
    ]
    expected = rule.get("expected_geometry_type")
    if expected:  # V12
        wrong = F.size(F.array_except(types, F.array(F.lit(expected))))
        note = F.concat(F.lit(f"'{expected}', found "), listed)
        out.append(_finding("error", "type_mismatch", geometry, F.when(go_on, wrong).otherwise(zero), note))
    else:
        mixed = F.when(go_on & (F.size(types) > 1), F.size(types)).otherwise(zero)
        out.append(_finding("warning", "mixed_types", geometry, mixed, listed))
    no_crs = go_on & (F.size(F.filter(srids, lambda s: s > 0)) == 0)  # V13
    out.append(_finding("warning", "no_crs", geometry, no_crs.cast("int"), None))
    wanted = rule.get("expected_crs")
    if wanted is not None:
        other = F.filter(srids, lambda s: (s > 0) & ~s.eqNullSafe(F.lit(_expected_srid(wanted))))
        found = F.concat(F.lit(f"'{wanted}', found "), F.array_join(F.transform(other, lambda s: F.concat(F.lit("EPSG:"), s.cast("string"))), ", "))
        out.append(_finding("error", "crs_mismatch", geometry, F.when(go_on, F.size(other)).otherwise(zero), found))
    all_out = go_on & (outside == valid)  # V14
    out.append(_finding("error", "all_outside", geometry, F.when(all_out, outside).otherwise(zero), None))
    out.append(_finding("warning", "some_outside", geometry, F.when(go_on & ~all_out, outside).otherwise(zero), None))
    if plain:  # V16
        blank = reduce(lambda a, b: a & b, [_blank(df, c) for c in plain])
        out.append(_finding("warning", "empty_properties", None, measure("blank", F.count_if(blank)), None))
    return out


# Findings after which the later geometry checks are not reported.
_STOPS = ("all_unusable", "all_invalid", "all_outside")
_AFTER_STOP = ("duplicate_features", "empty_properties")


def _sample(df: DataFrame, condition: Column, key: str) -> str:
    """First offending keys; a top-k, so each task keeps only that many rows."""
    rows = df.where(condition).select(key).orderBy(key).limit(SAMPLE_KEYS + 1).collect()
    keys = [r[0] for r in rows]
    return f" (indices: {keys[:SAMPLE_KEYS]}{'...' if len(keys) > SAMPLE_KEYS else ''})"


def validate(
    df: DataFrame | None,
    rules: Rules | None = None,
    geometry: str | None = None,
    key: str | None = None,
    header: list[str] | None = None,
) -> ValidationResult:
    """V1-V18 as a result object; the frame itself is only read.

    ``header`` carries the column names as written in the source, where they
    may still repeat. ``key`` names a column whose values identify offending
    rows in warnings.
    """
    if df is None:
        return ValidationResult(False, [MESSAGES["none"]])
    errors: list[str] = []
    names = header or df.columns
    if not df.columns:
        errors.append(MESSAGES["no_columns"])
        if df.isEmpty():
            errors.append(MESSAGES["no_rows"])
        return ValidationResult(False, errors)
    repeated = sorted({n for n in names if names.count(n) > 1}, key=names.index)
    if len(set(df.columns)) < len(df.columns):
        # A frame whose own names repeat cannot be addressed by name any further.
        n = df.count()
        errors = [MESSAGES["no_rows"]] if n == 0 else [MESSAGES["duplicate_columns"].format(detail=repeated)]
        return ValidationResult(False, errors, [], n)
    geometry = geometry or next(iter(geometry_columns(df)), None)
    # A bounded number of rows: one per finding, however large the frame.
    found = gate_report(df, rules, geometry).collect()
    checked = max((r["checked_rows"] for r in found), default=None)
    if checked is None:
        checked = df.count()
    if any(r["check"] == "no_rows" for r in found):
        return ValidationResult(False, [MESSAGES["no_rows"]], [], 0)
    if repeated:
        errors.append(MESSAGES["duplicate_columns"].format(detail=repeated))
    warnings: list[str] = []
    with_nulls = [r["column"] for r in found if r["check"] == "missing_values"]
    if with_nulls:
        warnings.append(MESSAGES["missing_values"].format(detail=with_nulls))
    stopped = any(r["check"] in _STOPS for r in found)
    order = list(MESSAGES)
    for r in sorted(found, key=lambda r: order.index(r["check"])):
        check = r["check"]
        if check == "missing_values" or (stopped and check in _AFTER_STOP):
            continue
        detail = r["detail"] or ""
        if key and check == "some_invalid":
            g = _q(geometry)
            detail = _sample(df, ~G.is_unusable(g) & ~F.coalesce(G.is_valid(g), F.lit(False)), key)
        if key and check == "some_outside":
            detail = ";" + _sample(df, ~G.is_unusable(_q(geometry)) & G.outside_world(_q(geometry)), key)
        message = MESSAGES[check].format(column=r["column"], count=r["violations"], detail=detail)
        (errors if r["severity"] == "error" else warnings).append(message)
    return ValidationResult(not errors, errors, warnings, checked)


def flag_rows(df: DataFrame, rules: Rules | None = None, geometry: str | None = None) -> DataFrame:
    """Add ``_violations``: the row-level rules a row breaks."""
    tests = [(f"{check}:{name}", t) for check, name, _, t in _range_tests(df, rules or {})]
    if geometry is not None:
        tests.append((f"unusable_geometry:{geometry}", G.is_unusable(_q(geometry))))
    labels = [F.when(t, F.lit(label)) for label, t in tests]
    empty = F.array().cast("array<string>")
    return df.withColumn("_violations", F.array_compact(F.array(*labels)) if labels else empty)


def split(df: DataFrame, rules: Rules | None = None, geometry: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with the rules they break)."""
    flagged = flag_rows(df, rules, geometry)
    accepted = flagged.where(F.size("_violations") == 0).drop("_violations")
    return accepted, flagged.where(F.size("_violations") > 0)
