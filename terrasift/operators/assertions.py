"""Declarative assertions: each returns the failing rows.

An assertion passes when its result is empty; ``verdict`` turns a result into
one row with the status its severity asks for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions.geometry import contains, is_valid
from terrasift.functions.numeric import in_range
from terrasift.functions.text import word_initcap
from terrasift.operators.joins import lookup_join


def _where(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def not_null(df: DataFrame, c: str, where: Column | None = None) -> DataFrame:
    """T1."""
    return _where(df, where).where(F.col(c).isNull())


def unique(df: DataFrame, *cols: str, where: Column | None = None) -> DataFrame:
    """Repeated keys with their row count. NULL is ignored in a single-column test only."""
    rows = _where(df, where)
    if len(cols) == 1:
        rows = rows.where(F.col(cols[0]).isNotNull())
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def accepted_values(df: DataFrame, c: str, values: Sequence, where: Column | None = None) -> DataFrame:
    """Values outside the domain with their row count."""
    rows = _where(df, where).where(~F.col(c).isin(list(values)))
    return rows.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def relationships(
    child: DataFrame, c: str, parent: DataFrame, pc: str, where: Column | None = None
) -> DataFrame:
    """Child rows whose key is absent from the parent; NULL keys are ignored."""
    keys = parent.select(F.col(pc).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    rows = _where(child, where).where(F.col(c).isNotNull()).withColumn("_key", F.col(c))
    return lookup_join(rows, keys, "_key", "left_anti").drop("_key")


def not_null_proportion(df: DataFrame, c: str, at_least: float) -> DataFrame:
    """T5: one row with the share when it is too low."""
    share = F.avg(F.col(c).isNotNull().cast("int"))
    return df.agg(share.alias("not_null_proportion")).where(F.col("not_null_proportion") < at_least)


def accepted_range(
    df: DataFrame,
    c: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
    where: Column | None = None,
) -> DataFrame:
    """T6 / T21."""
    return _where(df, where).where(~in_range(c, low, high, inclusive))


def expression_is_true(df: DataFrame, expr: Column | str, where: Column | None = None) -> DataFrame:
    """Rows for which the expression is false; an unknown result does not fail."""
    test = F.expr(expr) if isinstance(expr, str) else expr
    return _where(df, where).where(~test)


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both counts in one row when they differ."""
    sides = a.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        b.select(F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    totals = sides.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("rows_b")
    )
    return totals.where(F.col("rows_a") != F.col("rows_b"))


def not_empty_string(df: DataFrame, c: str, where: Column | None = None) -> DataFrame:
    """T10."""
    return _where(df, where).where(F.trim(F.col(c)) == "")


def matches(df: DataFrame, c: str, regex: str, where: Column | None = None) -> DataFrame:
    """T13."""
    return expression_is_true(df, F.col(c).rlike(regex), where)


def title_case(df: DataFrame, c: str, where: Column | None = None) -> DataFrame:
    """T17."""
    return expression_is_true(df, F.col(c) == word_initcap(c), where)


def sectors_within_total(df: DataFrame, sectors: Sequence[str], total: str) -> DataFrame:
    """Some sector exceeds the total; a NULL total never fails."""
    over = reduce(lambda a, b: a | b, [F.coalesce(F.col(s), F.lit(0)) > F.col(total) for s in sectors])
    return df.where(F.col(total).isNotNull() & over)


def rounded_not_above(df: DataFrame, part: str, whole: str) -> DataFrame:
    """Part exceeds whole after rounding to units."""
    return df.where(F.round(F.col(part), 0) > F.round(F.col(whole), 0))


def scalar_expectation(df: DataFrame, measure: Column, op: str, value: int | float) -> DataFrame:
    """One row with the measured value when the comparison fails."""
    tests = {"=": F.col("measured") == value, ">=": F.col("measured") >= value, "<=": F.col("measured") <= value}
    return df.agg(measure.alias("measured")).where(~tests[op])


def absent_from(df: DataFrame, c: str, value) -> DataFrame:
    """Rows carrying a value that must not appear."""
    return df.where(F.col(c) == value)


def geometry_valid(df: DataFrame, c: str) -> DataFrame:
    """T18."""
    return df.where(~is_valid(c))


def centroid_inside(df: DataFrame, geometry: str, lon: str, lat: str) -> DataFrame:
    """T19 / J15."""
    return df.where(~contains(geometry, lon, lat))


def not_above_parent(
    child: DataFrame, parent: DataFrame, on: str, measure: str, where: Column | None = None
) -> DataFrame:
    """Child rows whose measure exceeds that of their parent."""
    lookup = parent.select(F.col(on), F.col(measure).alias("parent_measure"))
    joined = lookup_join(_where(child, where), lookup, on, "left")
    return joined.where(F.col(measure) > F.col("parent_measure"))


def mismatch(
    df: DataFrame, code: str, value: str, lookup: DataFrame, lookup_code: str, lookup_value: str, as_names: bool
) -> DataFrame:
    """Rows whose value differs from the looked-up one, NULL being a value."""
    keyed = lookup.select(F.col(lookup_code).alias("_code"), F.col(lookup_value).alias("lookup_value"))
    keyed = keyed.where(F.col("_code").isNotNull())
    joined = lookup_join(df.withColumn("_code", F.col(code)), keyed, "_code", "inner")
    ours, theirs = F.col(value), F.col("lookup_value")
    if as_names:
        ours, theirs = F.lower(F.trim(ours)), F.lower(F.trim(theirs))
    return joined.where(~ours.eqNullSafe(theirs)).drop("_code")


def functional_dependency(
    df: DataFrame, key: str, attribute: str, keep_null_key: bool = True, where: Column | None = None
) -> DataFrame:
    """A2: keys that carry more than one attribute value."""
    rows = _where(df, where)
    if not keep_null_key:
        rows = rows.where(F.col(key).isNotNull())
    return (
        rows.groupBy(F.col(key).alias("key"))
        .agg(F.countDistinct(F.col(attribute)).alias("n_values"))
        .where(F.col("n_values") > 1)
    )


def sum_matches(
    df: DataFrame, total: Column, parts: Sequence[str], tolerance: float, key: str
) -> DataFrame:
    """Rows whose parts do not add up to the total within the tolerance; NULL never fails."""
    gap = F.abs(total - reduce(lambda a, b: a + b, [F.col(p) for p in parts]))
    return df.select(F.col(key), gap.alias("gap")).where(F.col("gap") > tolerance)


def verdict(failing: DataFrame, name: str, severity: str = "error") -> DataFrame:
    """One row (test, failures, status); status is pass, warn or error."""
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit(severity))
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("test"), "failures", status.alias("status")
    )


def report(*branches: DataFrame) -> DataFrame:
    """Branches of one report under each other."""
    return reduce(lambda a, b: a.unionByName(b), branches)
