"""Fused assertion reports (H, B, E families).

Many assertions over one table are evaluated in a single scan: each row emits
one small record per check it takes part in, the records are pre-aggregated
before the shuffle, and a failing key comes out with its detail count. Adding
a check adds no further scan of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("failing_key", "issue", "detail_count")
_DETAIL = "decimal(38,6)"


@dataclass(frozen=True)
class Distinct:
    """Fails for a group with more than one distinct value; NULL values do not count."""

    issue: str
    key: Column
    value: Column
    group: Sequence[Column] = field(default_factory=tuple)
    where: Column | None = None


@dataclass(frozen=True)
class Count:
    """Fails for every key with more than ``above`` rows."""

    issue: str
    key: Column
    where: Column | None = None
    above: int = 0


@dataclass(frozen=True)
class PerRow:
    """Fails for every row that meets the condition, reporting its detail."""

    issue: str
    key: Column
    detail: Column
    where: Column


@dataclass(frozen=True)
class Total:
    """Fails when the number of matching rows differs from ``expected``."""

    issue: str
    key: str
    where: Column
    expected: int = 0


Check = Distinct | Count | PerRow | Total


def _emit(condition: Column | None, record: Column) -> Column:
    return record if condition is None else F.when(condition, record)


def _explode(df: DataFrame, records: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array_compact(F.array(*records))).alias("r")).select("r.*")


def _per_row(df: DataFrame, checks: list[PerRow]) -> DataFrame:
    records = [
        _emit(
            c.where,
            F.struct(
                c.key.cast("string").alias("failing_key"),
                F.lit(c.issue).alias("issue"),
                c.detail.cast(_DETAIL).alias("detail_count"),
            ),
        )
        for c in checks
    ]
    return _explode(df, records)


def _grouped(df: DataFrame, checks: list[Distinct | Count]) -> DataFrame:
    null = F.lit(None).cast("string")
    records = []
    for c in checks:
        distinct = isinstance(c, Distinct)
        # Extra grouping columns are folded into one text that keeps NULL apart from a value.
        group = F.to_json(F.array(*[g.cast("string") for g in c.group])) if distinct and c.group else null
        records.append(
            _emit(
                c.where,
                F.struct(
                    F.lit(c.issue).alias("issue"),
                    F.lit(distinct).alias("distinct"),
                    F.lit(1 if distinct else c.above).alias("above"),
                    c.key.cast("string").alias("failing_key"),
                    group.alias("grp"),
                    (c.value.cast("string") if distinct else null).alias("value"),
                ),
            )
        )
    keys = ["issue", "distinct", "above", "failing_key", "grp"]
    # The first grouping carries the value, so a hot key is spread over its values.
    per_value = _explode(df, records).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_value.groupBy(*keys)
        .agg(F.count("value").alias("_values"), F.sum("n").alias("_rows"))
        .withColumn("detail", F.when(F.col("distinct"), F.col("_values")).otherwise(F.col("_rows")))
        .where(F.col("detail") > F.col("above"))
        .select("failing_key", "issue", F.col("detail").cast(_DETAIL).alias("detail_count"))
    )


def _totals(df: DataFrame, checks: list[Total]) -> DataFrame:
    measured = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c.key).alias("failing_key"),
                    F.lit(c.issue).alias("issue"),
                    (F.count_if(c.where) - F.lit(c.expected)).cast(_DETAIL).alias("detail_count"),
                )
                for c in checks
            ]
        ).alias("r")
    )
    return measured.select(F.inline("r")).where(F.col("detail_count") != 0)


def check_report(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Failing keys of all checks as (failing_key, issue, detail_count); empty means every check passed."""
    todo = list(checks)
    branches = []
    if rows := [c for c in todo if isinstance(c, PerRow)]:
        branches.append(_per_row(df, rows))
    if groups := [c for c in todo if isinstance(c, (Distinct, Count))]:
        branches.append(_grouped(df, groups))
    if totals := [c for c in todo if isinstance(c, Total)]:
        branches.append(_totals(df, totals))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out.select(*REPORT_COLUMNS)
