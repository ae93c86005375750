"""Declared test suites, compiled into one scan of the model.

Every row of the model sends a small record for each test it says something
about: a failing row its test, a test on keys its key as well. Parents and
compared tables add records of their own, so that keys without a parent, and
row counts that differ, come out of the same grouping instead of joins. Records
are counted before the shuffle; a hot key is one counter a task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.operators.joins import lookup_join

_ROWS = "rows"


@dataclass(frozen=True)
class Expectation:
    """A test of a suite. ``where`` limits it to some rows; ``severity`` is what a failure means."""

    name: str
    severity: str = "error"
    where: str | None = None


@dataclass(frozen=True)
class Rows(Expectation):
    """Fails for each row for which the condition holds; an unknown result does not fail."""

    fails: str | Callable[[], Column] = "false"


@dataclass(frozen=True)
class Unique(Expectation):
    """Fails for each key that several rows have. A single null column is no key; a combination with nulls is one."""

    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Accepted(Expectation):
    """Fails for each value beyond the accepted ones; null is not judged."""

    column: str = ""
    values: tuple = ()


@dataclass(frozen=True)
class Share(Expectation):
    """Fails once when a smaller share of the rows than ``at_least`` has a value; a model without rows passes."""

    column: str = ""
    at_least: float = 1.0


@dataclass(frozen=True)
class Related(Expectation):
    """Fails for each row whose key no row of the table ``parent`` has; null keys are not judged."""

    column: str = ""
    parent: str = ""
    parent_column: str = ""


@dataclass(frozen=True)
class DistinctCount(Expectation):
    """Fails once when the column has another number of values than expected."""

    column: str = ""
    expected: int = 0


@dataclass(frozen=True)
class SameRows(Expectation):
    """Fails by the difference between the row counts of the model and the table ``other``."""

    other: str = ""


@dataclass(frozen=True)
class NotAboveParent(Expectation):
    """Fails for each row whose measure exceeds that of its parent in the table ``parent``."""

    key: str = ""
    measure: str = ""
    parent: str = ""


def _not_null(c: str, **kw) -> Rows:
    return Rows(f"not_null_{c}", fails=f"`{c}` is null", **kw)


def not_null(*columns: str, **kw) -> list[Expectation]:
    return [_not_null(c, **kw) for c in columns]


def unique(*columns: str, **kw) -> Unique:
    return Unique("unique_" + "_".join(columns), columns=columns, **kw)


def not_empty(*columns: str, **kw) -> list[Expectation]:
    return [Rows(f"not_empty_string_{c}", fails=f"trim(`{c}`) = ''", **kw) for c in columns]


def in_range(column: str, low: float | None = None, high: float | None = None, **kw) -> Rows:
    ends = [f"`{column}` {sign} {end}" for sign, end in (("<", low), (">", high)) if end is not None]
    return Rows(f"accepted_range_{column}", fails=" or ".join(ends), **kw)


def accepted(column: str, *values, **kw) -> Accepted:
    return Accepted(f"accepted_values_{column}", column=column, values=values, **kw)


def share(column: str, at_least: float, **kw) -> Share:
    return Share(f"not_null_proportion_{column}", column=column, at_least=at_least, **kw)


def is_true(name: str, expression: str, **kw) -> Rows:
    return Rows(name, fails=f"not ({expression})", **kw)


def related(column: str, parent: str, parent_column: str, **kw) -> Related:
    return Related(f"relationships_{column}", column=column, parent=parent, parent_column=parent_column, **kw)


# What a grouped record counts as: failing rows, keys above one row, keys, rows without a parent, or a row count.
_ROW, _KEY, _VALUE, _ORPHAN, _COUNT = "row", "key", "value", "orphan", "count"


def _record(test: str, kind: str, key: Column | None = None, weight: int = 1, parent: bool = False) -> Column:
    no_key = F.lit(None).cast("string")
    return F.struct(
        F.lit(test).alias("test"), F.lit(kind).alias("kind"), (no_key if key is None else key).alias("key"),
        F.lit(weight).alias("weight"), F.lit(parent).alias("parent"),
    )


def _said(test: Expectation) -> Column:
    """The record that a row sends for a test, null where it has nothing to say."""
    rows = F.lit(True) if test.where is None else F.expr(test.where)
    match test:
        case Rows(fails=fails):
            return F.when(rows & (F.expr(fails) if isinstance(fails, str) else fails()), _record(test.name, _ROW))
        case Unique(columns=(one,)):
            return F.when(rows & F.col(one).isNotNull(), _record(test.name, _KEY, F.col(one).cast("string")))
        case Unique(columns=several):
            # Told apart by position, so a null is a value of its own.
            key = F.to_json(F.array(*[F.col(c).cast("string") for c in several]), {"ignoreNullFields": "false"})
            return F.when(rows, _record(test.name, _KEY, key))
        case Accepted(column=c, values=values):
            return F.when(rows & ~F.col(c).isin(list(values)), _record(test.name, _VALUE, F.col(c).cast("string")))
        case Share(column=c):
            return F.when(rows & F.col(c).isNotNull(), _record(test.name, _ROW))
        case Related(column=c):
            return F.when(rows & F.col(c).isNotNull(), _record(test.name, _ORPHAN, F.col(c).cast("string")))
        case DistinctCount(column=c):
            return F.when(rows & F.col(c).isNotNull(), _record(test.name, _VALUE, F.col(c).cast("string")))
        case SameRows():
            return F.when(rows, _record(test.name, _COUNT))
        case NotAboveParent(measure=m):
            return F.when(rows & (F.col(m) > F.col(f"_parent_{test.name}")), _record(test.name, _ROW))
    raise TypeError(f"unknown kind of test: {test}")


def run_suite(model: DataFrame, tests: Sequence[Expectation], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(test, severity, failures, status) of every test, the model read once.

    ``tables`` holds the parents and compared tables by name. Failures are rows,
    keys or values as each test says; status is pass, or the severity. A model
    without rows passes all tests but those on row and value counts.
    """
    names = [t.name for t in tests]
    if len(set(names)) < len(names):
        raise ValueError(f"tests of one name: {sorted({n for n in names if names.count(n) > 1})}")
    tables = tables or {}
    for t in tests:
        for needed in (getattr(t, "parent", None), getattr(t, "other", None)):
            if needed and needed not in tables:
                raise KeyError(f"test {t.name} needs the table '{needed}'")
        if isinstance(t, NotAboveParent):
            parents = tables[t.parent].select(F.col(t.key), F.col(t.measure).alias(f"_parent_{t.name}"))
            model = lookup_join(model, parents, t.key, "left")
    # Shares are of the rows that their test looks at, so rows are counted for each condition.
    bases = {t.where: f"{_ROWS}_{k}" for k, t in enumerate(tests) if isinstance(t, Share)}
    counted = [F.when(F.lit(True) if w is None else F.expr(w), _record(name, _ROW)) for w, name in bases.items()]
    records = model.select(F.explode(F.array_compact(F.array(*[_said(t) for t in tests], *counted))).alias("r")).select("r.*")
    for t in tests:
        if isinstance(t, Related):
            key = F.col(t.parent_column).cast("string")
            records = records.unionByName(tables[t.parent].where(key.isNotNull()).select(_record(t.name, _ORPHAN, key, 0, True).alias("r")).select("r.*"))
        if isinstance(t, SameRows):
            records = records.unionByName(tables[t.other].select(_record(t.name, _COUNT, None, -1).alias("r")).select("r.*"))
    grouped = records.groupBy("test", "kind", "key").agg(F.sum("weight").alias("n"), F.max("parent").alias("parent"))
    measured = (
        F.when(F.col("kind").isin(_ROW, _COUNT), F.col("n"))
        .when(F.col("kind") == _KEY, (F.col("n") > 1).cast("long"))
        .when(F.col("kind") == _VALUE, 1)
        .otherwise(F.when(F.col("parent"), 0).otherwise(F.col("n")))
    )
    # One number a test: as many rows as there are tests, whatever the model holds.
    per_test = grouped.groupBy("test").agg(F.sum(measured).alias("n"))
    totals = per_test.agg(F.coalesce(F.map_from_entries(F.collect_list(F.struct("test", "n"))), F.expr("map()").cast("map<string,bigint>")).alias("n"))

    def number(name: str) -> Column:
        return F.coalesce(F.col("n")[name], F.lit(0))

    def failures(t: Expectation) -> Column:
        match t:
            case Share(at_least=least):
                rows = number(bases[t.where])
                return F.when((rows > 0) & (number(t.name).cast("double") / rows < least), 1).otherwise(0)
            case DistinctCount(expected=n):
                return F.when(number(t.name) != n, 1).otherwise(0)
            case SameRows():
                return F.abs(number(t.name))
        return number(t.name)

    rows = [F.struct(F.lit(t.name).alias("test"), F.lit(t.severity).alias("severity"), failures(t).cast("long").alias("failures")) for t in tests]
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")).alias("status")
    return totals.select(F.inline(F.array(*rows))).select("test", "severity", "failures", status)
