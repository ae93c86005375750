"""Collects queries and the SQL each is compared with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.inputs import INPUTS, Tables, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Reference formulations shared by several comparisons, as named SQL texts.
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def _with(sql: str) -> str:
    """Prefix the inputs and views a text mentions, in order of dependency."""
    known = {**{n: duck(s) for n, s in INPUTS.items()}, **VIEWS}
    order: list[str] = []

    def visit(text: str) -> None:
        for n in known:
            if n not in order and re.search(rf"\b{n}\b", text):
                visit(known[n])
                if n not in order:
                    order.append(n)

    visit(sql)
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    if not ctes:
        return sql
    return f"WITH {ctes}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = _with(sql)
        return fn

    return wrap
