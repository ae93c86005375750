"""Catalogue views, previews and orderings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.functions.numeric import priority_rank
from terrasift.operators.profiling import PRIORITIES

_CATALOGUE = "table_schema string, table_name string, table_type string, row_count bigint"


def load_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    """Full-table scans keyed by bare table name."""
    return {n.split(".")[-1]: spark.table(n) for n in names}


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """S8 / O4."""
    return df.limit(n)


def column_catalogue(df: DataFrame, name: str) -> DataFrame:
    """Name, type and nullability of every column in order, with its number of values."""
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(i).alias("ordinal_position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
                    F.count(F.col(f"`{f.name}`")).alias("n_values"),
                )
                for i, f in enumerate(df.schema.fields, start=1)
            ]
        ).alias("r")
    ).select(F.inline("r"))


def table_catalogue(spark: SparkSession, schemas: Sequence[str] | None = None) -> DataFrame:
    """Tables of the session catalog with their row counts, by schema and name."""
    wanted = list(schemas) if schemas else [d.name for d in spark.catalog.listDatabases()]
    found = [(s, t) for s in wanted for t in spark.catalog.listTables(s) if t.tableType in ("MANAGED", "EXTERNAL")]
    counts = [
        spark.table(f"`{s}`.`{t.name}`").agg(
            F.lit(s).alias("table_schema"),
            F.lit(t.name).alias("table_name"),
            F.lit(t.tableType).alias("table_type"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for s, t in found
    ]
    if not counts:
        return spark.createDataFrame([], _CATALOGUE)
    return reduce(lambda a, b: a.unionByName(b), counts).orderBy("table_schema", "table_name")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """S10 for frames that are not in the catalog."""
    counts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), counts).orderBy("table_name")


def by_priority(df: DataFrame, c: str, order: Mapping[str, int] = PRIORITIES) -> DataFrame:
    """O2."""
    return df.orderBy(priority_rank(c, order))


def top_rows(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """O3: the k largest rows; planned as a top-k without a full sort."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def find_one(df: DataFrame, **equal) -> DataFrame:
    """The first row meeting all equalities."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == kv[1]), equal.items(), df).limit(1)
