"""Table sinks: replace and append loads, additive schema changes, layouts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasift.functions import geometry as G
from terrasift.functions.numeric import nan_to_null
from terrasift.operators.gate import geometry_columns
from terrasift.operators.joins import row_salt
from terrasift.operators.spatial import DEFAULT_CELL, grid_index

LOAD_MODES = ("replace", "append")

# Rows of one key or place can be split over up to this many ranges.
_LAYOUT_SALTS = 1024

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


class LoadError(ValueError):
    """The request or the frame cannot be loaded."""


@dataclass
class LoadResult:
    schema: str
    table: str
    load_mode: str
    rows_loaded: int
    columns: list[str] = field(default_factory=list)


def check_load(schema: str, table: str, mode: str, chunk_size: int | None) -> None:
    """K6: refuse unknown modes, unsafe identifiers and senseless batch sizes."""
    if mode not in LOAD_MODES:
        raise LoadError(f"Invalid load_mode '{mode}'. Must be one of {sorted(LOAD_MODES)}")
    for name in (schema, table):
        if not _IDENTIFIER.fullmatch(name or ""):
            raise LoadError(f"Invalid identifier '{name}'")
    if chunk_size is not None and chunk_size <= 0:
        raise LoadError(f"chunk_size must be positive, got {chunk_size}")


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def storage_type(dtype: T.DataType) -> T.DataType:
    """K3: the column type a landing type is stored as."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, (T.BooleanType, T.StringType)):
        return dtype
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    return T.StringType()


def storage_frame(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """K3 + K5: every column in its storage type, NaN as NULL; ``keep`` passes columns unchanged."""
    out = []
    for f in nan_to_null(df).schema.fields:
        target = storage_type(f.dataType)
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        if f.name in keep or f.dataType == target:
            out.append(_q(f.name))
        elif nested:
            out.append(F.to_json(_q(f.name)).alias(f.name))
        else:
            out.append(_q(f.name).cast(target).alias(f.name))
    return nan_to_null(df).select(*out)


def reconcile_columns(df: DataFrame, table: str) -> list[str]:
    """K4: add the columns the table lacks as nullable ones; changed types are refused."""
    spark = df.sparkSession
    existing = {f.name.lower(): f for f in spark.table(table).schema.fields}
    added = []
    for f in df.schema.fields:
        known = existing.get(f.name.lower())
        if known is None:
            added.append(f)
        elif known.dataType != f.dataType:
            raise LoadError(
                f"Column '{f.name}' of {table} is {known.dataType.simpleString()}, the source has {f.dataType.simpleString()}"
            )
    if added:
        ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"alter table {table} add columns ({ddl})")
    return [f.name for f in added]


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Columns by name in the order of the table; columns the source lacks are NULL."""
    own = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            _q(own[f.name.lower()]).alias(f.name) if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.sparkSession.table(table).schema.fields
        ]
    )


def _writer(df: DataFrame, location: str | None, partition_by: Sequence[str]):
    writer = df.write.format("parquet")
    if location:
        writer = writer.option("path", location)
    return writer.partitionBy(*partition_by) if partition_by else writer


def load_table(
    df: DataFrame,
    schema: str,
    table: str,
    mode: str = "replace",
    chunk_size: int | None = None,
    location: str | None = None,
    partition_by: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> LoadResult:
    """K1-K6: replace or append rows, creating the table when it is missing.

    Replacing keeps the table and everything built on it: the rows are
    overwritten in place. Rows are counted while they are written. A
    ``chunk_size`` is checked, but does not shape the files: as a number of rows
    a batch it would leave very many small ones.
    """
    check_load(schema, table, mode, chunk_size)
    if df.isEmpty():
        raise LoadError("Cannot load an empty frame")
    spark = df.sparkSession
    stored = storage_frame(df, keep)
    seen = Observation()
    counted = stored.observe(seen, F.count(F.lit(1)).alias("rows"))
    spark.sql(f"create database if not exists {schema}")
    name = f"{schema}.{table}"
    if not spark.catalog.tableExists(name):
        _writer(counted, location, partition_by).mode("errorifexists").saveAsTable(name)
    else:
        reconcile_columns(stored, name)
        _in_table_order(counted, name).write.insertInto(name, overwrite=mode == "replace")
    return LoadResult(schema, table, mode, int(seen.get["rows"]), list(df.columns))


def load_spatial(
    df: DataFrame,
    schema: str,
    table: str,
    mode: str = "replace",
    chunk_size: int | None = None,
    geometry: str | None = None,
    location: str | None = None,
    cell: float = DEFAULT_CELL,
) -> LoadResult:
    """K7 + K8: a frame with a geometry column, stored with its box and grid cell.

    The declared type is the single type present, or the generic ``Geometry``.
    """
    geometry = geometry or next(iter(geometry_columns(df)), None)
    if geometry is None:
        raise LoadError("The frame has no geometry column")
    g = _q(geometry)
    facts = df.agg(
        F.sort_array(F.collect_set(g["gtype"])).alias("types"), F.sort_array(F.collect_set(g["srid"])).alias("srids")
    ).first()
    srids = [s for s in facts["srids"] if s]
    if len(srids) != 1:
        raise LoadError(f"The geometry needs one reference system, found {srids}")
    declared = facts["types"][0] if len(facts["types"]) == 1 else "Geometry"
    laid_out = spatial_layout(df, geometry, cell)
    meta = {"geometry_type": declared, "srid": srids[0]}
    marked = laid_out.withColumn(geometry, g.alias(geometry, metadata=meta))
    return load_table(marked, schema, table, mode, chunk_size, location, keep=(geometry,))


def spatial_layout(df: DataFrame, geometry: str, cell: float = DEFAULT_CELL) -> DataFrame:
    """K8: bounding box and grid cell as columns, rows near each other kept together.

    Parquet keeps the extremes of these columns per row group, so a box filter
    skips most of the table. Range partitioning splits a crowded cell by the
    box itself, and a crowded spot by the row salt.
    """
    b = G.bounds(geometry)
    boxed = df.select(
        "*",
        *[b[c].alias(f"_{c}") for c in ("minx", "miny", "maxx", "maxy")],
        grid_index(b["minx"], cell).alias("_cell_x"),
        grid_index(b["miny"], cell).alias("_cell_y"),
    )
    return sorted_layout(boxed, "_cell_x", "_cell_y", "_minx", "_miny")


def sorted_layout(df: DataFrame, *keys: str) -> DataFrame:
    """K9: rows range-partitioned and sorted by the keys a later filter or join uses.

    The salt behind the keys lets a range boundary fall inside a hot key.
    """
    return df.repartitionByRange(*keys, row_salt(df, _LAYOUT_SALTS)).sortWithinPartitions(*keys)


def recreate_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Drop and create from a query."""
    df.sparkSession.sql(f"create database if not exists {name.split('.')[0]}")
    _writer(df, location, ()).mode("overwrite").saveAsTable(name)


def publish_view(df: DataFrame, name: str) -> None:
    """K11."""
    df.createOrReplaceTempView(name)


def write_ordered(df: DataFrame, name: str, *order: str, location: str | None = None) -> None:
    """Table whose files follow a total order; ties may span files."""
    recreate_table(df.orderBy(*order, row_salt(df, _LAYOUT_SALTS)), name, location)


def bucketed_table(df: DataFrame, name: str, buckets: int, *keys: str, location: str | None = None) -> None:
    """K9: bucketed and sorted by the join keys, so repeated joins need no shuffle."""
    df.sparkSession.sql(f"create database if not exists {name.split('.')[0]}")
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
