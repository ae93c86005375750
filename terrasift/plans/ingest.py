"""Metadata-driven loading: extract, gate, load."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from terrasift.operators.gate import DataQualityError, Rules, ValidationResult, validate
from terrasift.plans.registry import MetadataResolutionError, Registry, resolve
from terrasift.session import staged
from terrasift.sources.readers import ExtractionError, UnsupportedFileTypeError, csv_layout, file_kind, path_exists, read_source
from terrasift.sources.writers import LoadError, LoadResult, load_spatial, load_table

# Loader names and whether they store geometry.
LOADER_CLASSES = {"CSVLoader": False, "ExcelLoader": False, "GeoPackageLoader": True, "GeoJSONLoader": True}


class IngestionError(RuntimeError):
    """Extraction or loading of a dataset failed."""


class UnsupportedLoaderClassError(ValueError):
    """The configured loader is not known."""


@dataclass
class RunResult:
    dataset_name: str
    metadata: dict[str, Any]
    rows_extracted: int
    validation: ValidationResult
    load: LoadResult


def spatial_loader(loader_class: str) -> bool:
    if loader_class not in LOADER_CLASSES:
        raise UnsupportedLoaderClassError(
            f"Unsupported loader_class '{loader_class}'. Supported values: {sorted(LOADER_CLASSES)}"
        )
    return LOADER_CLASSES[loader_class]


def _extract(spark: SparkSession, path: str, file_type: str) -> tuple[DataFrame, list[str] | None]:
    """The frame, and for CSV landings the first header that names a column twice."""
    try:
        is_csv = file_kind(file_type) == "csv" and path_exists(spark, path)
        layout = csv_layout(spark, path) if is_csv else None
        return read_source(spark, path, file_type, layout=layout), layout.repeated if layout else None
    except (FileNotFoundError, UnsupportedFileTypeError, ExtractionError) as exc:
        raise IngestionError(f"Extraction failed for '{path}' as '{file_type}': {exc}") from exc


def load(
    df: DataFrame,
    loader_class: str,
    schema: str,
    table: str,
    load_mode: str | None = None,
    chunk_size: int | None = None,
    location: str | None = None,
) -> LoadResult:
    """Load a frame with the configured loader; no mode means replace."""
    sink = load_spatial if spatial_loader(loader_class) else load_table
    try:
        return sink(df, schema, table, load_mode or "replace", chunk_size, location=location)
    except LoadError as exc:
        raise IngestionError(f"Load failed for {schema}.{table}: {exc}") from exc


def ingest(
    spark: SparkSession,
    path: str,
    file_type: str,
    loader_class: str,
    schema: str,
    table: str,
    load_mode: str = "replace",
    chunk_size: int | None = None,
) -> LoadResult:
    """L2: extract and load without the gate."""
    spatial_loader(loader_class)
    return load(_extract(spark, path, file_type)[0], loader_class, schema, table, load_mode, chunk_size)


def gated_load(
    df: DataFrame,
    meta: Mapping[str, Any],
    rules: Rules | None = None,
    raise_on_invalid: bool = True,
    location: str | None = None,
    header: list[str] | None = None,
) -> RunResult:
    """Validate, then load; an invalid frame is refused unless told otherwise.

    The frame is staged on shared storage between the two, so the source is
    read once. ``header`` carries column names as the source spells them.
    """
    df = staged(df)
    outcome = validate(df, rules, header=header)
    if not outcome.is_valid and raise_on_invalid:
        raise DataQualityError(outcome.errors)
    done = load(
        df,
        meta["loader_class"],
        meta["schema"],
        meta["table"],
        meta["load_mode"],
        meta["chunk_size"],
        location,
    )
    return RunResult(meta["dataset_name"], dict(meta), outcome.checked_rows, outcome, done)


def resolve_one(registry: Registry, name: str) -> Row:
    found = resolve(registry, [name]).first()
    if found is None:
        raise MetadataResolutionError(f"Dataset '{name}' is not registered")
    if found["missing"]:
        raise MetadataResolutionError(f"No {found['missing']} registered for dataset '{name}'")
    return found


def run_dataset(
    spark: SparkSession,
    registry: Registry,
    name: str,
    rules: Rules | None = None,
    raise_on_invalid: bool = True,
) -> RunResult:
    """L1: resolve, extract, validate, load."""
    meta = resolve_one(registry, name).asDict()
    spatial_loader(meta["loader_class"])
    df, repeated = _extract(spark, meta["path"], meta["file_type"])
    return gated_load(df, meta, rules, raise_on_invalid, header=repeated)


def run_all(
    spark: SparkSession,
    registry: Registry,
    rules: Mapping[str, Rules] | None = None,
    raise_on_invalid: bool = True,
    parallel: int = 4,
) -> dict[str, RunResult | Exception]:
    """L4: every configured dataset, by priority; independent Spark jobs run side by side."""
    order = registry.config.orderBy(F.col("priority").asc_nulls_last(), "asset_name").select("asset_name").collect()
    names = [r["asset_name"] for r in order]

    def one(name: str) -> RunResult | Exception:
        try:
            return run_dataset(spark, registry, name, (rules or {}).get(name), raise_on_invalid)
        except Exception as exc:  # noqa: BLE001 - one failing dataset must not stop the others
            return exc

    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(names, pool.map(one, names)))
