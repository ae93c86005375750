"""Dataset registry: registration and resolution as set operations.

Registering a directory is one batch of joins against the existing tables, not
a loop over files. Keys are hashes of the natural key, so registering again
gives the same ids.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.operators.joins import lookup_join

DATASET_SCHEMA = "id bigint, name string, description string, owner string, priority int"
SOURCE_SCHEMA = "id bigint, dataset_id bigint, type string, path string, file_type string"
TARGET_SCHEMA = "id bigint, dataset_id bigint, database string, schema string, table string"
CONFIG_SCHEMA = (
    "pipeline_id bigint, dataset_id bigint, asset_name string, priority int, loader_class string, "
    "chunk_size int, load_mode string, created_at timestamp, updated_at timestamp"
)


class MetadataResolutionError(LookupError):
    """A dataset cannot run because part of its metadata is not registered."""


@dataclass
class Registry:
    dataset: DataFrame
    source: DataFrame
    target: DataFrame
    config: DataFrame


def empty_registry(spark: SparkSession) -> Registry:
    return Registry(*[spark.createDataFrame([], s) for s in (DATASET_SCHEMA, SOURCE_SCHEMA, TARGET_SCHEMA, CONFIG_SCHEMA)])


def _id(*cols: str) -> Column:
    return F.xxhash64(*[F.col(c) for c in cols])


def new_datasets(descriptions: DataFrame, existing: DataFrame) -> DataFrame:
    """Datasets whose name is new; of several files with one name the first in path order counts."""
    fields = ["name", "description", "owner", "priority"]
    first = F.min(F.struct("file", *[F.col(f) for f in fields[1:]])).alias("f")
    valid = descriptions.where(F.col("error").isNull() & (F.length("name") > 0))
    chosen = valid.groupBy("name").agg(first).select("name", *[F.col(f"f.{f}") for f in fields[1:]])
    fresh = chosen.join(existing.select("name"), "name", "left_anti")
    return fresh.select(_id("name").alias("id"), *fields)


def _with_dataset(descriptions: DataFrame, datasets: DataFrame) -> DataFrame:
    ids = datasets.select(F.col("id").alias("dataset_id"), "name")
    return lookup_join(descriptions.where(F.col("error").isNull()), ids, "name", "inner")


def unresolved(descriptions: DataFrame, datasets: DataFrame) -> DataFrame:
    """Files left out: unreadable ones, and those whose dataset is not registered."""
    bad = descriptions.where(F.col("error").isNotNull()).select("file", "error")
    named = descriptions.where(F.col("error").isNull())
    lost = lookup_join(named, datasets.select("name"), "name", "left_anti")
    return bad.unionByName(lost.select("file", F.concat(F.lit("dataset not registered: "), "name").alias("error")))


def _content_key(pattern: Sequence[bool], fields: Sequence[str]) -> Column:
    """Text key of the fields the pattern keeps."""
    kept = [F.col(f).cast("string") if keep else F.lit(None).cast("string") for keep, f in zip(pattern, fields)]
    return F.to_json(F.array(F.col("dataset_id").cast("string"), *kept))


def _new_children(rows: DataFrame, existing: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows repeating neither the table nor an earlier file of the batch.

    A row repeats another when all its non-NULL fields agree. Every row is
    entered under each subset of its filled fields with the earliest file that
    has them, so a row finds what it repeats by one key instead of being
    compared with the other rows of its dataset.
    """
    batch = rows.groupBy("dataset_id", *fields).agg(F.min("file").alias("file"))
    known = existing.select("dataset_id", *fields, F.lit("").alias("file")).unionByName(batch)
    patterns = list(product((True, False), repeat=len(fields)))

    def filled(pattern: Sequence[bool]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for k, f in zip(pattern, fields) if k], F.lit(True))

    entries = F.array_compact(F.array(*[F.when(filled(p), _content_key(p, fields)) for p in patterns]))
    earliest = known.select(F.explode(entries).alias("_key"), "file").groupBy("_key").agg(F.min("file").alias("_first"))
    own = F.to_json(F.array(*[F.col(c).cast("string") for c in ("dataset_id", *fields)]))
    # The batch holds each content once, so no key repeats on either side.
    fresh = batch.withColumn("_key", own).join(earliest, "_key").where(F.col("_first") == F.col("file"))
    return fresh.select(F.xxhash64("dataset_id", *fields).alias("id"), "dataset_id", *fields)


def new_sources(descriptions: DataFrame, datasets: DataFrame, existing: DataFrame) -> DataFrame:
    """R2."""
    rows = _with_dataset(descriptions, datasets).where("has_source")
    return _new_children(rows, existing, ["type", "path", "file_type"])


def new_targets(descriptions: DataFrame, datasets: DataFrame, existing: DataFrame) -> DataFrame:
    """R3."""
    rows = _with_dataset(descriptions, datasets).where("has_target")
    return _new_children(rows, existing, ["database", "schema", "table"])


def new_configs(descriptions: DataFrame, datasets: DataFrame, existing: DataFrame) -> DataFrame:
    """One configuration per dataset; its asset name is the dataset name."""
    fields = ["priority", "loader_class", "chunk_size", "load_mode"]
    rows = _with_dataset(descriptions, datasets).withColumn("asset_name", F.col("name"))
    keys = ["dataset_id", "asset_name"]
    first = F.min(F.struct("file", *fields)).alias("f")
    chosen = rows.groupBy(*keys).agg(first).select(*keys, *[F.col(f"f.{f}") for f in fields])
    fresh = chosen.join(existing.select(*keys), keys, "left_anti")
    now = F.current_timestamp()
    return fresh.select(
        _id(*keys).alias("pipeline_id"), *keys, *fields, now.alias("created_at"), now.alias("updated_at")
    )


def register_all(descriptions: DataFrame, registry: Registry) -> Registry:
    """R1-R4 in order: datasets first, everything else refers to them."""
    datasets = registry.dataset.unionByName(new_datasets(descriptions, registry.dataset))
    return Registry(
        datasets,
        registry.source.unionByName(new_sources(descriptions, datasets, registry.source)),
        registry.target.unionByName(new_targets(descriptions, datasets, registry.target)),
        registry.config.unionByName(new_configs(descriptions, datasets, registry.config)),
    )


def list_configs(registry: Registry) -> DataFrame:
    """R6."""
    return registry.config.orderBy("pipeline_id")


def resolve(registry: Registry, names: Sequence[str] | None = None) -> DataFrame:
    """Everything needed to run each dataset, with the first missing piece named.

    A dataset with several sources or targets resolves to the one with the
    smallest id.
    """
    d = registry.dataset.select(F.col("id").alias("dataset_id"), F.col("name").alias("dataset_name"))
    if names is not None:
        d = d.where(F.col("dataset_name").isin(list(names)))

    def one(df: DataFrame, fields: Sequence[str], key: str, mark: str) -> DataFrame:
        first = F.min(F.struct(key, *fields)).alias("f")
        return df.groupBy("dataset_id").agg(first).select(
            "dataset_id", *[F.col(f"f.{f}") for f in fields], F.lit(True).alias(mark)
        )

    s = one(registry.source, ["type", "path", "file_type"], "id", "_s")
    t = one(registry.target, ["database", "schema", "table"], "id", "_t")
    c = (
        registry.config.groupBy(F.col("asset_name").alias("dataset_name"))
        .agg(F.min(F.struct("pipeline_id", "priority", "loader_class", "chunk_size", "load_mode")).alias("f"))
        .select("dataset_name", "f.priority", "f.loader_class", "f.chunk_size", "f.load_mode", F.lit(True).alias("_c"))
    )
    missing = (
        F.when(F.col("_s").isNull(), F.lit("source"))
        .when(F.col("_t").isNull(), F.lit("target"))
        .when(F.col("_c").isNull(), F.lit("pipeline_config"))
    )
    joined = d.join(s, "dataset_id", "left").join(t, "dataset_id", "left").join(c, "dataset_name", "left")
    return joined.withColumn("missing", missing).drop("_s", "_t", "_c")
