"""Dataset descriptions in YAML files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.sources.readers import path_exists

DESCRIPTION_SCHEMA = (
    "file string, error string, name string, description string, owner string, priority int, "
    "has_source boolean, type string, path string, file_type string, "
    "loader_class string, chunk_size int, load_mode string, "
    "has_target boolean, database string, `schema` string, `table` string"
)


def _parse(file: str, text: str) -> dict:
    import yaml

    row: dict = {"file": file}
    try:
        doc = yaml.safe_load(text)
    except yaml.YAMLError as exc:
        return row | {"error": f"unreadable: {exc}".splitlines()[0]}
    if not isinstance(doc, dict):
        return row | {"error": "not a mapping"}
    dataset = doc.get("dataset")
    if not isinstance(dataset, dict):
        return row | {"error": "missing 'dataset' block"}
    if not dataset.get("name"):
        return row | {"error": "missing dataset name"}
    source, target = doc.get("source"), doc.get("target")
    loader = doc.get("loader") if isinstance(doc.get("loader"), dict) else {}
    row |= {k: dataset.get(k) for k in ("name", "description", "owner", "priority")}
    row |= {"has_source": isinstance(source, dict), "has_target": isinstance(target, dict)}
    source, target = (x if isinstance(x, dict) else {} for x in (source, target))
    row |= {k: source.get(k) for k in ("type", "path", "file_type")}
    row |= {k: target.get(k) for k in ("database", "schema", "table")}
    # Some descriptions keep the load mode with the target instead of the loader.
    row |= {
        "loader_class": loader.get("class"),
        "chunk_size": loader.get("chunk_size"),
        "load_mode": loader.get("load_mode") or target.get("load_mode"),
    }
    return row


_FIELDS = [f.split()[0].strip("`") for f in DESCRIPTION_SCHEMA.split(", ")]
_WHOLE = ("priority", "chunk_size")
_FLAGS = ("has_source", "has_target")


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [_parse(p, t) for p, t in zip(pdf["path"], pdf["text"])]
        out = pd.DataFrame([[r.get(f) for f in _FIELDS] for r in rows], columns=_FIELDS, dtype=object)
        for c in _FIELDS:
            if c in _WHOLE:
                out[c] = pd.to_numeric(out[c], errors="coerce").astype("Int32")
            elif c not in _FLAGS:
                out[c] = out[c].map(lambda v: None if v is None else str(v))
        yield out


def parse_descriptions(files: DataFrame) -> DataFrame:
    """Descriptions of a (path, text) frame; a bad file is a row with ``error`` set."""
    return files.select("path", "text").mapInPandas(_parse_batches, DESCRIPTION_SCHEMA)


def read_descriptions(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``*.yml`` below a directory."""
    if not path_exists(spark, directory):
        raise FileNotFoundError(f"Metadata directory not found: {directory}")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.yml")
        .load(directory)
    )
    return parse_descriptions(files.select("path", F.col("content").cast("string").alias("text")))
