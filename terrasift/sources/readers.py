"""Landing readers and the format dispatch."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasift.functions.geometry import DEFAULT_SRID, from_geojson
from terrasift.sources.cells import schema_of
from terrasift.sources.geopackage import read_geopackages
from terrasift.sources.typing import infer_types, tokens_to_null
from terrasift.sources.workbook import read_workbooks

# Accepted spellings of the file types.
FILE_TYPES = {
    "csv": "csv", "xlsx": "excel", "xls": "excel", "excel": "excel",
    "gpkg": "geopackage", "geopackage": "geopackage", "geojson": "geojson",
}


class UnsupportedFileTypeError(ValueError):
    """The file type is not one of the accepted spellings."""


class ExtractionError(RuntimeError):
    """The file is there but cannot be read as what it claims to be."""


@dataclass
class CsvLayout:
    """The headers of a CSV landing, each with the files that have it, and whether quotes hold line breaks."""

    headers: list[tuple[list[str], list[str]]]
    quoted_breaks: bool

    @property
    def repeated(self) -> list[str] | None:
        """The first header that names a column twice."""
        return next((names for names, _ in self.headers if len(set(names)) < len(names)), None)


def _odd_quotes() -> Column:
    return (F.length("value") - F.length(F.translate("value", '"', ""))) % 2 == 1


def csv_layout(spark: SparkSession, path: str) -> CsvLayout:
    """The first line of every file, in one pass over the text.

    What reaches the driver is one row a header with its file names, which the
    listing of the landing holds as well. Empty files have no header.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), _odd_quotes().alias("odd"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("place"),
    )
    files = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"), F.bool_or("odd").alias("odd"))
    found = files.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"), F.bool_or("odd").alias("odd"))
    rows = sorted(found.collect(), key=lambda r: r["files"])
    headers = [(next(csv.reader([r["header"].removeprefix("\ufeff")]), []), r["files"]) for r in rows]
    return CsvLayout(headers, any(r["odd"] for r in rows))


def _csv_by_name(reader: DataFrameReader, path: str, layout: CsvLayout) -> DataFrame:
    """Files of one header at a time, put together by column name; columns come in the order of the first header."""
    if len(layout.headers) < 2:
        return reader.csv(path)
    first = layout.headers[0][0]
    for names, files in layout.headers:
        if sorted(names) != sorted(first) or len(set(names)) < len(names):
            raise ExtractionError(f"CSV header {names} of '{files[0]}' does not have the columns {first}, each once")
    # Listed names are percent-encoded, and readers take some characters for patterns.
    literal = lambda f: re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f))
    texts = [T.StructType([T.StructField(n, T.StringType()) for n in names]) for names, _ in layout.headers]
    parts = [reader.schema(t).csv([literal(f) for f in files]) for t, (_, files) in zip(texts, layout.headers, strict=True)]
    return reduce(DataFrame.unionByName, parts)


def _has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some line of the files opens a quote that it does not close."""
    return not spark.read.text(path).where(_odd_quotes()).isEmpty()


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool | None = None,
    layout: CsvLayout | None = None,
) -> DataFrame:
    """Header row, missing-value tokens to NULL, types from the whole file or a given schema.

    Without a schema every column is read as text first, so one odd value
    cannot change how the others are parsed. Given their layout, files with the
    same columns in another order are read by name. Without it, files whose header
    differs from the first one's are refused rather than read by position; with
    it, those that lack or add columns. Line breaks inside
    quotes are looked for unless ``multi_line`` says whether there are any; files
    that hold some are read by one task each.
    """
    if multi_line is None:
        multi_line = layout.quoted_breaks if layout else _has_quoted_breaks(spark, path)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    # With a layout the headers have been compared, and a repeated name may be numbered by the reader.
    reader = reader.option("multiLine", multi_line).option("enforceSchema", layout is not None)
    text = tokens_to_null(_csv_by_name(reader, path, layout) if layout else reader.csv(path))
    if schema is None:
        return infer_types(text)
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema_of(schema).fields])


_FEATURES = (
    "crs struct<properties: struct<name: string>>, "
    "features array<struct<properties: map<string, string>, geometry: string>>"
)


def read_geojson(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, geometry: str = "geometry"
) -> DataFrame:
    """One row per feature, properties as columns, geometry as the struct.

    Without a schema the property names come from one aggregate over the keys
    and their types from another. A named reference system sets the SRID,
    otherwise the format's default holds.
    """
    docs = spark.read.schema(_FEATURES).option("multiLine", True).json(path)
    epsg = F.regexp_extract(F.col("crs.properties.name"), r"EPSG:+([0-9]+)$", 1).try_cast("int")
    srid = F.coalesce(epsg, F.lit(DEFAULT_SRID)).alias("srid")
    features = docs.select(srid, F.posexplode("features").alias("at", "f")).select("srid", "f.properties", F.col("f.geometry").alias("g"))
    schema = schema_of(schema)
    if schema is not None:
        names = schema.names
        columns = [F.try_element_at("properties", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
        attributes = features.select(*columns, "srid", "g")
    else:
        # Names in order of first use; a bounded set, one per property.
        entries = features.select(F.posexplode(F.map_keys("properties")).alias("at", "name"))
        found = entries.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
        names = [r["name"] for r in found]
        columns = [F.try_element_at("properties", F.lit(n)).alias(n) for n in names]
        attributes = infer_types_keeping(features.select(*columns, "srid", "g"), names)
    located = attributes.withColumn(geometry, from_geojson("g"))
    located = located.withColumn(geometry, F.col(geometry).withField("srid", F.col("srid")))
    return located.select(*names, geometry)


def infer_types_keeping(df: DataFrame, names: list[str]) -> DataFrame:
    """Type the named text columns, leaving the others as they are."""
    if not names:
        return df
    typed = infer_types(df.select(*[F.col(f"`{n}`") for n in names])).schema
    rest = [F.col(c) for c in df.columns if c not in names]
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in typed.fields], *rest)


_READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "excel": read_workbooks,
    "geopackage": read_geopackages,
    "geojson": read_geojson,
}


def file_kind(file_type: str) -> str:
    """Normalise a file type; unknown ones are refused with the accepted spellings."""
    kind = FILE_TYPES.get(file_type.strip().lower().lstrip("."))
    if kind is None:
        raise UnsupportedFileTypeError(f"Unsupported file_type '{file_type}'. Supported values: {sorted(FILE_TYPES)}")
    return kind


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system the path belongs to."""
    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").isEmpty()
    except AnalysisException:
        return False


def read_source(
    spark: SparkSession, path: str, file_type: str, schema: T.StructType | str | None = None,
    layout: CsvLayout | None = None,
) -> DataFrame:
    """Read a landing file by its declared type; CSV files by the names in their own headers."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Source file not found: {path}")
    kind = file_kind(file_type)
    if path.lower().endswith(".xls"):
        raise ExtractionError(f"'{path}' is a legacy binary workbook; save it as .xlsx")
    try:
        if kind == "csv":
            df = read_csv(spark, path, schema, layout=layout or csv_layout(spark, path))
        else:
            df = _READERS[kind](spark, path, schema)
        if not df.columns:
            raise ExtractionError(f"Failed to extract data from '{path}' as '{file_type}': no columns")
        return df
    except PySparkException as exc:
        raise ExtractionError(f"Failed to extract data from '{path}' as '{file_type}': {exc}") from exc


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names exactly as the file spells them, repeats included."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0]["value"] if first else ""
    probe = spark.range(1).select(F.from_csv(F.lit(line), F.lit(", ".join(f"c{i} string" for i in range(line.count(",") + 1)))).alias("r"))
    return [v for v in probe.first()["r"] if v is not None]
