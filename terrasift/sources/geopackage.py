"""GeoPackage files: attributes and geometry of the first feature table (S3)."""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasift.functions.geometry import from_wkb
from terrasift.sources.cells import BATCH_ROWS, NUMBER, TEXT, cell, read_files, schema_of, type_cells

# Bytes taken by the envelope for each envelope code of the blob header.
_ENVELOPE_BYTES = (0, 32, 48, 48, 64)


def _open(content: bytes) -> sqlite3.Connection:
    db = sqlite3.connect(":memory:")
    db.deserialize(content)
    return db


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _layout(db: sqlite3.Connection) -> tuple[str, str, list[str]]:
    table, geometry = db.execute(
        "select table_name, column_name from gpkg_geometry_columns order by table_name limit 1"
    ).fetchone()
    info = db.execute(f"pragma table_info({_quoted(table)})").fetchall()
    # The integer primary key is the feature id, not an attribute.
    names = [r[1] for r in info if r[1] != geometry and not (r[5] and r[2].upper().startswith("INT"))]
    return table, geometry, names


def split_blob(blob: bytes | None) -> tuple[int | None, bytes | None]:
    """SRID and WKB of a geometry blob; an empty geometry has no WKB."""
    if not blob or blob[:2] != b"GP":
        return None, None
    flags = blob[3]
    (srid,) = struct.unpack_from("<i" if flags & 1 else ">i", blob, 4)
    wkb = bytes(blob[8 + _ENVELOPE_BYTES[(flags >> 1) & 7] :])
    return srid, None if flags & 0x10 else wkb


def join_blob(srid: int, wkb: bytes) -> bytes:
    return b"GP\x00\x01" + struct.pack("<i", srid) + wkb


def _cell(v) -> str | None:
    if v is None:
        return None
    if isinstance(v, (int, float)):
        return cell(NUMBER, repr(v))
    return cell(TEXT, v if isinstance(v, str) else bytes(v).hex())


def _names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        heads = [_layout(_open(c))[2] for c in pdf["content"]]
        yield pd.DataFrame({"path": pdf["path"].tolist(), "names": heads})


def _records(names: list[str]):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                db = _open(content)
                table, geometry, own = _layout(db)
                wanted = ", ".join(_quoted(n) if n in own else "null" for n in names)
                cursor = db.execute(
                    f"select {_quoted(geometry)}{', ' + wanted if wanted else ''} from {_quoted(table)} order by rowid"
                )
                while rows := cursor.fetchmany(BATCH_ROWS):
                    parts = [split_blob(r[0]) for r in rows]
                    yield pd.DataFrame(
                        {
                            "srid": pd.array([p[0] for p in parts], dtype="Int32"),
                            "wkb": [p[1] for p in parts],
                            "cells": [[_cell(v) for v in r[1:]] for r in rows],
                        }
                    )
                db.close()

    return decode


def decode_geopackages(
    files: DataFrame, geometry: str = "geometry", schema: T.StructType | str | None = None
) -> DataFrame:
    """Features of all files in a (path, content) frame; a schema of the attributes saves two passes."""
    schema = schema_of(schema)
    if schema is not None:
        names = schema.names
    else:
        heads = files.mapInPandas(_names, "path string, names array<string>")
        spread = heads.select(F.posexplode("names").alias("at", "name"))
        # Bounded by the number of attributes, not by the features.
        found = spread.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
        names = [r["name"] for r in found]
    records = files.mapInPandas(_records(names), "srid int, wkb binary, cells array<string>")
    typed = type_cells(records, names, keep=("srid", "wkb"), schema=schema)
    parsed = typed.withColumn(geometry, from_wkb("wkb"))
    located = parsed.withColumn(geometry, F.col(geometry).withField("srid", F.col("srid")))
    return located.select(*names, geometry)


def read_geopackages(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S3: one file, or every file below a folder."""
    return decode_geopackages(read_files(spark, path, (".gpkg",)), schema=schema)


def geopackage_bytes(table: str, names: list[str], rows: list[tuple], srid: int = 4326) -> bytes:
    """A GeoPackage with one feature table; each row is the attributes followed by its WKB."""
    db = sqlite3.connect(":memory:")
    db.execute("create table gpkg_contents (table_name text primary key, data_type text, identifier text, srs_id integer)")
    db.execute(
        "create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id integer, z tinyint, m tinyint)"
    )
    db.execute("insert into gpkg_contents values (?, 'features', ?, ?)", (table, table, srid))
    db.execute("insert into gpkg_geometry_columns values (?, 'geom', 'GEOMETRY', ?, 0, 0)", (table, srid))
    cols = ", ".join(_quoted(n) for n in names)
    db.execute(f"create table {_quoted(table)} (fid integer primary key, geom blob, {cols})")
    marks = ", ".join("?" for _ in range(len(names) + 1))
    db.executemany(
        f"insert into {_quoted(table)} (geom, {cols}) values ({marks})",
        [(None if r[-1] is None else join_blob(srid, r[-1]), *r[:-1]) for r in rows],
    )
    db.commit()
    return db.serialize()
