"""Typed cells shared by the workbook and GeoPackage decoders.

A decoder runs inside ``mapInPandas`` over (path, content) rows, one file per
row, and yields every record as an array of cell texts led by a kind mark. The
columns are typed afterwards by Spark from the kinds seen over all files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER, TEXT, FLAG, MOMENT = "n", "s", "b", "d"

# Records per Arrow batch: a file of any length streams through bounded memory.
BATCH_ROWS = 10_000


def cell(kind: str, value: str) -> str:
    return kind + value


def read_files(spark, path: str, suffixes: tuple[str, ...]) -> DataFrame:
    """(path, content) of the files below a path, read through the cluster's file system."""
    reader = spark.read.format("binaryFile")
    if not path.lower().endswith(suffixes):
        reader = reader.option("pathGlobFilter", "*{" + ",".join(suffixes) + "}").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "content")


def schema_of(schema: T.StructType | str | None) -> T.StructType | None:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def type_cells(
    records: DataFrame, names: list[str], keep: tuple[str, ...] = (), schema: T.StructType | None = None
) -> DataFrame:
    """Columns from the ``cells`` array, typed by the schema or else by one aggregate over the kinds."""

    def at(i: int) -> Column:
        return F.get("cells", F.lit(i))

    if schema is not None:
        typed = [F.substring(at(i), 2, 2**31 - 1).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
        return records.select(*[F.col(k) for k in keep], *typed)

    def kind(i: int, k: str) -> Column:
        return F.count_if(at(i).startswith(k))

    def whole_number(i: int) -> Column:
        """The cell as 64-bit integer, straight from its text; NULL if it is none."""
        text = F.regexp_extract(at(i), r"^n(-?[0-9]+)(\.0)?\z", 1)
        return F.nullif(text, F.lit("")).try_cast("bigint")

    stats = records.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(
                F.count(at(i)).alias("filled"),
                kind(i, NUMBER).alias(NUMBER),
                kind(i, FLAG).alias(FLAG),
                kind(i, MOMENT).alias(MOMENT),
                F.count(whole_number(i)).alias("integral"),
            ).alias(f"c{i}")
            for i in range(len(names))
        ],
    ).first()
    out = [F.col(k) for k in keep]
    for i, name in enumerate(names):
        s = stats[f"c{i}"]
        value = F.substring(at(i), 2, 2**31 - 1)
        if s["filled"] == 0 or s[NUMBER] == s["filled"]:
            whole = s["filled"] == stats["rows"] and s["filled"] > 0 and s["integral"] == s["filled"]
            out.append((whole_number(i) if whole else value.cast("double")).alias(name))
        elif s[MOMENT] == s["filled"]:
            out.append(value.cast("timestamp_ntz").alias(name))
        elif s[FLAG] == s["filled"] == stats["rows"]:
            out.append((value == "1").alias(name))
        else:
            out.append(value.alias(name))
    return records.select(*out)
