"""Description of all columns of a table at once (X1): counts, modes and quartiles.

Every filled cell is a record (column, value). Records are counted before they
move and are then laid out by range over (column, value), so a column lies in
order over many tasks. Totals of each column and range tell modes at once and
the ranges that hold the ranks of the quartiles; only these are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasift.operators.reconcile import overview
from terrasift.session import staged

QUARTILES = (0.25, 0.5, 0.75)
_NUMBERS = ("integer", "long", "double", "float", "short", "byte", "decimal")


def _cells(df: DataFrame) -> DataFrame:
    """(column, num, text) of every filled cell: numbers as num, all else as text. NaN counts as missing."""

    def cell(f) -> Column:
        c = F.col(f"`{f.name}`")
        number = f.dataType.typeName() in _NUMBERS
        num = F.nanvl(c.cast("double"), F.lit(None).cast("double")) if number else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if number else c.cast("string")
        record = F.struct(F.lit(f.name).alias("column"), num.alias("num"), text.alias("text"))
        return F.when(num.isNotNull() if number else text.isNotNull(), record)

    return df.select(F.explode(F.array_compact(F.array(*[cell(f) for f in df.schema.fields]))).alias("r")).select("r.*")


def described(df: DataFrame, name: str) -> DataFrame:
    """One row a column with counts, and mode or moments and quartiles.

    ``unique``, ``top`` and ``freq`` tell the distinct values and the most
    frequent one (ties: the least) of columns that are not numbers; ``mean``,
    ``std``, ``min``, ``q25``, ``q50``, ``q75``, ``max`` those of numbers, the
    quartiles interpolated linearly. Values that do not apply are null, as they
    are for columns without values. Nested columns are described by their text.
    """
    sizes = _cells(df).groupBy("column", "num", "text").agg(F.count(F.lit(1)).alias("n"))
    # Stored, since range bounds may differ from one evaluation to the next.
    ranged = staged(sizes.repartitionByRange("column", "num", "text").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("column", "part").agg(
        F.sum("n").alias("filled"), F.count(F.lit(1)).alias("values"), F.min(F.struct((-F.col("n")).alias("n"), "text")).alias("mode"), F.count("num").alias("numbers")
    )
    modes = parts.groupBy("column").agg(F.sum("values").alias("values"), F.min("mode").alias("mode"), F.sum("numbers").alias("numbers"))
    column = Window.partitionBy("column")
    # One row for each column and range.
    ends = parts.where("numbers > 0").withColumns({"end": F.sum("filled").over(column.orderBy("part")), "all": F.sum("filled").over(column)})
    at = [((F.col("all") - 1) * q) for q in QUARTILES]
    ranks = F.array(*[F.struct(F.lit(k).alias("quartile"), p.alias("at")) for k, p in enumerate(at)])
    wanted = ends.select("column", "part", (F.col("end") - F.col("filled")).alias("before"), "end", F.explode(ranks).alias("r")).select(
        "column", "part", "before", "end", "r.quartile", F.col("r.at").alias("at")
    )
    # The two values that a quartile lies between have ranks floor(at) and ceil(at), counted from 0.
    held = wanted.where((F.floor("at") < F.col("end")) & (F.ceil("at") >= F.col("before")))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("column", "part", "quartile").orderBy("num"))
    near = ranged.join(held, ["column", "part"]).withColumn("upto", upto)

    def has(rank: Column) -> Column:
        return (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))

    low, high = F.max(F.when(has(F.floor("at")), F.col("num"))), F.max(F.when(has(F.ceil("at")), F.col("num")))
    quartiles = near.groupBy("column", "quartile").agg((low + (high - low) * F.first(F.col("at") - F.floor("at"))).alias("value"))
    wide = quartiles.groupBy("column").agg(*[F.max(F.when(F.col("quartile") == k, F.col("value"))).alias(f"q{int(q * 100)}") for k, q in enumerate(QUARTILES)])
    # Tables of one row a column.
    text = F.col("numbers") == 0
    return (
        overview(df, name).join(modes, "column", "left").join(wide, "column", "left")
        .select(
            "table", "column", "data_type", "n_rows", "n_values",
            F.when(text, F.col("values")).alias("unique"), F.when(text, F.col("mode.text")).alias("top"), F.when(text, -F.col("mode.n")).alias("freq"),
            "mean", "std", "min", "q25", "q50", "q75", "max",
        )
    )
