"""Joins that stay balanced when the lookup side is large or a key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side may be broadcast only up to these measured sizes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

# Above this estimate the size is not even measured.
_MEASURE_BELOW_BYTES = 512 << 20

SALTS = 32
HOT_FRACTION = 0.01


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of a plan; an estimate, so good for ruling a side out, not in."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:  # a remote session has no JVM handle
        return None


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure whether a side is small enough to send to every executor.

    The measuring job reads at most ``max_rows + 1`` rows, and is skipped when
    the optimizer already estimates a large side.
    """
    estimate = estimated_bytes(df)
    if estimate is not None and estimate > _MEASURE_BELOW_BYTES:
        return False
    # Only a number for each row moves to the task that adds them up.
    widths = df.select(_row_bytes(df).cast("bigint").alias("width")).limit(max_rows + 1)
    rows, size = widths.agg(F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: texts by their length, nested values by their JSON form, others by a fixed width."""
    width = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            width = width + F.coalesce(F.length(F.to_json(F.struct(c.alias("v")))), F.lit(0))
        else:
            width = width + F.lit(16)
    return width


def row_salt(df: DataFrame, salts: int) -> Column:
    """Spread rows over the salts; copies of one row in different partitions differ too.

    The value depends only on the row and its input partition, so a retried
    task deals its rows out the same way again.
    """
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id(), F.lit(salts))


def hot_keys(df: DataFrame, on: Sequence[str], fraction: float = HOT_FRACTION) -> DataFrame:
    """Keys holding more than ``fraction`` of the rows: never more than ``1 / fraction`` of them."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    # One row; the counts behind it are the same shuffle as those it is compared with.
    total = F.broadcast(counts.agg(F.sum("_n").alias("_total")))
    return counts.crossJoin(total).where(F.col("_n") > F.col("_total") * fraction).select(*on, F.lit(True).alias("_hot"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
    fraction: float = HOT_FRACTION,
) -> DataFrame:
    """Shuffled join where only the hot keys of ``big`` are split over ``salts`` tasks.

    Right for every join type that keeps or filters rows of ``big``: inner,
    left, left_semi and left_anti.
    """
    on = list(on)
    # Broadcasting the hot keys is safe: their number is bounded by 1 / fraction.
    hot = F.broadcast(hot_keys(big, on, fraction))
    # A NULL key matches nothing, so rows without a key may go anywhere.
    keyless = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in on])
    spread_out = F.coalesce(F.col("_hot"), F.lit(False)) | keyless
    left = big.join(hot, on, "left").withColumn("_salt", F.when(spread_out, row_salt(big, salts)).otherwise(F.lit(0)))
    spread = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(hot, on, "left").withColumn("_salt", F.explode(spread)).drop("_hot")
    right = right.withColumn("_salt", F.col("_salt").cast("bigint"))
    left = left.withColumn("_salt", F.col("_salt").cast("bigint")).drop("_hot")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Fact rows against a keyed lookup.

    A lookup measured as small is broadcast, so the fact side is not shuffled;
    a larger one takes the salted shuffle join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup):
        return fact.join(F.broadcast(lookup), keys, how)
    return salted_join(fact, lookup, keys, how)

