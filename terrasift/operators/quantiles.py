"""Exact medians that no single task gathers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasift.session import staged


def exact_medians(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    """Median of the filled values per group, one row a group (one row in all without ``by``).

    Equal values are counted first, then lie in order over range partitions.
    Totals per partition say which of them hold the middle ranks; only these
    are sorted, so a hot group is spread and a task holds one range of it.
    """
    keys = list(by)
    sizes = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # Stored, since the range bounds may differ from one evaluation to the next.
    ranged = staged(sizes.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()))
    group = Window.partitionBy(*keys)
    # One row for each group and partition.
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_m"))
    parts = parts.withColumn("_end", F.sum("_m").over(group.orderBy("_part"))).withColumn("_all", F.sum("_m").over(group))
    parts = parts.withColumns({"_lo": F.expr("(_all + 1) div 2"), "_hi": F.expr("_all div 2 + 1"), "_before": F.col("_end") - F.col("_m")})
    middle = parts.where((F.col("_before") < F.col("_hi")) & (F.col("_end") >= F.col("_lo")))
    middle = middle.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_before", "_lo", "_hi")
    # A missing key is a group as well.
    same = reduce(lambda x, i: x & F.col(keys[i]).eqNullSafe(F.col(f"_k{i}")), range(len(keys)), F.col("_part") == F.col("_p"))
    held = ranged.join(middle, same)
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_v"))
    held = held.withColumn("_upto", upto)

    def has(rank: str):
        return (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_n") < F.col(rank))

    found = held.where(has("_lo") | has("_hi"))
    return found.groupBy(*keys).agg((F.min("_v") * 0.5 + F.max("_v") * 0.5).alias(name))
