"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.session import scratch_dir

# A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
# Sides of joins up to so many narrow rows (ids and a number or two) are broadcast.
BROADCAST_ROWS = 200_000
# Documents handed to a Python worker at once, which bounds its memory.
BATCH_ROWS = 500
BATCH_BYTES = 32 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python workers receive few documents at a time, since one may hold megabytes."""
    key, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    # A batch holds no more than so many bytes either, however long its texts are.
    if int(re.match(r"\d+", spark.conf.get(size))[0]) > BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """The name itself, or with underscores behind it where the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def saved(df: DataFrame) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it again: a cut of the
    lineage that outlives its executors."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame of narrow rows has at most so many; counting stops beyond."""
    return df.limit(rows + 1).count() <= rows


def narrow_join(big: DataFrame, narrow: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a side of narrow rows: broadcast up to BROADCAST_ROWS of them, else by shuffle."""
    return big.join(F.broadcast(narrow) if is_small(narrow) else narrow, on, how)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal integer keys, as tables; only one group is held at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_numpy() for k in keys]
        edge = np.zeros(table.num_rows, dtype=bool)
        for c in columns:
            edge[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(edge).tolist(), table.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(int(c[lo]) for c in columns)
            if key != last and held:
                yield pa.concat_tables(held)
                held = []
            last = key
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def _are_stars(pairs: DataFrame) -> bool:
    """Whether of the distinct pairs (lo, hi) every hi stands below one lo only, and no lo below another."""
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("node"), F.lit(below).alias("below")) for c, below in (("lo", 0), ("hi", 1))])).alias("end")
    seen = pairs.select(ends).groupBy("end.node").agg(F.sum("end.below").alias("n"), F.min("end.below").alias("least"))
    return seen.where("n > 1 or (n = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Nodes hang themselves under ever smaller neighbours (large star, then small
    star), so the number of rounds grows with the logarithm of the longest path.
    A hub's edges are never gathered: its minimum is an aggregate, and the join
    that hands it out can be split. Each round is written to shared storage, and
    there is none once all nodes hang right below the least of their component.
    """
    pairs = saved(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    )

    while not _are_stars(pairs):
        both = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: larger neighbours move below the least one.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("lo < hi").distinct()
        # Small star: the neighbours below move under the least of them.
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low, "hi")
            .select(F.explode(F.array(F.struct("m", F.col("hi").alias("x")), F.struct("m", F.col("lo").alias("x")))).alias("e"))
            .select(F.col("e.m").alias("lo"), F.col("e.x").alias("hi"))
            .where("lo < hi")
            .distinct()
        )
        pairs = saved(small)
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose doc_id is not among the given ones; texts are shuffled only when those are many."""
    ids = saved(ids.select("doc_id").where("doc_id is not null").distinct())
    return narrow_join(docs, ids, ["doc_id"], "left_anti").select(docs.columns)


Function = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
