"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, in shuffled order, gets a virtual finish time: the
words its source has sent when half of the document is through, divided by the
source's target. All documents are range-sorted by that time and the queue is
cut where the running total reaches the budget, so sources advance in proportion
to their targets. A source may be sent twice; the second pass follows the first.
Taking the middle of a document rounds each source to the nearest document.

Hot sources: running totals come from range partitions over (source, shuffle
key, row) with an offset for each partition, so no source is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasift.llm.common import BLANKS, narrow_join, saved

# Fixed values of the contract: weights in order of sources, share of all words, passes.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
SEED = 20250


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANKS)
    return F.size(parts).cast("long") - (F.element_at(parts, 1) == "").cast("long") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")


def running_total(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """Add the total of ``size`` over all rows up to each row in a global order.

    Rows are range-partitioned; only one number for each partition is summed in
    one place. ``order`` must tell rows apart for partitions to stay even.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = saved(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.sum(size).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, F.sum(size).over(within) + F.col("_offset")).drop("_part", "_offset")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = PASSES) -> DataFrame:
    """(source, source_size, rank, before, target) from one row (source, source_size) per source.

    Targets share ``share`` of all words by weight and stop at ``most`` times the
    source's size; the excess is shared again among the others until none is above.
    """
    ordered = sizes.withColumn("absent", F.col("source").isNull()).withColumn("one", F.lit(1))
    ranked = running_total(ordered, ["absent", "source"], "one", "rank")
    ranked = running_total(ranked, ["rank"], "source_size", "through")
    nth = F.pmod(F.col("rank") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    ranked = saved(ranked.withColumn("weight", weight).withColumn("before", F.col("through") - F.col("source_size")))
    cap = F.col("source_size") * float(most)
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > cap
        kept, free, n = ranked.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if n == capped or not free:
            break
        level, capped = (budget - (kept or 0.0)) / free, n
    return ranked.select("source", "source_size", "rank", "before", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, h.

    ``taken`` counts the words that the mix takes of the row: none, all, or all
    twice. A null text has no words; a null source is a source of its own and
    comes last; rows without a doc_id and repeated rows are rows like any other,
    and which of equal rows is taken makes no difference. Of an empty table the
    mix is empty. ``h`` is a hash of the text, to find it again.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("h")
    )
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(source_targets(sizes))
    budget = (targets.agg(F.sum("target")).first()[0]) or 0.0
    known = F.broadcast(targets) if targets.count() < 100_000 else targets
    rows = rows.join(known, rows["source"].eqNullSafe(targets["source"])).drop("source")

    shuffled = rows.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "h"))
    queued = running_total(shuffled, ["rank", "key", "row"], "size", "sent").withColumn("sent", F.col("sent") - F.col("before"))
    passes = F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))).alias("pass")
    finish = (F.col("sent") - F.col("size") / 2 + F.col("pass") * F.col("source_size")) / F.col("target")
    timed = queued.where("size > 0 and target > 0").select("rank", "key", "row", "size", "sent", "source_size", "target", passes)
    timed = timed.select("rank", "key", "row", "size", "pass", finish.alias("finish"))
    line = running_total(timed, ["finish", "rank", "key", "row", "pass"], "size", "total")
    taken = line.where(F.col("total") - F.col("size") / 2 <= budget).groupBy("row").agg(F.sum("size").alias("taken"))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "h"
    )


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns.

    Rows equal in doc_id and text are taken together, from one of them. Rows
    without words are never taken.
    """
    taken = mix(docs.select("doc_id", "text", "source"), seed)
    copies = taken.where("size > 0").groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(
        F.sum(F.col("taken") / F.col("size")).cast("int").alias("_copies"), F.count("*").alias("_rows")
    )
    copies = saved(copies.where("_copies > 0"))
    # The columns of the table travel in one, so that their names cannot clash.
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_all"), F.xxhash64("text").alias("_h"), F.col("doc_id").cast("long").alias("_id"))
    # Null ids are told apart from all others by a flag, so that the join is an equality.
    for_join = lambda df: df.withColumns({"_none": F.col("_id").isNull(), "_id": F.coalesce("_id", F.lit(0))})
    found = narrow_join(for_join(keyed), for_join(copies), ["_id", "_none", "_h"])
    once = found.where("_rows = 1")
    if not copies.where("_rows > 1").isEmpty():
        once = once.unionByName(found.where("_rows > 1").dropDuplicates(["_id", "_none", "_h"]))
    return once.select("_all", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_all.*")
