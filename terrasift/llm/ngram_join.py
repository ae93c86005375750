"""N-gram Jaccard join over signature trees.

A document is the set of its distinct word n-grams; two documents link when
``100 * intersection >= percent * union``, and linked documents form components.

1. Equal sets are one class, named by a 64-bit hash of the set.
2. Every pair that links shares an n-gram among the first
   ``n - ceil(percent * n / 100) + 1`` of either set, under any fixed order of
   the n-grams. The order puts n-grams last that many documents share, so a
   passage found everywhere makes no bucket. Frequent n-grams are found by
   lossy counting over all documents; a missed one costs time, never a link.
3. Each n-gram held in two or more prefixes is a bucket. Buckets with the same
   classes are one. The classes of a bucket go to signature trees over bitmaps,
   joined by dual traversal; what they cannot rule out is verified on whole sets.
4. Three rounds: each class in one bucket; one class for each component left in
   a bucket; then, for completeness, all classes of the buckets that still hold
   several components. A bucket above ``BLOCK`` classes is split into blocks,
   and in the last round into pairs of blocks, so no task holds a large group.

Whole texts are never shuffled and pairs are never listed: a group of g classes
yields at most g - 1 links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import fresh, without, components, groups, narrow_join, saved, small_batches
from terrasift.llm.signature_tree import bitmap, links, survivors, width_for

# Classes that one tree holds at most.
BLOCK = 400
# Entries of the table of frequent n-grams (8 bytes and a rank each) at most.
FREQUENT_MAX = 1 << 19
# Documents that make an n-gram frequent, at least.
FREQUENT_LEAST = 6
# Distinct n-grams that lossy counting keeps in a task's memory.
_COUNTERS = 1 << 22
# N-grams that wait to be counted at once.
_WAITING = 1 << 19


class _WordHashes(dict):
    """Hashes of words seen so far, emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, size: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; A-Z count as a-z.

    A text with fewer words is one n-gram, a text without words or null none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(size, len(w))
    acc = np.full(len(w) - span + 1, span, dtype=np.uint64)
    for k in range(span):
        acc = _mixed(acc * np.uint64(0xD6E8FEB86659FD93) + w[k : len(w) - span + 1 + k])
    return np.unique(acc)


def class_id(s: np.ndarray) -> int:
    """Name of a set: equal sets get equal names, others differ but for a 64-bit collision."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)))


def _sets(batches, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    hashes = _WordHashes()
    for batch in batches:
        yield batch, [shingle_set(t.as_py(), size, hashes) for t in batch.column("text")]


class _Counter:
    """Lossy counting: the n-grams seen most, within a fixed number of counters."""

    def __init__(self):
        self.seen, self.counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, sets: list[np.ndarray]) -> None:
        for s in sets:
            self.waiting.append(s)
            self.size += len(s)
            if self.size > _WAITING:
                self._merge()
        if len(self.seen) > _COUNTERS * 3 // 4:
            self._keep(self.counts > 1)
        if len(self.seen) > _COUNTERS // 2:
            self._keep(np.sort(np.argpartition(self.counts, -_COUNTERS // 4)[-_COUNTERS // 4 :]))

    def _keep(self, which) -> None:
        self.seen, self.counts = self.seen[which], self.counts[which]

    def _merge(self) -> None:
        """Add what waits to the counters: a short sorted run into the long one, with no array beside them that is as long as all counters but the new ones."""
        if not self.size:
            self.waiting = []
            return
        run = np.concatenate(self.waiting)
        self.waiting, self.size = [], 0
        run.sort()
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        n = np.diff(starts, append=len(run)).astype(np.int32)
        run = run[starts]
        at = np.searchsorted(self.seen, run)
        known = np.zeros(len(run), dtype=bool)
        inside = at < len(self.seen)
        known[inside] = self.seen[at[inside]] == run[inside]
        self.counts[at[known]] += n[known]
        self.counts = np.insert(self.counts, at[~known], n[~known])
        self.seen = np.insert(self.seen, at[~known], run[~known])

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        self._keep(self.counts > 1)
        return self.seen, self.counts.astype(np.int64)


def _described(df: DataFrame, size: int) -> DataFrame:
    """One pass over all texts: a row (doc_id, n_shingles, cls, bits) for each
    document, and rows (gram, seen) of n-grams that several documents of a task hold."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()), ("bits", pa.binary()), ("gram", pa.int64()), ("seen", pa.int64())]
    )

    def run(batches):
        counter = _Counter()
        for batch, sets in _sets(batches, size):
            counter.add(sets)
            none = [None] * len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([bitmap(s, width_for(len(s))).tobytes() if len(s) else None for s in sets], pa.binary()),
                    pa.array(none, pa.int64()),
                    pa.array(none, pa.int64()),
                ],
                schema=schema,
            )
        grams, seen = counter.result()
        for at in range(0, len(grams), 50_000):
            part = slice(at, at + 50_000)
            none = pa.nulls(len(grams[part]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(len(none), pa.binary()), pa.array(grams[part].view(np.int64)), pa.array(seen[part])], schema=schema
            )

    return df.mapInArrow(run, "doc_id long, n_shingles long, cls long, bits binary, gram long, seen long")


def _frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent n-grams, sorted, with the number of documents; at most FREQUENT_MAX."""
    total = saved(counted.groupBy("gram").agg(F.sum("seen").alias("n")).where(F.col("n") >= FREQUENT_LEAST))
    # The most frequent that fit: thresholds of equal ratio, from counts per power.
    powers = total.groupBy(F.floor(F.log2("n") * 4).alias("p")).count().collect()
    room, least = FREQUENT_MAX, None
    for p, n in sorted(((r[0], r[1]) for r in powers), reverse=True):
        if (room := room - n) < 0:
            break
        least = p
    if least is None:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    found = total.where(F.floor(F.log2("n") * 4) >= least).toPandas()
    grams, n = found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(grams)
    return grams[order], n[order]


def _prefix(s: np.ndarray, percent: int, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The first n-grams of a set: infrequent ones by hash, then frequent ones by frequency."""
    length = len(s) - (percent * len(s) + 99) // 100 + 1
    if not len(grams):
        return s[:length]
    at = np.searchsorted(grams, s)
    at[at == len(grams)] = 0
    known = grams[at] == s
    rare = s[~known]
    if len(rare) >= length:
        return rare[:length]
    often, count = s[known], n[at[known]]
    return np.concatenate([rare, often[np.lexsort((often, count))][: length - len(rare)]])


def _tree_links(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b): links between components, from rows (keys, cls, comp, side, grams) whose keys name one task's work."""

    def run(batches):
        for group in groups(batches, keys):
            first = np.unique(group.column("cls").to_numpy() * 2 + group.column("side").to_numpy(), return_index=True)[1]
            group = group.take(first)
            comp, side = group.column("comp").to_numpy(), group.column("side").to_numpy()
            if len(comp) < 2 or comp.min() == comp.max():
                continue
            sets = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in group.column("grams")]
            found = links(sets, comp, percent, None if (side == 0).all() else side)
            if found:
                pairs = stars([(int(comp[i]), int(comp[j])) for i, j in found])
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    tasks = rows.select(*keys, "cls", "comp", "side", "grams")
    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _pruned(members: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The rows (bucket, cls, comp) whose class has a partner of another component in
    the bucket that the signature trees over bitmaps cannot rule out."""
    keys = ["bucket", "block", "block2"]

    def run(batches):
        for group in groups(batches, keys):
            comp, side, n = (group.column(c).to_numpy() for c in ("comp", "side", "n"))
            if len(comp) < 2 or comp.min() == comp.max():
                continue
            rows = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in group.column("bits")]
            alive = survivors(rows, n, comp, percent, None if (side == 0).all() else side)
            if alive.any():
                yield pa.RecordBatch.from_arrays([group.column(c).filter(pa.array(alive)).combine_chunks() for c in ("bucket", "cls", "comp")], ["bucket", "cls", "comp"])

    tasks = _block_pairs(members).join(bits, "cls").select(*keys, "cls", "comp", "side", "n", "bits")
    tasks = tasks.repartition(*keys).sortWithinPartitions(*keys)
    return saved(tasks.mapInArrow(run, "bucket long, cls long, comp long").distinct())


def stars(pairs: list[tuple[int, int]]) -> np.ndarray:
    """(root, node) rows that join what the pairs join, every node right below its least one."""
    up: dict[int, int] = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        lo, hi = sorted((top(a), top(b)))
        up[hi] = lo
    return np.array([(top(x), x) for x in list(up) if top(x) != x], dtype=np.int64).reshape(-1, 2)


def _one_of_equal_lists(members: DataFrame, item: str) -> DataFrame:
    """Of buckets that hold the same items, one; buckets of one item go."""
    lists = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(item)).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), item)).alias("y")
    )
    keep = lists.where("n > 1").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    return members.join(keep, "bucket", "left_semi")


def _blocked(members: DataFrame) -> DataFrame:
    """A block within each bucket, of about BLOCK classes."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    return members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("cls"), "blocks")).drop("blocks")


def _block_pairs(members: DataFrame) -> DataFrame:
    """Rows of every pair of blocks of a bucket that can hold a link between components.

    Large components of a bucket have blocks of their own, which are not compared
    with one another.
    """
    # Each step is written once: as one plan, every use of a step would compute all before it again.
    counts = saved(members.groupBy("bucket", "comp").agg(F.count("*").alias("n")))
    large = F.col("n") > BLOCK // 2
    small = counts.where(~large).groupBy("bucket").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    placed = saved(
        members.join(counts, ["bucket", "comp"])
        .join(small, "bucket", "left")
        .withColumn("own", F.when(large, F.col("comp")))
        .withColumn(
            "at",
            F.when(large, F.xxhash64(F.lit("own"), "comp", F.pmod(F.xxhash64("cls"), F.ceil(F.col("n") / BLOCK)))).otherwise(
                F.xxhash64(F.lit("pool"), F.pmod(F.xxhash64("comp"), "blocks"))
            ),
        )
        .select("bucket", "at", "own", "cls", "comp")
    )
    blocks = saved(placed.select("bucket", F.col("at").alias("block"), "own").distinct())
    other = blocks.select("bucket", F.col("block").alias("block2"), F.col("own").alias("own2"))
    pairs = blocks.join(other, "bucket").where("block <= block2 and (own is null or own2 is null or own <> own2)")
    # A block meets itself on side 0, another one as sides 1 and 2.
    within, first, second = (F.struct(F.col(at).alias("at"), F.lit(side).alias("side")) for at, side in (("block", 0), ("block", 1), ("block2", 2)))
    ends = F.explode(F.when(F.col("block") == F.col("block2"), F.array(within)).otherwise(F.array(first, second))).alias("end")
    sides = pairs.select("bucket", "block", "block2", ends).select("bucket", "block", "block2", "end.at", "end.side")
    return placed.join(sides, ["bucket", "at"]).select("bucket", "block", "block2", "cls", "comp", "side")


def ngram_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links, the own one
    included. Null, empty and blank texts have no n-grams and link with nothing;
    a text of fewer than ``size`` words is a single n-gram. Rows without a doc_id
    link with nothing and have no component. Repeated rows are one class. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = base.where("doc_id is not null")
    passed = saved(_described(base, size))
    described = passed.where("gram is null").select("doc_id", "n_shingles", "cls")
    classes = described.where("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    grams, counts = _frequent(passed.where("gram is not null"))
    shared_grams, shared_counts = spark.sparkContext.broadcast(grams), spark.sparkContext.broadcast(counts)

    def run(batches):
        for _, sets in _sets(batches, size):
            known, n = shared_grams.value, shared_counts.value
            keys = [_prefix(s, percent, known, n) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, dtype=np.uint64), *keys]).view(np.int64)),
                    pa.array(np.repeat(np.array([class_id(s) for s in sets], dtype=np.int64), [len(k) for k in keys])),
                ],
                ["bucket", "cls"],
            )

    prefixes = saved(named.mapInArrow(run, "bucket long, cls long"))
    held = prefixes.groupBy("bucket").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi")
    shared = saved(held.select("bucket"))
    members = narrow_join(prefixes, shared, ["bucket"], "left_semi").distinct()
    members = saved(_one_of_equal_lists(saved(members), "cls"))

    # Only classes that a bitmap finds a partner for are looked at with their sets.
    bits = passed.where("gram is null and cls is not null").select("cls", F.col("n_shingles").alias("n"), "bits")
    bits = saved(bits.join(members.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"]))
    members = _pruned(members.withColumn("comp", F.col("cls")), bits, percent).select("bucket", "cls")
    members = saved(_one_of_equal_lists(members, "cls"))

    # Whole sets of the classes left, from one document each.
    wanted = members.select("cls").distinct().join(classes, "cls")
    ids = saved(wanted.select(F.col("rep").alias("doc_id"), "cls"))

    def whole(batches):
        for _, sets in _sets(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["cls", "grams"],
            )

    texts = narrow_join(named, ids.select("doc_id").distinct(), ["doc_id"], "left_semi")
    sets = saved(texts.mapInArrow(whole, "cls long, grams binary").join(ids.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]))

    # Round 1: each class in one bucket.
    one = members.groupBy("cls").agg(F.min("bucket").alias("bucket"))
    rows = _blocked(one).join(sets, "cls").select("*", F.col("cls").alias("comp"), F.lit(0).alias("side"))
    comps = saved(components(_tree_links(rows, ["bucket", "block"], percent)))

    def known_components():
        found = comps.select(F.col("node").alias("cls"), F.col("component"))
        return members.join(found, "cls", "left").select("bucket", "cls", F.coalesce("component", "cls").alias("comp"))

    def several(rows):
        mixed = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
        return rows.join(mixed, "bucket", "left_semi")

    def joined(found):
        """Components over those known and the new links between them."""
        return saved(components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found)))

    # Round 2: one class for each component of a bucket.
    mixed = saved(several(known_components()))
    if not mixed.isEmpty():
        hubs = saved(mixed.groupBy("bucket", "comp").agg(F.min("cls").alias("cls")))
        hubs = _blocked(saved(_one_of_equal_lists(hubs, "cls")))
        comps = joined(_tree_links(hubs.join(sets, "cls").withColumn("side", F.lit(0)), ["bucket", "block"], percent))

        # Round 3: every pair of different components that share a bucket.
        left = _pruned(saved(several(known_components())), bits, percent)
        if not left.isEmpty():
            pairs = _block_pairs(left)
            comps = joined(_tree_links(pairs.join(sets, "cls"), ["bucket", "block", "block2"], percent))

    # Components of classes become those of documents.
    of_class = classes.join(comps.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_class = of_class.join(least, "component").select("cls", "component_id")
    linked = described.join(named_class, "cls", "left")
    return linked.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) without those near to another that stays: of each
    component one row, with all columns.

    The row of the least doc_id stays, nulls last; of equal doc_ids that of the
    least MD5 of the text. Rows are compared as such, whatever doc_ids they share
    or lack; rows without words stay.
    """
    ids = docs.groupBy(F.col("doc_id").alias("doc_id")).count()
    if ids.where("doc_id is null or count > 1").isEmpty():
        found = saved(ngram_components(docs, size, percent).select("doc_id", "component_id"))
        return without(docs, found.where("component_id <> doc_id"))
    key = fresh(docs, "_key")
    keyed = saved(docs.withColumn(key, F.monotonically_increasing_id()))
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    groups = ngram_components(rows, size, percent).select(F.col("doc_id").alias("id"), "component_id")
    order = keyed.select(F.col(key).alias("id"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.md5("text").alias("text"), F.col(key).alias("id")).alias("order"))
    ranked = saved(groups.join(order, "id"))
    # A minimum and a join on the component; a group is never gathered.
    first = saved(ranked.groupBy("component_id").agg(F.min("order").alias("first")))
    gone = saved(ranked.join(first, "component_id").where("id <> first.id").select(F.col("id").alias(key)))
    return narrow_join(keyed, gone, [key], "left_anti").select(docs.columns)
