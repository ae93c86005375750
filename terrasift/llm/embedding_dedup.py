"""Near-duplicate embeddings by cross-polytope hashing with multiprobe buckets.

Vectors are turned by pseudo-random rotations (sign flips and fast Hadamard
transforms, three of each) and hashed to the nearest signed axis, twice for each
table. A vector stands in the bucket of its own hash and in that of the next
nearest axis. Vectors that share a bucket are candidates, verified by cosine in
double precision.

Equal vectors of a label are one class with a weight. A bucket above ``BLOCK``
classes is compared in pairs of blocks; a pair that shares several buckets
counts in the first one only, so links are counted without listing pairs, and a
task sends one row for each class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import components, groups, saved, small_batches
from terrasift.llm.ngram_join import stars

TABLES = 8
BLOCK = 512
THRESHOLD = 0.98
_SEED = 97


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n = x.shape[1]
    h = 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        a, b = y[:, :, 0, :] + y[:, :, 1, :], y[:, :, 0, :] - y[:, :, 1, :]
        y[:, :, 0, :], y[:, :, 1, :] = a, b
        h *= 2
    return x / np.sqrt(n)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two next to their largest component: squares neither overflow nor vanish, and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def bucket_codes(x: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Codes (rows, tables, 2) of unit vectors: of the nearest axes, and with the second hash's next nearest."""
    width = 1 << max(1, int(np.ceil(np.log2(max(2, x.shape[1])))))
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    rng = np.random.default_rng(_SEED)
    codes = np.empty((len(x), tables, 2), dtype=np.int64)
    rows = np.arange(len(x))
    for t in range(tables):
        axes, gap, second = [], [], []
        for _ in range(2):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            size = np.abs(y)
            order = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = size[rows, order[:, 0]] < size[rows, order[:, 1]]
            order[swap] = order[swap][:, ::-1]
            signed = order * 2 + (y[rows[:, None], order] < 0)
            axes.append(signed[:, 0])
            second.append(signed[:, 1])
            gap.append(size[rows, order[:, 0]] - size[rows, order[:, 1]])
        base = 2 * width
        codes[:, t, 0] = axes[0] * base + axes[1]
        # The probe changes the hash that was the closer call.
        codes[:, t, 1] = np.where(gap[0] < gap[1], second[0] * base + axes[1], axes[0] * base + second[1])
    return codes


def _links(table: pa.Table, threshold: float, tables: int):
    """(classes, links by weight, star edges) of one block or pair of blocks."""
    side = table.column("side").to_numpy()
    cls, weight = table.column("cls").to_numpy(), table.column("weight").to_numpy()
    bucket_table, bucket_code = int(table.column("t")[0].as_py()), int(table.column("code")[0].as_py())
    raw = np.stack([np.frombuffer(b.as_buffer(), dtype=np.float64) for b in table.column("vec")])
    codes = np.stack([np.frombuffer(b.as_buffer(), dtype=np.int64) for b in table.column("codes")]).reshape(len(cls), tables, 2)
    norm = np.sqrt((raw * raw).sum(axis=1))
    rows = np.flatnonzero(side <= 1)
    cols = rows if (side == 0).all() else np.flatnonzero(side == 2)
    i, j = np.nonzero(raw[rows] @ raw[cols].T / np.outer(norm[rows], norm[cols]) >= threshold - 1e-9)
    i, j = rows[i], cols[j]
    if cols is rows:
        i, j = i[i < j], j[i < j]
    n_links = np.zeros(len(cls), dtype=np.int64)
    edges: list[tuple[int, int]] = []
    for at in range(0, len(i), 20_000):
        a, b = i[at : at + 20_000], j[at : at + 20_000]
        cosine = (raw[a] * raw[b]).sum(axis=1) / (norm[a] * norm[b])
        a, b = a[cosine >= threshold], b[cosine >= threshold]
        # Buckets that both share, in order; only the first counts.
        shared = (codes[a][:, :, :, None] == codes[b][:, :, None, :]).any(axis=3)
        earlier = shared[:, :bucket_table].any(axis=(1, 2))
        here = np.where(shared[:, bucket_table], codes[a][:, bucket_table], np.iinfo(np.int64).max).min(axis=1)
        first = ~earlier & (here == bucket_code)
        a, b = a[first], b[first]
        np.add.at(n_links, a, weight[b])
        np.add.at(n_links, b, weight[a])
        edges += zip(cls[a].tolist(), cls[b].tolist(), strict=True)
        if len(edges) > 100_000:
            edges = [tuple(e) for e in stars(edges).tolist()]
    return cls, n_links, stars(edges)


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of one label and length are compared. Null labels and vectors
    that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows without a vec_id, whose component is null. Repeated
    rows are vectors of their own. Other columns are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2000)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    rows = saved(base.withColumn("cls", F.when(usable, F.xxhash64("label", F.size("embedding"), "embedding"))))
    named = rows.where("cls is not null")
    # min_by and first would sort the vectors; equal ones are dropped instead.
    sizes = saved(named.groupBy("cls").agg(F.count("*").alias("weight"), F.min("vec_id").alias("rep")))
    distinct = named.select("cls", "label", "embedding").dropDuplicates(["cls"])

    def coded(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("embedding")
            length = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(length)])
            codes, vec = [b""] * batch.num_rows, [b""] * batch.num_rows
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                x = scaled(np.stack([values[starts[k] : starts[k] + n] for k in at]))
                found = bucket_codes(x / np.sqrt((x * x).sum(axis=1, keepdims=True)), tables)
                for k, c, v in zip(at, found, x, strict=True):
                    codes[k], vec[k] = c.tobytes(), v.tobytes()
            grouped = pa.array([n for n in length], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("label"), grouped, pa.array(vec, pa.binary()), pa.array(codes, pa.binary()),
                 pa.array([np.frombuffer(c, dtype=np.int64) for c in codes], pa.list_(pa.int64()))],
                ["cls", "label", "n", "vec", "codes", "listed"],
            )

    label_type = rows.schema["label"].dataType.simpleString()
    hashed = saved(
        distinct.mapInArrow(coded, f"cls long, label {label_type}, n int, vec binary, codes binary, listed array<long>").join(sizes, "cls")
    )
    placed = hashed.select("cls", "label", "n", F.posexplode("listed").alias("k", "code")).select(
        "cls", F.xxhash64("label", "n").alias("space"), F.expr("k div 2").cast("int").alias("t"), "code"
    ).distinct()
    bucket = ["space", "t", "code"]
    full = saved(placed.groupBy(*bucket).agg(F.count("*").alias("held")).where("held > 1"))
    members = placed.join(full, bucket).withColumn("block", F.pmod(F.xxhash64("cls"), F.ceil(F.col("held") / BLOCK)))
    members = saved(members.drop("held"))
    blocks = members.select(*bucket, "block").distinct()
    pairs = blocks.join(blocks.withColumnRenamed("block", "block2"), bucket).where("block <= block2")
    first = members.join(pairs, [*bucket, "block"]).withColumn("side", F.when(F.col("block") == F.col("block2"), 0).otherwise(1))
    second = members.withColumnRenamed("block", "block2").join(pairs.where("block <> block2"), [*bucket, "block2"]).withColumn("side", F.lit(2))
    keys = [*bucket, "block", "block2"]
    work = first.select(*keys, "side", "cls").union(second.select(*keys, "side", "cls")).join(hashed.select("cls", "weight", "vec", "codes"), "cls")

    def run(batches):
        for group in groups(batches, keys):
            cls, n, star = _links(group, threshold, tables)
            some = n > 0
            a = np.concatenate([cls[some], star[:, 0]])
            b = np.concatenate([cls[some], star[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.concatenate([n[some], np.zeros(len(star), dtype=np.int64)]))], ["a", "b", "n"])

    found = saved(work.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long, n long"))
    linked = found.where("a = b").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    joined = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "cls")
    classes = sizes.join(joined, "cls", "left").select("cls", "rep", "weight", F.coalesce("component", "cls").alias("component"))
    least = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = classes.join(least, "component").join(linked, "cls", "left").select(
        "cls", "component_id", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    result = rows.select("vec_id", "cls").join(classes, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
