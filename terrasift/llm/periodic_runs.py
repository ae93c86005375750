"""Runs of periodic words, by maximal pairs over the LCP-interval tree of a text.

A run is a stretch of words with period q that no neighbouring word extends and
that is at least twice q long. A run from s with length n is the pair of places
(s, s + q) whose common continuation has n - q >= q words and whose left words
differ: a maximal pair whose distance is at most its length. So the suffixes of
a text are sorted, the tree of their LCP intervals is walked bottom-up, and each
node pairs the places of its children that differ in the word to their left.
Nothing has to be extended afterwards.

Nodes hold their places in order with the left word of each as its class. Within
the reach of one place, the occurrences of a node's words stand at equal steps,
so all of them but the first are of one class: of the classes of the larger
child, one place to the left and one to the right decide (``_pairs``). Each
place of the smaller child costs a binary search, and what it lists is a run
or a multiple of a run's period, of which a text has fewer than three a word.

Only places whose first ``least / 2`` words occur again, close enough for the
stretch of such places around them, enter the tree; other texts are done after
one sort of hashes. A text is one row in one task, as it is in the table.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import small_batches

LEAST = 12
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place; equal words give equal hashes."""
    n = len(ids) - size + 1
    h = np.zeros(n, dtype=np.uint64)
    words = ids.astype(np.uint64)
    for k in range(size):
        h ^= words[k : k + n] + _MIX
        h *= _ODD
        h ^= h >> np.uint64(29)
    return h


def _near_repeats(ids: np.ndarray, size: int) -> np.ndarray:
    """Places, ascending, that may begin a maximal pair no farther apart than it is long."""
    h = _hashes(ids, size)
    first = np.sort(h)
    if not (first[1:] == first[:-1]).any():
        return np.empty(0, dtype=np.int64)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    gap = np.zeros(len(h), dtype=np.int64)
    gap[order[:-1][same]] = np.diff(order)[same]
    # Stretches of places that occur again; a pair of m words makes one of m - size + 1 places.
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gap > 0, [0]])))
    stretch = np.zeros(len(h), dtype=np.int64)
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):
        stretch[lo:hi] = hi - lo
    close = (gap > 0) & (gap <= stretch + size - 1)
    if not close.any():
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(np.isin(h, h[close]))


def _levels(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1, 2, 4, ... words from each place, until all differ; 0 stands for the end."""
    levels = [(np.unique(ids, return_inverse=True)[1] + 1).astype(np.int32)]
    width = 1
    while len(ids) > 1 and levels[-1].max() < len(ids):
        rank = levels[-1].astype(np.int64)
        behind = np.zeros(len(ids), dtype=np.int64)
        behind[:-width] = rank[width:]
        levels.append((np.unique(rank * (len(ids) + 1) + behind, return_inverse=True)[1] + 1).astype(np.int32))
        width *= 2
        if width >= len(ids):
            break
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal words from the places a and b."""
    n = len(levels[0])
    found = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        x, y = a + found, b + found
        fits = np.maximum(x, y) + width <= n
        x, y = np.where(fits, x, 0), np.where(fits, y, 0)
        # A level holds each width once more only at the top, where all words may agree.
        found += width * (fits & (levels[k][x] == levels[k][y]))
    return found


def _pairs(small: list[int], large: list[int], m: int, left: list[int], out: list[tuple[int, int, int]]) -> None:
    """List the maximal pairs of ``m`` words between two children, no farther apart than m.

    Occurrences within reach of place i stand at equal steps. To its right all
    have one left word, so the nearest decides for all of them; to its left all
    but the farthest have that of i itself, so only the farthest can differ.
    """
    for i in small:
        mine = left[i]
        at = bisect_left(large, i)
        far = bisect_left(large, i - m, 0, at)
        if far < at and left[large[far]] != mine:
            out.append((large[far], i - large[far], m))
        if at < len(large) and large[at] - i <= m and left[large[at]] != mine:
            for k in range(at, len(large)):
                if large[k] - i > m:
                    break
                out.append((i, large[k] - i, m))


def runs_of(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of at least ``least`` words, by start and period."""
    size = (least + 1) // 2
    if len(ids) < max(least, 2):
        return []
    places = _near_repeats(ids, size)
    if not len(places):
        return []
    levels = _levels(ids)
    order = places[np.argsort(levels[-1][places], kind="stable")]
    lcp = _common(levels, order[:-1], order[1:]).tolist()
    left = [-1, *ids[:-1].tolist()]
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []
    node: list[int] = [int(order[0])]
    for place, m in zip([*order[1:].tolist(), -1], [*lcp, 0], strict=True):
        while stack and stack[-1][0] >= m:
            depth, held = stack.pop()
            small, large = (node, held) if len(node) <= len(held) else (held, node)
            _pairs(small, large, depth, left, found)
            if len(small) * 8 < len(large):
                for i in small:
                    insort(large, i)
                node = large
            else:
                node = sorted(large + small)
        if m >= size:
            stack.append((m, node))
        node = [place]
    shortest: dict[tuple[int, int], int] = {}
    for start, period, m in found:
        if m + period >= least:
            key = (start, m + period)
            shortest[key] = min(period, shortest.get(key, period))
    return sorted(((s, n, q) for (s, n), q in shortest.items()), key=lambda r: (r[0], r[2]))


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs, collapsed.

    ``runs`` lists (start, length, period) by start, then period, of all runs of
    at least ``least`` words; words are numbered from 0. ``collapsed`` is the
    text, its words joined by one space, without each word that a run contains
    after its first period. A null, empty or blank text has no words and no
    runs and collapses to the empty text. Repeated rows are judged one by one,
    null doc_ids stay null, other columns are not read, an empty table gives
    an empty result.
    """
    small_batches(docs.sparkSession)
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            counts, offsets, flat, texts = [], [0], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = text.split() if text else []
                known: dict[bytes, int] = {}
                ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
                runs = runs_of(ids, least)
                if runs:
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    for start, length, period in runs:
                        depth[start + period] += 1
                        depth[start + length] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                    flat += runs
                counts.append(len(ids))
                offsets.append(len(flat))
                texts.append(b" ".join(words))
            columns = np.array(flat, dtype=np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(columns[:, k]) for k in range(3)], fields=list(item))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of the contract: every tenth by the CRC of its doc_id turns periodic from some word on.

    Rows without a doc_id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")

    def place(i: Column) -> Column:
        return F.when(i < a, i).otherwise(a + (i - a) % p)

    turned = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", place(i))), " ")
    df = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    return df.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), turned).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Count, longest run and digests of what ``find_runs`` returns."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = F.col("best")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["n"]).alias("length"),
        best["period"].alias("period"),
        F.expr("-best.n * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
