"""Passages that occur twice or more, found by winnowed anchors and extension.

Every ``length`` consecutive words, a window, hold one anchor: the ``ANCHOR``
words with the least hash among them, the leftmost of equal ones. Equal windows
have equal anchors at one offset, so places that share an anchor are all that
has to be compared.

Of the places of an anchor one in a shortest text is the hub, and every other
place is joined with the hub alone, so a passage that a third of all texts share
costs one row a text. The text of the hub travels in pieces: what lies around the
common anchors, one piece for each diagonal. In the task of the other text each
anchor is extended word by word both ways, and stretches of at least ``length``
equal words are repeats on both sides.

What the hub does not share may still be shared by others. The windows of an
anchor that its extension has not reached are therefore taken as anchors
themselves, as long as the repeat looked for: whichever of them occurs at two
places is a repeat. A window that the hub of its anchor holds is found by every
other place, and one that the hub lacks is left over at every place, so no
repeat is missed.

Equal texts are one row with a number of copies. The distinct texts are written
once in buckets by their 128-bit key, so they are shuffled once.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import saved, small_batches
from terrasift.session import scratch_dir

LENGTH = 35
ANCHOR = 12
KEY = ["k1", "k2"]
_rng = np.random.default_rng(20)
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_POWER, _MIX, _ODD = np.uint64(0xD1342543DE82EF95), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text) of UTF-8 texts that lie one behind the other."""
    texts = texts[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    ink = ~_BLANK[texts]
    begin = ink.copy()
    begin[1:] &= ~ink[:-1]
    # A text begins a word even where the one before it ends in one.
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[at] = ink[at]
    starts = np.flatnonzero(begin)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, dtype=np.uint64), counts
    place = np.arange(len(texts)) - np.repeat(starts, np.diff(np.append(starts, len(texts)))) if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(texts), dtype=np.int64)
        place[starts[0] :] = np.arange(starts[0], len(texts)) - np.repeat(starts, np.diff(np.append(starts, len(texts))))
    power = np.full(int(place.max()) + 1, _POWER, dtype=np.uint64)
    np.multiply.accumulate(power, out=power)
    value = _BYTES[texts] * power[place]
    value[~ink] = 0
    return _mixed(np.add.reduceat(value, starts)), counts


def winnowed(words: np.ndarray, counts: np.ndarray, length: int, size: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, place, first window, last window) of the anchors of texts of ``counts`` words."""
    none = np.empty(0, dtype=np.int64)
    if len(words) < length:
        return none, none.astype(np.uint64), none, none, none
    powers = {1: words}
    for k in range(1, size.bit_length()):
        half = powers[1 << (k - 1)]
        powers[1 << k] = _mixed(half[: -(1 << (k - 1))] * _POWER + half[1 << (k - 1) :] + _MIX)
    # The gram of any size from those of powers of two that make it up.
    gram, have = None, 0
    for width in sorted((w for w in powers if size & w), reverse=True):
        part = powers[width][have:]
        gram = part if gram is None else _mixed(gram[: len(part)] * _POWER + part + _MIX)
        have += width
    n = len(words) - size + 1
    least, place, width, span = gram[:n], np.arange(n), 1, length - size + 1
    while width < span:
        step = min(width, span - width)
        right = least[step:] < least[:-step]
        least, place = np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])
        width += step
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    window = np.flatnonzero(np.arange(len(words)) + length <= ends[text]) if len(words) else none
    if not len(window):
        return none, none.astype(np.uint64), none, none, none
    at = place[window]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    owner = text[at[first]]
    begin = (ends - counts)[owner]
    return owner, gram[at[first]], at[first] - begin, window[first] - begin, window[last] - begin


def _anchors(texts: DataFrame, length: int, size: int) -> DataFrame:
    """(anchor, k1, k2, n, place, before, windows) of distinct texts: n words; the first of the anchor's
    ``windows`` begins ``before`` words ahead of it."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None and offsets[-1] else np.empty(0, dtype=np.uint8)
            hashes, counts = word_hashes(data, offsets)
            owner, anchor, place, first, last = winnowed(hashes, counts, length, size)
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), batch.column("k1").take(take), batch.column("k2").take(take), pa.array(counts[owner]).cast(pa.int32()),
                 pa.array(place).cast(pa.int32()), pa.array(place - first).cast(pa.int32()), pa.array(last - first + 1).cast(pa.int32())],
                ["anchor", "k1", "k2", "n", "place", "before", "windows"],
            )

    return texts.select(*KEY, "text").mapInArrow(run, "anchor long, k1 long, k2 long, n int, place int, before int, windows int")


def _cut(pairs: DataFrame, texts: DataFrame, length: int, size: int) -> DataFrame:
    """Add to each pair the pieces of the hub's text around the common anchors, one for each diagonal."""

    def run(batches):
        for batch in batches:
            offsets, begins, pieces = [0], [], []
            for text, seeds in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("seeds"), strict=True):
                words = text.split()
                s = seeds.values
                hub, place = s.field("hub_place").to_numpy(), s.field("place").to_numpy()
                for some in _by_diagonal(place, hub):
                    at = hub[some]
                    begin = max(0, int(at.min()) - length + size)
                    begins.append(begin)
                    pieces.append(b" ".join(words[begin : int(at.max()) + length]))
                offsets.append(len(pieces))
            item = pa.StructArray.from_arrays([pa.array(begins, pa.int32()), pa.array(pieces, pa.binary()).cast(pa.string())], ["begin", "words"])
            columns = [batch.column(c) for c in ("k1", "k2", "h1", "h2", "seeds")]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), item)], ["k1", "k2", "h1", "h2", "seeds", "pieces"])

    hubs = texts.select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), "text")
    seeds = pairs.schema["seeds"].dataType.simpleString()
    return pairs.join(hubs, ["h1", "h2"]).mapInArrow(
        run, f"k1 long, k2 long, h1 long, h2 long, seeds {seeds}, pieces array<struct<begin:int,words:string>>"
    )


def _stretches(same: np.ndarray) -> np.ndarray:
    """(begin, end) rows of the stretches of true values."""
    return np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))).reshape(-1, 2)


def _by_diagonal(place: np.ndarray, hub_place: np.ndarray) -> list[np.ndarray]:
    """The rows of each diagonal in order of place, by ascending diagonal."""
    diagonal = place - hub_place
    order = np.lexsort((place, diagonal))
    cuts = np.flatnonzero(np.diff(diagonal[order])) + 1
    return [order[a:b] for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)], strict=True)]


def _around(ids: np.ndarray, other: np.ndarray, shift: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Extend each place both ways as far as ``ids`` equals ``other``, whose first word lies on place
    ``shift``: [a, b), or b = place where the first word differs already."""
    lo, hi = max(0, shift), min(len(ids), shift + len(other))
    differ = np.flatnonzero(ids[lo:hi] != other[lo - shift : hi - shift]) + lo
    bounds = np.concatenate([[lo - 1], differ, [hi]])
    at = np.searchsorted(bounds, place)
    return bounds[at - 1] + 1, bounds[at]


class _Partners:
    """The columns of ``partners`` of a batch as flat arrays: partners of a row, seeds and pieces of a partner."""

    def __init__(self, column: pa.ListArray):
        self.rows = column.offsets.to_numpy()
        partners = column.values
        self.hub = [partners.field(c).to_numpy() for c in ("h1", "h2")]
        seeds, pieces = partners.field("seeds"), partners.field("pieces")
        self.seed_at = seeds.offsets.to_numpy()
        self.place, self.hub_place, self.before, self.windows = (
            seeds.values.field(c).to_numpy().astype(np.int64) for c in ("place", "hub_place", "before", "windows")
        )
        self.piece_at = pieces.offsets.to_numpy()
        self.begin, self.words = pieces.values.field("begin").to_numpy(), pieces.values.field("words").cast(pa.binary())


def _extended(work: DataFrame, length: int, size: int) -> DataFrame:
    """Extend the anchors of each text. Rows are repeats (k1, k2, start, stop) of the text and of its
    hubs, or windows left over, with their digest."""

    def extend(text: bytes, key: tuple[int, int], held: _Partners, rows: range, repeats: list, windows_left: list) -> None:
        words = text.split()
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
        left = np.zeros(len(words) + 1, dtype=np.int64)
        for r in rows:
            hub = (held.hub[0][r], held.hub[1][r])
            seeds = slice(held.seed_at[r], held.seed_at[r + 1])
            place, hub_place, before, windows = (c[seeds] for c in (held.place, held.hub_place, held.before, held.windows))
            for k, some in enumerate(_by_diagonal(place, hub_place)):
                at = place[some]
                d = int(at[0] - hub_place[some[0]])
                if hub == key:
                    begin = max(0, int(at.min()) - d - length + size)
                    other = ids[begin : int(at.max()) - d + length]
                else:
                    begin = int(held.begin[held.piece_at[r] + k])
                    piece = held.words[held.piece_at[r] + k].as_py().split()
                    other = np.fromiter(map(known.get, piece, repeat(-1)), dtype=np.int64, count=len(piece))
                a, b = _around(ids, other, begin + d, at)
                long = (b >= at + size) & (b - a >= length)
                if long.any():
                    # Seeds of one stretch follow each other.
                    new = long & np.append(True, a[1:] != a[:-1])
                    repeats.append((key, a[new], b[new]))
                    repeats.append((hub, a[new] - d, b[new] - d))
                # Windows of an anchor within its stretch are repeats; those ahead and behind are left over.
                first, last = at - before[some], at - before[some] + windows[some]
                ahead, behind = np.where(long, np.clip(a, first, last), last), np.where(long, np.clip(b - length + 1, first, last), last)
                np.add.at(left, np.concatenate([first, behind]), 1)
                np.add.at(left, np.concatenate([ahead, last]), -1)
        starts = np.flatnonzero(np.cumsum(left[:-1]) > 0)
        if len(starts):
            digests = [hashlib.blake2b(b" ".join(words[s : s + length]), digest_size=16).digest() for s in starts.tolist()]
            windows_left.append((key, starts, digests))

    def batch_of(found: list, digests: pa.Array) -> pa.RecordBatch:
        keys = np.repeat(np.array([key for key, _, _ in found]), [len(start) for _, start, _ in found], axis=0)
        start, stop = (np.concatenate([f[k] for f in found]).astype(np.int32) for k in (1, 2))
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(start), pa.array(stop), digests], ["k1", "k2", "start", "stop", "window"])

    def run(batches):
        for batch in batches:
            held = _Partners(batch.column("partners"))
            k1, k2 = (batch.column(c).to_numpy() for c in KEY)
            repeats, windows_left = [], []
            for k, text in enumerate(batch.column("text").cast(pa.binary())):
                extend(text.as_py(), (k1[k], k2[k]), held, range(held.rows[k], held.rows[k + 1]), repeats, windows_left)
            if repeats:
                yield batch_of(repeats, pa.nulls(sum(len(r[1]) for r in repeats), pa.binary()))
            if windows_left:
                digests = pa.array([x for w in windows_left for x in w[2]], pa.binary())
                yield batch_of([(key, start, start + length) for key, start, _ in windows_left], digests)

    return work.mapInArrow(run, "k1 long, k2 long, start int, stop int, window binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and the 128-bit key of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def _in_buckets(df: DataFrame) -> DataFrame:
    """Write a frame in buckets by KEY below the shared checkpoint folder, so that joins on KEY leave it in place."""
    spark = df.sparkSession
    name = f"terrasift_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *KEY).option("path", scratch_dir(spark)).saveAsTable(name)
    return spark.table(name)


def _spans(texts: DataFrame, length: int, size: int) -> DataFrame:
    """(k1, k2, spans): the repeated stretches of words of the distinct texts."""
    anchors = _anchors(texts, length, size)
    # Counts are written before they are joined: a join of two plain shuffles is split where a key is hot.
    several = saved(anchors.groupBy("anchor").count().where("count > 1").select("anchor"))
    shared = saved(anchors.join(several, "anchor", "left_semi"))
    hubs = saved(shared.groupBy("anchor").agg(F.min(F.struct("n", "k1", "k2", "place")).alias("hub")))
    seeds = shared.join(hubs, "anchor").where("k1 <> hub.k1 or k2 <> hub.k2 or place <> hub.place")
    seeds = seeds.select(*KEY, F.col("hub.k1").alias("h1"), F.col("hub.k2").alias("h2"), "place", F.col("hub.place").alias("hub_place"), "before", "windows")
    # The anchors of one text are at most as many as its words.
    pairs = saved(seeds.groupBy("h1", "h2", *KEY).agg(F.collect_list(F.struct("place", "hub_place", "before", "windows")).alias("seeds")))
    within = "h1 = k1 and h2 = k2"
    cut = _cut(pairs.where(f"not ({within})"), texts, length, size).unionByName(pairs.where(within), allowMissingColumns=True)
    work = cut.groupBy(*KEY).agg(F.collect_list(F.struct("h1", "h2", "seeds", "pieces")).alias("partners")).join(texts.select(*KEY, "text"), KEY)
    found = saved(_extended(work, length, size))
    left = found.where("window is not null")
    again = left.join(saved(left.groupBy("window").count().where("count > 1").select("window")), "window", "left_semi")
    repeats = found.where("window is null").unionByName(again).groupBy(*KEY, "start").agg(F.max("stop").alias("stop"))
    return repeats.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def repeats_of_texts(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """(members, texts): (doc_id, k1, k2) of every row of ``docs`` (doc_id, text), and of every distinct
    text (k1, k2, n_words, n_removed, spans, kept).

    ``spans`` are the maximal stretches [start, stop) of words that windows of
    ``length`` words cover whose words also start anywhere else; ``kept`` holds
    the other words, joined by one space. Null texts count as empty, which have
    no words; texts shorter than ``length`` words keep all; a text that several
    rows hold repeats as a whole. doc_id is only handed on, null or repeated;
    other columns are not read; an empty table gives empty results.
    """
    if not 1 <= size <= length:
        raise ValueError("an anchor has at least one word and no more than the length of a repeat")
    small_batches(docs.sparkSession)
    keyed = _keyed(docs)
    texts = _in_buckets(keyed.groupBy(*KEY).agg(F.any_value("text").alias("text"), F.count("*").alias("copies")))
    spans = _spans(texts, length, size)
    item = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        for batch in batches:
            counts, removed, offsets, flat, kept = [], [], [0], [], []
            rows = zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("copies").to_pylist(), batch.column("spans"), strict=True)
            for text, copies, found in rows:
                words = text.split()
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                if copies > 1 and len(words) >= length:
                    cover[0], cover[-1] = 1, -1
                elif found.is_valid:
                    np.add.at(cover, found.values.field("start").to_numpy(), 1)
                    np.add.at(cover, found.values.field("stop").to_numpy(), -1)
                gone = np.cumsum(cover[:-1]) > 0
                counts.append(len(words))
                removed.append(int(gone.sum()))
                flat += _stretches(gone).tolist()
                offsets.append(len(flat))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()] if removed[-1] else words))
            columns = np.array(flat, dtype=np.int64).reshape(-1, 2)
            structs = pa.StructArray.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], fields=list(item))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(kept, pa.binary()).cast(pa.string())],
                ["k1", "k2", "n_words", "n_removed", "spans", "kept"],
            )

    judged = texts.join(spans, KEY, "left").select(*KEY, "text", "copies", "spans").mapInArrow(
        run, "k1 long, k2 long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept string"
    )
    return keyed.select("doc_id", *KEY), judged


def without_repeats(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, spans, kept; see ``repeats_of_texts``."""
    members, texts = repeats_of_texts(docs, length, size)
    return members.join(saved(texts), KEY).select("doc_id", "n_words", "n_removed", "spans", "kept")


def repeat_digests(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, without moving the kept texts."""
    members, texts = repeats_of_texts(docs, length, size)
    digests = texts.select(*KEY, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return members.join(saved(digests), KEY).select("doc_id", "n_words", "n_removed", "kept_sha256")
