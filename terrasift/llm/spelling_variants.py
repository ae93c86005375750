"""Spelling variants: words one edit apart, by dense tiles of prefix and suffix lengths.

Two words are one inserted, deleted or replaced code point apart when their
common prefix and common suffix together reach the length of the longer one
less one. Blocks of words stand in two matrices of code points, padded on the
right and on the left; comparing a block with itself gives the prefix and suffix
lengths of all its pairs at once.

Blocks hold only words that can be so near: the longer length of a pair is cut
into ``PIECES`` pieces, the edit falls into one of them, and everything before
and behind that piece is the same in both words. A word therefore stands in one
block for each piece of its own length (where it is replaced in, or the longer
one) and for each piece of the next length (where it is the shorter one). A pair
counts in the block of the piece where the words first differ, so once. Blocks
above ``BLOCK`` words are cut again, into one block for each place of the piece;
such a block holds the words that differ in one given letter, so no more of them
than there are letters, and the work grows with the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import groups, saved

LETTERS = "A-Za-zÀ-ÿ"
PIECES = 4
# Words compared all with all; larger blocks are cut again.
BLOCK = 512
# Cells of one comparison.
_CELLS = 8_000_000


def letter_runs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, run): maximal runs of ``least`` or more letters, with A-Z in lower case."""
    runs = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least},}}+)"), F.lit(1))
    lower = F.translate(F.col("run"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select("doc_id", F.explode(runs).alias("run")).withColumn("run", lower)


def with_planted_slips(runs: DataFrame) -> DataFrame:
    """The words of the contract: runs lose one letter where the CRC of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int, often: int = 2) -> DataFrame:
    """(word, n): words of at least ``least`` code points with at least ``often`` occurrences."""
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)


def _block(m: Column, lo: Column, hi: Column) -> Column:
    """The block of words of length m, or of m - 1, that agree outside [lo, hi) of length m."""
    word, n = F.col("word"), F.length("word")
    tail = F.substring(word, n - (m - hi) + 1, m - hi)
    return F.struct(F.xxhash64(m, lo, hi, F.substring(word, F.lit(1), lo), tail).alias("block"), m.alias("m"), lo.alias("lo"), hi.alias("hi"))


def _placed(words: DataFrame, pieces: int) -> DataFrame:
    """Every word once for each block it stands in: those of its own length and of the next."""
    lengths = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m"))
    size = F.ceil(F.col("m") / pieces).cast("int")
    cut = lengths.withColumn("size", size).withColumn("lo", F.explode(F.expr("sequence(0, m - 1, size)")))
    return cut.select("word", "n", _block(F.col("m"), F.col("lo"), F.least(F.col("lo") + F.col("size"), F.col("m"))).alias("b")).select("word", "n", "b.*")


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded on the right, and padded on the left."""
    length = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    row = np.repeat(np.arange(len(words)), length)
    column = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    right = np.zeros((len(words), width), dtype=np.uint32)
    right[row, column] = points
    left = np.zeros_like(right)
    left[row, column + width - np.repeat(length, length)] = points
    return right, left


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows; equal rows agree over their whole width."""
    different = a != b
    return np.where(different.any(axis=-1), different.argmax(axis=-1), a.shape[-1])


def near_in_blocks(words: list[str], starts: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of near words, place of the first near word) of each word within its block.

    Blocks are stretches of words from each start. Those of one size are
    compared together; a large one in bands of rows against all its words.
    """
    width = int(max(len(w) for w in words)) + 1
    right, left = _matrices(words, width)
    left = left[:, ::-1]
    length = np.array([len(w) for w in words])
    sizes = np.diff(np.append(starts, len(words)))
    count, first = np.zeros(len(words), dtype=np.int64), np.full(len(words), -1, dtype=np.int64)
    for size in np.unique(sizes[sizes > 1]):
        size = int(size)
        same = starts[sizes == size]
        band = min(size, max(1, _CELLS // (size * width)))
        at_once = max(1, _CELLS // (size * band * width))
        for some in range(0, len(same), at_once):
            block = same[some : some + at_once, None] + np.arange(size)
            for top in range(0, size, band):
                rows = block[:, top : top + band]
                prefix = _agree(right[rows][:, :, None, :], right[block][:, None, :, :])
                suffix = _agree(left[rows][:, :, None, :], left[block][:, None, :, :])
                longer = np.maximum(length[rows][:, :, None], length[block][:, None, :])
                near = (prefix + suffix >= longer - 1) & (rows[:, :, None] != block[:, None, :])
                head = block[:, :1, None]
                near &= (longer == m[head]) & (prefix >= lo[head]) & (prefix < hi[head])
                count[rows] = near.sum(axis=2)
                first[rows] = np.where(near.any(axis=2), np.take_along_axis(block, near.argmax(axis=2), axis=1), -1)
    return count, first


def _compared(placed: DataFrame) -> DataFrame:
    """(word, near, best, best_n): how many near words each word has in a block, and the most frequent of them."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])

    def tasks(batches):
        held: list[pa.Table] = []
        rows = 0
        for group in groups(batches, ["block"]):
            if group.num_rows > 1:
                held.append(group)
                rows += group.num_rows
            if rows >= 8192:
                yield held
                held, rows = [], 0
        if held:
            yield held

    def run(batches):
        for held in tasks(batches):
            table = pa.concat_tables(held)
            starts = np.cumsum([0, *(t.num_rows for t in held[:-1])])
            words = table.column("word").to_pylist()
            count, first = near_in_blocks(words, starts, *(table.column(c).to_numpy() for c in ("m", "lo", "hi")))
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[k] for k in some], pa.string()), pa.array(count[some]), pa.array([words[k] for k in first[some]], pa.string()),
                 pa.array(table.column("n").to_numpy()[first[some]])],
                schema=schema,
            )

    # Within a block the more frequent words come first, equally frequent ones by code points.
    dealt = placed.repartition("block").sortWithinPartitions("block", F.desc("n"), "word")
    return dealt.mapInArrow(run, "word string, near long, best string, best_n long")


def near_words(words: DataFrame, pieces: int = PIECES, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, best, best_n) of distinct ``words`` (word, n).

    n_near counts the words one edit away; best is the most frequent of them,
    of equally frequent ones the least by code points, null where there is none.
    """
    placed = _placed(words, pieces)
    # A hot block is counted by partial sums; its words are dealt out anew and never meet in one task.
    hot = saved(placed.groupBy("block").count().where(F.col("count") > block).select("block"))
    if hot.isEmpty():
        found = _compared(placed)
    else:
        again = placed.join(hot, "block", "left_semi").withColumn("at", F.explode(F.expr("sequence(lo, hi - 1)")))
        again = again.select("word", "n", _block(F.col("m"), F.col("at"), F.col("at") + 1).alias("b")).select("word", "n", "b.*")
        found = _compared(placed.join(hot, "block", "left_anti").unionByName(again))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    per_word = found.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    return words.join(per_word, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last word that the forms lead to.

    Every step leads to a word ten times as frequent, so chains are short; each
    round doubles what a row has skipped.
    """
    reached = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = saved(reached.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def spelling_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct ``words`` (word, n).

    The form of a word is its most frequent near word (ties: the least by code
    points) if that one is at least ``times`` as frequent, else null; the root is
    where the forms lead to, the word itself without a form. An empty table
    gives an empty result; other columns are not read.
    """
    words = saved(words.select("word", "n"))
    near = saved(near_words(words))
    is_form = F.coalesce(F.col("best_n") >= times * F.col("n"), F.lit(False))
    rows = near.withColumn("form", F.when(is_form, F.col("best"))).withColumn("form_n", F.when(is_form, F.col("best_n")))
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_of_documents(docs: DataFrame, least: int = 7) -> DataFrame:
    """The spelling variants of the words of ``docs`` (doc_id, text), as the contract has them.

    Null, empty and blank texts have no words; a null doc_id counts as the empty
    text in the checksum; repeated rows count again; other columns are not read.
    """
    return spelling_variants(vocabulary(with_planted_slips(letter_runs(docs, least)), least))
