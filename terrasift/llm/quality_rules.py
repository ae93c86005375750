"""Quality rules: fixed counts, and a likelihood ratio of hashed n-grams.

The n-grams are all words and all pairs of neighbouring words of the whole text;
words of more than ``LONG_WORD`` characters are cut into pieces besides, so text
without blanks has n-grams as well. They are hashed into ``BUCKETS``. The raw
multinomial counts them over all documents, the target over a bounded sample of
trusted ones and ``PRIOR`` n-grams distributed like the raw ones, so that a
small sample says little. A document's score is the mean over its n-grams of
log p_target / p_raw, so length does not matter; it is kept from ``THRESHOLD``
upwards. Only DataFrame functions are used and texts are never shuffled: the
ratios are one row of BUCKETS numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import BLANKS, saved

BUCKETS = 1 << 14
PRIOR = 64 * BUCKETS
LONG_WORD, PIECE = 16, 8
# Trusted documents that the target is counted over, those with the least hashes.
TRUSTED_DOCUMENTS = 4000
# Set on labelled documents that were neither trusted nor failed by the base rules,
# at three sizes of the table: it keeps 99.8 % or more of the good ones at each.
THRESHOLD = -0.02
_BLANK_CHARS = "\x20\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def grams_of(words: str) -> Column:
    """Buckets of all words, of all pairs of neighbours (the last word has the end), and of the pieces of long words."""
    def bucket(*parts: Column) -> Column:
        return F.pmod(F.hash(*parts), F.lit(BUCKETS))

    pieces = F.transform(F.filter(words, lambda w: F.length(w) > LONG_WORD), lambda w: F.regexp_extract_all(w, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    return F.concat(
        F.transform(words, lambda w: bucket(w)),
        F.transform(words, lambda w, i: bucket(F.lit(2), w, F.get(words, i + 1))),
        F.transform(F.flatten(pieces), lambda x: bucket(F.lit(3), x)),
    )


def _windows(words: str) -> Column:
    """Hashes of all 3-word windows."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """Add words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    df = docs.withColumn("text", F.coalesce("text", F.lit("")))
    df = df.withColumn("words", words_of(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, _BLANK_CHARS, "")) > 0)
    df = df.withColumn("_lines", lines)
    # Of one value for each row, so not computed anew for each window.
    df = df.withColumn("_bits", F.ceil(F.log2(F.col("n_words") + 1)).cast("int"))
    df = df.withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bits")) - 1)
    mask = F.col("_mask")
    nothing = F.array().cast("array<bigint>")
    df = df.withColumn("_windows", F.when(F.col("n_words") >= 4, _windows("words")).otherwise(nothing))
    # Most texts have no window twice. In the others, sorted by hash with the place in the
    # low bits, equal windows are neighbours; these are compared word by word.
    placed = F.transform("_windows", lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("bigint")))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_keys", F.when(twice, F.sort_array(placed)).otherwise(nothing))

    def same(a: Column, b: Column) -> Column:
        i, j = a.bitwiseAND(mask).cast("int"), b.bitwiseAND(mask).cast("int")
        equal = F.get("words", i) == F.get("words", j)
        for k in (1, 2):
            equal = equal & (F.get("words", i + k) == F.get("words", j + k))
        # The bits above the place are the hash.
        return F.coalesce((a.bitwiseXOR(b) <= mask) & (a.bitwiseXOR(b) >= 0) & equal, F.lit(False))

    found = F.filter("_keys", lambda x, j: same(x, F.get("_keys", j - 1)) | same(x, F.get("_keys", j + 1)))
    df = df.withColumn("_at", F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask))))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-3).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3).cast("bigint"), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    df = df.withColumns({
        "word_chars": F.length(F.translate("text", _BLANK_CHARS, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered,
    })
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_lines", "_keys", "_at", "_bits", "_mask", "_windows")


def trusted_ids(labels: DataFrame, most: int = TRUSTED_DOCUMENTS) -> DataFrame:
    """Up to ``most`` doc_ids labelled good and nowhere bad, those with the least hashes."""
    each = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = each.agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")).where("quality = 1 and toxic = 0")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with the array ``ratios``: log p_target / p_raw of each bucket, the raw counts with one added."""
    def counted(rows: DataFrame, name: str) -> DataFrame:
        words = rows.select(words_of(F.coalesce("text", F.lit(""))).alias("words"))
        return words.select(F.explode(grams_of("words")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))

    raw = counted(docs, "raw")
    target = counted(docs.join(F.broadcast(trusted), "doc_id", "left_semi"), "target")
    both = saved(docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(raw, "bucket", "left").join(target, "bucket", "left"))
    total_raw, total_target = both.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0))).first()
    raw_share = (F.coalesce("raw", F.lit(0)) + 1.0) / float(total_raw + BUCKETS)
    target_share = (F.coalesce("target", F.lit(0)) + float(PRIOR) * raw_share) / float(total_target + PRIOR)
    ratio = F.log(target_share / raw_share) if total_target else F.lit(0.0)
    listed = both.agg(F.array_sort(F.collect_list(F.struct("bucket", ratio.alias("r")))).alias("rows"))
    return listed.select(F.transform("rows", lambda r: r["r"]).alias("ratios"))


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score.

    A null text has no words. Texts without n-grams score 0. Without trusted
    documents every score is 0, so only the base rules decide. Rows without a
    doc_id are judged like others; repeated rows stay; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    trusted = saved(trusted_ids(labels))
    ratios = log_ratios(docs, trusted)
    rows = with_counts(docs).withColumn("_grams", grams_of("words")).crossJoin(F.broadcast(ratios))
    total = F.aggregate("_grams", F.lit(0.0), lambda acc, b: acc + F.get("ratios", b))
    rows = rows.withColumn("score", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(0.0))
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score"
    )
