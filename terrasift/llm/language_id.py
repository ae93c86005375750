"""Language identification by cross-parsing entropy.

For each language a suffix automaton recognises the substrings of a reference
text, over the language's own letters, however many its script has. A document is parsed into phrases, each the longest match that the
reference has; the language whose reference needs the fewest phrases a letter
wins. Documents are cut into segments that are parsed side by side, one symbol
of all segments at a time; a phrase ends with its segment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasift.llm.common import held_out, narrow_join, saved, small_batches

# The documented bounds of the reference texts: documents by language (one for
# each hash bucket), symbols by language and in all. Every language keeps at
# least LEAST_SYMBOLS, however many there are, and every letter of its texts.
SAMPLE_BUCKETS = 64
SAMPLE_CHARS = 8000
REFERENCE_SYMBOLS = 32_000
ALL_SYMBOLS = 1_000_000
LEAST_SYMBOLS = 256
# Transitions on so many frequent letters of a language are a table, on the others a sorted list.
DENSE = 62

_SEGMENT = 256
_LANES = 1 << 14
_SHIFT = np.int64(1) << 21
_ALPHA: list[np.ndarray] = []
UNDETERMINED = "und"


def _is_letter() -> np.ndarray:
    """Whether a code point is a letter, for all of them; made once in a process."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0]


def letters_of(text: str | None) -> tuple[np.ndarray, int]:
    """Lower-cased letters of a text as code points, each run of other characters behind one as a 1, and their number."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _is_letter()[codes]
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # of a run of other characters, the first
    return np.where(letters, codes, 1)[keep].astype(np.int32), int(letters.sum())


def suffix_automaton(symbols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The automaton of all substrings of the stretches between zeros.

    A transition table (states, width), -1 where there is none, and the
    transitions on symbols from ``width`` on: sorted state << 21 | symbol, and targets.
    """
    go: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for s in symbols.tolist():
        if not s:
            last = 0
            continue
        if last == 0 and s in go[0]:
            # A new stretch that begins like an earlier one is extended from what is known.
            q = go[0][s]
            if length[q] == 1:
                last = q
                continue
            go.append(dict(go[q]))
            link.append(link[q])
            length.append(1)
            clone = len(go) - 1
            link[q] = clone
            p = 0
            while p >= 0 and go[p].get(s) == q:
                go[p][s] = clone
                p = link[p]
            last = clone
            continue
        if s in go[last] and length[go[last][s]] == length[last] + 1:
            last = go[last][s]
            continue
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        new = len(go) - 1
        p = last
        while p >= 0 and s not in go[p]:
            go[p][s] = new
            p = link[p]
        if p >= 0:
            q = go[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                clone = len(go) - 1
                link[q] = link[new] = clone
                while p >= 0 and go[p].get(s) == q:
                    go[p][s] = clone
                    p = link[p]
        last = new
    states = np.repeat(np.arange(len(go)), [len(g) for g in go])
    on = np.array([s for g in go for s in g], dtype=np.int64)
    to = np.array([t for g in go for t in g.values()], dtype=np.int32)
    table = np.full((len(go), width), -1, dtype=np.int32)
    dense = on < width
    table[states[dense], on[dense]] = to[dense]
    keys = states[~dense] * _SHIFT + on[~dense]
    order = np.argsort(keys)
    return table, keys[order], to[~dense][order]


class Reference:
    """The automaton of one language over its own letters.

    Symbols are 1 for a run of other characters, then the letters of the
    language, frequent ones first; 0 is a letter it does not have.
    """

    def __init__(self, texts: list[np.ndarray]):
        """From texts as ``letters_of`` gives them."""
        points, counts = np.unique(np.concatenate(texts), return_counts=True)
        points, counts = points[points > 1], counts[points > 1]
        order = np.lexsort((points, -counts))
        self.points = points
        self.symbol = np.empty(len(points), dtype=np.int32)
        self.symbol[order] = np.arange(2, len(points) + 2)
        self.width = min(len(points), DENSE) + 2
        gap = np.zeros(1, dtype=np.int32)
        self.table, self.keys, self.targets = suffix_automaton(np.concatenate([x for t in texts for x in (self.known(t), gap)]), self.width)
        # The state behind each symbol at the start of a phrase; the root where there is none.
        self.first = np.zeros(len(points) + 2, dtype=np.int32)
        self.first[: self.width] = np.maximum(self.table[0], 0)
        at_root = self.keys < _SHIFT
        self.first[self.keys[at_root]] = self.targets[at_root]

    def known(self, points: np.ndarray) -> np.ndarray:
        """Code points as symbols of this language."""
        if not len(self.points):
            return (points == 1).astype(np.int32)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(points == 1, 1, np.where(self.points[at] == points, self.symbol[at], 0)).astype(np.int32)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states behind each symbol, -1 where the phrase ends before it."""
        if not len(self.keys):
            return self.table.ravel()[state * self.width + c]
        rare = np.flatnonzero(c >= self.width)
        here = self.table.ravel()[state * self.width + np.where(c < self.width, c, 0)]
        if len(rare):
            key = state[rare] * _SHIFT + c[rare]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            here[rare] = np.where(self.keys[at] == key, self.targets[at], -1)
        return here

    def phrases(self, columns: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each segment; ``columns`` holds one symbol of all of them a row, ``active`` how many go on."""
        count = np.ones(columns.shape[1], dtype=np.int64)
        state = np.zeros(columns.shape[1], dtype=np.int32)
        for t in range(columns.shape[0]):
            n = active[t]
            if not n:
                break
            c = columns[t, :n]
            here = self.step(state[:n], c)
            ended = here < 0
            state[:n] = np.where(ended, self.first[c], here)
            if t:
                count[:n] += ended
        return count


@dataclass
class LanguageModel:
    """References of all languages: about 10 MB for each of a few, less for each of many."""

    languages: list[str]
    references: list[Reference]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        parsed = [letters_of(t) for t in texts]
        total = np.zeros((len(self.references), len(texts)))
        owner, pieces = [], []
        for d, (s, _) in enumerate(parsed):
            for at in range(0, len(s), _SEGMENT):
                owner.append(d)
                pieces.append(s[at : at + _SEGMENT])
        for lo in range(0, len(pieces), _LANES):
            part = pieces[lo : lo + _LANES]
            order = sorted(range(len(part)), key=lambda i: -len(part[i]))
            lengths = np.array([len(part[i]) for i in order])
            matrix = np.ones((len(part), int(lengths[0])), dtype=np.int32)
            for row, i in zip(matrix, order, strict=True):
                row[: len(part[i])] = part[i]
            active = np.searchsorted(-lengths, -np.arange(matrix.shape[1]), side="left")
            # Each letter is looked up once for each language, not once for each place.
            points, columns = np.unique(matrix.T, return_inverse=True)
            columns = columns.reshape(matrix.shape[1], matrix.shape[0])
            at = np.array(owner[lo : lo + _LANES])[order]
            for k, reference in enumerate(self.references):
                found = reference.phrases(reference.known(points)[columns], active)
                total[k] += np.bincount(at, weights=found, minlength=len(texts))
        best, score = [], []
        for d, (_, n) in enumerate(parsed):
            if not n or not self.references:
                best.append(UNDETERMINED)
                score.append(0.0)
                continue
            # exp of the phrases saved against each other, a letter, sharpened as texts grow.
            gap = (total[:, d] - total[:, d].min()) / np.sqrt(n)
            weight = np.exp(-np.minimum(gap, 700))
            k = int(np.argmin(total[:, d]))  # of equals, the first language
            best.append(self.languages[k])
            score.append(float(weight[k] / weight.sum()))
        return best, score


def _shared_out(lengths: list[int], room: int) -> list[int]:
    """Equal shares of ``room``, what short texts leave going to the longer ones."""
    shares, left = [0] * len(lengths), room
    for rank, i in enumerate(sorted(range(len(lengths)), key=lambda i: lengths[i])):
        shares[i] = min(lengths[i], left // (len(lengths) - rank))
        left -= shares[i]
    return shares


def fit_languages(docs: DataFrame) -> LanguageModel:
    """References from ``docs`` (doc_id, text, lang), without the held-out fold.

    One document for each language and hash bucket: that of the least hash among
    those of SAMPLE_CHARS or less, or among the longer ones where there are no
    others. A language's documents share its symbols equally.
    """
    usable = docs.where("doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))
    hashed = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    rank = F.shiftrightunsigned("h", 2) + F.when(F.length("text") > SAMPLE_CHARS, F.lit(1 << 62)).otherwise(0)
    keyed = hashed.select("lang", "text", F.pmod("h", F.lit(SAMPLE_BUCKETS)).alias("bucket"), rank.alias("rank"))
    chosen = saved(keyed.groupBy("lang", "bucket").agg(F.min("rank").alias("rank")))
    found = chosen.select("lang").distinct().count()
    room = max(LEAST_SYMBOLS, min(REFERENCE_SYMBOLS, ALL_SYMBOLS // max(1, found)))
    # Texts are cut on the executors, so that at most four characters for each symbol kept reach the driver.
    share = F.ceil(F.lit(4 * room) / F.count("*").over(Window.partitionBy("lang"))).cast("int")
    rows = narrow_join(keyed, chosen, ["lang", "bucket", "rank"]).groupBy("lang", "bucket").agg(F.max("text").alias("text"))
    rows = rows.select("lang", "bucket", F.substr("text", F.lit(1), share).alias("text"))
    texts: dict[str, list[np.ndarray]] = {}
    for r in sorted(rows.collect()):
        texts.setdefault(r["lang"], []).append(letters_of(r["text"])[0])
    languages = sorted(texts)
    references = []
    for lang in languages:
        shares = _shared_out([len(t) for t in texts[lang]], room)
        references.append(Reference([t[:n] for t, n in zip(texts[lang], shares, strict=True)]))
    return LanguageModel(languages, references)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score.

    A null text and one without letters are ``und`` with score 0; so is every
    text if no language was learned. Of languages with equal phrases the first by
    name wins, so also where no language has any letter of the text, with score
    1 / languages. Rows without a doc_id and repeated rows are
    treated alike; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            best, score = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
