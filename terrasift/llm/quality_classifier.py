"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Every vocabulary entry has a sparse random index vector; its word vector is the
sum of the index vectors of its neighbours in the training texts. Words too rare
for the vocabulary share the entry of their shape (``Aa.``, ``A!``, ``9-9``). A
document is the mean of its words' vectors, with its length and two measures of
how its own words repeat. A two-layer network in numpy scores it; a temperature fitted on
texts the network has not seen calibrates its probabilities.

The model is fitted on the driver over a bounded sample of labelled documents;
every document is then scored on the executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import fresh, held_out, saved, small_batches

# The documented bounds of the sample: labelled documents with the least hashes,
# of at most so many characters each.
SAMPLE_DOCUMENTS = 4000
SAMPLE_CHARS = 20_000
CUT = 0.7

_DIM, _NONZERO, _REACH, _LEAST_COUNT, _HIDDEN = 64, 4, 2, 3, 32
_PRIOR_WORDS = 8
_EXTRA = _DIM + 3  # with the repetition of words, of neighbours, and the length
_SHAPE = bytes(
    97 if 97 <= b <= 122 else 65 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else 97 if b >= 128 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """Pattern of a word: runs of lower case, upper case and digits, other bytes as they are; marked to differ from words."""
    return b"\x00" + _RUNS.sub(rb"\1", word.translate(_SHAPE))[:12]


def _index_vectors(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, _DIM, (n, _NONZERO)), rng.choice([-1.0, 1.0], (n, _NONZERO))


class _Ids(dict):
    """Vocabulary ids of words; rare words have that of their shape, unknown shapes 0."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        i = self.vocabulary.get(word)
        if i is None:
            i = self.vocabulary.get(shape(word), 0)
        self[word] = i
        return i


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


@dataclass
class QualityModel:
    """Everything a worker needs; about 20 MB at most, whatever the table's size."""

    vocabulary: dict[bytes, int]
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray] | None  # None: ``constant`` is every score
    temperature: float
    constant: float

    def features(self, texts) -> np.ndarray:
        ids, hashes = _Ids(self.vocabulary), _Hashes()
        return np.array([self._pooled(t, ids, hashes) for t in texts]).reshape(-1, _EXTRA)

    def _pooled(self, text, ids, hashes) -> np.ndarray:
        words = _words(text)
        n = len(words)
        return self.pooled(np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=n), np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n))

    def pooled(self, at: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Features of a document from the vocabulary ids and the hashes of its words."""
        row = np.zeros(_EXTRA)
        n = len(at)
        if not n:
            return row
        # A few words say little, so the mean is drawn towards zero.
        row[:_DIM] = self.vectors[at].sum(axis=0) / (n + _PRIOR_WORDS)
        # Own index vectors of all words cancel out unless few words repeat.
        sign = np.where(h & np.uint64(1 << 20), 1.0, -1.0)
        own = np.bincount((h & np.uint64(1023)).astype(np.int64), weights=sign, minlength=1024)
        row[_DIM] = np.log1p((own**2).sum() / n)
        row[_DIM + 1] = (h[1:] == h[:-1]).sum() / (n + _PRIOR_WORDS)
        row[_DIM + 2] = np.log1p(n)
        return row

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Sample:
    """Labelled texts as arrays of word numbers; no text is held once it has been added."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.rows: list[tuple[tuple, np.ndarray, int]] = []

    def add(self, text: str | None, label: int, key: tuple) -> None:
        words, known = _words(text), self.words
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int32, count=len(words))
        self.rows.append((key, ids, label))

    def ordered(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Word numbers and labels in order of the keys, which may be asked for once."""
        self.rows.sort(key=lambda r: r[0])
        rows, self.rows = self.rows, []
        return [r[1] for r in rows], np.array([r[2] for r in rows], dtype=float)


def _word_vectors(texts: list[np.ndarray], words: list[bytes]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Vocabulary (id 0 is no word), context vectors of unit length, and the vocabulary id of each word number."""
    counts = np.zeros(len(words), dtype=np.int64)
    for at in texts:
        counts += np.bincount(at, minlength=len(words))
    names = {w for w, n in zip(words, counts.tolist(), strict=True) if n >= _LEAST_COUNT} | {shape(w) for w in words}
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(names))}
    size = len(vocabulary) + 1
    place, sign = _index_vectors(size)
    ids = _Ids(vocabulary)
    # Rare words stand for their shapes, as they do when documents are scored.
    entry = np.array([ids[w] for w in words], dtype=np.int64)
    total = np.zeros(size * _DIM)
    for raw in texts:
        at = entry[raw]
        for off in range(1, _REACH + 1):
            for a, b in ((at[:-off], at[off:]), (at[off:], at[:-off])):
                if len(a):
                    np.add.at(total, (a[:, None] * _DIM + place[b]).ravel(), sign[b].ravel())
    context = total.reshape(size, _DIM)
    vectors = np.empty((size, _DIM), dtype=np.float32)
    length = lambda v: np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    for lo in range(0, size, 4096):
        part = slice(lo, min(lo + 4096, size))
        # Its own index vector keeps an entry apart from others in like company.
        own = np.zeros((part.stop - lo, _DIM))
        np.add.at(own, (np.arange(part.stop - lo)[:, None], place[part]), sign[part])
        vectors[part] = context[part] / length(context[part]) + own / length(own)
    return vocabulary, vectors, entry


def _train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    rng = np.random.default_rng(7)
    layers = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], _HIDDEN)), np.zeros(_HIDDEN),
        rng.normal(0, np.sqrt(2 / _HIDDEN), _HIDDEN), np.zeros(1),
    ]
    m, v = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(40):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            w1, b1, w2, b2 = layers
            h = np.maximum(x[rows] @ w1 + b1, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2[0], -30, 30)))
            d = (p - y[rows]) / len(rows)
            dh = np.outer(d, w2) * (h > 0)
            grads = [x[rows].T @ dh + 1e-4 * w1, dh.sum(0), h.T @ d + 1e-4 * w2, np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                layers[k] = layers[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def fit(sample: Sample) -> QualityModel:
    """Fit on texts with labels 0 and 1; the order of their keys decides nothing but the split."""
    texts, y = sample.ordered()
    n1 = float(y.sum()) if len(y) else 0.0
    words, sample.words = list(sample.words), {}
    vocabulary, vectors, entry = _word_vectors(texts, words)
    model = QualityModel(vocabulary, vectors, np.zeros(_EXTRA), np.ones(_EXTRA), None, 1.0, (n1 + 1) / (len(y) + 2))
    if n1 in (0.0, float(len(y))):
        return model  # one class only: its smoothed share is every score
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    x = np.array([model.pooled(entry[t], hashes[t]) for t in texts]).reshape(-1, _EXTRA)
    del texts, words, entry, hashes
    calibrating = np.arange(len(y)) % 5 == 0
    if len(set(y[~calibrating])) < 2:
        calibrating[:] = False
    model.mean, model.scale = x[~calibrating].mean(0), x[~calibrating].std(0) + 1e-6
    model.layers = _train((x[~calibrating] - model.mean) / model.scale, y[~calibrating])
    if calibrating.any():
        z, t = model.logits(x[calibrating]), y[calibrating]

        def loss(temperature: float) -> float:
            s = np.clip(z / temperature, -30, 30)
            return float(np.mean(np.log1p(np.exp(-s)) * t + np.log1p(np.exp(s)) * (1 - t)))

        model.temperature = min(np.geomspace(0.5, 8, 33).tolist(), key=loss)
    return model


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on a sample of ``docs`` (doc_id, text) whose quality ``labels`` (doc_id, quality) tell.

    Documents of the held-out fold, without a doc_id or a label of 0 or 1, with
    contradicting labels or beyond SAMPLE_CHARS give no example.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("highest"))
        .where("quality = highest")
    )
    sample = saved(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS).select("doc_id", "quality"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= SAMPLE_CHARS)
    found = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.max("text").alias("text"))
    taken = Sample()
    # One partition at a time, and each text only until its words are numbered.
    for r in found.toLocalIterator():
        taken.add(r["text"], r["quality"], (xxhash.xxh64_intdigest(str(r["doc_id"])), r["doc_id"]))
    return fit(taken)


def score_documents(docs: DataFrame, model: QualityModel, keep: bool = False) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``; with ``keep``, all columns of ``docs`` with ``_predicted`` as the last, under another name if there is such a column.

    Null and empty texts are documents without words and get the network's score
    for such. Rows without a doc_id and repeated rows are scored alike.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            score = shared.value.scores(shared.value.features(batch.column("text").to_pylist()))
            yield batch, score, (score >= CUT).astype(np.int32)

    if keep:
        flag = fresh(docs, "_predicted")

        def run_all(batches):
            for batch, _, predicted in scored(batches):
                yield batch.append_column(flag, pa.array(predicted))

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return docs.mapInArrow(run_all, f"{schema}, {flag} int")

    def run(batches):
        for batch, score, predicted in scored(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(predicted)], ["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be of quality 1, with their columns."""
    kept = score_documents(docs, fit_on_labels(docs, labels), keep=True)
    return kept.where(F.col(kept.columns[-1]) == 1).select(docs.columns)
