"""Periodic runs, spelling variants and repeated passages against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from terrasift.llm import periodic_runs, spelling_variants, substring_dedup

NASTY = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "x " * 3000), (6, "z" * 20000), (7, "one two three " * 5), (7, "one two three " * 5),
    (None, "one two three " * 5), (8, "é ñ 中文 🙂 don't " * 9), (9, " ".join(f"w{k % 4000}" for k in range(12000))),
]
FIELDS = "doc_id long, text string, n string, words string, window string, k1 string, block string, h string, runs string, copies string"


@pytest.fixture(scope="module")
def nasty(spark):
    # Extra columns have names that the operators use inside.
    return spark.createDataFrame([(i, t, *"abcdefgh") for i, t in NASTY], FIELDS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


def words_of(text):
    return text.encode().split() if text else []


def brute_runs(a, least):
    found = {}
    for q in range(1, len(a) // 2 + 1):
        s = 0
        while s < len(a) - q:
            e = s
            while e < len(a) - q and a[e] == a[e + q]:
                e += 1
            if e > s and e - s + q >= max(least, 2 * q):
                found.setdefault((s, e - s + q), q)
            s = max(e, s + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 60))]
        if a and rng.random() < 0.5:
            s, p = rng.randrange(len(a)), rng.randint(1, 9)
            a = a[:s] + [a[min(s + k % p, len(a) - 1)] for k in range(len(a) - s)]
        least = rng.choice([2, 4, 5, 12])
        assert periodic_runs.runs_of(np.array(a, dtype=np.int64), least) == brute_runs(a, least), (a, least)


@pytest.mark.parametrize("kind", ["ones", "period", "fibonacci", "lines"])
def test_runs_of_very_long_texts(kind):
    a, b = [0], [0, 1]
    while len(b) < 100_000:
        a, b = b, b + a
    text = {"ones": [0] * 300_000, "period": [k % 7 for k in range(300_000)], "fibonacci": b, "lines": [x for k in range(20_000) for x in (*range(8), 100 + k)]}[kind]
    found = periodic_runs.runs_of(np.array(text, dtype=np.int64))
    assert {"ones": [(0, 300_000, 1)], "period": [(0, 300_000, 7)], "lines": []}.get(kind, found) == found
    assert len(found) < len(text)


def test_run_digests(spark, nasty, empty):
    got = periodic_runs.run_digests(periodic_runs.find_runs(nasty)).collect()
    assert len(got) == len(NASTY)
    want = []
    for i, t in NASTY:
        words = words_of(t)
        runs = brute_runs(words[:3100] if i != 9 else [], 12) if i != 5 else [(0, 3000, 1)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        if i == 9:
            # 4,000 words three times over.
            runs, gone = [(0, 12000, 4000)], set(range(4000, 12000))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((
            i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest(),
        ))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert periodic_runs.run_digests(periodic_runs.find_runs(empty)).count() == 0
    assert periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(empty))).count() == 0


def test_planted_runs(spark, nasty):
    got = sorted(((r["doc_id"] is None, r["doc_id"], " ".join(w.decode() for w in words_of(r["text"]))) for r in periodic_runs.with_planted_runs(nasty).collect()), key=repr)
    want = []
    for i, t in NASTY:
        w = words_of(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        want.append((i is None, i, " ".join(x.decode() for x in w)))
    assert got == sorted(want, key=repr)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts):
    rows = {}
    for w, n in counts.items():
        near = [v for v in counts if v != w and one_edit(v, w)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        rows[w] = [len(near), best if best is not None and counts[best] >= 10 * n else None]
    for w in rows:
        root = w
        while rows[root][1] is not None:
            root = rows[root][1]
        rows[w].append(root)
    return sorted((w, f, r, counts[w], k, counts.get(f)) for w, (k, f, r) in rows.items())


@pytest.mark.parametrize(("pieces", "block", "least"), [(4, 512, 1), (2, 4, 1), (3, 8, 3)])
def test_spelling_variants(spark, monkeypatch, pieces, block, least):
    rng = random.Random(pieces)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(least, 6))) for _ in range(250)} | {"a" * k for k in range(least, 12)}
    counts = {w: 10 ** rng.randint(0, 5) + rng.randint(0, 1) for w in words}
    monkeypatch.setattr(spelling_variants.near_words, "__defaults__", (pieces, block))
    got = spelling_variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == brute_variants(counts)


def test_variants_of_documents(spark, nasty, empty):
    rng = random.Random(5)
    base = ["thonerin", "Thonerin", "thonering", "öffnungen", "x" * 40, "short"]
    rows = [(k if k % 7 else None, " ".join(rng.choice(base) for _ in range(40)) + "...ABCDEFGH") for k in range(200)] + NASTY
    counts = collections.Counter()
    for i, t in rows:
        for run in __import__("re").findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "[" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    got = spelling_variants.variants_of_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr) == sorted(brute_variants(counts), key=repr)
    assert spelling_variants.variants_of_documents(empty).count() == 0


def brute_repeats(texts, length):
    seen = collections.Counter(tuple(w[k : k + length]) for w in texts for k in range(len(w) - length + 1))
    out = []
    for w in texts:
        gone = {k + j for k in range(len(w) - length + 1) if seen[tuple(w[k : k + length])] > 1 for j in range(length)}
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 5, 6])
def test_repeats_equal_brute_force(spark, size):
    rng = random.Random(size)
    rows = []
    for k in range(120):
        words = [rng.choice("ab" if k % 3 else "abcdefgh") + rng.choice("xyz"[: 1 + k % 3]) for _ in range(rng.choice([0, 3, 6, 12, 40]))]
        if rows and rng.random() < 0.5:
            other = rng.choice(rows)[1].split()
            at = rng.randint(0, len(words))
            words[at:at] = other[rng.randint(0, 5) :][: rng.randint(4, 30)] * rng.choice([1, 1, 3])
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(words)))
    got = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=6, size=size).collect()
    want = brute_repeats([words_of(t) for _, t in rows], 6)
    assert [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in sorted(got)] == [(i, *w) for (i, _), w in zip(rows, want, strict=True)]
    assert all(sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)


def test_repeats_of_odd_rows(spark, nasty, empty):
    got = substring_dedup.repeat_digests(nasty).collect()
    want = brute_repeats([words_of(t) for _, t in NASTY], 35)
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, gone, kept) in zip(NASTY, want, strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert substring_dedup.repeat_digests(empty).count() == 0
