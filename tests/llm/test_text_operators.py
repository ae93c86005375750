"""Operators on text collections against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
NASTY = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A B"), (6, "x " * 3000), (7, "z" * 20000), (8, "one two three four five"), (8, "one two three four five"),
    (None, "one two three four five"), (9, "é ñ 中文 🙂 don't <|endoftext|> end"), (10, "mail me@x.example.org or 1.2.3.4, 4111 1111 1111 1111, +1 (555) 010-2030"),
]


@pytest.fixture(scope="module")
def nasty(spark):
    rows = [(i, t, "lang", "a" if k % 3 else None, 7, "x") for k, (i, t) in enumerate(NASTY)]
    # Extra columns have names that the operators use inside.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, cls string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, cls string")


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(spark):
    return {r["doc_id"]: r["text"] or "" for r in docs_of(spark).select("doc_id", "text").collect()}


def brute_components(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = [x.encode().lower() for x in WORDS.findall(t)]
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((top(a), top(b)))
                up[hi] = lo
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_ngram_components(spark, size, percent):
    from terrasift.llm.ngram_join import ngram_components

    texts = texts_of(spark)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(docs_of(spark), size, percent).collect()}
    assert got == brute_components(texts, size, percent)


def test_ngram_components_with_split_buckets(spark, monkeypatch):
    """Blocks of three: groups of near copies are found across blocks as well."""
    from terrasift.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rng = random.Random(4)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    texts = {}
    for i in range(60):
        words = list(base[i % 3])
        for _ in range(i % 4):
            words[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(df).collect()}
    assert got == brute_components(texts, 4, 85)


def test_blocks_of_a_bucket_meet_by_a_short_plan(spark, monkeypatch):
    from terrasift.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(4)
    rows = [(bucket, cls, cls % 2 if cls < 12 else cls) for bucket in range(3) for cls in rng.sample(range(30), 22)]
    rows += [(3, 1, 1), (3, 2, 1), (4, 7, 7)]
    met = ngram_join._block_pairs(spark.createDataFrame(rows, "bucket long, cls long, comp long"))
    tasks = collections.defaultdict(list)
    for r in met.collect():
        tasks[r["bucket"], r["block"], r["block2"]].append((r["cls"], r["comp"], r["side"]))
    found = set()
    for (bucket, block, block2), held in tasks.items():
        assert len(held) == len(set(held)) and {s for _, _, s in held} <= ({0} if block == block2 else {1, 2})
        found |= {(bucket, a, b) for a, c, s in held for b, d, t in held if a < b and c != d and (s == t == 0 or s != t)}
    assert found == {(x, a, b) for x, a, c in rows for y, b, d in rows if x == y and a < b and c != d}
    # What it has written is read, not computed again for each use.
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 4


def test_components_take_no_round_when_all_are_stars(spark, monkeypatch):
    from terrasift.llm import common

    written = []
    write = common.saved
    monkeypatch.setattr(common, "saved", lambda df: written.append(df) or write(df))

    def found(edges):
        written.clear()
        return {(r["node"], r["component"]) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}

    assert found([(1, 5), (7, 1), (2, 3), (2, 3), (4, 4), (None, 9)]) == {(1, 1), (5, 1), (7, 1), (2, 2), (3, 2)}
    assert len(written) == 1
    assert found([]) == set() and len(written) == 1
    assert found([(1, 2), (2, 3)]) == {(1, 1), (2, 1), (3, 1)} and len(written) == 2
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)]
    up = {x: x for e in edges for x in e}
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert found(edges) == {(x, up[x]) for a, b in edges if a != b for x in (a, b)}


def test_ngram_counter_counts_and_keeps_the_frequent(monkeypatch):
    """Exact while its counters suffice; beyond, what is seen all the time stays."""
    from terrasift.llm import ngram_join

    rng = np.random.default_rng(5)
    monkeypatch.setattr(ngram_join, "_WAITING", 50)
    draws = [np.unique(rng.integers(0, 400, rng.integers(0, 30)).astype(np.uint64)) for _ in range(200)]
    counter = ngram_join._Counter()
    for at in range(0, len(draws), 7):
        counter.add(draws[at : at + 7])
    seen, counts = counter.result()
    want = collections.Counter(x for d in draws for x in d.tolist())
    assert dict(zip(seen.tolist(), counts.tolist(), strict=True)) == {x: n for x, n in want.items() if n > 1}
    assert (np.diff(seen.astype(np.int64)) > 0).all()

    monkeypatch.setattr(ngram_join, "_COUNTERS", 256)
    counter, often = ngram_join._Counter(), np.arange(20, dtype=np.uint64)
    for k in range(300):
        counter.add([np.concatenate([often, np.arange(1000 + 40 * k, 1040 + 40 * k, dtype=np.uint64)])])
        assert len(counter.seen) <= 192
    seen, counts = counter.result()
    assert dict(zip(seen.tolist(), counts.tolist(), strict=True)) == dict.fromkeys(range(20), 300)
    assert [len(x) for x in ngram_join._Counter().result()] == [0, 0]


def test_ngram_edge_cases(nasty, empty):
    from terrasift.llm.ngram_join import ngram_components

    got = collections.Counter(tuple(r) for r in ngram_components(nasty).collect())
    assert got[(1, 0, 1)] == got[(2, 0, 2)] == got[(3, 0, 3)] == 1
    assert got[(4, 1, 4)] == got[(5, 1, 4)] == 1 and got[(8, 2, 8)] == 2 and got[(None, 2, None)] == 1
    assert ngram_components(empty).count() == 0


def test_mix(spark, nasty, empty):
    from terrasift.llm.mixing import mix, mixed_documents, word_count

    rows = mix(docs_of(spark)).drop("h").toPandas()
    texts = texts_of(spark)
    assert all(n == len(WORDS.findall(texts[i])) for i, n in zip(rows.doc_id, rows["size"], strict=True))
    assert (rows.taken <= 2 * rows["size"]).all() and (rows.taken % rows["size"].clip(lower=1) == 0).all()
    source = docs_of(spark).select("doc_id", "source").toPandas()
    by = rows.merge(source, on="doc_id").groupby("source", dropna=False)
    g = by.agg(size=("size", "sum"), named=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), longest=("size", "max"))
    names = sorted(n for n in g.index if n == n)
    weight = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    assert (g["size"] == g.named).all() and abs(g.target.sum() - 1.5 * g["size"].sum()) < 1e-6 * g.target.sum()
    level = {round(g.target[n] / weight[n], 6) for n in names if g.target[n] < 2 * g["size"][n] - 1e-6}
    assert len(level) <= 1 and (g.target <= 2 * g["size"] + 1e-6).all()
    assert ((g.taken - g.target).abs() <= g.longest).all()
    again = mix(docs_of(spark).repartition(5)).drop("h").toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    few = mix(nasty)
    assert few.count() == len(NASTY) and few.where("taken > 2 * size").count() == 0 and mix(empty).count() == 0
    taken = few.where("size > 0").select(F.sum(F.col("taken") / F.col("size"))).first()[0]
    mixed = mixed_documents(nasty)
    assert mixed.columns == nasty.columns and mixed.count() == taken
    counts = spark.createDataFrame([(t,) for _, t in NASTY], "text string").select(word_count(F.col("text"))).collect()
    assert [r[0] for r in counts] == [len(WORDS.findall(t or "")) for _, t in NASTY]


def test_language_id(spark, nasty, empty):
    from terrasift.llm.language_id import fit_languages, identify, suffix_automaton

    rng = random.Random(1)
    stretches = [[rng.randrange(2, 6) for _ in range(40)] for _ in range(4)]
    symbols = np.array([x for s in stretches for x in [*s, 0]])
    table = suffix_automaton(symbols, 8)[0]
    narrow, keys, targets = suffix_automaton(symbols, 4)
    listed = dict(zip(keys.tolist(), targets.tolist(), strict=True))
    for state, x in [(s, x) for s in range(len(table)) for x in range(2, 6)]:
        assert table[state][x] == (narrow[state][x] if x < 4 else listed.get((state << 21) + x, -1))
    parts = {tuple(s[i:j]) for s in stretches for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for _ in range(3000):
        probe = tuple(rng.randrange(2, 6) for _ in range(rng.randrange(1, 8)))
        state = 0
        for x in probe:
            state = table[state][x] if state >= 0 else -1
        assert (state >= 0) == (probe in parts)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(docs)
    rows = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert rows.where("lang = lang_pred").count() >= 0.97 * rows.count()
    got = {r["doc_id"]: r for r in identify(nasty, model).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["score"] == 0.0
    assert identify(empty, fit_languages(empty)).count() == 0
    assert {r["lang_pred"] for r in identify(nasty, fit_languages(empty)).collect()} == {"und"}


def test_language_id_of_large_scripts(spark):
    """Alphabets of thousands of letters, two vocabularies of one script, and a rare language among 300."""
    from terrasift.llm.language_id import fit_languages, identify

    rng = random.Random(5)
    scripts = {"ko": (0xAC00, 2000), "zh": (0x4E00, 3000), "zh2": (0x4E00, 3000), "ru": (0x430, 32), "el": (0x3B1, 25), "en": (0x61, 26)}
    words = {k: ["".join(chr(lo + rng.randrange(n)) for _ in range(rng.randint(1, 3) if n > 99 else rng.randint(3, 8))) for _ in range(900)] for k, (lo, n) in scripts.items()}
    rows = [(i, " ".join(rng.choices(words[k], k=60)), k) for i in range(600) for k in [list(scripts)[i % 6]]]
    rows += [(1000 + i, f"{chr(0x1200 + i)}{chr(0x1300 + i % 50)} " * 5, f"x{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).cache()
    model = fit_languages(docs)
    assert len(model.languages) >= 200
    got = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and doc_id < 1000").collect()
    for k in scripts:
        of = [r["lang_pred"] for r in got if r["lang"] == k]
        assert of.count(k) >= 0.95 * len(of) > 0, (k, of)
    taught = {r["doc_id"]: r for r in identify(docs, model).where("not held_out and doc_id >= 1000").collect()}
    assert sum(r["lang_pred"] == f"x{d - 1000}" for d, r in taught.items()) >= 0.95 * len(taught)


def test_quality_classifier(spark, nasty, empty):
    from terrasift.llm.quality_classifier import accepted_documents, fit_on_labels, score_documents

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_on_labels(docs, labels)
    rows = score_documents(docs, model).join(labels, "doc_id").where("held_out")
    assert rows.where("predicted = quality").count() >= 0.9 * rows.count()
    assert score_documents(docs, model).where("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0
    assert score_documents(nasty, model).where("score is null").count() == 0
    assert accepted_documents(docs, labels).columns == docs.columns
    unlabelled = fit_on_labels(empty, labels.limit(0))
    assert {r["score"] for r in score_documents(nasty, unlabelled).collect()} == {0.5}


def brute_scores(spark, texts, trusted):
    """Scores by plain counts of n-grams; only the hash of an n-gram is asked of the engine."""
    from terrasift.llm.quality_rules import BUCKETS, PRIOR

    def grams(t):
        w = WORDS.findall(t)
        long = [x[k : k + 8] for x in w if len(x) > 16 for k in range(0, len(x), 8)]
        return [(1, x, None) for x in w] + [(2, a, b) for a, b in zip(w, [*w[1:], None], strict=True)] + [(3, x, None) for x in long]

    of = {i: grams(t) for i, t in texts.items()}
    asked = spark.createDataFrame(sorted({g for x in of.values() for g in x}, key=repr), "kind int, a string, b string")
    hashed = asked.select("*", F.expr(f"pmod(case kind when 1 then hash(a) when 2 then hash(2, a, b) else hash(3, a) end, {BUCKETS})").alias("h"))
    bucket = {(r["kind"], r["a"], r["b"]): r["h"] for r in hashed.collect()}
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for i, x in of.items():
        at = np.bincount([bucket[g] for g in x], minlength=BUCKETS) if x else 0
        raw += at
        target += at if i in trusted else 0
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    ratio = np.log((target + PRIOR * p_raw) / (target.sum() + PRIOR) / p_raw)
    return {i: float(np.mean([ratio[bucket[g]] for g in x])) if x else 0.0 for i, x in of.items()}


def test_quality_score_sees_the_whole_text(spark):
    from terrasift.llm.quality_rules import judge_quality

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {i: t for i, t in texts_of(spark).items() if len(t.split()) > 100}
    trusted = {r["doc_id"] for r in labels.where("quality = 1 and coalesce(toxic, 0) = 0").collect()}
    i, text = next((i, t) for i, t in sorted(texts.items()) if i in trusted)
    rng = random.Random(1)
    inside = " ".join(w[:3] + "xqzjkvwqxz" + w[3:] if len(w) > 3 else w for w in text.split())
    mixed = text.split()
    rng.shuffle(mixed)
    others = [(1000 + i, inside), (2000 + i, " ".join(mixed)), (3000 + i, "xqzj" * 5000), (4000 + i, "vwqk" * 5000)]
    docs = spark.createDataFrame([*texts.items(), *others], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in judge_quality(docs, labels).collect()}
    assert len({round(got[k + i], 6) for k in (0, 1000, 2000)}) == 3 and got[1000 + i] < got[i] and got[2000 + i] < got[i]
    assert got[3000 + i] != 0.0 and got[4000 + i] != 0.0


def test_quality_rules(spark, nasty, empty):
    from terrasift.llm.quality_rules import judge_quality

    def counts(t):
        w = WORDS.findall(t)
        seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        inside = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = judge_quality(docs_of(spark), labels).collect()
    texts = texts_of(spark)
    for r in rows:
        n = counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and not (r["base_failed"] and r["kept"])
    trusted = {r["doc_id"] for r in labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 and t = 0").collect()}
    score, kept = brute_scores(spark, texts, trusted), {r["doc_id"]: r["kept"] for r in rows}
    assert all(abs(r["score"] - score[r["doc_id"]]) < 1e-9 for r in rows)
    assert all(kept[i] == (s >= -0.02) for i, s in score.items() if not next(r for r in rows if r["doc_id"] == i)["base_failed"])
    assert sorted(map(str, (tuple(r)[1:6] for r in judge_quality(nasty, labels.limit(0)).collect()))) == sorted(str(counts(t or "")) for _, t in NASTY)
    assert judge_quality(empty, labels).count() == 0


def test_embeddings_in_double_precision(spark):
    from terrasift.llm.embedding_dedup import embedding_components

    rows = [(1, [1e-50, 0.0]), (2, [1e-50, 0.0]), (3, [1e200, 1e200]), (4, [1e200, 1e200]), (5, [3e-200, 3e-200]), (6, [0.0, 0.0]), (7, [1.0, float("inf")]), (8, [1.0, 1.0 + 1e-12])]
    df = spark.createDataFrame([(i, "a", v) for i, v in rows], "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_components(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 3), 4: (3, 3), 5: (3, 3), 6: (0, 6), 7: (0, 7), 8: (3, 3)}


def test_embeddings(spark):
    from terrasift.llm import embedding_dedup

    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 20))
    rows, vectors = [], {}
    for i in range(150):
        v = (base[i % 6] + rng.normal(size=20) * (0.02 + 0.06 * (i % 5 == 0))).astype(np.float32)
        v = base[i % 6].astype(np.float32) if i % 7 == 0 else v
        rows.append((i, [float(x) for x in v], i % 2))
        vectors[i] = (i % 2, v.astype(float))
    bad = [(900, None, 1), (901, [0.0] * 20, 1), (902, [float("nan")] * 20, 1), (903, rows[0][1], None), (904, [], 1), (905, [None, 1.0], 1), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("cls", F.lit("x"))
    for block in (512, 8):
        embedding_dedup.BLOCK = block
        got = {r["vec_id"]: r for r in embedding_dedup.embedding_components(df).collect()}
        up = {i: i for i in vectors}

        def top(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        n = dict.fromkeys(vectors, 0)
        for a in vectors:
            for b in vectors:
                (la, x), (lb, y) = vectors[a], vectors[b]
                if a < b and la == lb and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    n[a], n[b] = n[a] + 1, n[b] + 1
                    lo, hi = sorted((top(a), top(b)))
                    up[hi] = lo
        found = sum(got[i]["n_links"] for i in vectors)
        assert found >= 0.97 * sum(n.values()) and all(got[i]["n_links"] <= n[i] for i in vectors)
        assert sum(got[i]["component_id"] == top(i) for i in vectors) >= 145
        assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))
    embedding_dedup.BLOCK = 512
    assert embedding_dedup.embedding_components(df.limit(0)).count() == 0


def test_bpe(spark, nasty, empty):
    from tokenizers import Tokenizer

    from terrasift.llm.bpe import TreeEncoder, default_vocabulary, encode_documents

    plain = Tokenizer.from_file(default_vocabulary())
    rng = random.Random(9)
    pieces = ["the ", "don't ", "  ", "\n\n", "aaaa", "é", "中", "🙂", "123", "<|endoftext|>", "'s", "!!", "abcd", "\t", " x"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 700))) for _ in range(60)]
    texts += ["".join(rng.choice("abcde") for _ in range(9000)), " " * 3000 + "x", "ab" * 5000, "'" * 2000 + "s", "<|endoftext|>" * 300]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    for fast in (True, False):
        encoder = TreeEncoder(default_vocabulary(), leaf=200)
        assert encoder.fast
        encoder.fast = encoder.fast if fast else None
        got = encoder.encode(texts)
        assert [g.tolist() for g in got] == want
        assert encoder.decode(got) == [plain.decode(w, skip_special_tokens=False) for w in want]
    rows = {r["doc_id"]: r for r in encode_documents(nasty, keep_ids=True).collect()}
    assert rows[1]["n_tokens"] == 0 and rows[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[9]["ids"] == plain.encode(NASTY[10][1], add_special_tokens=False).ids and rows[9]["decoded"] == NASTY[10][1]
    assert encode_documents(empty).count() == 0


def test_licenses(spark, nasty, empty):
    from terrasift.llm.license_scan import ENDS, HINT, RULES, SENTENCES, scan_licenses

    for r in scan_licenses(docs_of(spark)).collect():
        parts = [p for p in re.split(ENDS, texts_of.cache[r["doc_id"]]) if re.search("[A-Za-z0-9]", p)]
        ids = [SENTENCES[k] for p in parts if re.search(HINT, p) and (k := re.sub("[^a-z0-9]+", " ", p.lower()).strip()) in SENTENCES]
        names = list(dict.fromkeys(n for n, seq in RULES if "," + ",".join(seq) + "," in "," + ",".join(ids) + ","))
        assert (r["n_sentences"], r["sentence_ids"], r["license"], r["licenses"]) == (len(parts), ",".join(ids), names[0] if names else None, ",".join(names))
    assert scan_licenses(nasty).where("license is not null").count() == 0 and scan_licenses(empty).count() == 0


def test_wrapped_licenses(spark):
    from terrasift.llm.license_scan import scan_licenses

    apache = """# Copyright 2020 A. Body\n#\n# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n"""
    mit = """Copyright (c) 2020 A. Body\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above"""
    gpl = """ * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n"""
    bsd = """All rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n"""
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\r\nLicense, v. 2.0. If a copy"
    texts = [apache, mit, gpl, bsd, mpl, "You may not use this file except in compliance with the License.", "not released under the MIT license", "All rights reserved\nmore words"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["license"] for r in scan_licenses(rows).orderBy("doc_id").collect()]
    assert got == ["Apache-2.0", "MIT", "GPL-3.0", "BSD", "MPL-2.0", "Apache-2.0", None, "proprietary"]
    own = scan_licenses(rows, {"more words": "Own"}, (("own", ("Own",)),))
    assert [r["license"] for r in own.orderBy("doc_id").collect()] == [None] * 7 + ["own"]


@pytest.fixture(scope="module", autouse=True)
def _texts(spark):
    texts_of.cache = texts_of(spark)


def test_pii(spark, nasty, empty):
    from terrasift.llm.pii import find_pii, sanitised

    got = {r["doc_id"]: r for r in find_pii(nasty).collect()}
    assert got[10]["spans"] == "email:5:21,ip:25:32,card:34:53,phone:55:72" and got[10]["n_term"] == 0
    assert got[1]["spans"] == "" and got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = {r["doc_id"]: r for r in sanitised(nasty).collect()}
    assert clean[10]["text"] == "mail <EMAIL> or <IP>, <CARD>, <PHONE>" and clean[10]["n_chars"] == len(clean[10]["text"])
    assert clean[1]["text"] is None and clean[9]["text"] == NASTY[10][1] and sanitised(nasty).columns == nasty.columns
    assert find_pii(empty).count() == 0 and sanitised(empty).count() == 0
    odd = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4", "x" * 3000 + "@", "é é +1 234 567 890 é", "1-2 3 4-5 6 7 8 9 0 1 2 3", "+1+2 222 333 4444", " ".join(["12.5"] * 900) + " a@b.cd"]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in find_pii(rows).collect()}
    assert spans[0] == "email:0:5,email:5:11" and spans[1] == "ip:0:7,ip:8:15,ip:26:36" and spans[2] == "" and spans[6] == "email:4500:4506"
    assert spans[3] == "phone:4:18" and spans[5] == "phone:2:17"


def test_pii_of_long_and_crossing_spans(spark):
    """A text of a megabyte with 50,000 spans; spans, terms and cuts against plain code."""
    from terrasift.llm import pii

    rng = random.Random(4)
    long = " ".join(f"word{rng.choice('abc')} Zorblatt u{i}@mail{i % 977}.example.com é\U0001F600 1.2.3.{i % 300}" for i in range(25_000))
    crossing = "x 1.2.3.4.5@b.cd +1 234 567 890 4111 1111 1111 1111 Zorblatt " + "q" * 700 + " u1@mail1.example.com"
    rows = [(1, long), (2, crossing), (3, None), (4, ""), (5, "Zorblattu1@mail1.example.com Zorblatt")]
    rows += [(i, f"plain text number {i} of a clean kind") for i in range(10, 40)]
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, _blank long")
    found = {r["doc_id"]: r for r in pii.with_all_spans(docs).select("_row.doc_id", "base", "spans").collect()}
    clean = {r["doc_id"]: r for r in pii.sanitised(docs).collect()}
    terms = {r["term"] for r in pii.disclosing_terms(pii.with_base_spans(docs).select("text", "base")).collect()}
    for i, text in rows:
        base, spans = found[i]["base"], found[i]["spans"]
        assert [s for s in spans if s["kind"] != 4] == base and all(text[s["start"] : s["end"]] == s["value"] for s in spans)
        assert all(s["value"].lower() in terms for s in spans if s["kind"] == 4)
        want, at, k = "", 0, 0
        while k < len(spans):
            head, end = spans[k], spans[k]["end"]
            while k < len(spans) and spans[k]["start"] < end:
                end, k = max(end, spans[k]["end"]), k + 1
            want += text[at : head["start"]] + ["<EMAIL>", "<IP>", "<CARD>", "<PHONE>", ""][head["kind"]]
            at = end
        assert clean[i]["text"] == (None if text is None else want + text[at:]) and clean[i]["_blank"] == i
    assert len(found[1]["base"]) >= 25_000 and sanitised_columns(docs) == docs.columns


def sanitised_columns(docs):
    from terrasift.llm.pii import sanitised

    return sanitised(docs).columns


def test_disclosing_terms_at_every_size(spark, monkeypatch):
    """A planted name is found in tables of 300, 3,000 and 30,000 texts, a word of five texts in none; also when the terms are joined by shuffle."""
    from terrasift.llm import pii

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    for size in (300, 3000, 30_000):
        rows = ["the and Ostrander with single@mail.example.com and the Common"] + [f"{word()} and the Common {word()} with" for _ in range(4)]
        rows += [f"{word()} {word()} and the {word()} with" for _ in range(size)]
        docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
        for limit in (pii.BROADCAST_CHARS, 0):
            monkeypatch.setattr(pii, "BROADCAST_CHARS", limit)
            got = pii.find_pii(docs).where("n_term > 0").collect()
            assert [(r["doc_id"], r["n_term"]) for r in got] == [(0, 1)]
            assert f"term:{rows[0].index('Ostrander')}:" in got[0]["spans"]


def test_disclosing_terms(spark):
    from terrasift.llm.pii import find_pii, sanitised

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, f"{word()} {word()} the Quillfeather box@mail.example.com the {word()} {word()}. Later Quillfeather {word()}") for i in range(6)]
    rows += [(i, " ".join(["the", "Later", *(word() for _ in range(30))])) for i in range(6, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in find_pii(df).collect()}
    assert all(got[i]["n_term"] == 2 for i in range(6)) and all(got[i]["spans"] == "" for i in range(6, 200))
    assert all("Quill" not in r["text"] and "<EMAIL>" in r["text"] for r in sanitised(df).where("doc_id < 6").collect())


def test_disclosing_terms_of_signatures_copies_and_single_documents(spark):
    from terrasift.llm.pii import find_pii

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    common = ["and", "the", "with", "from"]
    prose = lambda: " ".join(x for _ in range(20) for x in (word(), rng.choice(common)))
    # The same signature below different texts; contexts copied many times; one document with its own name.
    rows = [f"{prose()}\n{'-' * 60}\nwith Quillfeather from signed@mail.example.com" for _ in range(5)]
    rows += 40 * [f"{prose()} the Marrowby with copied@mail.example.com and {prose()}" for _ in range(4)]
    rows += [f"{' '.join(common * 10)} the Ostrander from single@mail.example.com {' '.join(common * 10)}"]
    rows += [prose() for _ in range(9000)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    for r in find_pii(df).where("spans <> ''").collect():
        text = rows[r["doc_id"]]
        terms = [text[int(a) : int(b)] for kind, a, b in (x.split(":") for x in r["spans"].split(",")) if kind == "term"]
        name = next(x for x in ("Quillfeather", "Marrowby", "Ostrander") if x in text)
        assert name in terms and not set(terms) & set(common)


def test_url_filters(spark):
    from terrasift.llm.url_filters import judge_urls

    urls = [None, "", "no scheme", "http://", "http://A.NET", "http://a.NET/x", "http://Example.net/en/1?q#f", "http://notexample.com/de/", "https://m.example.com/de/x", "http://b.org/fr/?", "http://b.org/FR/", "x://org/fr/", "a://b://c.net/"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    got = [tuple(r) for r in judge_urls(rows).orderBy("page_id").collect()]
    rules = {"net/": ("net", "/", "block"), "example.net/en/": ("example.net", "/en/", "allow"), "example.com/de/": ("example.com", "/de/", "block"), "org/fr/": ("org", "/fr/", "allow")}
    want = []
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [n for n, (h, p, _) in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=len) if fits else None
        want.append((i, host, path, best, rules[best][2] if best else "allow"))
    assert got == want and judge_urls(rows.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = docs_of(spark)
    kept = cp.saved(cp.quality_classifier(spark, docs, SF))
    one = cp.saved(cp.ngram_jaccard_join(spark, kept, SF))
    texts = {r["doc_id"]: r["text"] or "" for r in kept.collect()}
    brute = brute_components(texts, 5, 80)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c for _, c in brute.values()})
    clean = cp.saved(cp.pii(spark, one, SF))
    assert clean.count() == one.count()
    mixed = cp.saved(cp.mix_sources(spark, clean, SF))
    assert mixed.columns == docs.columns and [n for n, _ in cp.STAGES] == ["quality_classifier", "ngram_jaccard_join", "pii", "mix_sources", "bpe"]
    tokens = cp.bpe(spark, mixed, SF)
    assert tokens.count() == mixed.count()
    twice = one.unionByName(one)
    assert cp.ngram_jaccard_join(spark, twice, SF).count() == one.count()


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as cp

    a, b = "one two three four five six seven eight nine ten " * 3, "red green blue black white pink grey brown gold teal " * 3
    rows = [(1, a), (1, b), (1, a), (2, a + "ten"), (None, b), (None, None), (None, "alone among the others it is here"), (3, ""), (3, None), (4, " \n")]
    names = ("_id", "_copies", "_predicted", "_h", "_rows", "_key", "_ALL")
    docs = spark.createDataFrame(
        [(i, t, "en", "s" if k % 2 else None, k, *(f"{n}{k}" for n in names)) for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names),
    ).repartition(3)
    own = {f"{k}": r for k, r in enumerate(rows)}

    def intact(df):
        found = df.collect()
        assert df.columns == docs.columns
        assert all(r[n] == f"{n}{r['_id'][3:]}" for r in found for n in names)
        return sorted(r["_id"][3:] for r in found)

    left = intact(cp.ngram_jaccard_join(spark, docs, SF))
    # One of the three rows near a, one of b; all rows without near ones.
    assert len(set(left) & {"0", "2", "3"}) == 1 and not set(left) & {"3"} and set(left) & {"1", "4"} == {"1"} and set(left) >= set("56789")
    mixed = intact(cp.mix_sources(spark, docs, SF))
    assert set(mixed) and all((own[k][1] or "").split() for k in mixed)
    assert set(intact(cp.quality_classifier(spark, docs, SF))) <= set(own)
    for stage in ("quality_classifier", "ngram_jaccard_join", "pii", "mix_sources"):
        assert getattr(cp, stage)(spark, docs.limit(0), SF).count() == 0
    assert cp.bpe(spark, docs, SF).count() == len(rows)
