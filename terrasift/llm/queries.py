"""The registered queries of this subpackage and the SQL that some can be compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrasift.llm.common import Function, table

QUERIES: dict[str, Function] = {}
ORACLES: dict[str, str] = {}


def query(fn: Function) -> Function:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 85 % of their four-word shingles."""
    from terrasift.llm.ngram_join import ngram_components

    return ngram_components(table(spark, folder, "documents"), size=4, percent=85)


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document in a mix of all sources by weight."""
    from terrasift.llm.mixing import mix

    return mix(table(spark, folder, "documents")).drop("h")


@query
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text, and the text decoded from them, as digests."""
    from terrasift.llm.bpe import encode_documents

    return encode_documents(table(spark, folder, "documents"))


@query
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of the fixed rules on every page."""
    from terrasift.llm.url_filters import judge_urls

    return judge_urls(table(spark, folder, "pages"))


ORACLES["op9_url_filters"] = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path
    FROM cut
), judged AS (
    SELECT *, CASE
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM split
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text, by pattern and by disclosure."""
    from terrasift.llm.pii import find_pii

    return find_pii(table(spark, folder, "documents"))


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base rules and likelihood ratio of every text."""
    from terrasift.llm.quality_rules import judge_quality

    return judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every text."""
    from terrasift.llm.quality_classifier import fit_on_labels, score_documents

    docs = table(spark, folder, "documents")
    return score_documents(docs, fit_on_labels(docs, table(spark, folder, "labels")))


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every text."""
    from terrasift.llm.language_id import fit_languages, identify

    docs = table(spark, folder, "documents")
    return identify(docs, fit_languages(docs))


@query
def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of embeddings of one label by cosine."""
    from terrasift.llm.embedding_dedup import embedding_components

    return embedding_components(table(spark, folder, "embeddings"))


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence sentences and licences of every text."""
    from terrasift.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, folder, "documents"))


# CRC-32 of a list of bytes, each byte worked off by eight shifts.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_ASCII = "list_transform(range(length({text})), lambda i: unicode(substr({text}, i + 1, 1))::BIGINT)"


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words, and every text without their repetitions."""
    from terrasift.llm.periodic_runs import find_runs, run_digests, with_planted_runs

    return run_digests(find_runs(with_planted_runs(table(spark, folder, "documents"))))


ORACLES["op12_periodic_runs"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
           CRC AS h
    FROM documents
), e AS (
    SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM d
), turned AS (
    SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END)::BIGINT]) ELSE w END AS w
    FROM e
), grams AS (
    SELECT rid, i, array_to_string(w[i + 1:i + 6], ' ') AS g FROM (SELECT rid, w, unnest(range(n - 5)) AS i FROM turned WHERE n >= 12)
), repeated AS (
    SELECT rid, i, g FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), apart AS (
    SELECT x.rid, y.i - x.i AS q, x.i FROM repeated x JOIN repeated y ON x.rid = y.rid AND x.g = y.g AND x.i < y.i
), islands AS (
    SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM apart
), found AS (
    SELECT rid, min(i) AS s, count(*) + 5 + q AS n, q FROM islands GROUP BY rid, q, island HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12
), runs AS (
    SELECT rid, s, n, min(q) AS q FROM found GROUP BY rid, s, n
), listed AS (
    SELECT rid, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
           min({'n': -n, 's': s, 'q': q}) AS best
    FROM runs GROUP BY rid
), dropped AS (
    SELECT DISTINCT rid, unnest(range(s + q, s + n)) AS i FROM runs
), gone AS (
    SELECT rid, list(i) AS places FROM dropped GROUP BY rid
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS "start", -best.n AS length, best.q AS period,
       (-best.n * 1000) // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i - 1)) END, ' '), '')) AS collapsed_sha256
FROM turned t LEFT JOIN listed USING (rid) LEFT JOIN gone USING (rid)
""".replace("CRC", _CRC32.format(bytes=_ASCII.format(text="doc_id::VARCHAR")))


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words one edit from a far more frequent word."""
    from terrasift.llm.spelling_variants import variants_of_documents

    return variants_of_documents(table(spark, folder, "documents"))


# Letters up to U+00FF in UTF-8, as bytes.
_LATIN = """flatten(list_transform(range(length({text})), lambda i: CASE WHEN unicode(substr({text}, i + 1, 1)) < 128
    THEN [unicode(substr({text}, i + 1, 1))::BIGINT]
    ELSE [(192 | (unicode(substr({text}, i + 1, 1)) >> 6))::BIGINT, (128 | (unicode(substr({text}, i + 1, 1)) & 63))::BIGINT] END))"""

ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), keyed AS (
    SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs WHERE length(run) >= 7
), hashed AS (
    SELECT run, CRC AS h FROM keyed
), slipped AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
    SELECT word, count(*) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), less AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM less x JOIN less y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
    UNION SELECT x.word, x.n, y.word, y.n FROM less x JOIN words y ON x.rest = y.word
    UNION SELECT y.word, y.n, x.word, x.n FROM less x JOIN words y ON x.rest = y.word
), best AS (
    SELECT word, n, count(*) AS n_near, min({'n': -other_n, 'w': other}) AS b FROM near GROUP BY word, n
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 10 * w.n THEN b.w END AS form, CASE WHEN -b.n >= 10 * w.n THEN -b.n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), walk AS (
    SELECT word, word AS root, 0 AS steps FROM forms
    UNION ALL SELECT w.word, f.form, w.steps + 1 FROM walk w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL
), ends AS (
    SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
""".replace("CRC", _CRC32.format(bytes=_LATIN.format(text="key")))


@query
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every text without the words of 35-word passages that occur elsewhere too."""
    from terrasift.llm.substring_dedup import repeat_digests

    return repeat_digests(table(spark, folder, "documents"))


ORACLES["op13_substring_dedup"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
    SELECT rid, i, md5(array_to_string(w[i + 1:i + 35], ' ')) AS g FROM (SELECT rid, w, unnest(range(len(w) - 34)) AS i FROM d WHERE len(w) >= 35)
), repeated AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1
), covered AS (
    SELECT rid, list(DISTINCT i) AS places FROM (SELECT rid, unnest(range(i, i + 35)) AS i FROM repeated) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i - 1)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN covered USING (rid)
"""
