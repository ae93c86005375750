"""Personal data: fixed patterns, and terms that give protected entities away.

The patterns find e-mail and IP addresses, card and phone numbers. The values
found are the protected entities. A term is a run of three or more letters
within ``REACH`` code points of an entity. Over the whole corpus,

    PMI(term; entity) = log(n_both * N / (n_term * n_entity)),
    IC(entity)        = log(N / n_entity),

where all four count distinct texts, so a group of copies is one of them: those
with the term near the entity, with the term, with the entity, and all. The share
n_both / n_term is taken at its lower bound of 95 % confidence (Wilson), which asks
for more evidence the fewer texts there are but sets no least number. A term
discloses an entity if, with the share so bounded, it leaves at most ``BITS_LEFT``
of the entity's information content (IC - PMI, which is the share alone) and gives
at least ``BITS_GIVEN`` of it (PMI), so entities in too large a part of the texts
have none. Both depend on shares of the texts, not on how many there are. Such a
term is removed wherever it stands in a document that holds the entity.

Work is linear in a text and in its spans, but for a logarithm: parts of a text
are read from blocks of it, and places are found by halving sorted arrays.
Only DataFrame functions are used. Whole texts are not shuffled while the
documents with disclosing terms are few enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import BROADCAST_ROWS, fresh, narrow_join, saved

# Fixed values of the contract: kinds in order, with their patterns. Repetitions
# that cannot give back are possessive, and searches do not start inside a run
# that has failed as a whole, so long runs take linear time.
_LOCAL, _DOMAIN = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SIGN = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TERM = "term"
KINDS = (*PATTERNS, TERM)

REACH = 60
BITS_LEFT = 2
BITS_GIVEN = 4
# Of the normal distribution, for a one-sided bound of 95 %.
CONFIDENCE = 1.645
_BLOCK = 64
_PIECE = 256
# Terms of texts are broadcast up to so many characters, and joined with so many salts beyond.
BROADCAST_CHARS = 16 << 20
_SALTS = 16

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _running(values: Column, combine=lambda a, b: a + b) -> Column:
    """Exclusive running totals of an array of bigint, block by block so that long arrays stay cheap."""

    def grow(items: Column, step=lambda x: x) -> Column:
        return F.aggregate(items, F.array(F.lit(0).cast("bigint")), lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), step(x)))))

    starts = F.sequence(F.lit(1), F.size(values), F.lit(_BLOCK))
    inner = F.transform(starts, lambda s: grow(F.slice(values, s, F.lit(_BLOCK))))
    outer = grow(inner, lambda r: F.element_at(r, -1))
    zipped = F.zip_with(inner, F.slice(outer, F.lit(1), F.size(outer) - 1), lambda r, o: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda v: combine(v, o)))
    return F.when(F.size(values) > 0, F.flatten(zipped)).otherwise(F.array().cast("array<bigint>"))


def _reach(spans: str) -> Column:
    """For each of the sorted spans the greatest end of those before it."""
    return _running(F.transform(spans, lambda s: s["end"]), F.greatest)


def _leading(items: str, holds) -> Column:
    """How many items of a sorted array come before the first for which ``holds`` fails."""
    n = F.size(items)

    def halve(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        below = holds(F.get(items, mid))
        return F.struct(F.when(below, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(below, acc["hi"]).otherwise(mid).alias("hi"))

    ends = F.struct(F.lit(0).alias("lo"), n.alias("hi"))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), F.length(F.bin(n))), ends, halve)["lo"]).otherwise(0)


def _pieces(text: str, used: Column) -> Column:
    """The text in pieces of ``_PIECE`` code points, where used."""
    return F.when(used, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _part(pieces: str, lo: Column, hi: Column) -> Column:
    """The code points from ``lo`` to before ``hi`` of a text in pieces."""
    first, last = F.floor(lo / _PIECE).cast("int"), F.floor((hi - 1) / _PIECE).cast("int")
    joined = F.array_join(F.slice(pieces, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.substr(joined, (lo - first * _PIECE + 1).cast("int"), (hi - lo).cast("int"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(plain, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p).otherwise("999").cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(value))
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _located(df: DataFrame, name: str, pattern: str, applies: Column, kind: int) -> DataFrame:
    """Add spans of all matches of a pattern in ``text`` as an array column."""
    empty = F.array().cast("array<string>")
    df = df.withColumns({
        "_hit": F.when(applies, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(empty),
    })
    gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g).cast("bigint"))
    df = df.withColumn("_gap", F.when(F.size("_hit") > 0, gaps).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_len", F.zip_with("_hit", F.slice("_gap", F.lit(1), F.size("_hit")), lambda h, g: F.length(h) + g))
    df = df.withColumn("_from", _running(F.col("_len")))
    spans = F.transform(
        F.arrays_zip("_hit", "_gap", "_from"),
        lambda x: F.struct(
            (x["_from"] + x["_gap"]).alias("start"), F.lit(kind).alias("kind"),
            (x["_from"] + x["_gap"] + F.length(x["_hit"])).alias("end"), x["_hit"].alias("value"),
        ),
    )
    found = F.when(F.size("_hit") > 0, F.filter(spans, lambda s: s["value"].isNotNull())).otherwise(F.array().cast(_SPAN))
    return df.withColumn(name, found).drop("_hit", "_gap", "_len", "_from")


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Add ``base``: spans (start, kind, end, value) that pass their checks, by start, then kind."""
    df = docs.withColumn("text", F.coalesce("text", F.lit("")))
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        df = _located(df, f"_{kind}", pattern, F.col("text").rlike(_SIGN[kind]), k)
    def kept_of(kind: str) -> Column:
        return F.filter(f"_{kind}", lambda s: _valid(kind, s["value"]))

    kept = [kept_of(kind) for kind in PATTERNS]
    return df.withColumn("base", F.sort_array(F.concat(*kept))).drop(*[f"_{kind}" for kind in PATTERNS])


def _entity(span: Column) -> Column:
    return F.xxhash64(span["kind"], span["value"])


_LETTERS = r"\p{L}{3,}"


def _share(k: str, n: str) -> Column:
    """Lower confidence bound of the share k / n."""
    n, z2 = F.greatest(F.col(n), F.col(k)).cast("double"), CONFIDENCE**2
    p = F.col(k) / n
    return (p + z2 / (2 * n) - CONFIDENCE * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def disclosing_terms(spans: DataFrame) -> DataFrame:
    """(doc, term) where the text hashed to ``doc`` has a term that discloses an entity it holds, over all rows (text, base)."""
    held = spans.select(F.xxhash64("text").alias("doc"), "base", _pieces("text", F.size("base") > 0).alias("pieces"))

    def context(s: Column) -> Column:
        before = _part("pieces", F.greatest(F.lit(0), s["start"] - REACH), s["start"])
        before = F.when(s["start"] > REACH, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
        after = _part("pieces", s["end"], s["end"] + REACH)
        after = F.when(F.length(after) == REACH, F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after)
        return F.struct(_entity(s).alias("entity"), F.lower(F.concat(before, F.lit(" "), after)).alias("words"))

    contexts = saved(held.select("doc", F.explode(F.transform("base", context)).alias("c")).select("c.entity", "c.words", "doc"))
    holders = contexts.select("doc", "entity").distinct()
    entities = holders.groupBy("entity").agg(F.count("*").alias("n_entity"))
    terms = F.explode(F.array_distinct(F.regexp_extract_all("words", F.lit(_LETTERS), F.lit(0)))).alias("term")
    seen = contexts.select("entity", "doc", terms)
    pairs = saved(seen.distinct().groupBy("entity", "term").agg(F.count("*").alias("n_both")))
    if pairs.isEmpty():
        return pairs.select(F.lit(0).cast("bigint").alias("doc"), "term")
    total = float(spans.select(F.xxhash64("text").alias("doc")).distinct().count())

    def telling(n_both: str, n_term: str) -> Column:
        return _share(n_both, n_term) >= 2.0**-BITS_LEFT

    def reveals(n_term: str) -> Column:
        gives = _share("n_both", n_term) * total / F.col("n_entity") >= 2.0**BITS_GIVEN
        return telling("n_both", n_term) & gives

    # A term is in at least as many texts as there are with it near an entity;
    # the terms and pairs that fail even by that number, such as common words, go first.
    least = seen.select("term", "doc").distinct().groupBy("term").agg(F.count("*").alias("n_least"))
    most = pairs.groupBy("term").agg(F.max("n_both").alias("n_most"))
    least = saved(least.join(most, "term").where(telling("n_most", "n_least")).drop("n_most"))
    pairs = saved(narrow_join(narrow_join(pairs, least, ["term"]), saved(entities), ["entity"]).where(reveals("n_least")).drop("n_least"))
    if pairs.isEmpty():
        return pairs.select(F.lit(0).cast("bigint").alias("doc"), "term")
    # Which texts of the corpus have each of these terms, and how many they are.
    words = spans.select(F.xxhash64("text").alias("doc"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_LETTERS), F.lit(0)))).alias("term"))
    known = saved(pairs.select("term").distinct())
    places = saved(narrow_join(words, known, ["term"], "left_semi").distinct())
    counts = places.groupBy("term").agg(F.count("*").alias("n_term"))
    disclosed = pairs.join(counts, "term").where(reveals("n_term")).select("entity", "term")
    # Nearly all texts with such a term hold the entity, so this join does not multiply.
    return places.join(disclosed, "term").join(holders, ["doc", "entity"], "left_semi").select("doc", "term").distinct()


def _with_terms(found: DataFrame, disclosed: DataFrame) -> DataFrame:
    """Add ``_terms``, the sorted disclosing terms of each text; where they are too many to
    broadcast, copies of a text are spread over salts."""
    terms = saved(disclosed.groupBy(F.col("doc").alias("_key")).agg(F.sort_array(F.collect_set("term")).alias("_terms")))
    found = found.withColumn("_key", F.xxhash64("text"))
    held = terms.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.sum(F.length(F.array_join("_terms", " "))))
    rows, chars = held.first()
    if rows <= BROADCAST_ROWS and (chars or 0) <= BROADCAST_CHARS:
        return found.join(F.broadcast(terms), "_key", "left").drop("_key")
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    salted = found.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(_SALTS)).cast("int"))
    return salted.join(terms.select("_key", "_terms", salts), ["_key", "_salt"], "left").drop("_key", "_salt")


def with_all_spans(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as ``text`` (empty for null), ``_row`` (its other columns, and whether the
    text is null in the first field), ``base`` and ``spans`` (base ones and disclosing terms, by start, then kind).

    A null text counts as empty and has no spans. Repeated rows and rows without
    a doc_id are treated alike; an empty table stays empty.
    """
    others = [docs[c] for c in docs.columns if c != "text"]
    row = F.struct(docs["text"].isNull().alias(fresh(docs, "_blank")), *others)
    found = with_base_spans(docs.select(row.alias("_row"), docs["text"].alias("text")))
    disclosed = saved(disclosing_terms(found.select("text", "base")))
    if disclosed.isEmpty():
        return found.withColumn("spans", F.col("base"))
    found = _with_terms(found.withColumn("_reach", _reach("base")), disclosed)
    found = _located(found, "_words", r"\p{L}+", F.col("_terms").isNotNull(), KINDS.index(TERM))

    def free(w: Column) -> Column:
        """Whether no base span overlaps: of those that start before its end, none ends behind its start."""
        n = _leading("base", lambda s: s["start"] < w["end"])
        furthest = F.greatest(F.get("_reach", n - 1), F.get("base", n - 1)["end"])
        return (n == 0) | (furthest <= w["start"])

    def disclosing(w: Column) -> Column:
        term = F.lower(w["value"])
        return F.coalesce(F.get("_terms", _leading("_terms", lambda t: t < term)) == term, F.lit(False))

    revealing = F.filter("_words", lambda w: F.when(disclosing(w), free(w)).otherwise(False))
    spans = F.when(F.col("_terms").isNotNull(), F.sort_array(F.concat("base", revealing))).otherwise(F.col("base"))
    return found.withColumn("spans", spans).drop("_terms", "_words", "_reach")


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_term. Places are code points, the end exclusive."""
    found = with_all_spans(docs.select("doc_id", "text"))

    def count_of(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [count_of(k).alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)]
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_term"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with personal data generalised to its kind and disclosing terms removed.

    Overlapping spans are replaced as one, under the kind that starts first.
    ``n_chars``, where present, follows the text. Null texts stay null.
    """
    found = with_all_spans(docs)
    span = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))

    # A span that starts behind all ends before it begins a cut, which reaches to the greatest end before the next.
    found = found.withColumn("_reach", _reach("spans"))
    found = found.withColumn("_heads", F.filter(F.arrays_zip("spans", "_reach"), lambda s: s["spans"]["start"] >= s["_reach"]))
    ends = F.concat(F.transform(F.slice("_heads", 2, F.greatest(F.size("_heads") - 1, F.lit(0))), lambda s: s["_reach"]), F.array(F.array_max(F.transform("spans", lambda s: s["end"]))))
    cut = lambda h, end: F.struct(h["spans"]["start"].alias("start"), h["spans"]["kind"].alias("kind"), end.alias("end"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    found = found.withColumn("_cut", F.when(F.size("spans") > 0, F.zip_with("_heads", ends, cut)).otherwise(empty))
    found = found.withColumn("_pieces", _pieces("text", F.size("spans") > 0))
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in PATTERNS], F.lit(""))
    first = F.array(F.lit(0).cast("bigint"))
    starts_at = F.concat(first, F.transform("_cut", lambda s: s["end"]))
    piece = F.zip_with(
        "_cut", F.slice(starts_at, F.lit(1), F.size("_cut")),
        lambda s, at: F.concat(_part("_pieces", at, s["start"]), F.element_at(tags, s["kind"] + 1)),
    )
    tail = _part("_pieces", F.element_at(starts_at, -1), F.length("text").cast("bigint"))
    blank = F.col("_row").getField(fresh(docs, "_blank"))
    text = F.when(F.size("_cut") > 0, F.concat(F.array_join(piece, ""), tail)).when(~blank, F.col("text"))
    found = found.withColumn("_new", text)
    return found.select(
        *[
            F.col("_new").alias(c) if c == "text"
            else F.when(F.size("_cut") > 0, F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col(f"_row.{c}")).alias(c) if c == "n_chars"
            else F.col(f"_row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
