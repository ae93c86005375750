"""Comparison of two datasets.

Matches are many-to-many, and a popular name may hold a large share of both
sides. No operator here lists the matched pairs: both sides are counted per
key value first, and the number of pairs follows as the product of the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions.numeric import round_half_even
from terrasift.functions.places import Box, distance_km, inside_box, missing_coordinates
from terrasift.functions.text import has_pattern, prefix_equals
from terrasift.operators.joins import lookup_join
from terrasift.operators.profiling import group_sizes, side_flags
from terrasift.operators.quantiles import exact_medians
from terrasift.session import staged


def _percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, round_half_even(F.lit(100.0) * part / whole, digits))


def _union(branches: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), branches)


# --- X1-X4 -------------------------------------------------------------------


def overview(df: DataFrame, name: str) -> DataFrame:
    """Count, mean, deviation, range and number of values of every column, as text."""
    rows = F.count(F.lit(1))

    def column(f) -> Column:
        c = F.col(f"`{f.name}`")
        numeric = f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")
        value = c.cast("double") if numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("table"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            rows.alias("n_rows"),
            F.count(c).alias("n_values"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    return df.agg(F.array(*[column(f) for f in df.schema.fields]).alias("r")).select(F.inline("r"))


def value_mapping(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Attribute values per key; NULL keys are dropped, NULL values not counted.

    Returns (key, n_values, first_value, last_value) instead of a list, which
    one key could make unbounded; ``mapping_values`` has the values as rows.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(
            F.countDistinct(F.col(attribute)).alias("n_values"),
            F.min(F.col(attribute)).alias("first_value"),
            F.max(F.col(attribute)).alias("last_value"),
        )
    )


def mapping_summary(df: DataFrame, code: str, name: str) -> DataFrame:
    """Codes, names and codes with several names, in one row."""
    return value_mapping(df, code, name).agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n_values") > 1).alias("n_ambiguous")
    )


def mapping_values(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Every value of the ambiguous keys as a row (key, value, n_rows)."""
    pairs = (
        df.where(F.col(key).isNotNull() & F.col(attribute).isNotNull())
        .groupBy(F.col(key).alias("key"), F.col(attribute).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    # One row per pair is left, so the second grouping is small; min <> max marks an ambiguous key.
    ambiguous = (
        pairs.groupBy("key").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where("lo <> hi").select("key")
    )
    return lookup_join(pairs, ambiguous, "key", "left_semi")


def first_value(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Value of the first row of each key in the given order."""
    return (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min_by(value, order).alias("value"))
    )


def level_completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing count and percent per column."""
    rows = F.count(F.lit(1))
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count_if(F.col(c).isNull()).alias("missing"),
                    _percent(F.count_if(F.col(c).isNull()), rows).alias("missing_percent"),
                )
                for c in cols
            ]
        ).alias("r")
    ).select(F.inline("r"))


def overlap(a: DataFrame, b: DataFrame, key: str, key_b: str | None = None) -> DataFrame:
    """Distinct keys of both sides, shared and exclusive, from one shuffle."""
    flags = side_flags(a, [key], b, [key_b or key])
    in_a, in_b = F.col("in_a"), F.col("in_b")
    counts = flags.agg(
        F.count_if(in_a).alias("n_a"),
        F.count_if(in_b).alias("n_b"),
        F.count_if(in_a & in_b).alias("n_common"),
        F.count_if(in_a & ~in_b).alias("n_only_a"),
        F.count_if(in_b & ~in_a).alias("n_only_b"),
    )
    return counts.select(
        "*",
        _percent(F.col("n_common"), F.col("n_a")).alias("pct_a_in_b"),
        _percent(F.col("n_common"), F.col("n_b")).alias("pct_b_in_a"),
    )


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on both sides."""
    return side_flags(a, [key], b, [key]).where("in_a and in_b").select(F.col("k0").alias(key))


def only_in_first(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on the first side only."""
    return side_flags(a, [key], b, [key]).where("in_a and not in_b").select(F.col("k0").alias(key))


# --- matched pairs by counting -----------------------------------------------


def _side_counts(df: DataFrame, records: Sequence[Column], left: bool) -> DataFrame:
    rows = df.select(F.explode(F.array_compact(F.array(*records))).alias("r")).select("r.*")
    return rows.withColumn("a", F.lit(int(left))).withColumn("b", F.lit(int(not left)))


def _key_record(part: int, keys: Sequence[Column], value: Column | None, null_safe: bool) -> Column:
    """One counting record: which question, the key as text, and the value compared."""
    key = F.to_json(F.array(*[k.cast("string") for k in keys]))
    value = F.lit(None).cast("string") if value is None else value.cast("string")
    record = F.struct(F.lit(part).alias("part"), key.alias("key"), value.alias("value"))
    needed = [] if null_safe else [k.isNotNull() for k in keys]
    return F.when(reduce(lambda x, y: x & y, needed), record) if needed else record


def _pairs(a: DataFrame, b: DataFrame, ra: Sequence[Column], rb: Sequence[Column]) -> DataFrame:
    """(part, key, value, n_a, n_b): rows of both sides per record, pre-aggregated, one shuffle."""
    both = _side_counts(a, ra, True).unionByName(_side_counts(b, rb, False))
    return both.groupBy("part", "key", "value").agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))


def agreement(
    a: DataFrame,
    b: DataFrame,
    key: str,
    pairs: Sequence[tuple[str, str]],
    null_safe_keys: bool = False,
) -> DataFrame:
    """Over all matched pairs, how often two attributes agree ignoring case.

    A pair with a NULL on either side counts as a disagreement (N11).
    """

    def records(cols: Sequence[str]) -> list[Column]:
        out = [_key_record(0, [F.col(key)], None, null_safe_keys)]
        for i, c in enumerate(cols, start=1):
            record = _key_record(i, [F.col(key)], F.upper(F.col(c)), null_safe_keys)
            out.append(F.when(F.col(c).isNotNull(), record))
        return out

    counts = _pairs(a, b, records([p[0] for p in pairs]), records([p[1] for p in pairs]))
    hits = counts.groupBy("part").agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("hits"))
    total = F.coalesce(F.max(F.when(F.col("part") == 0, F.col("hits"))), F.lit(0))
    wide = hits.agg(
        total.alias("matched"),
        *[
            F.coalesce(F.max(F.when(F.col("part") == i, F.col("hits"))), F.lit(0)).alias(f"h{i}")
            for i in range(1, len(pairs) + 1)
        ],
    )
    rows = [
        F.struct(
            F.lit(p[0]).alias("attribute"),
            F.col("matched"),
            F.col(f"h{i}").alias("agree"),
            _percent(F.col(f"h{i}"), F.col("matched")).alias("agree_percent"),
            (F.col("matched") - F.col(f"h{i}")).alias("disagree"),
        )
        for i, p in enumerate(pairs, start=1)
    ]
    return wide.select(F.inline(F.array(*rows)))


def disagreeing_keys(a: DataFrame, b: DataFrame, key: str, ca: str, cb: str) -> DataFrame:
    """Keys with matched pairs whose attribute disagrees, with the number of such pairs."""

    def records(c: str) -> list[Column]:
        value = F.upper(F.col(c))
        return [
            _key_record(0, [F.col(key)], None, False),
            F.when(F.col(c).isNotNull(), _key_record(1, [F.col(key)], value, False)),
        ]

    counts = _pairs(a, b, records(ca), records(cb))
    product = F.col("n_a") * F.col("n_b")
    per_key = counts.groupBy("key").agg(
        F.coalesce(F.sum(F.when(F.col("part") == 0, product)), F.lit(0)).alias("pairs"),
        F.coalesce(F.sum(F.when(F.col("part") == 1, product)), F.lit(0)).alias("agree"),
    )
    name = F.get(F.from_json("key", "array<string>"), F.lit(0))
    return per_key.where(F.col("pairs") > F.col("agree")).select(
        name.alias("key"), "pairs", (F.col("pairs") - F.col("agree")).alias("disagree")
    )


def strategies(
    a: DataFrame,
    b: DataFrame,
    key_sets: Mapping[str, Sequence[str]],
    null_safe_keys: bool = False,
) -> DataFrame:
    """Matched pairs and match rates for several key sets, from one shuffle."""
    names = list(key_sets)

    def records() -> list[Column]:
        rows = _key_record(-1, [], None, True)
        return [rows] + [
            _key_record(i, [F.col(k) for k in key_sets[n]], None, null_safe_keys) for i, n in enumerate(names)
        ]

    counts = _pairs(a, b, records(), records())
    per_part = counts.groupBy("part").agg(
        F.sum(F.col("n_a") * F.col("n_b")).alias("matched"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b")
    )
    wide = per_part.agg(
        F.max(F.when(F.col("part") == -1, F.col("n_a"))).alias("n_a"),
        F.max(F.when(F.col("part") == -1, F.col("n_b"))).alias("n_b"),
        *[
            F.coalesce(F.max(F.when(F.col("part") == i, F.col("matched"))), F.lit(0)).alias(f"m{i}")
            for i in range(len(names))
        ],
    )
    rows = [
        F.struct(
            F.lit(n).alias("strategy"),
            F.col(f"m{i}").alias("matched"),
            _percent(F.col(f"m{i}"), F.col("n_a")).alias("rate_a"),
            _percent(F.col(f"m{i}"), F.col("n_b")).alias("rate_b"),
        )
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def match_risk(a: DataFrame, b: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Names with several matched pairs under the given keys, and their number."""
    position = list(keys).index(by)
    record = [_key_record(0, [F.col(k) for k in keys], None, False)]
    counts = _pairs(a, b, record, record)
    name = F.get(F.from_json("key", "array<string>"), F.lit(position))
    return (
        counts.where((F.col("n_a") > 0) & (F.col("n_b") > 0))
        .groupBy(name.alias("key"))
        .agg(F.sum(F.col("n_a") * F.col("n_b")).alias("matches"))
        .where(F.col("matches") > 1)
    )


def unmatched_sides(
    a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe_keys: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows of each side whose keys do not occur on the other.

    With ``null_safe_keys`` a NULL key part matches another NULL (N12);
    without, a row with a NULL key is unmatched. The keys of both sides go
    through one grouping that flags the side; it is written once, and each side
    is joined with the keys that only it has.
    """

    def keyed(df: DataFrame, side: int) -> DataFrame:
        parts = [F.col(k).cast("string") for k in keys]
        # Keys are compared as one text that keeps NULL apart from any value.
        key = F.to_json(F.array(*parts))
        if not null_safe_keys:
            # No array is written like this, so keys with a NULL stay on their side.
            key = F.when(reduce(lambda x, y: x & y, [p.isNotNull() for p in parts]), key).otherwise(F.lit(f"side {side}"))
        return df.withColumn("_key", key)

    sides = [keyed(a, 0), keyed(b, 1)]
    tagged = [df.select("_key", F.lit(i).alias("side")) for i, df in enumerate(sides)]
    flags = tagged[0].unionByName(tagged[1]).groupBy("_key").agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    alone = staged(flags.where(F.col("lo") == F.col("hi")).select("_key", "lo"))
    found = [
        lookup_join(df, alone.where(F.col("lo") == i).select("_key"), "_key", "left_semi").drop("_key")
        for i, df in enumerate(sides)
    ]
    return found[0], found[1]


def unmatched(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe_keys: bool = True) -> DataFrame:
    """Rows of ``a`` whose keys do not occur in ``b``; see ``unmatched_sides``."""
    return unmatched_sides(a, b, keys, null_safe_keys)[0]


# --- X6-X8 -------------------------------------------------------------------


def casing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Whether every non-NULL value of a column is lower case, and its number of variants."""
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.coalesce(F.bool_and(F.col(c) == F.lower(F.col(c))), F.lit(True)).alias("all_lower"),
                )
                for c in cols
            ]
        ).alias("r")
    ).select(F.inline("r"))


def variant_mapping(a: DataFrame, ca: str, b: DataFrame, cb: str) -> DataFrame:
    """Every spelling in ``a`` with the first spelling in ``b`` equal up to case."""
    left = a.select(F.col(ca).alias("value_a")).where(F.col("value_a").isNotNull()).distinct()
    right = (
        b.where(F.col(cb).isNotNull()).groupBy(F.upper(F.col(cb)).alias("_key")).agg(F.min(F.col(cb)).alias("value_b"))
    )
    joined = left.withColumn("_key", F.upper("value_a")).join(right, "_key", "left")
    return joined.select("value_a", F.coalesce("value_b", F.lit("NO MATCH")).alias("value_b"))


def containment_matches(a: DataFrame, ca: str, b: DataFrame, cb: str) -> DataFrame:
    """Pairs of distinct names where one contains the other, ignoring case.

    Instead of comparing every name with every other, each name is cut into
    its substrings of the lengths that occur on the other side, and these are
    matched by equality. Only true matches leave the join. Names are short, and
    the set of lengths is at most as large as the longest name.
    """
    left = a.select(F.col(ca).alias("value_a")).where(F.length(ca) > 0).distinct().withColumn("ua", F.upper("value_a"))
    right = b.select(F.col(cb).alias("value_b")).where(F.length(cb) > 0).distinct().withColumn("ub", F.upper("value_b"))
    b_in_a = _substring_pairs(left, "ua", right, "ub")
    a_in_b = _substring_pairs(right, "ub", left, "ua")
    pairs = b_in_a.select("value_a", "value_b").unionByName(a_in_b.select("value_a", "value_b"))
    return pairs.distinct()


# Abbreviated state names and what they stand for.
STATE_NAMES = {
    "cent eq": "Central Equatoria", "east eq": "Eastern Equatoria", "west eq": "Western Equatoria",
    "north bahr": "Northern Bahr El Ghazal", "west bahr": "Western Bahr El Ghazal", "unity": "Unity", "warrap": "Warrap",
    "jonglei": "Jonglei", "upper nile": "Upper Nile", "lakes": "Lakes", "abyei region": "Abyei Administrative Area",
}


def containment_summary(a: DataFrame, ca: str, b: DataFrame, cb: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """For every distinct name of ``a``, what it stands for and how it occurs among the names of ``b``.

    ``names`` spells abbreviations out (others stand for themselves). Returns
    name, full_name, found_in_b (as written), n_containing (names of b that hold
    the full name, ignoring case), n_contained (names that lie properly within
    it) and first_match, the least of both. Names of b are indexed by their
    pieces and counted per piece before they meet, so no pairs are listed: one
    row a name comes out, and a piece that most names share is one counter.
    """
    spelled = F.create_map(*[F.lit(x) for kv in (names or {}).items() for x in kv]) if names else None
    full = F.coalesce(F.try_element_at(spelled, F.col("name")), F.col("name")) if names else F.col("name")
    left = a.select(F.col(ca).alias("name")).where(F.length("name") > 0).distinct().withColumn("full_name", full)
    left = staged(left.withColumn("key", F.upper("full_name")))
    right = b.select(F.col(cb).alias("value")).where(F.length("value") > 0).distinct()
    right = staged(right.groupBy(F.upper("value").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first")))
    pieces = _pieces(right, left).groupBy("piece").agg(F.sum("n").alias("n_containing"), F.min("first").alias("first_holding"))
    within = _pieces(left.select("key").distinct(), right).where("piece <> key").join(right.select(F.col("key").alias("piece"), "n", "first"), "piece")
    within = within.groupBy("key").agg(F.sum("n").alias("n_contained"), F.min("first").alias("first_within"))
    written = b.select(F.col(cb).alias("full_name"), F.lit(True).alias("_written")).where("full_name is not null").distinct()
    return (
        left.join(pieces.withColumnRenamed("piece", "key"), "key", "left").join(within, "key", "left").join(written, "full_name", "left")
        .select(
            "name", "full_name", F.coalesce("_written", F.lit(False)).alias("found_in_b"),
            F.coalesce("n_containing", F.lit(0)).alias("n_containing"), F.coalesce("n_contained", F.lit(0)).alias("n_contained"),
            F.least("first_holding", "first_within").alias("first_match"),
        )
    )


def _pieces(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """The distinct pieces of each key of ``outer`` that are as long as some key of ``inner``, beside its row."""
    # One row with an array bounded by the longest key.
    lengths = inner.agg(F.collect_set(F.length("key")).alias("lengths"))
    fits = F.filter("lengths", lambda n: n <= F.length("key"))
    cuts = F.transform(fits, lambda n: F.transform(F.sequence(F.lit(1), F.length("key") - n + 1), lambda i: F.substring(F.col("key"), i, n)))
    return outer.crossJoin(F.broadcast(lengths)).select(*outer.columns, F.explode(F.array_distinct(F.flatten(cuts))).alias("piece"))


def _substring_pairs(outer: DataFrame, oc: str, inner: DataFrame, ic: str) -> DataFrame:
    lengths = inner.agg(F.collect_set(F.length(ic)).alias("lengths"))
    # One row with an array bounded by the longest name.
    sized = outer.join(F.broadcast(lengths.withColumn("_one", F.lit(1))), F.lit(1) == F.col("_one"))
    cuts = F.flatten(
        F.transform(
            F.filter("lengths", lambda n: n <= F.length(oc)),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.length(oc) - n + 1), lambda i: F.substring(F.col(oc), i, n)
            ),
        )
    )
    pieces = sized.select(*outer.columns, F.explode(F.array_distinct(cuts)).alias(ic))
    # A short name found in very many others makes a hot key, which the salted path splits.
    return lookup_join(pieces, inner, ic, "inner")


def business_key(df: DataFrame, key: str) -> DataFrame:
    """Uniqueness of a key: rows, values, duplicate rate, repeated keys, largest group."""
    sizes = (
        df.groupBy(F.col(key).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count("k").alias("unique_keys"),
            F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
            F.max(F.when(F.col("k").isNotNull(), F.col("n"))).alias("max_per_key"),
        )
    )
    rate = _percent(F.col("total_rows") - F.col("unique_keys"), F.col("total_rows"))
    return sizes.select(
        "total_rows",
        "unique_keys",
        rate.alias("duplicate_rate"),
        (F.col("total_rows") == F.col("unique_keys")).alias("is_business_key"),
        "duplicate_keys",
        "max_per_key",
    )


def length_distribution(df: DataFrame, c: str) -> DataFrame:
    """Rows per text length, in order of length."""
    length = F.length(F.col(c).cast("string"))
    return df.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy("length")


def prefix_agreement(df: DataFrame, code: str, other: str, length: int = 4) -> DataFrame:
    """X8 / P29."""
    hits = F.count_if(prefix_equals(code, other, length))
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("total_rows"), hits.alias("prefix_matches"), _percent(hits, rows).alias("match_percent"))


# --- X9-X13 ------------------------------------------------------------------


def coordinate_coverage(df: DataFrame, lat: str, lon: str, name: str) -> DataFrame:
    """X9."""
    gone = F.count_if(missing_coordinates(lat, lon))
    rows = F.count(F.lit(1))
    return df.agg(
        F.lit(name).alias("dataset"),
        (rows - gone).alias("with_coordinates"),
        _percent(rows - gone, rows).alias("coverage_percent"),
        gone.alias("missing"),
        _percent(gone, rows).alias("missing_percent"),
    )


def first_places(df: DataFrame, key: str, lat: str, lon: str, order: str, side: str) -> DataFrame:
    """Coordinates of the first row per key; a reduction, so a hot key is combined map-side."""
    first = F.min(F.struct(F.col(order).alias("o"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))).alias("f")
    rows = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(first)
    return rows.select("key", F.col("f.lat").alias(f"lat_{side}"), F.col("f.lon").alias(f"lon_{side}"))


def coordinate_distances(a: DataFrame, b: DataFrame, key: str, lat: str, lon: str, order: str) -> DataFrame:
    """Distance between the first rows of every shared key that have coordinates on both sides."""
    fa = first_places(a, key, lat, lon, order, "a").dropna()
    fb = first_places(b, key, lat, lon, order, "b").dropna()
    joined = fa.join(fb, "key")
    km = distance_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    band = (
        F.when(F.col("distance_km") < 0.001, F.lit("exact"))
        .when(F.col("distance_km") < 1, F.lit("minor"))
        .when(F.col("distance_km") >= 5, F.lit("major"))
        .otherwise(F.lit("moderate"))
    )
    return joined.withColumn("distance_km", km).withColumn("band", band)


def coordinate_compare(a: DataFrame, b: DataFrame, key: str, lat: str, lon: str, order: str) -> DataFrame:
    """Summary of the distances; no cap on the number of keys."""
    d = staged(coordinate_distances(a, b, key, lat, lon, order))
    km, n = F.col("distance_km"), F.count(F.lit(1))
    bands = [("exact", "exact_match"), ("minor", "minor_diff"), ("major", "major_diff")]
    summary = d.agg(
        n.alias("n_common"),
        F.avg(F.col("lat_a") - F.col("lat_b")).alias("mean_lat_diff"),
        F.avg(F.col("lon_a") - F.col("lon_b")).alias("mean_lon_diff"),
        F.avg(km).alias("mean_km"),
        F.max(km).alias("max_km"),
        F.stddev_samp(km).alias("std_km"),
        *[F.count_if(F.col("band") == b).alias(label) for b, label in bands],
        *[_percent(F.count_if(F.col("band") == b), n).alias(f"{label}_percent") for b, label in bands],
    )
    # Both sides are one row.
    return summary.crossJoin(exact_medians(d, "distance_km", name="median_km"))


def duplicate_coordinates(df: DataFrame, lat: str, lon: str, digits: int = 4) -> DataFrame:
    """X11: rounded places shared by several rows."""
    rows = df.where(~missing_coordinates(lat, lon))
    return (
        rows.groupBy(round_half_even(F.col(lat), digits).alias("lat"), round_half_even(F.col(lon), digits).alias("lon"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def duplicate_coordinate_summary(df: DataFrame, lat: str, lon: str, digits: int = 4) -> DataFrame:
    """X11 / A12."""
    return duplicate_coordinates(df, lat, lon, digits).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.max("n_rows").alias("max_per_place")
    )


def whitespace_issues(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values with leading, trailing or double spaces per column."""
    out = []
    for c in cols:
        s = F.col(c)
        lead, trail = F.count_if(s.startswith(" ")), F.count_if(s.endswith(" "))
        double = F.count_if(s.contains("  "))
        out.append(
            F.struct(
                F.lit(c).alias("column"),
                lead.alias("leading"),
                trail.alias("trailing"),
                double.alias("multiple"),
                (lead + trail + double).alias("total"),
            )
        )
    return df.agg(F.array(*out).alias("r")).select(F.inline("r"))


def category_distribution(df: DataFrame, c: str, where: Column | None = None) -> DataFrame:
    """Rows and share per category; the share refers to the whole table."""
    kept = F.lit(True) if where is None else where
    # NULL categories and rows outside the filter still count towards the total.
    groups = df.groupBy(F.col(c).alias("category")).agg(
        F.count_if(F.coalesce(kept, F.lit(False))).alias("n_rows"), F.count(F.lit(1)).alias("n_all")
    )
    total = groups.agg(F.sum("n_all").alias("total"), F.lit(1).alias("_one"))
    joined = groups.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")  # one row
    return joined.where(F.col("category").isNotNull() & (F.col("n_rows") > 0)).select(
        "category", "n_rows", _percent(F.col("n_rows"), F.col("total")).alias("percent")
    )


def pattern_share(df: DataFrame, c: str, pattern: str) -> DataFrame:
    """Rows whose text carries a pattern."""
    hits, rows = F.count_if(has_pattern(c, pattern)), F.count(F.lit(1))
    return df.agg(rows.alias("total_rows"), hits.alias("with_pattern"), _percent(hits, rows).alias("percent"))


# --- X17, X18 ----------------------------------------------------------------

# Facility types that count as valid.
VALID_FACILITY_TYPES = ("PHCU", "PHCC", "Hospital")


def _dependency_violations(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys with several attribute values, and keys in total."""
    groups = value_mapping(df, key, attribute)
    return groups.agg(F.count_if(F.col("n_values") > 1).alias("violations"), F.count(F.lit(1)).alias("total"))


def facility_rules(df: DataFrame, dataset: str, box: Box) -> DataFrame:
    """The nine business rules as (rule, dataset, violations, total, verdict).

    Expects facility_name, state, state_code, county, payam, latitude and
    longitude; rules 8 and 9 run when facility_type and facility_code exist.
    """
    gone = missing_coordinates("latitude", "longitude")
    rows = F.count(F.lit(1))
    located = F.count_if(~gone)
    counted = [
        ("1 every facility has coordinates", F.count_if(gone), rows),
        ("2 every facility has a payam", F.count_if(F.col("payam").isNull()), rows),
        ("7 coordinates within bounds", F.count_if(~gone & ~inside_box("latitude", "longitude", box)), located),
    ]
    if "facility_type" in df.columns:
        known = F.coalesce(F.col("facility_type").isin(*VALID_FACILITY_TYPES), F.lit(False))
        counted.append(("8 facility type is valid", F.count_if(~known), rows))
    scan = df.agg(
        F.array(
            *[F.struct(F.lit(r).alias("rule"), v.alias("violations"), t.alias("total")) for r, v, t in counted]
        ).alias("r")
    ).select(F.inline("r"))
    branches = [scan]
    for rule, key, attribute in (
        ("3 one code per state", "state", "state_code"),
        ("4 one state per county", "county", "state"),
        ("5 one county per payam", "payam", "county"),
    ):
        branches.append(_dependency_violations(df, key, attribute).withColumn("rule", F.lit(rule)))
    named = df.where(F.col("payam").isNotNull() & F.col("facility_name").isNotNull())
    names = group_sizes(named, ["payam", "facility_name"]).select(
        F.lit("6 names unique within a payam").alias("rule"),
        F.col("n_duplicate_groups").alias("violations"),
        F.col("n_groups").alias("total"),
    )
    branches.append(names)
    if "facility_code" in df.columns:
        codes = df.groupBy("facility_code").agg(F.count(F.lit(1)).alias("n"))
        branches.append(
            codes.agg(
                (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("violations"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            ).withColumn("rule", F.lit("9 facility code is unique"))
        )
    verdict = F.when(F.col("violations") == 0, F.lit("PASS")).otherwise(F.lit("VIOLATION"))
    return _union([b.select("rule", "violations", "total") for b in branches]).select(
        "rule", F.lit(dataset).alias("dataset"), "violations", "total", verdict.alias("verdict")
    )


def scorecard(a: DataFrame, b: DataFrame, key: str, key_sets: Mapping[str, Sequence[str]], box: Box) -> DataFrame:
    """One row per investigation with the figures of both sides, derived from the operators above."""
    o = overlap(a, b, key).select(
        F.lit("overlap").alias("investigation"),
        F.col("pct_a_in_b").alias("result_a"),
        F.col("pct_b_in_a").alias("result_b"),
    )
    s = strategies(a, b, key_sets).select(
        F.concat(F.lit("match rate "), F.col("strategy")).alias("investigation"),
        F.col("rate_a").alias("result_a"),
        F.col("rate_b").alias("result_b"),
    )

    def sides(one: DataFrame, two: DataFrame, name: str) -> DataFrame:
        left = one.select(F.col("v").alias("result_a"), F.lit(None).cast("double").alias("result_b"))
        right = two.select(F.lit(None).cast("double").alias("result_a"), F.col("v").alias("result_b"))
        return (
            left.unionByName(right)
            .agg(F.max("result_a").alias("result_a"), F.max("result_b").alias("result_b"))
            .select(F.lit(name).alias("investigation"), "result_a", "result_b")
        )

    def cover(df: DataFrame) -> DataFrame:
        return coordinate_coverage(df, "latitude", "longitude", "").select(F.col("coverage_percent").alias("v"))

    def broken(df: DataFrame) -> DataFrame:
        failed = F.count_if(F.col("verdict") == "VIOLATION").cast("double")
        return facility_rules(df, "", box).agg(failed.alias("v"))

    coverage_row = sides(cover(a), cover(b), "coordinate coverage")
    rules_row = sides(broken(a), broken(b), "business rules violated")
    return _union([o, s, coverage_row, rules_row])
