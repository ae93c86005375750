"""Profiles of tables and columns.

Counting metrics of all columns come from one aggregate over one scan.
Distinct counts group each column on its own: a columnar scan then reads every
column once, keys are pre-aggregated before the shuffle, and no row is blown up
to one copy per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terrasift.functions.keys import row_key, value_key
from terrasift.functions.numeric import priority_rank, round_half_even
from terrasift.functions.places import PROFILE_BOX, Box
from terrasift.functions.text import BLANK, strip_blanks

# Texts that stand for a missing value.
PLACEHOLDERS = ("unknown", "n/a", "none", "nan", "-", "not applicable", "null", "na", "n.a.")

# Order of the finding priorities.
PRIORITIES = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}

_NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
_LONG_TEXT = 100
_HIGH_CARDINALITY = 50


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _missing(df: DataFrame, name: str) -> Column:
    c = _q(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _percent(part: Column, whole: Column, digits: int) -> Column:
    """Half-even rounding; NULL for an empty table."""
    return F.when(whole > 0, round_half_even(F.lit(100.0) * part / whole, digits))


def _long(df: DataFrame, per_column: list[Column]) -> DataFrame:
    """One aggregate holding a struct per column, turned into one row per column."""
    return df.agg(F.array(*per_column).alias("r")).select(F.inline("r"))


def _union(branches: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), branches)


# --- value frequencies -------------------------------------------------------


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows per value of a column without NULL; long texts appear as their digest."""
    key = value_key(df, c)
    rows = df.where(~_missing(df, c)).select(key.alias("key"))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def frequencies(df: DataFrame, c: str) -> DataFrame:
    """Full frequency table (value, n) of a column."""
    return df.where(~_missing(df, c)).groupBy(_q(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: distinct values, values seen more than once, their rows, values seen once."""
    out = []
    for i, c in enumerate(cols or df.columns):
        n = F.col("n")
        counts = value_counts(df, c).agg(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("distinct"),
            F.count_if(n > 1).alias("duplicate_values"),
            F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).cast("bigint").alias("rows_with_duplicates"),
            F.count_if(n == 1).alias("singletons"),
        )
        out.append(counts)
    return _union(out)


def top_values(df: DataFrame, c: str, k: int, above: int = 0) -> DataFrame:
    """The k most frequent values seen more than ``above`` times, ties by the value itself.

    Counting runs on value keys. Texts are fetched only for the keys that reach
    the k-th largest count, and of those that tie the smallest are kept.
    """
    counts = value_counts(df, c).where(F.col("n") > above)
    if not isinstance(df.schema[c].dataType, T.StringType):
        top = counts.orderBy(F.desc("n"), "key").limit(k)
        return top.select(F.lit(c).alias("column"), F.col("key").cast("string").alias("value"), "n")
    # One row.
    least = counts.orderBy(F.desc("n")).limit(k).agg(F.min("n").alias("least"))
    reached = counts.join(F.broadcast(least), F.col("n") >= F.col("least")).select("key", "n")
    rows = df.where(~_missing(df, c)).select(value_key(df, c).alias("key"), _q(c).alias("value"))
    top = rows.join(reached, "key").select("value", "n").distinct().orderBy(F.desc("n"), "value").limit(k)
    return top.select(F.lit(c).alias("column"), "value", "n")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row with rows, distinct rows and surplus copies."""
    groups = df.select(row_key(df).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return groups.agg(
        total.alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (total - F.count(F.lit(1))).alias("duplicate_rows"),
    )


# --- F1-F7 -------------------------------------------------------------------


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """F1."""
    missing = reduce(lambda a, b: a + b, [_missing(df, c).cast("bigint") for c in df.columns])
    key = row_key(df)
    # Copies of a row share their missing cells, so both metrics come from one grouping.
    groups = df.select(key.alias("k"), missing.alias("m")).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("m").alias("m")
    )
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    cells = F.coalesce(F.sum("m"), F.lit(0)).cast("bigint")
    width = len(df.columns)
    return groups.agg(
        F.lit(name).alias("table"),
        total.alias("total_rows"),
        F.lit(width).cast("bigint").alias("total_columns"),
        (total - F.count(F.lit(1))).alias("duplicate_rows"),
        cells.alias("missing_cells"),
        _percent(cells, total * width, 2).alias("missing_percent"),
    )


def column_missing(df: DataFrame, name: str) -> DataFrame:
    """Missing count and percent of every column, from one aggregate."""
    rows = F.count(F.lit(1))
    return _long(
        df,
        [
            F.struct(
                F.lit(name).alias("table"),
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.count_if(_missing(df, f.name)).alias("missing_count"),
                _percent(F.count_if(_missing(df, f.name)), rows, 2).alias("missing_percent"),
            )
            for i, f in enumerate(df.schema.fields)
        ],
    )


def column_profile(df: DataFrame, name: str) -> DataFrame:
    """one row per column."""
    distinct = distinct_counts(df).select("column", F.col("distinct").alias("unique_values"))
    return column_missing(df, name).join(distinct, "column")


def tables_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """F3."""
    return _union([table_profile(df, name) for name, df in tables.items()])


def _flag(table: Column, issue: Column, priority: str) -> list[Column]:
    return [table.alias("table"), issue.alias("issue"), F.lit(priority).alias("priority")]


def quality_flags_basic(tables: Mapping[str, DataFrame]) -> DataFrame:
    """High above 20 % missing, Medium for duplicate rows, Low for any missing cell."""
    t = F.col("table")
    columns = _union([column_missing(df, name) for name, df in tables.items()])
    summary = tables_summary(tables)
    high = columns.where(F.col("missing_percent") > 20).select(
        *_flag(t, F.format_string("High missing data: %s (%.1f%% missing)", "column", "missing_percent"), "High")
    )
    # One row per table: the summary yields both of its flags in one pass.
    dup = F.when(F.col("duplicate_rows") > 0, F.struct(*_flag(t, F.format_string("Contains %,d duplicate rows", "duplicate_rows"), "Medium")))
    low = F.when(F.col("missing_percent") > 0, F.struct(*_flag(t, F.format_string("Overall %.1f%% missing data", "missing_percent"), "Low")))
    rest = summary.select(F.inline(F.array_compact(F.array(dup, low))))
    return high.unionByName(rest)


def quality_flags(tables: Mapping[str, DataFrame]) -> DataFrame:
    """CRITICAL empty columns, HIGH 20-100 % missing, MEDIUM duplicates and names with line breaks, HIGH unnamed columns."""
    t, pct = F.col("table"), F.col("missing_percent")
    columns = _union([column_missing(df, name) for name, df in tables.items()])
    empty = F.when(pct == 100, F.struct(*_flag(t, F.format_string("EMPTY COLUMN: %s (100%% missing)", "column"), "CRITICAL")))
    high = F.when((pct > 20) & (pct < 100), F.struct(*_flag(t, F.format_string("High missing: %s (%.1f%% missing)", "column", "missing_percent"), "HIGH")))
    per_column = columns.select(F.inline(F.array_compact(F.array(empty, high))))
    dups = tables_summary(tables).where(F.col("duplicate_rows") > 0).select(
        *_flag(t, F.format_string("Contains %,d duplicate rows", "duplicate_rows"), "MEDIUM")
    )
    unnamed = columns.where(F.col("column").startswith("unnamed")).select("table").distinct().select(
        *_flag(t, F.lit("Column names need cleaning ('unnamed:_1', etc.)"), "HIGH")
    )
    broken = columns.where(F.col("column").contains("\n")).select("table").distinct().select(
        *_flag(t, F.lit("Column names contain newline characters (\\n) - needs cleaning"), "MEDIUM")
    )
    flags = _union([per_column, dups, unnamed, broken])
    return flags.withColumn("sort_order", priority_rank("priority", PRIORITIES))


def observations(df: DataFrame, name: str) -> DataFrame:
    """worst columns, column types and kinds of content, as (table, observation, value)."""
    columns = column_missing(df, name)
    partial = (F.col("missing_count") > 0) & (F.col("missing_percent") < 100)
    worst = F.slice(
        F.sort_array(F.collect_list(F.when(partial, F.struct((-F.col("missing_percent")).alias("p"), "position", "column")))), 1, 3
    )
    empty = F.sort_array(F.collect_list(F.when(F.col("missing_percent") == 100, F.struct("position", "column"))))
    names = lambda a: F.array_join(F.transform(a, lambda s: s["column"]), ", ")
    present = lambda *cs: F.lit("yes" if set(cs) & set(df.columns) else "no")
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    types = ", ".join(f"{k}:{kinds.count(k)}" for k in sorted(set(kinds)))
    # One row per column goes in, so the collected lists are as short as the schema is wide.
    row = columns.agg(names(worst).alias("worst"), names(empty).alias("empty"))
    pairs = [
        ("top_missing_columns", F.col("worst")),
        ("empty_columns", F.col("empty")),
        ("column_types", F.lit(types)),
        ("spatial_data", present("geometry")),
        ("coordinates", present("latitude", "longitude")),
        ("admin_codes", present("admin1_pcode", "admin2_pcode")),
    ]
    built = [F.struct(F.lit(name).alias("table"), F.lit(k).alias("observation"), v.alias("value")) for k, v in pairs]
    return row.select(F.inline(F.array(*built)))


def structural(df: DataFrame, name: str) -> DataFrame:
    """shape, duplicate rows and single-column key candidates."""
    counts = duplicate_rows(df).select(
        F.lit(name).alias("table"), F.col("total_rows").alias("row_count"), "duplicate_rows"
    )
    keys = distinct_counts(df).select(F.lit(name).alias("table"), "position", "column", "distinct")
    joined = keys.join(F.broadcast(counts), "table")  # counts is one row
    candidate = F.when(F.col("distinct") == F.col("row_count"), F.struct("position", "column"))
    found = F.sort_array(F.collect_list(candidate))
    return joined.groupBy("table", "row_count", "duplicate_rows").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.array_join(F.transform(found, lambda s: s["column"]), ", ").alias("key_candidates"),
    )


# --- F8-F12 ------------------------------------------------------------------


def completeness(df: DataFrame, cols: Sequence[str] | None = None, pandas_compat: bool = False) -> DataFrame:
    """F8: NULL, blank, whitespace-only, placeholder and filled counts per column.

    ``pandas_compat`` counts a NULL text as a placeholder too.
    """
    texts = set(text_columns(df))
    rows = F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    out = []
    for i, c in enumerate(cols or df.columns):
        null = F.count_if(_missing(df, c))
        if c in texts:
            stripped = strip_blanks(_q(c))
            blank = F.count_if(_q(c) == "")
            space = F.count_if((stripped == "") & (_q(c) != ""))
            placeholder = F.count_if(F.lower(stripped).isin(*PLACEHOLDERS))
            if pandas_compat:
                placeholder = placeholder + null
        else:
            blank = space = placeholder = zero
        filled = rows - null - blank
        out.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                rows.alias("total"),
                null.alias("null_count"),
                _percent(null, rows, 1).alias("null_pct"),
                blank.alias("blank"),
                _percent(blank, rows, 1).alias("blank_pct"),
                space.alias("whitespace_only"),
                placeholder.alias("placeholder_count"),
                _percent(placeholder, rows, 1).alias("placeholder_pct"),
                filled.alias("filled"),
                _percent(filled, rows, 1).alias("filled_pct"),
            )
        )
    return _long(df, out)


def uniqueness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """distinct share and repeated values per column."""
    counts = distinct_counts(df, cols)
    total = df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(1).alias("_one"))
    joined = counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")  # one row
    return joined.select(
        "position",
        "column",
        "distinct",
        "total_rows",
        _percent(F.col("distinct"), F.col("total_rows"), 1).alias("unique_pct"),
        (F.col("distinct") == F.col("total_rows")).alias("is_unique"),
        "duplicate_values",
        "rows_with_duplicates",
    )


def duplicate_examples(df: DataFrame, cols: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """the k most repeated values per column."""
    return _union([top_values(df, c, k, above=1) for c in (cols or df.columns)])


def text_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """spacing, casing, non-ASCII, length and numeric-looking text per column."""
    out = []
    for c in cols or text_columns(df):
        s = _q(c)
        total = F.count(s)
        out.append(
            F.struct(
                F.lit(c).alias("column"),
                total.alias("total"),
                F.count_if(s.rlike(f"^{BLANK}")).alias("lead_ws"),
                F.count_if(s.rlike(rf"{BLANK}\z")).alias("trail_ws"),
                F.count_if(s.rlike(f"{BLANK}{{2}}")).alias("multi_sp"),
                F.count_if(s.rlike("[A-Z]") & s.rlike("[a-z]")).alias("mixed_case"),
                F.count_if(s.rlike(r"[^\x00-\x7F]")).alias("non_ascii"),
                F.max(F.length(s)).cast("bigint").alias("max_length"),
                ((total > 0) & (F.count_if(s.rlike(_NUMERIC_TEXT)) == total)).alias("numeric_text"),
            )
        )
    n = F.col
    marks = [
        (n("lead_ws") > 0, "lead_ws"),
        (n("trail_ws") > 0, "trail_ws"),
        (n("multi_sp") > 0, "multi_sp"),
        (n("mixed_case") > 0, "mixed_case"),
        (n("non_ascii") > 0, "non_ascii"),
        (n("max_length") > _LONG_TEXT, "long_vals"),
        (n("numeric_text"), "numeric_text"),
    ]
    issues = F.array_join(F.array_compact(F.array(*[F.when(t, F.lit(m)) for t, m in marks])), ", ")
    verdict = F.when(n("total") == 0, F.lit("-")).when(issues == "", F.lit("Clean")).otherwise(issues)
    return _long(df, out).withColumn("issues", verdict)


def text_top_values(df: DataFrame, cols: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """the k most frequent values per text column."""
    return _union([top_values(df, c, k) for c in (cols or text_columns(df))])


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Range, moments, negatives, zeros and values beyond three standard deviations."""
    names = list(cols or numeric_columns(df))

    def present(c: str) -> Column:
        return F.when(~_missing(df, c), _q(c).cast("double"))

    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(present(c)).alias("total"),
                F.min(present(c)).alias("min"),
                F.max(present(c)).alias("max"),
                F.avg(present(c)).alias("mean"),
                F.stddev_samp(present(c)).alias("std"),
                F.count_if(present(c) < 0).alias("negatives"),
                F.count_if(present(c) == 0).alias("zeros"),
            ).alias(f"s{i}")
            for i, c in enumerate(names)
        ],
        F.lit(1).alias("_one"),
    )
    # The statistics are one row; every data row meets it without a shuffle.
    rows = df.select(F.lit(1).alias("_one"), *[present(c).alias(f"v{i}") for i, c in enumerate(names)])
    outliers = rows.join(F.broadcast(stats), "_one").agg(
        F.lit(1).alias("_one"),
        *[
            F.count_if(
                (F.col(f"s{i}.std") > 0)
                & (F.abs(F.try_divide(F.col(f"v{i}") - F.col(f"s{i}.mean"), F.col(f"s{i}.std"))) > 3)
            ).alias(f"o{i}")
            for i in range(len(names))
        ],
    )
    built = [F.struct(F.col(f"s{i}").alias("s"), F.col(f"o{i}").alias("outliers_3std")) for i in range(len(names))]
    flat = outliers.join(F.broadcast(stats), "_one").select(F.inline(F.array(*built)))
    return flat.select("s.*", "outliers_3std").where(F.col("total") > 0)


def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """distinct values, singletons and flags per text column."""
    names = list(cols or text_columns(df))
    texts = _long(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.count(_q(c)).alias("total"),
                (F.count_if(_q(c).rlike(_NUMERIC_TEXT)) == F.count(_q(c))).alias("numeric_text"),
            )
            for c in names
        ],
    ).where(F.col("total") > 0)
    joined = texts.join(distinct_counts(df, names).select("column", "distinct", "singletons"), "column")
    marks = [
        F.when(F.col("numeric_text"), F.lit("NumericText")),
        F.when(F.col("distinct") > _HIGH_CARDINALITY, F.lit("HighCard")),
        F.when(F.col("singletons") > 0, F.concat(F.lit("S:"), F.col("singletons").cast("string"))),
    ]
    return joined.select(
        "column", "distinct", "total", "singletons", F.array_join(F.array_compact(F.array(*marks)), ", ").alias("flags")
    )


# --- F13 ---------------------------------------------------------------------


def geometry_named(cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c.lower() in ("geometry", "geom", "wkt", "the_geom")]


def latitude_named(cols: Sequence[str]) -> list[str]:
    return [c for c in cols if "lat" in c.lower() or c.lower().strip() in ("y", "ycoord", "y_coord")]


def longitude_named(cols: Sequence[str]) -> list[str]:
    return [
        c for c in cols if any(p in c.lower() for p in ("lon", "lng")) or c.lower().strip() in ("x", "xcoord", "x_coord")
    ]


def coordinate_profile(df: DataFrame, box: Box = PROFILE_BOX) -> DataFrame:
    """ranges and plausibility flags of every latitude / longitude pair found by name."""
    pairs = list(zip(latitude_named(df.columns), longitude_named(df.columns)))
    if not pairs:
        raise ValueError("no latitude / longitude columns")

    def number(c: str) -> Column:
        v = _q(c).cast("double") if c in numeric_columns(df) else _q(c).cast("string").try_cast("double")
        return F.when(~F.isnan(v), v)

    out = [
        F.struct(
            F.lit(lat).alias("lat_col"),
            F.lit(lon).alias("lon_col"),
            F.count_if(number(lat).isNull()).alias("lat_null"),
            F.count_if(number(lon).isNull()).alias("lon_null"),
            F.min(number(lat)).alias("lat_min"),
            F.max(number(lat)).alias("lat_max"),
            F.min(number(lon)).alias("lon_min"),
            F.max(number(lon)).alias("lon_max"),
            F.count_if((number(lat) == 0) & (number(lon) == 0)).alias("zero_zero"),
        )
        for lat, lon in pairs
    ]
    c = F.col
    lat_lo, lat_hi, lon_lo, lon_hi = c("lat_min"), c("lat_max"), c("lon_min"), c("lon_max")
    swapped = ((F.abs(lat_hi - lat_lo) > 40) & (F.abs(lon_hi - lon_lo) < 15)) | ((lat_hi > 60) & (lat_lo < -60))
    marks = [
        F.when((lat_hi > 90) | (lat_lo < -90), F.lit("LAT_OUT_OF_GLOBAL_RANGE")),
        F.when((lon_hi > 180) | (lon_lo < -180), F.lit("LON_OUT_OF_GLOBAL_RANGE")),
        F.when((lat_hi > box.lat_max) | (lat_lo < box.lat_min), F.lit("LAT_OUTSIDE_SS")),
        F.when((lon_hi > box.lon_max) | (lon_lo < box.lon_min), F.lit("LON_OUTSIDE_SS")),
        F.when(c("zero_zero") > 0, F.concat(F.lit("ZERO_ZERO:"), c("zero_zero").cast("string"))),
        F.when(swapped, F.lit("LIKELY_SWAPPED")),
    ]
    flags = F.array_join(F.array_compact(F.array(*marks)), ", ")
    return _long(df, out).withColumn("flags", F.when(flags == "", F.lit("OK")).otherwise(flags))


def geometry_text_profile(df: DataFrame, c: str) -> DataFrame:
    """NULL, blank, EMPTY and filled counts of a geometry text column."""
    s = _q(c).cast("string")
    blank = F.count_if(strip_blanks(s) == "")
    null = F.count_if(s.isNull())
    total = F.count(F.lit(1))
    return df.agg(
        F.lit(c).alias("column"),
        total.alias("total"),
        null.alias("null_count"),
        blank.alias("blank"),
        F.count_if(s.rlike(r"(?i)^EMPTY\z")).alias("empty"),
        (total - null - blank).alias("filled"),
    )


def geometry_type_counts(df: DataFrame, c: str) -> DataFrame:
    """rows per leading type word of a geometry text column."""
    word = F.regexp_extract(_q(c).cast("string"), r"^([A-Za-z]+)", 1)
    return df.select(word.alias("geom_type")).where(F.col("geom_type") != "").groupBy("geom_type").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- F14-F18 -----------------------------------------------------------------


def _absent_values(source: DataFrame, c: str, target: DataFrame, tc: str) -> DataFrame:
    values = source.select(F.col(c).alias("value")).where(F.col("value").isNotNull()).distinct()
    known = target.select(F.col(tc).alias("value")).where(F.col("value").isNotNull()).distinct()
    # Both sides hold one row per value, so no key can be hot.
    return values.join(known, "value", "left_anti")


def fk_check(source: DataFrame, c: str, target: DataFrame, tc: str, samples: int = 5) -> DataFrame:
    """One row (status, missing_values, samples)."""
    for df, name, side in ((source, c, "source"), (target, tc, "target")):
        if name not in df.columns:
            return source.sparkSession.createDataFrame(
                [(f"SKIP: {name} not in {side}", 0, "")], "status string, missing_values bigint, samples string"
            )
    absent = _absent_values(source, c, target, tc)
    # A bounded sample: the smallest few values, kept by a top-k.
    few = absent.select(F.col("value").cast("string").alias("value")).orderBy("value").limit(samples)
    listed = few.agg(F.array_join(F.sort_array(F.collect_list("value")), ", ").alias("samples"), F.lit(1).alias("_one"))
    n = absent.agg(F.count(F.lit(1)).alias("missing_values"), F.lit(1).alias("_one"))
    status = F.when(F.col("missing_values") == 0, F.lit("OK")).otherwise(F.lit("FAIL"))
    return n.join(F.broadcast(listed), "_one").select(status.alias("status"), "missing_values", "samples")


def hierarchy_check(df: DataFrame, child: str, parent: str) -> DataFrame:
    """children that map to more than one parent; pairs with a NULL are dropped."""
    pairs = df.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
    return (
        pairs.groupBy(F.col(child).alias("child"))
        .agg(F.countDistinct(F.col(parent)).alias("n_parents"))
        .where(F.col("n_parents") > 1)
    )


def constant_check(df: DataFrame, c: str, expected: str) -> DataFrame:
    """F16: values of a column that should be constant, NULL included."""
    return (
        df.where(~F.col(c).eqNullSafe(F.lit(expected)))
        .groupBy(F.col(c).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rows breaking each rule, from one aggregate; a rule holds when its count is zero."""
    broken = F.col("violations")
    return _long(
        df, [F.struct(F.lit(name).alias("rule"), F.count_if(bad).alias("violations")) for name, bad in rules.items()]
    ).withColumn("holds", broken == 0)


def unknown_values(df: DataFrame, c: str, known: Sequence[str]) -> DataFrame:
    """lower-case trimmed values outside a closed domain."""
    value = F.lower(strip_blanks(c))
    rows = df.select(value.alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(list(known)))
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))


def coverage(a: DataFrame, c: str, b: DataFrame, d: str) -> DataFrame:
    """Distinct values present on one side only, from one shuffle."""
    return side_flags(a, [c], b, [d]).agg(
        F.count_if(F.col("in_a") & F.col("in_b")).alias("in_both"),
        F.count_if(F.col("in_a") & ~F.col("in_b")).alias("missing_in_b"),
        F.count_if(~F.col("in_a") & F.col("in_b")).alias("extra_in_b"),
    )


def side_flags(a: DataFrame, ka: Sequence[str], b: DataFrame, kb: Sequence[str]) -> DataFrame:
    """Distinct non-NULL keys of both sides with the sides they occur on."""
    names = [f"k{i}" for i in range(len(ka))]

    def side(df: DataFrame, keys: Sequence[str], left: bool) -> DataFrame:
        cols = [F.col(k).alias(n) for k, n in zip(keys, names)]
        return df.select(*cols, F.lit(left).alias("a"), F.lit(not left).alias("b")).dropna(subset=names)

    both = side(a, ka, True).unionByName(side(b, kb, False))
    return both.groupBy(*names).agg(F.bool_or("a").alias("in_a"), F.bool_or("b").alias("in_b"))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of groups, groups with several rows and the largest group."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("n_groups"),
            F.count_if(F.col("n") > 1).alias("n_duplicate_groups"),
            F.max("n").alias("max_group_size"),
        )
    )


def top_per_group(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """The k most frequent values of every group; only counts are ranked."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), value))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)

