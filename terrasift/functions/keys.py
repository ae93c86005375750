"""Entity keys, surrogate keys and compact grouping keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_SENTINEL = "_dbt_utils_surrogate_key_null_"

# Texts longer than this travel through a shuffle as a digest of the whole text.
_DIGEST_ABOVE = 64

_FIXED_WIDTH = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the raw values, NULL replaced by the sentinel."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def entity_key(name: Column | str, *codes: Column | str) -> Column:
    """md5 of the lower-case name followed by the codes; NULL name gives NULL."""
    parts = [F.lower(F.trim(_col(name)))]
    parts += [F.coalesce(F.trim(_col(c)), F.lit("unknown")) for c in codes]
    return F.md5(F.concat(*parts))


def value_key(df: DataFrame, name: str) -> Column:
    """Grouping key for the values of a column: the value, or the md5 of a long or nested one."""
    field = df.schema[name]
    c = F.col(f"`{name}`")
    if isinstance(field.dataType, T.StringType):
        return F.when(F.length(c) > _DIGEST_ABOVE, F.concat(F.lit("\u0001md5:"), F.md5(c))).otherwise(c)
    if isinstance(field.dataType, T.BinaryType):
        return F.md5(c)
    if isinstance(field.dataType, _FIXED_WIDTH):
        return c
    return F.when(c.isNotNull(), F.md5(F.to_json(F.struct(c.alias("v")))))


def row_key(df: DataFrame, cols: list[str] | None = None) -> Column:
    """One column that is equal exactly for equal rows (NULL equals NULL)."""
    names = cols or df.columns
    values = [F.col(f"`{c}`") for c in names]
    if all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in names):
        return F.struct(*values)
    return F.md5(F.to_json(F.struct(*values)))
