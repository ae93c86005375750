"""Column typing of landing data: missing-value tokens, type inference, column names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts read as a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_INTEGER = r"^\s*[+-]?[0-9]+\s*\z"
_REAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
_BOOLEAN = r"^(True|False|TRUE|FALSE|true|false)\z"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def tokens_to_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Missing-value tokens become NULL in every text column."""
    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(
        *[F.when(~_q(c).isin(*tokens), _q(c)).alias(c) if c in texts else _q(c) for c in df.columns]
    )


def infer_types(df: DataFrame) -> DataFrame:
    """Type text columns from their whole content, in one aggregate.

    Integers without gaps become bigint, beyond 64 bits decimal(38, 0) and beyond
    that text, so keys stay exact; other numbers become double, and booleans
    without gaps boolean; everything else stays text.
    """
    if not df.columns:
        return df
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(
                F.count(_q(c)).alias("n"),
                F.count_if(_q(c).rlike(_INTEGER)).alias("integer"),
                F.count(F.when(_q(c).rlike(_INTEGER), F.trim(_q(c)).try_cast("bigint"))).alias("bigint"),
                F.count(F.when(_q(c).rlike(_INTEGER), F.trim(_q(c)).try_cast("decimal(38,0)"))).alias("wide"),
                F.count_if(_q(c).rlike(_REAL)).alias("real"),
                F.count_if(_q(c).rlike(_BOOLEAN)).alias("boolean"),
            ).alias(f"c{i}")
            for i, c in enumerate(df.columns)
        ],
    ).first()
    out = []
    for i, c in enumerate(df.columns):
        s = stats[f"c{i}"]
        full = s["n"] == stats["rows"]
        if s["n"] == 0 or s["real"] == s["n"]:
            # A column without values is floating point in the landing format, like one with gaps.
            target = "double"
            if full and s["n"] and s["integer"] == s["n"]:
                target = "bigint" if s["bigint"] == s["n"] else "decimal(38,0)" if s["wide"] == s["n"] else "string"
            out.append(F.trim(_q(c)).try_cast(target).alias(c))
        elif full and s["boolean"] == s["n"]:
            out.append(_q(c).try_cast("boolean").alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


def normalized_name(name: str) -> str:
    return re.sub(r"[ \t\r\n]", "_", name.strip(" ").lower())


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower case, blanks and line breaks to underscores; clashing names are refused."""
    names = [normalized_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after normalisation: {clashes}")
    return df.toDF(*names)
