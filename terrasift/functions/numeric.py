"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the only spelling of a number the guarded cast accepts.
PLAIN_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_decimal(c: Column | str, precision: int = 38, scale: int = 10) -> Column:
    """Text to decimal when it is spelled as a plain number, NULL otherwise."""
    text = _col(c)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast(T.DecimalType(precision, scale)))


def as_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """P10."""
    return _col(c).cast(T.DecimalType(precision, scale))


def row_sum(*cols: Column | str) -> Column:
    """NULL in any part makes the sum NULL."""
    return reduce(lambda a, b: a + b, [_col(c) for c in cols])


def guarded_ratio(num: Column, den: Column, precision: int, scale: int) -> Column:
    """NULL unless the denominator is positive."""
    return F.when(den > 0, (num / den).cast(T.DecimalType(precision, scale)))


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round to the even neighbour, scale back, as array libraries do."""
    factor = F.lit(float(10**digits))
    return F.rint(c.cast("double") * factor) / factor


def weighted_score(weights: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the weights whose condition holds."""
    return reduce(lambda a, b: a + b, [F.when(cond, F.lit(w)).otherwise(F.lit(0)) for cond, w in weights])


def label_first(rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """First label whose condition holds."""
    out = F.when(rules[0][1], F.lit(rules[0][0]))
    for label, cond in rules[1:]:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def in_range(c: Column | str, low: float | None, high: float | None, inclusive: bool = True) -> Column:
    """Three-valued range test with open ends."""
    value = _col(c)
    tests: list[Column] = []
    if low is not None:
        tests.append(value >= low if inclusive else value > low)
    if high is not None:
        tests.append(value <= high if inclusive else value < high)
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def priority_rank(c: Column | str, order: Mapping[str, int]) -> Column:
    """O2: rank of a label in a custom order."""
    pairs = [F.lit(x) for kv in order.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(c))
