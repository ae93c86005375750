"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and tokens that must equal the agreed cleaning rules.
INVISIBLE_CHARS = "[\\u200B\\u200C\\u200D\\uFEFF\\u00A0]"
PLACEHOLDER_TOKENS = ("N/A", "NA", "-", "UNKNOWN", "NULL", "")

_WORD_RUN = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_blank(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def collapse_spaces(c: Column | str) -> Column:
    """Trim spaces, then squeeze every whitespace run to one space."""
    return F.regexp_replace(F.trim(_col(c)), r"\s+", " ")


def clean_text(c: Column | str) -> Column:
    """Drop invisible characters, trim, squeeze, blank to NULL; case is kept."""
    visible = F.regexp_replace(_col(c), INVISIBLE_CHARS, " ")
    return null_if_blank(collapse_spaces(visible))


def word_initcap(c: Column | str) -> Column:
    """Capitalise after every character that is neither letter nor digit."""
    words = F.regexp_extract_all(_col(c), F.lit(_WORD_RUN), F.lit(1))
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))),
        "",
    )


def is_placeholder(c: Column | str, tokens: Sequence[str] = PLACEHOLDER_TOKENS) -> Column:
    return F.upper(F.trim(_col(c))).isin(list(tokens))


def placeholder_to_null(
    c: Column | str, tokens: Sequence[str] = PLACEHOLDER_TOKENS, case: str | None = None
) -> Column:
    """Placeholder tokens to NULL, trim and squeeze, then initcap / upper / as is."""
    kept = F.when(~is_placeholder(c, tokens), _col(c))
    text = null_if_blank(collapse_spaces(kept))
    if case == "initcap":
        return word_initcap(text)
    if case == "upper":
        return F.upper(text)
    return text


def number_text(c: Column | str, tokens: Sequence[str] = PLACEHOLDER_TOKENS) -> Column:
    """P7 + P8: placeholder tokens to NULL and thousands separators removed, still text."""
    kept = F.when(~is_placeholder(c, tokens), _col(c))
    return null_if_blank(strip_thousands(F.trim(kept)))


def strip_thousands(c: Column | str) -> Column:
    """P8."""
    return F.replace(_col(c), F.lit(","), F.lit(""))


def upper_code(c: Column | str) -> Column:
    """P11."""
    return F.upper(F.trim(_col(c)))


def lower_name(c: Column | str) -> Column:
    """P11."""
    return F.lower(F.trim(_col(c)))


def category(c: Column | str) -> Column:
    """P25: closed-domain value, lower case, blank to NULL."""
    return null_if_blank(F.lower(F.trim(_col(c))))


def match_name(c: Column | str) -> Column:
    """Name used for matching: trimmed, upper case, double spaces halved once."""
    return F.replace(F.upper(strip_blanks(c)), F.lit("  "), F.lit(" "))


# Fixed value: the characters that Python counts as white space.
BLANK = r"[\s\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def strip_blanks(c: Column | str) -> Column:
    """Remove surrounding whitespace of any kind, Unicode blanks included."""
    return F.regexp_replace(_col(c), rf"^{BLANK}++|(?<!{BLANK}){BLANK}++\z", "")


def prefix_equals(code: Column | str, other: Column | str, length: int = 4) -> Column:
    """NULL on either side counts as no match."""
    return F.coalesce(F.substring(_col(code), 1, length) == _col(other), F.lit(False))


def has_pattern(c: Column | str, pattern: str, ignore_case: bool = True) -> Column:
    """NULL is no match."""
    regex = f"(?i){pattern}" if ignore_case else pattern
    return F.coalesce(_col(c).rlike(regex), F.lit(False))


def has_text(c: Column | str, part: str) -> Column:
    """Plain containment, NULL is no match."""
    return F.coalesce(_col(c).contains(part), F.lit(False))


def expand_abbreviation(c: Column | str, names: Mapping[str, str]) -> Column:
    """Full name for a known abbreviation, NULL for an unknown one."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(c))
