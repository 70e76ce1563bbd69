"""Text normalisation and tokens as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accordant import policy

# Runs of two or more letters, digits or underscores in any script.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


# Every white-space character, ASCII separators included.
WHITE_SPACE = " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))


def normalize_match(c: Column | str) -> Column:
    """Matching form: null becomes the empty string, otherwise stripped and lower-cased."""
    return F.coalesce(F.lower(strip(c)), F.lit(""))


def normalize_evidence(c: Column | str) -> Column:
    """Evidence form: white space collapsed, lower-cased, empty becomes null."""
    folded = F.regexp_replace(_col(c).cast("string"), r"(?U)\s+", " ")
    return F.nullif(F.lower(F.trim(folded)), F.lit(""))


def alphanumeric_core(c: Column | str) -> Column:
    """Letters a-z and digits only (expects the evidence form)."""
    return F.regexp_replace(_col(c), "[^a-z0-9]", "")


def is_blank(c: Column | str) -> Column:
    """Null, or one of the texts that stand for "no value"."""
    return _col(c).isNull() | strip(c).isin(policy.BLANK_TEXTS)


def flag(condition: Column) -> Column:
    """1.0 or 0.0."""
    return F.when(condition, 1.0).otherwise(0.0)


def same_text(a: Column | str, b: Column | str) -> Column:
    """1.0 when both matching forms are equal (two missing values count as equal), else 0.0."""
    return flag(normalize_match(a) == normalize_match(b))


def block_key(state: Column | str, city: Column | str) -> Column:
    return F.concat(F.lower(_col(state)), F.lit("_"), F.lower(_col(city)))


def case_variant(c: Column | str, upper: Column) -> Column:
    return F.when(upper, F.upper(_col(c))).otherwise(F.lower(_col(c)))


def words(c: Column | str) -> Column:
    """Lower-cased tokens in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def unigrams_and_bigrams(tokens: Column) -> Column:
    """All tokens followed by all pairs of neighbouring tokens."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n),
        lambda first, second: F.concat(first, F.lit(" "), second),
    )
    return F.concat(tokens, pairs)


def pair_label(a: Column | str, b: Column | str) -> Column:
    """Display form of a source pair."""
    return F.concat(_col(a), F.lit(" ↔ "), _col(b))


def choose(c: Column, mapping: dict, default=None) -> Column:
    """Literal lookup; unmapped values give ``default``."""
    result = None
    for key, value in mapping.items():
        result = F.when(c == key, value) if result is None else result.when(c == key, value)
    return result.otherwise(F.lit(default))


def choose_column(c: Column, mapping: dict[str, Column]) -> Column:
    """The mapped column for the value of ``c``; unmapped values give null."""
    result = None
    for key, column in mapping.items():
        result = F.when(c == key, column) if result is None else result.when(c == key, column)
    return result
