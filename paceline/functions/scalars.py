"""Scalar column expressions. All are native: no Python runs per row."""

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a row counts as a finish when its status contains one of these.
FINISHED = "Finished|Lap|Lapped"

ASCII_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _col(c):
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def letter_tables():
    """(one, many): non-ASCII characters whose compatibility decomposition holds
    exactly one ASCII letter, and those that hold several, with those letters."""
    one, many = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.decomposition(char):
            letters = "".join(c for c in unicodedata.normalize("NFKD", char) if c in ASCII_LETTERS)
            if len(letters) == 1:
                one[char] = letters
            elif letters:
                many[char] = letters
    return one, many


def letters_only(text) -> Column:
    """Lower-case ASCII letters of a text; accents are stripped, the rest is dropped."""
    one, many = letter_tables()
    text = _col(text)
    single = F.translate(text, "".join(one), "".join(one.values()))
    spelled = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    characters = F.transform(F.split(single, ""), lambda c: F.coalesce(spelled[c], c))
    has_many = F.length(F.translate(text, "".join(many), "")) < F.length(text)
    plain = F.when(has_many, F.array_join(characters, "")).otherwise(single)
    # most names are ASCII and need neither table
    plain = F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(plain)
    return F.lower(F.regexp_replace(plain, "[^a-zA-Z]", ""))


def entity_key(given, family) -> Column:
    """``g_family`` from two names, null when either has no letters."""
    names = F.concat(letters_only(given), F.lit("_"), letters_only(family))
    # one expression, so that the cleaning above is evaluated once
    return F.nullif(F.regexp_replace(names, "^(?:([a-z])[a-z]*(_[a-z]+)|.*)$", "$1$2"), F.lit(""))


def full_name(given, family) -> Column:
    return F.trim(F.concat(or_empty(given), F.lit(" "), or_empty(family)))


def or_empty(text) -> Column:
    return F.coalesce(_col(text), F.lit(""))


def title_key(key) -> Column:
    """``m_de_x`` -> ``M_De_X``."""
    return F.array_join(F.transform(F.split(_col(key), "_"), F.initcap), "_")


def number(text) -> Column:
    """Text to double; what is not a number becomes null."""
    value = _col(text).try_cast("double")
    return F.when(~F.isnan(value), value)


def text_number(text) -> Column:
    """``number`` of a column of texts. Without a digit, or the n of nan and inf, a text is no number and is not tried: failing costs far more."""
    return F.when(_col(text).rlike("[0-9nN]"), number(text))


def finite_or_null(value) -> Column:
    """NaN to null, so that aggregates skip it."""
    return F.when(~F.isnan(_col(value)), _col(value))


def without_nan(df: DataFrame) -> DataFrame:
    """The frame with NaN as null in every column of floating-point numbers."""
    numbers = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite_or_null(c) for c in numbers}) if numbers else df


def seconds(duration) -> Column:
    """Day-time interval to seconds."""
    return _col(duration).cast("interval second").cast("decimal(18,6)").cast("double")


def list_mean(text) -> Column:
    """Mean of a bracketed list such as ``[1.0, 2.5]`` held in a string.

    Blank items are skipped; one bad item makes the result null.
    """
    items = F.split(F.regexp_replace(_col(text), r"[\[\]]", ""), ",")
    numbers = F.transform(F.filter(items, lambda x: F.trim(x) != ""), number)
    total = F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(numbers) > 0, total / F.size(numbers))


def finished(status) -> Column:
    """Whether a status text is a finish; null is not."""
    return F.coalesce(_col(status).rlike(FINISHED), F.lit(False))


def name_matches(name, pattern) -> Column:
    """Case-insensitive regular-expression search; null does not match."""
    return F.coalesce(_col(name).rlike(f"(?iu){pattern}"), F.lit(False))


def at_zero(value) -> Column:
    """Clip below at zero."""
    value = _col(value)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def before(season, seq, cutoff) -> Column:
    """(season, seq) strictly before the cutoff pair."""
    year, rnd = cutoff
    return (_col(season) < year) | ((_col(season) == year) & (_col(seq) < rnd))


def outside(season, first, last) -> Column:
    return ~_col(season).between(first, last)
