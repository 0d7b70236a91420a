"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII letters, lower then upper (fixed values).
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def strip(s: Column) -> Column:
    """Trim any whitespace at both ends."""
    return F.regexp_replace(F.regexp_replace(s, r"^\s+", ""), r"\s+$", "")


# Two private-use characters and a space: starts a word for ``initcap`` (fixed value).
WORD_MARK = "\ue000\ue001 "


def title_case(s: Column) -> Column:
    """Upper-case the first letter of every letter run, lower-case the others.

    ``initcap`` starts words at spaces only, so every letter run is put behind a
    marked space first. Text that holds the mark itself is cut into runs instead.
    """
    marked = F.initcap(F.regexp_replace(s, r"(\p{L}+)", WORD_MARK + "$1"))
    runs = F.split(s, r"(?<=\P{L})(?=\p{L})|(?<=\p{L})(?=\P{L})")
    capital = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(F.contains(s, F.lit(WORD_MARK)), capital).otherwise(
        F.replace(marked, F.lit(WORD_MARK), F.lit(""))
    )


def swap_case(s: Column) -> Column:
    """Exchange upper and lower ASCII letters."""
    return F.translate(s, LOWER + UPPER, UPPER + LOWER)


def reverse_words(s: Column) -> Column:
    """Words in reverse order, single-spaced."""
    return F.array_join(F.reverse(F.split(strip(s), r"\s+")), " ")


def swap_pairs(s: Column) -> Column:
    """Exchange the characters of each adjacent pair; an odd last one stays."""
    return F.regexp_replace(s, r"(?s)(.)(.)", "$2$1")


def interchange(s: Column, a: int, b: int) -> Column:
    """Exchange the characters at two 0-based positions; shorter text is unchanged."""
    i, j = sorted((a, b))
    if i == j:
        return s
    char = lambda k: F.substring(s, k + 1, 1)
    swapped = F.concat(
        F.substring(s, 1, i), char(j), F.substring(s, i + 2, j - i - 1), char(i),
        F.substring(s, j + 2, 2**31 - 1),
    )
    return F.when(F.length(s) > j, swapped).otherwise(s)


def tokens(s: Column, separator: str = r"\s+") -> Column:
    """Split at a separator pattern."""
    return F.split(strip(s), separator)


def integer_tokens(s: Column) -> Column:
    """The whitespace-separated tokens made of digits only, as numbers; null beyond 38 digits."""
    found = F.regexp_extract_all(s, F.lit(r"(?<!\S)([0-9]+)(?!\S)"), F.lit(1))
    return F.transform(found, lambda w: w.try_cast("decimal(38,0)"))


def letter_tokens(s: Column) -> Column:
    """The whitespace-separated tokens made of letters only."""
    return F.regexp_extract_all(s, F.lit(r"(?<!\S)(\p{L}+)(?!\S)"), F.lit(1))
