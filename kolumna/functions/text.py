"""String functions as Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "0123456789"
# Runs of blanks as the shingle definition counts them: Unicode white space and the four
# ASCII separator characters.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def unchanged(text: Column) -> Column:
    return text


def lower(text: Column) -> Column:
    return F.lower(text)


def strip_symbols(text: Column) -> Column:
    """Delete ASCII punctuation and ASCII white space; other characters stay."""
    return F.translate(text, string.punctuation + string.whitespace, "")


def mask_digits(text: Column, mask: str = "*") -> Column:
    """Put ``mask`` in place of every ASCII digit."""
    return F.translate(text, DIGITS, mask * len(DIGITS))


def standard_form(text: Column) -> Column:
    """Lower case, without symbols, digits masked."""
    return mask_digits(strip_symbols(lower(text)))


def normal_forms(text: Column) -> list[Column]:
    """The four stages of staged matching, each more general than the one before."""
    letters = strip_symbols(text)
    lowered = strip_symbols(lower(text))
    return [text, letters, lowered, mask_digits(lowered)]


def shorter(left: Column, right: Column) -> Column:
    """The shorter string; the second one when both are equally long."""
    return F.when(F.length(left) < F.length(right), left).otherwise(right)


def shortest_word_length(text: Column) -> Column:
    """Length of the shortest piece between single blanks; empty pieces count."""
    return F.array_min(F.transform(F.split(text, " "), F.length))


def either_contains(left: Column, right: Column, form=unchanged) -> Column:
    return form(left).contains(form(right)) | form(right).contains(form(left))


def contained_in(left: Column, right: Column, form=unchanged) -> Column:
    """Is ``left`` a part of ``right``?"""
    return form(right).contains(form(left))


def within(distance: Column, limit: float) -> Column:
    return distance < limit


def shingles(text: Column, k: int) -> Column:
    """All substrings of ``k`` characters in order, after runs of blanks became one blank.

    A look-ahead visits every position in one pass, so the cost grows with the length of the text
    (``substring`` by position would walk from the start each time). The second look-ahead skips
    the inner half of characters that Java stores as two units.
    """
    window = r"(?s)(?=(.{%d}))(?![\x{DC00}-\x{DFFF}])" % k
    return F.regexp_extract_all(F.regexp_replace(text, BLANKS, " "), F.lit(window), F.lit(1))


def shingle_set(text: Column, k: int) -> Column:
    return F.array_distinct(shingles(text, k))


def set_jaccard_distance(left: Column, right: Column, k: int = 3) -> Column:
    """Jaccard distance of two strings over their shingle sets.

    Equal strings have distance 0. Strings shorter than ``k`` share nothing, nor do two strings
    without any shingle.
    """
    a, b = shingle_set(left, k), shingle_set(right, k)
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(left == right, 0.0).when(union == 0, 1.0).otherwise(1.0 - common / union)


def is_alphabetic(text: Column) -> Column:
    return text.rlike(r"^\p{L}+$")


def is_digits(text: Column) -> Column:
    return text.rlike(r"^\p{Nd}+$")
