"""Rules that name likely semantic types from the look of a value, as a data table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kolumna.functions.text import is_alphabetic, is_digits

# Literals that stand for an empty cell, compared in lower case.
EMPTY_LITERALS = ["null", "-", "_", "0", "none", ""]

# Fixed values: (test of the lower-cased value, its arguments, types it adds).
RULES = [
    ("letters", 1, ["person_name (middle_initial)", "borough"]),
    ("letters", 2, ["color"]),
    ("digits", 5, ["zip_code"]),
    ("digits from", 3, ["city_agency", "street_number", "phone_number", "building_classification"]),
    ("digits from", 1, ["street_number"]),
    ("contains", ["ps ", "is ", "js ", "hs "], ["school_name"]),
    ("long, contains", ["llc", "inc", "co"], ["business_name"]),
    ("long, contains", ["http", "www", "org", "com"], ["website"]),
    ("digit first, long, contains", ["ave", "str"], ["address"]),
]
# Single letters add a type only when it is the column's own.
OWN_TYPE_ONLY = ("letters", 1)


def is_empty_literal(value: Column) -> Column:
    return value.isNull() | F.lower(value).isin(EMPTY_LITERALS)


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(word) for word in words])


def _fires(test: str, argument, text: Column) -> Column:
    long = F.length(text) >= 3
    if test == "letters":
        return (F.length(text) == argument) & is_alphabetic(text)
    if test == "digits":
        return (F.length(text) == argument) & is_digits(text)
    if test == "digits from":
        return (F.length(text) >= argument) & is_digits(text)
    if test == "contains":
        return _contains_any(text, argument)
    if test == "long, contains":
        return long & _contains_any(text, argument)
    return long & _contains_any(text, argument) & text.rlike(r"^\p{Nd}")


def rule_types(value: Column, column_type: Column, rules=RULES, own_type_only=OWN_TYPE_ONLY) -> Column:
    """The types that the rules name for a value; [] when none fires."""
    text = F.lower(value)
    nothing = F.array().cast("array<string>")
    found = []
    for test, argument, types in rules:
        named = F.array(*[F.lit(t) for t in types])
        if (test, argument) == own_type_only:
            named = F.when(column_type.isin(types), F.array(column_type)).otherwise(nothing)
        found.append(F.when(_fires(test, argument, text), named).otherwise(nothing))
    return F.array_distinct(F.concat(*found))
