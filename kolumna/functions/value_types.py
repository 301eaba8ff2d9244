"""What a cell's text looks like: REAL, INTEGER, DATE/TIME or TEXT."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

REAL, INTEGER, DATE, TEXT = "REAL", "INTEGER", "DATE/TIME", "TEXT"

# Words that mark a column name as date-like.
DATE_WORDS = ["date", "period", "year", "month", "day", "time", "interval"]

# A real number needs a point and digits after it; an integer needs a digit.
REAL_SHAPE = r"^[-+]?[0-9]*\.[0-9]+([eE][-+]?[0-9]+)?$"
INTEGER_SHAPE = r"^\s*[-+]?[0-9]+\s*$"

# Shapes of dates and the pattern each is read with. ISO text is cast. A shape of digits alone must
# be the whole value; the others may stand inside other text.
ISO = "cast"
DATE_SHAPES = [
    (r"\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?", ISO),
    (r"\d{4}-\d{1,2}-\d{1,2}", ISO),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]", "M/d/yyyy h:mm:ss a"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}", "M/d/yyyy H:mm:ss"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}", "M/d/yyyy H:mm"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "M-d-yyyy"),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", "M.d.yyyy"),
    (r"\d{4}\.\d{1,2}\.\d{1,2}", "yyyy.M.d"),
    (r"(?:%(month)s) \d{1,2} \d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]", "MMM d yyyy h:mm:ss a"),
    (r"(?:%(month)s) \d{1,2} \d{4} \d{1,2}:\d{2} [AaPp][Mm]", "MMM d yyyy h:mm a"),
    (r"(?:%(month)s) \d{1,2} \d{4} \d{1,2}:\d{2}:\d{2}", "MMM d yyyy H:mm:ss"),
    (r"(?:%(month)s) \d{1,2} \d{4} \d{1,2}:\d{2}", "MMM d yyyy H:mm"),
    (r"(?:%(month)s) \d{1,2} \d{4}", "MMM d yyyy"),
    (r"\d{1,2} (?:%(month)s) \d{4}", "d MMM yyyy"),
    (r"\d{1,2}-(?:%(month)s)-\d{4}", "d-MMM-yyyy"),
    (r"\d{1,2}-(?:%(month)s)-\d{2}", "d-MMM-yy"),
    (r"\d{1,2} (?:%(month)s) \d{2}", "d MMM yy"),
    (r"(?:%(month)s) \d{4}", "MMM yyyy"),
    (r"(?:%(month)s)-\d{4}", "MMM-yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]", "M/d/yy h:mm:ss a"),
    (r"\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}", "M/d/yy H:mm"),
    (r"\d{1,2}/\d{1,2}/\d{2}", "M/d/yy"),
    (r"\d{1,2}-\d{1,2}-\d{2}", "M-d-yy"),
    (r"\d{4}-\d{1,2}", "yyyy-M"),
    (r"\d{1,2}/\d{4}", "M/yyyy"),
]
# Two-digit years from this one on belong to the century before.
PIVOT_YEAR = 2070
DIGIT_SHAPES = [(r"\d{8}", "yyyyMMdd"), (r"\d{6}", "yyyyMM"), (r"\d{4}", "yyyy")]
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"


def is_date_name(column_name: Column) -> Column:
    lowered = F.lower(column_name)
    return reduce(lambda a, b: a | b, [lowered.contains(word) for word in DATE_WORDS])


def plain_number(text: Column) -> Column:
    """Without thousands separators and currency signs."""
    return F.when(text.contains(",") | text.contains("$"), F.translate(text, ",$", "")).otherwise(text)


def is_real(text: Column) -> Column:
    return plain_number(text).rlike(REAL_SHAPE)


def is_integer(text: Column) -> Column:
    return plain_number(text).rlike(INTEGER_SHAPE)


def date_part(text: Column) -> Column:
    """The first date-shaped part of a text, month names cut to three letters; '' if none."""
    tidy = F.regexp_replace(F.lower(text), rf"\b({MONTHS})[a-z]*\.?,?", "$1")
    tidy = F.regexp_replace(tidy, r"(\d),(?= \d{4})", "$1")
    inside = "|".join(shape % {"month": MONTHS} for shape, _ in DATE_SHAPES)
    alone = "|".join(shape for shape, _ in DIGIT_SHAPES)
    part = rf"(?:(?<!\d)(?:{inside.replace('[ T]', '[ t]')})(?!\d))|(?:^\s*(?:{alone})\s*$)"
    return F.trim(F.regexp_extract(tidy, part, 0))


def order_vote(text: Column) -> Column:
    """1 if a date can only be read day first, -1 if only month first, 0 if it does not tell."""
    def vote(part: Column) -> Column:
        first, second = (F.regexp_extract(part, r"^(\d{1,2})[/.-](\d{1,2})[/.-]\d{2}", i).try_cast("int") for i in (1, 2))
        day, month = (first > 12) & (second <= 12), (second > 12) & (first <= 12)
        return F.when(day, 1).when(month, -1).otherwise(0)

    return once(date_part(text), vote)


def _parsed(part: Column, pattern: str, day_first: Column | None) -> Column:
    """Month first, or with ``day_first`` the day, and the other order where there is no such month; two-digit years
    as people mean them."""
    value = F.try_to_timestamp(part, F.lit(pattern))
    if pattern[:1] == "M" and pattern[1:4] in ("/d/", "-d-", ".d."):
        other = F.try_to_timestamp(part, F.lit("d" + pattern[1] + "M" + pattern[3:]))
        value = F.coalesce(value, other) if day_first is None else F.when(day_first, F.coalesce(other, value)).otherwise(F.coalesce(value, other))
    if "yyyy" in pattern:
        return value
    return once(value, lambda v: F.when(F.year(v) >= PIVOT_YEAR, v - F.expr("interval 100 years")).otherwise(v))


def read_date(part: Column, day_first: Column | None = None) -> Column:
    """Read a date-shaped part: its shape picks the one pattern that is tried."""
    chosen = F.when(part == "", F.lit(None).cast("timestamp"))
    for shape, pattern in DATE_SHAPES + DIGIT_SHAPES:
        whole = "^(?:" + (shape % {"month": MONTHS}).replace("[ T]", "[ t]") + ")$"
        value = (
            F.replace(part, F.lit("t"), F.lit(" ")).try_cast("timestamp")
            if pattern == ISO
            else _parsed(part, pattern, day_first)
        )
        chosen = chosen.when(part.rlike(whole), value)
    return chosen


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it.

    Filters on a typed column are pushed below the projection that made it, which would otherwise
    repeat the whole expression for each mention.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def date(text: Column, day_first: Column | None = None) -> Column:
    """The moment a text names, or null. Plain ISO text takes the short way."""
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}:\d{2}(?:\.\d{1,9})?)?$")
    return F.when(iso, text.try_cast("timestamp")).otherwise(once(date_part(text), lambda part: read_date(part, day_first)))


def in_years(moment: Column, first_year: int, last_year: int) -> Column:
    return F.year(moment).between(first_year, last_year)
