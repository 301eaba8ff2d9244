"""Worked examples and edge rows: strings, value types, metadata, profile."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kolumna.functions import rules
from kolumna.functions import text as tx
from kolumna.functions import value_types as vt
from kolumna.operators import cells as c
from kolumna.operators import itemsets, metadata, profile
from kolumna.plans import profile_report


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "value, kind, number",
    [
        ("1.5", "REAL", 1.5), (".5", "REAL", 0.5), ("-2.5e3", "REAL", -2500.0), ("$1,234.50", "REAL", 1234.5),
        ("0.0", "REAL", 0.0), ("1e5", "TEXT", None), ("1.", "TEXT", None), ("12", "INTEGER", 12.0),
        ("+3", "INTEGER", 3.0), ("-4", "INTEGER", -4.0), ("1,234", "INTEGER", 1234.0), ("$5", "INTEGER", 5.0),
        ("0", "INTEGER", 0.0), ("", "TEXT", None), ("-", "TEXT", None), ("+", "TEXT", None), ("$", "TEXT", None),
        (" 7 ", "INTEGER", 7.0), (None, None, None), ("2015-03-04", "TEXT", None),
    ],
)
def test_value_type(spark, value, kind, number):
    row = profile.with_types(spark.createDataFrame([("d", "c", value)], "dataset string, column_name string, value string")).first()
    assert (row.type, row.number) == (kind, number)


@pytest.mark.parametrize(
    "value, moment",
    [
        ("2015-03-04", "2015-03-04 00:00:00"), ("03/04/2015", "2015-03-04 00:00:00"), ("201911", "2019-11-01 00:00:00"),
        ("1849-12-31", None), ("2020-01-01", None), ("abc", None), ("2015", "2015-01-01 00:00:00"),
        ("20151103", "2015-11-03 00:00:00"), ("due 3/4/2015 noon", "2015-03-04 00:00:00"),
        ("March 4th", None), ("March 4, 2015", "2015-03-04 00:00:00"), ("4 Sept 2015", "2015-09-04 00:00:00"),
        ("03/04/2015 01:02:03 PM", "2015-03-04 13:02:03"), ("2015-03-04T05:06:07", "2015-03-04 05:06:07"),
        ("13/45/2015", None), ("12345", None), (None, None),
    ],
)
def test_dates(spark, value, moment):
    rows = spark.createDataFrame([("d", "o_orderdate", value)], "dataset string, column_name string, value string")
    row = profile.with_types(rows).first()
    assert (str(row.moment) if row.moment else None) == moment
    assert row.type == ("DATE/TIME" if moment else None)


def test_date_names(spark):
    names = ["Start_Date", "fiscal YEAR", "daytime", "Interval", "name"]
    found = [one(spark, name, vt.is_date_name) for name in names]
    assert found == [True, True, True, True, False]


def test_text_functions(spark):
    assert one(spark, "Core Subject 9,10\t!", tx.strip_symbols) == "CoreSubject910"
    assert one(spark, "a1-b22", tx.mask_digits) == "a*-b**"
    assert one(spark, "Ab 1,2", tx.standard_form) == "ab**"
    assert one(spark, "上海 市", tx.strip_symbols) == "上海市"
    assert one(spark, "a  bcd", tx.shortest_word_length) == 0
    assert one(spark, "ab  cd", lambda v: tx.shingles(v, 3)) == ["ab ", "b c", " cd"]
    assert one(spark, "ab", lambda v: tx.shingles(v, 3)) == []
    assert one(spark, "a😀bc", lambda v: tx.shingles(v, 3)) == ["a😀b", "😀bc"]
    assert one(spark, "x", lambda v: tx.shorter(v, F.lit("y"))) == "y"


@pytest.mark.parametrize("a, b, distance", [("", "", 0), ("上海", "上海市", 1), ("ab", "ab", 0), ("   ", "  ", 1), ("abcd", "abce", 2 / 3)])
def test_jaccard_short_rule(spark, a, b, distance):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        tx.set_jaccard_distance(F.col("a"), F.col("b")).alias("x")
    )
    assert row.first().x == pytest.approx(distance)


@pytest.mark.parametrize(
    "value, own, types",
    [
        ("K", "borough", ["borough"]), ("K", "city", []), ("BK", "city", ["color"]),
        ("10001", "city", ["zip_code", "city_agency", "street_number", "phone_number", "building_classification"]),
        ("12", "city", ["street_number"]), ("PS 41", "city", ["school_name"]), ("Acme LLC", "city", ["business_name"]),
        ("www.a.org", "city", ["website"]), ("1 Main Str", "city", ["address"]), ("Main Str", "city", []),
        ("a.com", "city", ["business_name", "website"]), ("ave", "city", []),
    ],
)
def test_rules(spark, value, own, types):
    assert one(spark, value, lambda v: rules.rule_types(v, F.lit(own))) == types


@pytest.mark.parametrize("value, empty", [(None, True), ("NULL", True), ("-", True), ("_", True), ("0", True), ("None", True), ("", True), ("x", False)])
def test_empty_literals(spark, value, empty):
    assert one(spark, value, rules.is_empty_literal) is empty


CELLS = [("d", "c", v) for v in ["b", "b", "a", "a", "x->1", None, "NaN", "1", "2.5"]] + [("d", "none", None)] * 2


@pytest.fixture(scope="module")
def frequencies(spark):
    return c.value_frequencies(spark.createDataFrame(CELLS, "dataset string, column_name string, value string"))


def test_counts(frequencies):
    rows = {r.column_name: r for r in metadata.cell_counts(frequencies).collect()}
    assert (rows["c"].number_distinct_values, rows["c"].number_non_empty_cells, rows["c"].number_empty_cells) == (6, 7, 2)
    assert (rows["none"].number_distinct_values, rows["none"].number_empty_cells) == (0, 2)
    assert metadata.cell_count_errors(metadata.cell_counts(frequencies)).count() == 0


def test_records(frequencies):
    rows = {r.column_name: r for r in profile_report.column_records(frequencies).collect()}
    assert rows["c"].frequent_values == ["a", "b", "1", "2.5", "NaN"]
    assert rows["none"].frequent_values == [] and rows["none"].itemset == "" and rows["none"].data_types is None
    types = {t.type: t for t in rows["c"].data_types}
    assert rows["c"].itemset == "-REAL--INTEGER--TEXT-"
    assert types["TEXT"].shortest_values == ["a", "b", "NaN", "x->1"]
    assert types["TEXT"].longest_values == ["x->1", "NaN", "a", "b"]
    assert types["TEXT"].average_length == pytest.approx((4 + 4 + 3) / 6)
    assert types["INTEGER"].max_value == 1 and types["REAL"].stddev == 0


def test_weighted_deviation_is_stable(spark):
    values = [1e12 + i % 7 for i in range(500)]
    rows = [("d", "c", f"{v:.1f}") for v in values]
    freq = c.value_frequencies(spark.createDataFrame(rows, "dataset string, column_name string, value string"))
    stats = profile.real_stats(profile.with_types(freq)).first()
    mean = sum(v - 1e12 for v in values) / 500
    assert stats.stddev == pytest.approx((sum((v - 1e12 - mean) ** 2 for v in values) / 500) ** 0.5, rel=1e-6)


def test_headers_and_mixed_types(spark):
    df = spark.sql("select 1 as `a.b`, 2.5d as `with blank`, true as t, timestamp'2015-01-01' as w, cast(null as int) as n")
    rows = {(r.column_name, r.value) for r in c.cells(df, "d").collect()}
    assert rows == {("a.b", "1"), ("with blank", "2.5"), ("t", "true"), ("w", "2015-01-01 00:00:00"), ("n", None)}


def test_itemset_ties(spark):
    total = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "itemset string, n bigint")
    assert {r.itemset for r in itemsets.most_frequent_itemsets(total).collect()} == {"a", "b"}


def test_long_integers(spark):
    """Exact extremes and totals of numbers of up to 80 digits against Python's integers."""
    import random

    from kolumna.operators.cells import cells, value_frequencies
    from kolumna.operators.long_integers import long_integer_stats
    from kolumna.operators.profile import with_types

    rng = random.Random(6)
    columns = {"a": [], "b": [], "c": [], "d": []}
    for _ in range(300):
        columns["a"].append(rng.randint(-(10**60), 10**60))
        columns["b"].append(-rng.randint(0, 10 ** rng.randint(1, 80)))
        columns["c"].append(rng.choice([0, 7, 10**59, -(10**59), 10**59 + 1]))
        columns["d"].append(rng.choice([5, 999999999, 1000000000, 10**17 + 3]))
    spell = [lambda x: str(x), lambda x: f"{x:,}", lambda x: f"+{x}" if x >= 0 else f"-00{-x}", lambda x: "-0" if x == 0 else str(x)]
    rows = [tuple(spell[i % 4](columns[name][i]) for name in columns) for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in columns))
    found = {r.column_name: r for r in long_integer_stats(with_types(value_frequencies(cells(df, "t")))).collect()}
    for name, values in columns.items():
        r = found[name]
        assert (r["count"], int(r.max_value), int(r.min_value), int(r.total)) == (300, max(values), min(values), sum(values)), name
        assert r.max_value == str(max(values)) and r.total == str(sum(values))
        assert abs(r.mean - sum(values) / 300) <= 1e-12 * abs(sum(values) / 300)


def test_one_date_order_for_a_column(spark):
    from kolumna.operators.cells import cells, value_frequencies
    from kolumna.operators.profile import date_orders, with_types

    rows = [("13/04/2015", "04/13/2015", "03/04/2015"), ("03/04/2015", "03/04/2015", "03/04/2015"), ("25/12/98", "12/25/98", "x"), ("04/25/2015", "25/04/2015", None), ("31-1-2014", "1-31-2014", None)]
    df = spark.createDataFrame(rows, "eu_date string, us_date string, any_date string")
    frequencies = value_frequencies(cells(df, "t"))
    assert {r.column_name: r.day_first for r in date_orders(frequencies).collect()} == {"eu_date": True, "us_date": False, "any_date": False}
    for by_column in (False, True):
        found = {(r.column_name, r.value): r.moment and str(r.moment.date()) for r in with_types(frequencies, order_by_column=by_column).collect()}
        assert found["eu_date", "03/04/2015"] == ("2015-04-03" if by_column else "2015-03-04")
        assert found["us_date", "03/04/2015"] == found["any_date", "03/04/2015"] == "2015-03-04"
        assert found["eu_date", "13/04/2015"] == found["us_date", "04/13/2015"] == "2015-04-13"
        assert found["eu_date", "04/25/2015"] == found["us_date", "25/04/2015"] == "2015-04-25"
        assert found["eu_date", "25/12/98"] == found["us_date", "12/25/98"] == "1998-12-25"
