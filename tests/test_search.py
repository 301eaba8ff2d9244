"""Nearest targets found with bounds: the same rows as the full comparison, from few pairs."""

from __future__ import annotations

import random
import re
import string
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from kolumna.operators import matching, nearest_search, semantics
from kolumna.operators.matching import STAGE_WEIGHTS

FIELDS = ["s_type", "target", "distance", "adjusted", "stage"]


def refs_of(spark, rows):
    return matching.reference(spark.createDataFrame(rows, "t string, v string, o int"), "t", "v", "o")


def strings_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")


def same_rows(a, b, keys):
    def key(r):
        return repr([r[c] for c in keys] + [r.s_type, r.target, round(r.distance, 9), round(r.adjusted, 9), r.stage])

    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def odd_text(rng):
    words = ["main", "Main", "street", "st.", "12", "99", "ave", "é", "x", "", "core subject", "aaaa", "aaaaaa", "AB-1", "ab1"]
    return rng.choice([" ", "", "-"]).join(rng.choice(words) for _ in range(rng.randint(0, 4)))


def test_equal_to_the_full_comparison(spark):
    rng = random.Random(4)
    targets = {(rng.choice("abc"), odd_text(rng)) for _ in range(150)}
    refs = refs_of(spark, [(t, v, rng.randint(1, 50)) for t, v in sorted(targets)])
    refs = spark.createDataFrame(refs.collect(), refs.schema)
    rows = strings_of(spark, [odd_text(rng) for _ in range(300)] + ["zzzz", "", None, "core subject 12", "core subject 12"])
    assert same_rows(nearest_search.nearest(rows, refs, ["k"]), matching.nearest(rows, refs, ["k"]), ["k"])


def test_groups(spark):
    rng = random.Random(9)
    refs = [refs_of(spark, [(rng.choice("ab"), odd_text(rng) + str(i), i) for i in range(20)]).withColumn("dataset", F.lit(g)) for g in "xyz"]
    refs = refs[0].unionByName(refs[1]).unionByName(refs[2])
    rows = strings_of(spark, [odd_text(rng) for _ in range(90)]).withColumn("dataset", F.get(F.array(*map(F.lit, "xyw")), F.col("k") % 3))
    refs = spark.createDataFrame(refs.collect(), refs.schema)
    ours = nearest_search.nearest(rows, refs, ["k", "dataset"], ["dataset"], stages=2)
    assert same_rows(ours, matching.nearest(rows, refs, ["k", "dataset"], ["dataset"], stages=2), ["k", "dataset"])
    assert ours.count() == 60


def test_no_targets(spark):
    rows = strings_of(spark, ["a"])
    assert nearest_search.nearest(rows, refs_of(spark, []), ["k"], stages=1).collect() == []
    assert nearest_search.nearest(rows.limit(0), refs_of(spark, [("a", "b", 1)]), ["k"], stages=1).collect() == []


def forms(text):
    strip = lambda s: s.translate({ord(c): None for c in string.punctuation + string.whitespace})
    lowered = strip(text.lower())
    return [text, strip(text), lowered, re.sub("[0-9]", "*", lowered)]


def grams_of(form):
    return {form[j : j + 3] for j in range(len(form) - 2)}


def plain_nearest(texts, targets):
    """By all shared shingles: (score, stage, target) of each text, and the pairs that share a shingle."""
    best, met = {}, 0
    all_forms = [forms(target) for target in targets]
    for stage, weight in enumerate(STAGE_WEIGHTS):
        postings, sizes = defaultdict(list), []
        for i, target_forms in enumerate(all_forms):
            grams = grams_of(target_forms[stage])
            sizes.append(len(grams))
            for g in grams:
                postings[g].append(i)
        for text in texts:
            if text in best and best[text][0] == 0:
                continue
            grams = grams_of(forms(text)[stage])
            common = Counter(i for g in grams for i in postings.get(g, ()))
            met += len(common)
            for i, c in common.items():
                score = (1 - c / (len(grams) + sizes[i] - c)) * weight
                best[text] = min(best.get(text, (9, 9, 9)), (round(score, 12), stage, i))
    return best, met


def test_a_hundred_thousand_targets(spark, monkeypatch):
    """Few of the pairs that share a shingle are compared: under a hundred for each string and form."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(4000)]
    targets = sorted({f"{rng.choice(words)} {rng.choice(words)} {rng.choice(['Street', 'Avenue', 'Road'])} {rng.randint(1, 99)}" for _ in range(100_200)})[:100_000]
    texts = []
    for target in rng.sample(targets, 40):
        at = rng.randrange(len(target))
        texts += [target, target[:at] + rng.choice("xyz") + target[at + 1 :], target.upper().replace(" ", "-")]
    texts = sorted(set(texts))
    counted = []
    original = nearest_search.pairs

    def counting(*args):
        found = original(*args)
        counted.append(found.count())
        return found

    monkeypatch.setattr(nearest_search, "pairs", counting)
    refs = spark.createDataFrame([("street", t, 1, i) for i, t in enumerate(targets)], "s_type string, target string, type_order int, target_order int")
    found = {r.text: r for r in nearest_search.nearest(strings_of(spark, texts), refs, ["text"]).collect()}
    answer, met = plain_nearest(texts, targets)
    for text in texts:
        score, stage, i = answer[text]
        assert (round(found[text].adjusted, 9), found[text].stage, found[text].target) == (round(score, 9), stage, targets[i])
    assert sum(counted) < 100 * 4 * len(texts) < met / 100, (sum(counted), met)


def test_names_that_differ_in_a_number(spark, monkeypatch):
    """All shingles they share are common ones: strings ask for subsets of them and meet no targets by a single one."""
    counted = []
    original = nearest_search.pairs

    def counting(*args):
        found = original(*args)
        counted.append(found.count())
        return found

    monkeypatch.setattr(nearest_search, "pairs", counting)
    refs = refs_of(spark, [("abc"[i % 3], f"Customer#{i:09d}", i) for i in range(1, 2001)] * 2 + [("c", "Customer", 0), ("a", "lie-1-2", 0)])
    refs = spark.createDataFrame(refs.collect(), refs.schema)
    texts = [f"Supplier-{i:06d}" for i in range(1, 2200, 23)]
    rows = strings_of(spark, texts)
    assert same_rows(nearest_search.nearest(rows, refs, ["k"]), matching.nearest(rows, refs, ["k"]), ["k"])
    assert sum(counted) == 0, counted


def test_short_and_long_ones_by_subsets_and_by_shingles(spark, monkeypatch):
    rng = random.Random(6)
    targets = {(rng.choice("abc"), odd_text(rng)) for _ in range(120)}
    refs = refs_of(spark, [(t, v, rng.randint(1, 50)) for t, v in sorted(targets)])
    refs = spark.createDataFrame(refs.collect(), refs.schema)
    rows = strings_of(spark, [odd_text(rng) for _ in range(150)] + ["", None])
    plain = matching.nearest(rows, refs, ["k"])
    for short, few in ((1, 400_000), (5, 0)):
        monkeypatch.setattr(nearest_search, "SHORT", short)
        monkeypatch.setattr(nearest_search, "FEW_SUBSETS", few)
        assert same_rows(nearest_search.nearest(rows, refs, ["k"]), plain, ["k"]), short


def plain_growth(spark, values, refs, **limits):
    rounds = 0
    while True:
        matches = matching.nearest(values, refs, ["value"], stages=1)
        grown = refs.sparkSession.createDataFrame(semantics.grown_reference(refs, matches, **limits).collect(), refs.schema)
        if grown.count() == refs.count():
            return refs, rounds
        refs, rounds = grown, rounds + 1


def test_growth_until_nothing_is_added(spark):
    """Values that reach each other by links: a plain loop needs three rounds and more, with the same targets."""
    chain = ["abcdefgh", "defghijk", "ghijklmn", "jklmnopq", "mnopqrst", "pqrstuvw", "zzz yyy", "zzz yyy xxx", "12 main street", "12 main st", "99 main str"]
    values = spark.createDataFrame([(v, v) for v in chain], "value string, text string")
    refs = refs_of(spark, [("letters", "abcdefg", 1), ("letters", "zzz", 2), ("street", "main street", 1)])
    refs = spark.createDataFrame(refs.collect(), refs.schema)
    for limits in ({"farthest": 0.8}, {"size": 4, "farthest": 0.9}):
        answer, rounds = plain_growth(spark, values, refs, **limits)
        found = semantics.grown_until_still(values, refs, stages=1, **limits)
        shown = [sorted((r.s_type, r.target, r.target_order) for r in df.collect()) for df in (found, answer)]
        assert shown[0] == shown[1]
        assert rounds >= (3 if "size" not in limits else 1)
