"""Edit and alignment scores of two short strings as folds over their characters.

A row of the usual table is a set of bits, one for each character of the left string, in words of
WORD_BITS: where the values of the row rise or fall by one. A whole row is then computed by a few
operations on each word, so that a pair costs one length, and the other only in words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of the left string in a word: a sum of two words with a carry stays within a long.
WORD_BITS = 60
_ALL = (1 << WORD_BITS) - 1


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _masks(text: Column) -> Column:
    """A map from (word, character) to the bits of its places in ``text``."""
    places = F.transform(
        _characters(text),
        lambda c, i: F.struct(
            F.concat(F.floor(i / WORD_BITS).cast("string"), c).alias("key"), F.call_function("shiftleft", F.lit(1).cast("long"), (i % WORD_BITS)).alias("bit")
        ),
    )

    def grouped(ordered: Column) -> Column:
        n = F.size(ordered)
        first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(ordered, i)["key"] != F.get(ordered, i - 1)["key"]))
        return _let(first, lambda starts: F.map_from_arrays(
            F.transform(starts, lambda i: F.get(ordered, i)["key"]),
            F.transform(starts, lambda i, k: F.aggregate(
                F.slice(ordered, i + 1, F.coalesce(F.get(starts, k + 1), n) - i), F.lit(0).cast("long"), lambda bits, x: bits + x["bit"]
            )),
        ))

    return _let(F.array_sort(places), grouped)


def _words(text: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((F.length(text) - 1) / WORD_BITS).cast("int"))


def _mask(masks: Column, word: Column, c: Column) -> Column:
    return F.coalesce(F.try_element_at(masks, F.concat(word.cast("string"), c)), F.lit(0).cast("long"))


def _not(bits: Column) -> Column:
    return bits.bitwiseXOR(F.lit(_ALL))


def _carry(total: Column) -> Column:
    return F.shiftright(total, WORD_BITS)


def _cut(bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(_ALL))


def _shifted(bits: Column, carry: Column) -> Column:
    """All bits one place up, with ``carry`` as the lowest; the highest is beyond the word."""
    return F.shiftleft(bits, 1).bitwiseOR(carry)


def common_subsequence_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence.

    A bit is 0 where a row of the table rises. A character of the right string moves the lowest 1 of each run
    of bits down to its next match, which an addition does for all runs at once.
    """
    def row(masks: Column, words: Column, before: Column, c: Column) -> Column:
        def step(done: Column, word: Column) -> Column:
            def moved(v: Column) -> Column:
                return _let(_mask(masks, word, c), lambda m: _let(
                    v + v.bitwiseAND(m) + done["carry"],
                    lambda total: F.struct(
                        F.concat(done["row"], F.array(_cut(total).bitwiseOR(v.bitwiseAND(_not(m))))).alias("row"), _carry(total).alias("carry")
                    ),
                ))

            return _let(F.get(before, word), moved)

        none = F.struct(F.array().cast("array<bigint>").alias("row"), F.lit(0).cast("long").alias("carry"))
        return F.aggregate(words, none, step, lambda done: done["row"])

    def folded(masks: Column, words: Column) -> Column:
        start = F.transform(words, lambda _: F.lit(_ALL))
        last = F.aggregate(_characters(right), start, lambda before, c: row(masks, words, before, c))
        return F.aggregate(last, F.lit(0), lambda n, bits: n + F.bit_count(_not(bits)))

    return F.when((left == "") | (right == ""), 0).otherwise(_let(_masks(left), lambda masks: _let(_words(left), lambda words: folded(masks, words))))


def alignment_distance(left: Column, right: Column) -> Column:
    """Optimal string alignment: edits and swaps of neighbours, no part edited twice.

    Against an empty string it is the length of the other. ``up`` and ``down`` are the places where a column of
    the table rises and falls, ``same`` those where its diagonal does not, ``seen`` the places of the last character.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    last = (F.length(left) - 1).cast("int")
    top = F.call_function("shiftleft", one, last % WORD_BITS)

    def step(masks: Column, before: Column, c: Column, done: Column, word: Column) -> Column:
        old = F.get(before, word)

        def found(m: Column) -> Column:
            swaps = _not(old["same"]).bitwiseAND(m)
            swapped = _cut(_shifted(swaps, done["swap"])).bitwiseAND(old["seen"])
            total = m.bitwiseAND(old["up"]) + old["up"] + done["add"]
            same = _cut(total).bitwiseXOR(old["up"]).bitwiseOR(m).bitwiseOR(old["down"]).bitwiseOR(swapped)
            return _let(F.struct(total.alias("total"), same.alias("same"), swaps.alias("swaps")), lambda x: rows(m, x))

        def rows(m: Column, x: Column) -> Column:
            rises = old["down"].bitwiseOR(_not(x["same"].bitwiseOR(old["up"])))
            falls = x["same"].bitwiseAND(old["up"])
            return _let(F.struct(rises.alias("rises"), falls.alias("falls")), lambda y: out(m, x, y))

        def out(m: Column, x: Column, y: Column) -> Column:
            rises, falls = _shifted(y["rises"], done["rise"]), _shifted(y["falls"], done["fall"])
            is_last = word == F.floor(last / WORD_BITS)
            change = F.when(is_last & (y["rises"].bitwiseAND(top) != 0), 1).when(is_last & (y["falls"].bitwiseAND(top) != 0), -1).otherwise(0)
            columns = F.struct(
                _cut(falls).bitwiseOR(_not(x["same"].bitwiseOR(_cut(rises)))).alias("up"), _cut(rises).bitwiseAND(x["same"]).alias("down"),
                x["same"].alias("same"), m.alias("seen"),
            )
            return F.struct(
                F.concat(done["row"], F.array(columns)).alias("row"), (done["distance"] + change).alias("distance"), _carry(x["total"]).alias("add"),
                F.shiftright(x["swaps"], WORD_BITS - 1).alias("swap"), _carry(rises).alias("rise"), _carry(falls).alias("fall"),
            )

        return _let(_mask(masks, word, c), found)

    def next_row(masks: Column, words: Column, state: Column, c: Column) -> Column:
        empty = F.filter(state["row"], lambda _: F.lit(False))
        begin = F.struct(
            empty.alias("row"), state["distance"].alias("distance"), zero.alias("add"), zero.alias("swap"), one.alias("rise"), zero.alias("fall")
        )
        return F.aggregate(
            words, begin, lambda done, word: step(masks, state["row"], c, done, word), lambda done: F.struct(done["row"].alias("row"), done["distance"].alias("distance"))
        )

    def folded(masks: Column, words: Column) -> Column:
        columns = F.transform(words, lambda _: F.struct(F.lit(_ALL).alias("up"), zero.alias("down"), zero.alias("same"), zero.alias("seen")))
        start = F.struct(columns.alias("row"), F.length(left).alias("distance"))
        return F.aggregate(_characters(right), start, lambda state, c: next_row(masks, words, state, c), lambda state: state["distance"])

    scored = _let(_masks(left), lambda masks: _let(_words(left), lambda words: folded(masks, words)))
    return F.when(left == "", F.length(right)).when(right == "", F.length(left)).otherwise(scored)


# From which Jaro similarity on a common prefix counts, and its largest weight.
PREFIX_THRESHOLD = 0.7
PREFIX_WEIGHT = 0.1


def jaro_winkler(left: Column, right: Column, threshold: float = PREFIX_THRESHOLD) -> Column:
    """Jaro–Winkler similarity; the common prefix counts in full, with weight at most 1 / longer length."""
    swap = F.length(left) > F.length(right)
    short = F.when(swap, right).otherwise(left)
    long = F.when(swap, left).otherwise(right)
    size0, size1 = F.length(short), F.length(long)
    reach = F.greatest(F.floor(size1 / 2 - 1), F.lit(0)).cast("int")

    def take(taken: Column, i: Column) -> Column:
        c = F.substring(short, i + 1, F.lit(1))
        window = F.sequence(F.greatest(i - reach, F.lit(0)), F.least(i + reach, size1 - 1))
        free = F.filter(
            window, lambda x: (F.substring(long, x + 1, F.lit(1)) == c) & ~F.array_contains(taken["at"], x)
        )
        hit = F.when(i - reach < size1, F.get(free, F.lit(0)))
        return F.when(
            hit.isNotNull(),
            F.struct(F.concat(taken["at"], F.array(hit)).alias("at"), F.concat(taken["from"], F.array(i)).alias("from")),
        ).otherwise(taken)

    none = F.array().cast("array<int>")
    matched = F.aggregate(
        F.sequence(F.lit(0), F.greatest(size0 - 1, F.lit(0))), F.struct(none.alias("at"), none.alias("from")), take
    )

    def score(m: Column) -> Column:
        count = F.size(m["at"])
        inner = F.zip_with(
            m["from"],
            F.sort_array(m["at"]),
            lambda i, x: F.when(F.substring(short, i + 1, F.lit(1)) != F.substring(long, x + 1, F.lit(1)), 1).otherwise(0),
        )
        half = F.floor(F.aggregate(inner, F.lit(0), lambda s, x: s + x) / 2)
        jaro = (count / size0 + count / size1 + (count - half) / count) / 3
        differ = F.filter(
            F.sequence(F.lit(1), size0), lambda i: F.substring(short, i, F.lit(1)) != F.substring(long, i, F.lit(1))
        )
        prefix = F.coalesce(F.get(differ, F.lit(0)) - 1, size0)
        raised = jaro + F.least(F.lit(PREFIX_WEIGHT), 1 / size1) * prefix * (1 - jaro)
        return F.when(count == 0, 0.0).otherwise(F.when(jaro > threshold, raised).otherwise(jaro))

    scored = F.get(F.transform(F.array(matched), score), F.lit(0))
    return F.when(left == right, 1.0).when((left == "") | (right == ""), 0.0).otherwise(scored)
