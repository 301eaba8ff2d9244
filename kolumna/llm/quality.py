"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolumna.llm.common import BLANKS, sealed
from kolumna.operators.steps import computed

SYMBOLS = "#*$%&|<>"

#: Frequent function words, four languages.
STOP_WORDS = (
    "the of and to in is that for it was on with be as at by this are from or",
    "der die das und in den von zu mit ist des im nicht ein eine auf für sich dem als",
    "le la les de des et en un une que est dans pour qui pas sur au du avec il",
    "el la los las de que y en un una es por con no para del se al lo como",
)

#: (measure, least, most): a row passes if every measure lies within; None leaves a side open. A
#: measure without a value (a ratio of nothing) passes.
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 20, None),
    ("mean_word_chars", 2, 20),
    ("symbols_per_word", None, 0.3),
    ("letter_words_ratio", 0.6, None),
    ("stop_word_ratio", 0.02, None),
    ("capital_words_ratio", None, 0.7),
    ("dup_lines_ratio", None, 0.5),
    ("bullet_lines_ratio", None, 0.9),
    ("ellipsis_lines_ratio", None, 0.5),
)

#: The base: at least this many words, and at most this share (percent) of them in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8

_WORD = "[^\\x20\\x09-\\x0D]"


def repeated_words(words: Column, size: int) -> Column:
    """How many of ``words`` lie in windows of ``size`` words that occur twice or more, the first included.

    Windows are compared by a 64-bit hash. Only a text with an equal pair sorts its windows; starts
    of repeated ones then cover min(size, distance to the next start) words each.
    """
    hashes = F.when(
        F.size(words) >= size,
        F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size))),
    ).otherwise(F.array().cast("array<bigint>"))
    return _bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h, size)))


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column, size: int) -> Column:
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = F.transform(
            s,
            lambda x, k: F.when(
                F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)), x["i"]
            ),
        )
        return F.sort_array(F.filter(same, lambda i: i.isNotNull()))

    def width(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1), i + size) - i)),
            F.lit(0), lambda total, n: total + n,
        )

    return _bind(ordered, lambda s: _bind(starts(s), width))


#: Counts and ratios of a text, in the order in which they follow its columns.
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "letter_words_ratio", "stop_word_ratio", "capital_words_ratio",
    "bullet_lines_ratio", "ellipsis_lines_ratio", "mean_word_chars", "symbols_per_word", "dup_lines_ratio",
]


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the measures of each whole text; null counts as empty.

    Columns of ``docs`` with the name of a measure are replaced.
    """
    docs, names, opened = sealed(docs, *MEASURES)
    text = F.coalesce(F.col(names[text_column]).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_WORD))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    df = computed(docs, __text=text, __words=words, __lines=lines)
    t, w, n_lines = F.col("__text"), F.col("__words"), F.size("__lines")
    n = F.size(w)
    stop = sorted({word for line in STOP_WORDS for word in line.split()})
    plain = lambda x: F.lower(F.regexp_replace(x, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))
    some = lambda array, test: F.size(F.filter(array, test))
    per = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    counted = {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (n_lines - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeated_words(w, WINDOW).cast("long"),
        "letter_words_ratio": per(some(w, lambda x: x.rlike("\\p{L}")), n),
        "stop_word_ratio": per(some(w, lambda x: plain(x).isin(stop)), n),
        "capital_words_ratio": per(some(w, lambda x: x.rlike("\\p{Lu}") & ~x.rlike("\\p{Ll}") & (F.length(x) > 1)), n),
        "bullet_lines_ratio": per(some(F.col("__lines"), lambda x: x.rlike("^\\s*[-*•‣●]")), n_lines),
        "ellipsis_lines_ratio": per(some(F.col("__lines"), lambda x: x.rlike("(\\.\\.\\.|…)\\s*$")), n_lines),
    }
    df = computed(df, **counted)
    ratios = {
        "mean_word_chars": per(F.col("word_chars"), F.col("n_words")), "symbols_per_word": per(F.col("n_symbols"), F.col("n_words")),
        "dup_lines_ratio": per(F.col("n_dup_lines"), n_lines),
    }
    return opened(df.withColumns(ratios), *MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def passes(rules=RULES) -> Column:
    """The table as one expression."""
    verdict = F.lit(True)
    for measure, least, most in rules:
        for bound in ([F.col(measure) >= least] if least is not None else []) + ([F.col(measure) <= most] if most is not None else []):
            verdict = verdict & F.coalesce(bound, F.lit(True))
    return verdict


def judged(docs: DataFrame, rules=RULES, text_column: str = "text") -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``.

    A null or blank text has no words and fails. Ratios of nothing pass their rule. Repeated rows are
    judged alike, an empty table stays empty, any length is read whole.
    """
    df = measures(docs.drop("base_failed", "kept"), text_column).withColumn("base_failed", base_failed())
    return df.withColumn("kept", ~F.col("base_failed") & passes(rules))


def verdict_sql() -> str:
    """The query's columns for ``documents`` in SQL."""
    stop = ", ".join(f"'{word}'" for word in sorted({word for line in STOP_WORDS for word in line.split()}))
    plain = "lower(regexp_replace(x, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g'))"
    tests = " and ".join(
        f"coalesce({measure} {sign} {bound}, true)" for measure, least, most in RULES for sign, bound in ((">=", least), ("<=", most)) if bound is not None
    )
    return f"""
with texts as (
    select doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from (select doc_id, coalesce(text, '') as t from documents)
),
windows as (
    select doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') as w
    from (select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from texts where len(words) >= {WINDOW})
),
repeated as (select doc_id, i from windows qualify count(*) over (partition by doc_id, w) > 1),
covered as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + {WINDOW})) as j from repeated) group by doc_id),
counted as (
    select doc_id, words, lines, len(words) as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
        length(t) - length(translate(t, '{SYMBOLS}', '')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(n, 0) as n_repeat_words
    from texts left join covered using (doc_id)
),
measured as (
    select *, word_chars / nullif(n_words, 0) as mean_word_chars, n_symbols / nullif(n_words, 0) as symbols_per_word,
        len(list_filter(words, lambda x: regexp_matches(x, '\\p{{L}}'))) / nullif(n_words, 0) as letter_words_ratio,
        len(list_filter(words, lambda x: {plain} in ({stop}))) / nullif(n_words, 0) as stop_word_ratio,
        len(list_filter(words, lambda x: regexp_matches(x, '\\p{{Lu}}') and not regexp_matches(x, '\\p{{Ll}}') and length(x) > 1))
            / nullif(n_words, 0) as capital_words_ratio,
        n_dup_lines / nullif(len(lines), 0) as dup_lines_ratio,
        len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•‣●]'))) / nullif(len(lines), 0) as bullet_lines_ratio,
        len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) / nullif(len(lines), 0) as ellipsis_lines_ratio,
        n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed
    from counted
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
    cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
    not base_failed and {tests} as kept
from measured"""
