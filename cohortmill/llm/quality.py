"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Each rule is a Spark column over a text's words, lines and characters.  A sample of whole
rows is used to estimate what each rule costs and how many rows it rejects; the rules then
become one nested ``CASE``, the one with most rejections per second first, so that a row
stops at the first rule it fails.  The order never changes which rows are rejected.

Native expressions only.  Defined results: a null text has no words and fails the base
rule, as an empty one does.  Rows are handled one by one; extra columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
#: Share and greatest number of rows of the planning sample; it orders the rules and decides nothing.
SAMPLE_SHARE, SAMPLE_ROWS, SAMPLE_SEED = 0.01, 2_000, 7

_SPACES = "\t\n\u000b\f\r"


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.filter(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), lambda w: w != "")


def chars_in_words(text: Column) -> Column:
    return F.length(F.translate(text, " " + _SPACES, ""))


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: chars_in_words(line) > 0)


def window_hashes(words: Column) -> Column:
    """A hash of each three-word window, by place."""
    hashed = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    return F.when(F.size(words) > 2, F.transform(F.sequence(F.lit(0), F.size(words) - 3), hashed))


def sorted_windows(hashes: Column) -> Column:
    """(hash, place) in order, null where no hash occurs twice."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(placed))


def repeated_words(ordered: Column) -> Column:
    """Words inside windows whose hash a neighbour in the order shares; a word counts once."""
    twice = F.filter(
        ordered,
        lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.coalesce(F.size(F.array_distinct(places)), F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the text.

    What a later expression reads more than once is a column of its own, so that it is
    computed once.
    """
    as_long = lambda c, name: c.cast("bigint").alias(name)
    text = F.col("text")
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .select("*", words_of(text).alias("words"), lines_with_words(text).alias("lines"))
        .select("*", window_hashes(F.col("words")).alias("hashes"))
        .select("*", sorted_windows(F.col("hashes")).alias("ordered"))
        .select(
            "doc_id",
            "text",
            as_long(F.size("words"), "n_words"),
            as_long(chars_in_words(text), "word_chars"),
            as_long(count_chars(text, SYMBOLS), "n_symbols"),
            as_long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
            as_long(repeated_words(F.col("ordered")), "n_repeat_words"),
        )
    )


def base_failed(min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


#: Rules of the cascade: true rejects the row.  Columns: those of ``measures``.
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: F.col("n_symbols") * 10 > F.col("n_words") * 3,
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    "duplicate_lines": lambda: F.col("n_dup_lines") * 10 > 3 * F.greatest(F.lit(10), F.size(F.split("text", "\n"))),
    "capitals": lambda: 2 * F.length(F.regexp_replace("text", r"[^A-Z]", "")) > F.col("word_chars"),
    "exclamations": lambda: 4 * count_chars(F.col("text"), "!") > F.col("n_words") * 3,
    "letters": lambda: 2 * F.length(F.regexp_replace("text", r"[^\p{L}]", "")) < F.col("word_chars"),
    "one_word": lambda: 5 * F.size(F.array_distinct(words_of(F.lower("text")))) < F.least(F.col("n_words"), F.lit(200)),
}


def plan_cascade(docs: DataFrame, rules: dict[str, Callable[[], Column]] | None = None) -> list[tuple[str, float, float]]:
    """(rule, rejected share, seconds a row) by rejection per cost on the sample, best first.

    The rows are drawn before anything is measured, as Spark samples what it is given.
    """
    rules = rules or RULES
    sample = measures(docs.select("doc_id", "text").sample(SAMPLE_SHARE, SAMPLE_SEED).limit(SAMPLE_ROWS)).persist()
    try:
        rows = max(1, sample.count())
        found = []
        for name, rule in rules.items():
            begun = time.perf_counter()
            rejected = sample.agg(F.count_if(F.coalesce(rule(), F.lit(False)))).first()[0]
            found.append((name, rejected / rows, (time.perf_counter() - begun) / rows))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: (-x[1] / x[2], x[0]))


def cascade(order: list[str], rules: dict[str, Callable[[], Column]] | None = None) -> Column:
    """The first rule of the order that rejects the row, or null; later rules are then not evaluated."""
    rules = rules or RULES
    verdict = F.when(F.coalesce(rules[order[0]](), F.lit(False)), F.lit(order[0]))
    for name in order[1:]:
        verdict = verdict.when(F.coalesce(rules[name](), F.lit(False)), F.lit(name))
    return verdict


def judge(docs: DataFrame) -> DataFrame:
    """The measures of every row, base_failed, kept, and the rule that rejected it."""
    measured = measures(docs)
    order = [name for name, _, _ in plan_cascade(docs)]
    return (
        measured.withColumn("base_failed", base_failed())
        .withColumn("failed_rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order)))
        .withColumn("kept", F.col("failed_rule").isNull())
        .drop("text")
    )
