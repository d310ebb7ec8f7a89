"""Titles that contain any of many words, by an index of short character sequences.

Testing every title for every word grows with both.  Here each word is looked up by the one of its sequences of up to
three characters that the fewest titles have; only titles with that sequence are tested for the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.storage import materialize

GRAM = 3


def _grams(text: Column, size: Column) -> Column:
    """The distinct sequences of ``size`` characters; none in a shorter text."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    found = F.transform(places, lambda at: F.substring(text, at, size))
    return F.when(F.length(text) >= size, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def titles_with_words(titles: DataFrame, words: DataFrame, gram: int = GRAM) -> DataFrame:
    """(title, word): every pair of a distinct lower-cased title and a word in it, ignoring case.

    ``titles`` and ``words`` have one text column each; NULLs are left out.  An empty word is in every title.
    """
    title, word = titles.columns[0], words.columns[0]
    named = materialize(
        titles.select(F.lower(title).alias("title")).where("title IS NOT NULL").distinct(), "titles"
    )
    asked = materialize(words.select(F.lower(word).alias("word")).where("word IS NOT NULL").distinct(), "words")
    # A word of fewer characters is looked up by itself.
    sized = asked.where("word <> ''").withColumn("size", F.least(F.length("word"), F.lit(gram)))
    sizes = [r["size"] for r in sized.select("size").distinct().collect()]  # at most ``gram`` numbers
    if sizes:
        each = F.explode(F.flatten(F.array(*[_grams(F.col("title"), F.lit(s)) for s in sorted(sizes)])))
        held = named.select("title", each.alias("gram"))
        known = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        options = sized.select("word", F.explode(_grams(F.col("word"), F.col("size"))).alias("gram"))
        # The rarest sequence of each word; one that no title has drops its word.
        rarest = options.join(known, "gram", "left").groupBy("word").agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")
        )
        index = rarest.where("best.n > 0").select("word", "best.gram")
        found = held.join(index, "gram").where(F.col("title").contains(F.col("word"))).select("title", "word")
    else:
        found = named.select("title", F.lit("").alias("word")).limit(0)
    if asked.where("word = ''").isEmpty():
        return found
    return found.unionByName(named.select("title", F.lit("").alias("word")))


def containing_any(table: DataFrame, words: DataFrame, column: str = "game_name") -> DataFrame:
    """Rows of ``table`` whose ``column`` contains any word, ignoring case: ``notable_entities`` for any number of words."""
    hit = titles_with_words(table.select(column), words).select(F.col("title").alias("_hit")).distinct()
    return table.join(hit, F.lower(table[column]) == hit["_hit"], "left_semi")
