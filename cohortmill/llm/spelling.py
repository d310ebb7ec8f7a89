"""Words one edit apart, by a frontier over a trie that lives in a table.

1. ``word_counts``: the words of all documents with their occurrences.
2. ``trie_edges``: one row per (node, next character) of the trie of those words.  A node is the
   hash of a beginning.  An edge keeps a signature of what follows in the words that pass it, one of 64
   bits for each.  Every word stands in the trie forwards and backwards: two words one edit
   apart share their first or their last half, so no walk has to start at the root, where
   every word would meet every branch.
3. ``near_words``: states (word, target, depth).  A word's own path needs no walk, so its states
   without an edit are known at every depth.  Joined with the edges of their node they take
   every other branch, as a replaced or an inserted character.  That fixes the target, and states
   with one edit follow it level by level, joined with the edge of its next character, until no edge is
   left that may lead to it, the target ends, or few words lie ahead.  A target that was reached is a
   neighbour if it is a word: equal hashes can add a state, never a neighbour.
4. ``spelling_groups``: neighbours of each word, its form and its root.

A state and a join row are a word long; a node has at most as many edges as there are letters,
and a word at most that many neighbours for each of its positions, so no group is large but the
states that wait at one node.  These are rows of a plain join whose other side is a stored table:
adaptive execution splits them.  The number of levels is the length of the longest beginning that
one-edit states share with two words or more, less a half word; it is small unless long
words differ from each other near their middle only.

Defined results: a null or empty text has no words; a null doc_id counts as an empty one in the
digest that picks the characters to delete.  Repeated rows count again.  Extra columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.lineage import cut
from cohortmill.storage import materialize

#: The letters of a run, what is lower-cased, and one run in how many loses a letter.
RUN_LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETE_ONE_IN = 31
MIN_LENGTH, MIN_COUNT, FORM_RATIO = 7, 2, 10
#: A state ends where the signature has this many bits at most; the words decide, so any number is right.
FEW_AHEAD = 8


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points and ``min_count`` occurrences."""
    # Whole runs all the same: the first place at which a long enough one matches is its begin.
    long_runs = F.lit(f"{RUN_LETTERS}{{{min_length},}}")
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("owner"),
        F.explode(F.regexp_extract_all("text", long_runs, F.lit(0))).alias("run"),
    )
    lowered = runs.select("owner", F.translate("run", UPPER, LOWER).alias("run"))
    digested = lowered.select("run", F.crc32(F.concat_ws(":", "owner", "run").cast("binary")).alias("h"))
    at = "CAST(h % length(run) AS INT)"
    word = F.expr(
        f"IF(h % {DELETE_ONE_IN} = 0, concat(left(run, {at}), substring(run, {at} + 2)), run)"
    )
    return (
        digested.select(word.alias("word"))
        .where(F.length("word") >= min_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def _both_ways(words: DataFrame) -> DataFrame:
    """(back, w): each word forwards and backwards."""
    ways = words.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("back"))
    return ways.select("back", F.when(F.col("back") == 0, F.col("word")).otherwise(F.reverse("word")).alias("w"))


def _node(text: str, depth: str) -> str:
    """The beginning of that length, as a hash whose last byte is free for the next character."""
    return f"xxhash64(back, left({text}, {depth})) & -256L"


def _edge(text: str, depth: str) -> str:
    """Node and next character in one number; the letters of a run have codes below 256."""
    return f"({_node(text, depth)}) | ascii(substring({text}, {depth} + 1, 1))"


def _place(rest: str) -> str:
    """The place of what follows an edge in its signature."""
    return f"CAST(pmod(xxhash64({rest}), 64) AS INT)"


def _bit(rest: str) -> str:
    return f"shiftleft(1L, {_place(rest)})"


def trie_edges(words: DataFrame) -> DataFrame:
    """(edge, ahead): the edges of each word from a depth on at which a neighbour can branch off."""
    steps = _both_ways(words).select(
        "back", "w", F.explode(F.expr("sequence((length(w) - 1) DIV 2, length(w) - 1)")).alias("depth")
    )
    edges = steps.select(
        F.expr(_edge("w", "depth")).alias("edge"), F.expr(_bit("substring(w, depth + 2)")).alias("bit")
    )
    return edges.groupBy("edge").agg(F.bit_or("bit").alias("ahead"))


def _branched(words: DataFrame, edges: DataFrame) -> DataFrame:
    """One-edit states: every branch off a word's own path that may lead to the rest of the word."""
    own = (
        _both_ways(words)
        .select("back", "w", F.explode(F.expr("sequence(length(w) DIV 2, length(w))")).alias("depth"))
        .select(
            "back", "w", "depth",
            F.expr("ascii(substring(w, depth + 1, 1))").alias("mine"),
            F.expr(_place("substring(w, depth + 2)")).alias("if_replaced"),
            F.expr(_place("substring(w, depth + 1)")).alias("if_inserted"),
        )
    )
    # A hash join: no node has more edges than there are letters, so that side has no hot key.
    met = own.join(edges.hint("shuffle_hash"), F.expr(_node("w", "depth")) == F.expr("edge & -256L"))
    ch = F.expr("edge & 255L")
    # A pair of equal length is found from its smaller word, others from the shorter one; ``mine`` is 0 at the end.
    replaced = (F.col("mine") != 0) & (ch > F.col("mine")) & F.expr("ahead & shiftleft(1L, if_replaced) != 0")
    inserted = (ch != F.col("mine")) & F.expr("ahead & shiftleft(1L, if_inserted) != 0")
    kinds = met.where(replaced | inserted).select(
        "back", "w", "depth", "ahead", F.char(ch).alias("ch"),
        F.explode(F.when(replaced & inserted, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.when(replaced, 2).otherwise(1)))).alias("skip"),
    )
    target = F.expr("concat(left(w, depth), ch, substring(w, depth + skip))")
    return _with_end(kinds.select("back", "w", target.alias("target"), (F.col("depth") + 1).alias("depth"), "ahead"))


def _with_end(states: DataFrame) -> DataFrame:
    ended = (F.bit_count("ahead") <= FEW_AHEAD) | (F.col("depth") >= F.length("target"))
    return states.withColumn("ended", ended).drop("ahead")


def _one_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    met = states.join(edges.hint("shuffle_hash"), F.expr(_edge("target", "depth")) == F.col("edge"))
    met = met.where(F.expr(f"ahead & {_bit('substring(target, depth + 2)')} != 0"))
    return _with_end(met.select("back", "w", "target", (F.col("depth") + 1).alias("depth"), "ahead"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair one inserted, deleted or replaced code point apart."""
    edges = materialize(trie_edges(words), "trie-edges")
    states = materialize(_branched(words, edges), "frontier")
    found = [states.where("ended")]
    while not (waiting := states.where("NOT ended")).isEmpty():
        states = materialize(_one_level(waiting, edges), "frontier")
        found.append(states.where("ended"))
    ends = reduce(DataFrame.union, found).select(
        F.expr("IF(back = 0, w, reverse(w))").alias("word"), F.expr("IF(back = 0, target, reverse(target))").alias("near")
    )
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = materialize(ends.join(known, "near").distinct().join(words, "word"), "near-words")
    return pairs.select("word", "n", "near", "near_n").union(pairs.select("near", "near_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; each form is more frequent, so chains end."""
    chains = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = chains.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = cut(
            chains.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            )
        )
        chains = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return chains


def spelling_groups(docs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near and form_n."""
    words = materialize(word_counts(docs), "words")
    best = near_words(words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    )
    judged = cut(
        best.select("word", "n_near", F.when(-F.col("best.rank") >= ratio * F.col("n"), F.col("best")).alias("best")).select(
            "word", "n_near", F.col("best.near").alias("form"), (-F.col("best.rank")).alias("form_n")
        )
    )
    roots = _roots(judged.where("form IS NOT NULL"))
    return (
        words.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
        )
    )
