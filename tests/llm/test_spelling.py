"""Spelling variants against a search of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from cohortmill.llm.spelling import LOWER, UPPER, near_words, spelling_groups, word_counts

SCHEMA = "doc_id bigint, text string, word string, n int, node string, target int"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return b[i + 1 :] == (a[i + 1 :] if len(a) == len(b) else a[i:])


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    n = {w: c for w, c in counts.items() if c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA).repartition(3)


def varied(seed):
    pick = random.Random(seed)
    rows = []
    for doc_id in range(120):
        words = []
        for _ in range(pick.randint(0, 25)):
            word = list(pick.choice(["Colouring", "colorin", "éléphants", "aaaaaaaa", "abababab", "÷×ÿÀÉéaa", "houses"]))
            for _ in range(pick.choice([0, 0, 1, 1, 2])):
                at = pick.randrange(len(word))
                word[at : at + pick.randint(0, 1)] = pick.choice(["", "a", "b", "é", "É", "s"])
            words += ["".join(word)] * pick.choice([1, 1, 2, 40])
        rows.append((pick.choice([doc_id, doc_id, 7, None]), pick.choice([" ", "-", "1"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_words_forms_and_roots(spark, seed):
    rows = varied(seed)
    out = spelling_groups(table(spark, rows))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected(rows)


def test_hard_rows(spark):
    long = "é" * 3000
    rows = [(None, None), (None, ""), (1, None), (2, " \n "), (3, long), (3, long), (4, long + "a"), (4, long + "a"),
            (5, "AbcdefgX " * 3), (5, "AbcdefgX " * 3), (6, "abcdefg×" * 2), (7, "ÀBCDEFGH àBCDEFGH ÀBCDEFGH àBCDEFGH")]
    got = [tuple(r) for r in spelling_groups(table(spark, rows)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected(rows)
    assert spelling_groups(table(spark, rows).limit(0)).collect() == []
    assert spelling_groups(table(spark, rows[:4])).collect() == []


def test_every_kind_and_place_of_edit(spark):
    base = "abcdefghi"
    edits = {base}
    for i in range(len(base) + 1):
        edits |= {base[:i] + c + base[i:] for c in "aeéz"}
        edits |= {base[:i] + c + base[i + 1 :] for c in ["", "z", "é"]}
    words = spark.createDataFrame([(w, 5) for w in edits], "word string, n bigint")
    got = {(r.word, r.near) for r in near_words(words).collect()}
    assert got == {(a, b) for a in edits for b in edits if one_edit(a, b)}


def test_a_hot_beginning_keeps_its_links(spark):
    """A third of all words begin alike, in text order as well as backwards."""
    pick = random.Random(3)
    words = {"prefixes" + "".join(pick.choice("abc") for _ in range(5)) for _ in range(200)}
    words |= {"".join(pick.choice("abc") for _ in range(5)) + "suffixes" for _ in range(200)}
    words |= {"".join(pick.choice("abcdefgh") for _ in range(9)) for _ in range(200)}
    rows = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    got = [(r.word, r.near) for r in near_words(rows).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_counts_are_of_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert {(r.word, r.n) for r in word_counts(docs).collect()} == {(w[0], w[3]) for w in want}
