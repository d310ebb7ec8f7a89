"""Disguised words reach the decoder whatever the signs, separators and repetitions."""

import itertools

import pyarrow as pa

from cohortmill.llm import textbytes as tb
from cohortmill.llm import toxicity

CLEAN = "The attion of ther and hand is on the edge of reason and nothing more"
LEET = ({}, {"o": "0", "i": "1"}, {"i": "!", "s": "$"})
SEPARATORS = ("", " ", ".", "  ", " - ")


def disguise(word, leet, times, separator):
    return separator.join(leet.get(c, c) * times for c in word)


def tokens(text):
    data, offsets = tb.buffer_of(pa.array([text]))
    return [token for _, token in toxicity.disguised(tb.lower_ascii(data), offsets)]


def test_tokens_that_are_decoded():
    for text in ("!diot", "*sshole", "a$$", "4$$"):
        assert tokens(f"so {text}, he said") == [text]
    for text, word in (("i d 1 o t", "id1ot"), ("5 t u p 1 d", "5tup1d"), ("i  d  i  o  t", "idiot"), ("a s s", "ass"), ("you a s c u m", "scum")):
        assert word in tokens(f"so {text}")
    assert "ass" in toxicity.Restorer(toxicity.np.zeros((27, 27))).word("a$$").split()
    assert tokens("plain words only, 2019 *** 3.14 (x)") == []


def test_every_combination_is_scored(spark, folder):
    sf = folder.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows, made = [(0, f"{CLEAN} {CLEAN}")], {}
    for k, (leet, times, separator) in enumerate(itertools.product(LEET, (1, 2, 3), SEPARATORS), 1):
        made[k] = " and the ".join(disguise(w, leet, times, separator) for w in ("idiot", "scum", "moron"))
        rows.append((k, f"{CLEAN} {made[k]} {CLEAN}"))
    out = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert out[0].predicted == 0
    assert [made[k] for k in made if not out[k].predicted] == []
