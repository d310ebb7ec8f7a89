"""Repeated passages against a count of all windows."""

import hashlib
import random

import pytest

from cohortmill.llm.suffixdedup import LoserTree, common_prefix, remove_repeats


def brute_force(texts, length):
    seen = {}
    for text in texts:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            seen[data[i : i + length]] = seen.get(data[i : i + length], 0) + 1
    rows = []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rows.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, digest string")


def result(spark, texts, **parameters):
    rows = remove_repeats(frame(spark, texts).repartition(5), **parameters).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]


def corpus(seed, size=60):
    """Texts that share passages of lengths around the limit, with changes at random places."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abé") for _ in range(pick.randint(1, 5)))
    passages = [" ".join(word() for _ in range(pick.randint(3, 40))) for _ in range(8)]
    texts = []
    for _ in range(size):
        parts = []
        for _ in range(pick.randint(1, 6)):
            passage = pick.choice(passages)
            if pick.random() < 0.4:
                at = pick.randrange(len(passage))
                passage = passage[:at] + pick.choice("xyz") + passage[at + 1 :]
            parts.append(passage if pick.random() < 0.6 else " ".join(word() for _ in range(12)))
        texts.append(" ".join(parts))
    return [*texts, texts[0], texts[0], None, "", "a", "na" * 200, "ab" * 3000, "q" * 39, "q" * 40, "q" * 41]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "parameters", [{}, {"max_group": 3}, {"run_bytes": 500, "piece_bytes": 5000}], ids=["plain", "hot", "many-runs"]
)
def test_equals_count_of_all_windows(spark, seed, parameters):
    texts = corpus(seed)
    assert result(spark, texts, length=40, gram=8, **parameters) == brute_force(texts, 40)


def test_large_group(spark):
    """One passage in many texts, so that the group is compared by classes."""
    pick = random.Random(5)
    noise = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n))
    texts = [noise(30) + "a shared passage of just enough bytes, forty-odd" + noise(30) for _ in range(120)]
    assert result(spark, texts, length=40, gram=8) == brute_force(texts, 40)


def test_test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    rows = remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == brute_force(texts, 400)


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert remove_repeats(empty).collect() == []
    rows = spark.createDataFrame([(None, "z" * 500), (None, "z" * 500), (None, None)], "doc_id bigint, text string")
    assert sorted(r.n_removed for r in remove_repeats(rows).collect()) == [0, 500, 500]


def test_loser_tree_order_and_prefixes():
    pick = random.Random(3)
    strings = [bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 9))) for _ in range(300)]
    runs = []
    for k in range(7):
        own, previous, run = sorted(strings[k::7]), b"", []
        for s in own:
            run.append((common_prefix(previous, s, 0), s, None))
            previous = s
        runs.append(iter(run))
    merged = list(LoserTree(runs))
    assert [s for _, s, _ in merged] == sorted(strings)
    previous = b""
    for shared, s, _ in merged:
        assert shared == common_prefix(previous, s, 0)
        previous = s
