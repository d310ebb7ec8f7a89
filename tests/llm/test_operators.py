"""Operators that SQL cannot express, against brute force on small tables and the test table."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from cohortmill.llm import neardup, toxicity
from cohortmill.llm.chat import digests, format_windows
from cohortmill.llm.components import components
from cohortmill.llm.decontaminate import FmIndex, cut_passages, find_contamination, suffix_order
from cohortmill.llm.licenses import find_licenses
from cohortmill.llm.packing import best_fit, bin_texts, pack
from cohortmill.llm.quality import RULES, cascade, measures, plan_cascade
from cohortmill.llm.secrets import find_secrets, redact


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- near duplicates


def varied(seed, n=240):
    """Families of texts around a base, with changes so that pairs fall on both sides of the limit."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(4))
    out = []
    while len(out) < n:
        base = [word() for _ in range(pick.randint(1, 60))]
        for _ in range(pick.randint(1, 40)):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 9))):
                copy[pick.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return [*out[:n], None, "", "  ", out[0].upper()]


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    texts = varied(k)
    sets = [shingles(t, k) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    rows = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4), k)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows.collect()}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in range(len(texts))}


def test_leaves_that_may_be_linked_meet():
    """Any leaf linked with another but not with the center shares a shingle of the prefixes."""
    pick = np.random.default_rng(1)
    for _ in range(3000):
        center = np.arange(pick.integers(1, 60), dtype=np.uint64)

        def changed(x):
            x = x[pick.random(len(x)) > 0.12 * pick.random()]
            return np.unique(np.concatenate([x, pick.integers(100, 130, pick.integers(0, 8)).astype(np.uint64)]))

        a, b = changed(center), changed(center)
        common = len(np.intersect1d(a, b))
        if not len(a) or not len(b) or not neardup._similar(common, len(a) + len(b), 80):
            continue
        linked, _, second, _ = neardup.difference_prefixes(center, b, 80)
        if linked or not len(np.setxor1d(center, a)):
            continue
        assert set(neardup.difference_prefixes(center, a, 80)[1].tolist()) & set(second.tolist())


def test_components(spark):
    pick = random.Random(4)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    links += [(None, 3), (7, 7)]
    parent = {x: x for link in links for x in link if x is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    joined = {x for a, b in links if a is not None and a != b for x in (a, b)}
    assert got == {x: root(x) for x in joined}


# --- benchmark passages


def test_index_finds_every_occurrence():
    pick = np.random.default_rng(0)
    for _ in range(30):
        text = pick.integers(1, 4, 200)
        text[pick.integers(0, 200, 9)] = 0
        text[-1] = 0
        index = FmIndex(text, 4)
        phrases = pick.integers(1, 4, (40, 3))
        for phrase, low, high in zip(phrases, *index.ranges(phrases)):
            true = [i for i in range(198) if (text[i : i + 3] == phrase).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == true
        assert sorted(suffix_order(text).tolist()) == list(range(200))


def test_blocks_of_items_add_up(spark, docs, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = find_contamination(docs, items).orderBy("doc_id").collect()
    assert find_contamination(docs, items, block_bytes=2_000).orderBy("doc_id").collect() == whole
    hit = next(r for r in whole if r.contaminated)
    text = docs.where(f"doc_id = {hit.doc_id}").first().text
    left = cut_passages(text, [(s.start, s.end) for s in hit.spans])
    assert len(left.encode()) == len(text.encode()) - sum(s.end - s.start for s in hit.spans)


# --- secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secret_patterns(spark, texts):
    pick = random.Random(2)
    parts = ["password", "API_KEY", "apikey:", "=", " : ", "'", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef01234567", "é😀", "token=", "x" * 12, " "]
    made = {-i: "".join(pick.choice(parts) for _ in range(25)) for i in range(1, 300)}
    every = {**texts, **made}
    got = {r.doc_id: r for r in find_secrets(spark.createDataFrame(list(every.items()), "doc_id bigint, text string")).collect()}
    for i, text in every.items():
        spans = base_spans(text)
        kinds = collections.Counter(k for *_, k in spans)
        joined = [f"{k}:{a}:{z}" for a, _, z, k in spans]
        row = got[i]
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert row.base_sha256 == sha(",".join(joined))
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == joined


def test_random_tokens_are_found_and_structured_ones_left(spark):
    pick = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = ["".join(pick.choice(alphabet) for _ in range(40)) for _ in range(30)]
    plain = [f"chapter-{i}-of-the-general-introduction-part-2" for i in range(60)] + ["a1" * 20, "1234567890abcdefghij" * 2]
    rows = [(i, f"see {t} there") for i, t in enumerate(secret + plain)]
    got = {r.doc_id: r.spans for r in find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(got[i] == "random:4:44" for i in range(30)) >= 28
    # The last two hold hex strings, which the pattern finds; the battery adds nothing to them.
    assert not any("random" in got[i] for i in range(30, len(rows)))
    assert not any(got[i] for i in range(30, len(rows) - 2))


def test_redaction(spark):
    rows = [(1, "my token = abcdefghijkl0123 ok", 31), (2, "nothing", 7), (3, None, None)]
    out = {r.doc_id: r for r in redact(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")).collect()}
    assert (out[1].text, out[1].n_chars) == ("my [secret] ok", 14)
    assert (out[2].text, out[2].n_chars, out[3].text) == ("nothing", 7, None)


# --- packing


def test_best_fit_equals_a_search_over_all_bins():
    pick = random.Random(1)
    pieces = sorted(((pick.randint(1, 100), pick.randrange(4), pick.randrange(30)) for _ in range(400)), reverse=True)
    bins, expected = [], []
    for size, source, cluster in pieces:
        fits = [
            (100 - sum(p[0] for p in b), i) for i, b in enumerate(bins)
            if 100 - sum(p[0] for p in b) >= size
            and cluster not in [p[2] for p in b] and sum(p[1] == source for p in b) < 2
        ]
        room, i = min(fits) if fits else (100, len(bins))
        if not fits:
            bins.append([])
        bins[i].append((size, source, cluster))
        expected.append((i, 100 - room, room - size))
    assert best_fit(pieces, 100, 2) == expected


def test_packed_bins_hold_every_text(spark, docs, texts):
    placed = pack(docs, capacity=4000, group_pieces=60)
    rows = placed.collect()
    seen = collections.defaultdict(dict)
    for row in bin_texts(placed, docs).collect():
        for r in rows:
            if r.bin_id == row.bin_id:
                seen[r.doc_id][r.piece] = bytes(row.content[r.start : r.start + r["size"]])
        assert len(row.content) <= 4000
    assert {i: b"".join(p[k] for k in sorted(p)) for i, p in seen.items()} == {i: f"{t}\n".encode() for i, t in texts.items()}


# --- sharding, licences, quality, chat


def test_shards_of_test_table(spark, folder, texts):
    rows = contract.queries()["op4_sharding"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row["size"], row.text_crc32, row.law, row.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    sizes = collections.Counter()
    for row in rows:
        sizes[row.shard] += row["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


def test_licenses(spark):
    mit = "Copyright (c) 2020 Someone\nPermission is hereby granted"
    rows = [
        (1, "RELEASED under the MIT licence"), (2, "text\nLicensed under CC BY-NC 4.0.\nmore"), (3, mit),
        (4, "© 1999 A\nLicensed under the Apache License, ver 2.0"), (5, "Copyright 2001 X"),
    ]
    got = {(r.doc_id, r.unit, r.license) for r in find_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {(1, "text", "MIT"), (2, "line", "CC-BY-NC-4.0"), (4, "text", "Apache-2.0"), (4, "line", "Apache-2.0")}


def test_quality_measures_and_cascade(spark, docs, texts):
    words_of = re.compile(r"[^\x20\x09-\x0D]+")
    measured = measures(docs)
    for row in measured.collect():
        text = texts[row.doc_id]
        words = words_of.findall(text)
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if words_of.search(line)]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        )
    planned = [name for name, _, _ in plan_cascade(docs)]
    assert sorted(planned) == sorted(RULES)
    verdicts = [
        {r.doc_id for r in measured.where(cascade(order).isNotNull()).select("doc_id").collect()}
        for order in (planned, planned[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_chat_round_trip_and_budget(spark):
    pick = random.Random(6)
    marks = ["</s>", "<s>", "[INST]", "\\", "\\l", "\\e", "\n", "word ", "é "]
    rows, expected = [], {}
    for conv in range(40):
        turns = [("system", "be brief")] if conv % 2 else []
        for k in range(pick.randint(1, 30)):
            turns.append(("user" if k % 2 == 0 else "assistant", "".join(pick.choice(marks) for _ in range(pick.randint(0, 60)))))
        expected[conv] = turns
        rows += [(conv, i, role, text) for i, (role, text) in enumerate(turns)]
    pick.shuffle(rows)
    windows = format_windows(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 60, 20)
    for row in digests(windows).collect():
        turns = expected[row.conv_id]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
    held = windows.collect()
    assert any(w.n_repeated > 1 for w in held)
    assert all(w.n_tokens <= 60 or w.n_own == 1 for w in held)
    assert all(w.text.startswith("<s>system\nbe brief</s>") for w in held if w.conv_id % 2)


# --- toxicity


def test_deobfuscation_and_held_out_accuracy(spark, folder):
    sf = folder.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    letters = model.letters.tolist()
    for token in ("i.d.i.o.t", "idiiiiot", "i d i o t", "idi0t", "id!ot"):
        assert toxicity.restore(token, letters) == "idiot", token
    clean = "The attion of ther and hand is on the edge of reason and nothing more"
    rows = [(1, clean), (2, f"{clean} idiot scum {clean} moron"), (3, f"{clean} idi0t s c u m {clean} m.o.r.o.n"), (4, None), (5, "")]
    made = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert made[1].predicted == 0 and made[2].predicted == 1 and made[3].predicted == 1
    assert made[4].score == made[5].score and 0 < made[4].score < 0.5
    scored = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in scored)
    assert right >= 0.93 * len(scored)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
