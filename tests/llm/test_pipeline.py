"""The pipeline on the test table, each stage against brute force on its own input."""

import re

import corpus_pipeline
from cohortmill.llm import toxicity
from cohortmill.llm.secrets import find_secrets


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def kept_of_near_duplicates(texts):
    """Five-word shingles at 0.8, all pairs; the smallest id of each component stays."""
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    component = {i: i for i in texts}

    def root(x):
        while component[x] != x:
            x = component[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b]) if a < b else 0
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                component[y] = x
    return {i for i in ids if root(i) == i}


def contaminated(texts, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = set()
    for item in items:
        words = split(item)
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    out = set()
    for i, text in texts.items():
        words = split(text)
        if any(tuple(words[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1)):
            out.add(i)
    return out


def test_every_stage_equals_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema = docs.schema
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = None
    for name, stage in corpus_pipeline.STAGES:
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            expected = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
        elif name == "near_dedup":
            expected = kept_of_near_duplicates(texts)
        elif name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            expected = set(texts) - contaminated(texts, items)
        elif name == "secrets":
            spans = {r.doc_id: r.spans for r in find_secrets(docs).collect()}
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = docs.collect()
        if name == "packing":
            assert {r.doc_id for r in rows} == set(texts)
            assert sum(r["size"] for r in rows) == sum(len((t or "").encode()) + 1 for t in texts.values())
            return
        assert docs.columns == schema.names
        if name == "secrets":
            for row in rows:
                found = [tuple(map(int, s.split(":")[1:])) for s in spans[row.doc_id].split(",") if s]
                left = "".join(c for k, c in enumerate(texts[row.doc_id]) if not any(a <= k < z for a, z in found))
                assert row.text.replace("[secret]", "") == left and row.n_chars == len(row.text)
        else:
            assert {r.doc_id for r in rows} == expected
            assert all(r.text == texts[r.doc_id] for r in rows)
        texts = {r.doc_id: r.text for r in rows}


def test_run_writes_and_rereads_the_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    # The last two tell pieces of rows with equal or without ids apart.
    assert out.columns == ["doc_id", "copy", "piece", "size", "bin_id", "start", "begin", "text_md5"] and out.count() > 0
