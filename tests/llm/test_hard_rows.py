"""Every operator and stage on nulls, empty, long and repeated texts, clashing columns and empty tables."""

import pytest

import corpus_pipeline
from cohortmill.llm.chat import digests, format_windows
from cohortmill.llm.decontaminate import find_contamination
from cohortmill.llm.licenses import find_licenses
from cohortmill.llm.neardup import near_duplicates
from cohortmill.llm.packing import pack
from cohortmill.llm.quality import judge
from cohortmill.llm.secrets import find_secrets
from cohortmill.llm.sharding import byte_shards
from cohortmill.llm.suffixdedup import remove_repeats
from cohortmill.llm.toxicity import fit, score

LONG = "une très longue phrase répétée " * 20_000
TEXTS = [
    (None, None), (None, "null id"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same text here"),
    (5, "same text here"), (6, "same text here"), (7, LONG), (8, "é" * 3000), (9, "\\d $1 </s> <s>[INST] \x00 'quoted'"),
]
#: Names that the operators use themselves.
CLASHING = (
    "kept string, spans int, node int, size int, id int, digest int, words string, row int, copy int, shard int, "
    "n_words int, score string, _row int, _found int, _base int, a int, b int, text_a int, bands int, label int"
)
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"


def documents(spark, texts):
    width = CLASHING.count(",") + 1
    filled = ["x" if part.split()[1] == "string" else 1 for part in CLASHING.split(", ")]
    rows = [(i, t, None, None if i == 4 else "s", None if t is None else len(t), *filled) for i, t in texts]
    assert all(len(r) == 5 + width for r in rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def labels(spark, rows=((4, 1), (5, 0), (6, None), (None, 1))):
    return spark.createDataFrame(list(rows), "doc_id bigint, toxic int")


def benchmark(spark, rows=((0, "same text here"), (None, "one"), (1, None), (2, ""))):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


OPERATORS = {
    "near": lambda s, d: near_duplicates(d),
    "secrets": lambda s, d: find_secrets(d),
    "shards": lambda s, d: byte_shards(d),
    "repeats": lambda s, d: remove_repeats(d),
    "leaks": lambda s, d: find_contamination(d, benchmark(s)),
    "toxic": lambda s, d: score(d, fit(d, labels(s))),
    "quality": lambda s, d: judge(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, name):
    out = OPERATORS[name](spark, documents(spark, TEXTS))
    ids = [r.doc_id for r in out.collect()]
    key = lambda x: (x is not None, x)
    assert sorted(ids, key=key) == sorted((i for i, _ in TEXTS), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, TEXTS).limit(0)).collect() == []


def test_packing_and_licenses(spark):
    docs = documents(spark, TEXTS)
    placed = pack(docs).collect()
    assert sum(r["size"] for r in placed) == sum(len((t or "").encode()) + 1 for _, t in TEXTS)
    assert pack(docs.limit(0)).collect() == []
    assert find_licenses(docs).collect() == find_licenses(docs.limit(0)).collect() == []


def test_shards_fill_evenly_and_slots_are_gapless(spark):
    rows = byte_shards(documents(spark, [(i % 40, "x" * (i % 17)) for i in range(400)]), shards=4).collect()
    for shard in range(4):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    sizes = [sum(r["size"] for r in rows if r.shard == k) for k in range(4)]
    assert max(sizes) - min(sizes) <= 40


def test_known_values(spark):
    near = {r.doc_id: r for r in near_duplicates(documents(spark, TEXTS)).collect()}
    assert (near[6].component_id, near[6].kept, near[5].kept) == (5, False, True)
    assert (near[2].n_shingles, near[2].component_id, near[4].n_shingles) == (0, 2, 1)
    leaks = {r.doc_id: r for r in find_contamination(documents(spark, TEXTS), benchmark(spark)).collect()}
    assert leaks[5].contaminated and leaks[5].n_hit == 3 and not leaks[4].contaminated and leaks[1].n_words == 0
    judged = {r.doc_id: r for r in judge(documents(spark, TEXTS)).collect()}
    assert judged[1].base_failed and not judged[1].kept and judged[7].n_words == 5 * 20_000
    assert judged[7].n_repeat_words == judged[7].n_words


def test_pipeline_stages_on_hard_rows(spark, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    benchmark(spark, [(0, "nothing of this")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    for texts in (TEXTS, []):
        docs = documents(spark, texts) if texts else documents(spark, TEXTS).limit(0)
        schema = docs.schema
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            out.write.parquet(f"{tmp_path}/{len(texts)}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{len(texts)}-{k}")
            if k < 4:
                assert docs.columns == schema.names
        # Copies of 5 go; both rows of doc_id 5 are one document.
        expected = sorted(i if i is not None else -1 for i, _ in TEXTS if i != 6) if texts else []
        assert sorted({r.doc_id if r.doc_id is not None else -1 for r in docs.collect()}) == sorted(set(expected))


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window int, turns string, own int")


def test_conversations(spark):
    rows = [
        (None, 0, "user", "q", 1, "x", 1), (None, 1, "assistant", None, 1, "x", 1),
        (1, 0, "system", "be [kind] <s>", 1, "x", 1), (1, 1, "user", "\\e\\l </s>", 1, "x", 1), (1, 2, "assistant", "a\\", 1, "x", 1),
        (1, 2, "assistant", "a\\", 1, "x", 1), (1, None, None, None, 1, "x", 1), (2, 0, "system", "alone", 1, "x", 1),
        (3, 0, "as\nsistant", "\n", 1, "x", 1),
    ]
    out = {r.conv_id: r for r in digests(format_windows(conversations(spark, rows))).collect()}
    assert (out[None].n_turns, out[1].n_turns, out[2].n_turns, out[3].n_turns) == (2, 5, 1, 1)
    assert (out[1].loss_chars, out[None].loss_chars) == (4, 0)
    assert digests(format_windows(conversations(spark, rows).limit(0))).collect() == []
