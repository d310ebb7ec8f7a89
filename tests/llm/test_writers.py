"""Functions that give back texts: no row is lost, multiplied or cut inside a character; any column name may clash."""

import ast
import collections
import pathlib
import re

import pytest
from pyspark.sql import functions as F

import cohortmill.llm
import corpus_pipeline
from cohortmill.llm.decontaminate import without_passages
from cohortmill.llm.packing import bin_texts, pack
from cohortmill.llm.sharding import write_shards
from cohortmill.storage import scratch_path

ROWS = [
    (5, "aaa"), (5, "bbbb"), (5, "bbbb"), (None, "cccc"), (None, "ddd"), (None, "cccc"), (None, None), (6, None), (6, ""),
    (7, "é" * 3000), (8, "x€" * 2000), (9, "\U0001f600" * 1500), (10, "a  b"), (10, "A b "),
]
SCHEMA = "doc_id bigint, text string, source string, shard string, slot int, slot_ string, _number int"


def table(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, None if i == 6 else "s", "mine", 3, "own", 4) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("capacity", [8, 100, 4096, 16_384])
def test_bins_give_back_every_text(spark, capacity):
    docs = table(spark)
    placed = pack(docs, capacity=capacity, group_pieces=50)
    rows = placed.collect()
    content = {r.bin_id: bytes(r.content) for r in bin_texts(placed, docs).collect()}
    assert sum(map(len, content.values())) == sum(len((t or "").encode()) + 1 for _, t in ROWS)
    back = collections.defaultdict(dict)
    for r in rows:
        assert r["size"] <= capacity
        part = content[r.bin_id][r.start : r.start + r["size"]]
        part.decode()  # whole characters only
        key = (r.doc_id, r.text_md5, r.copy)
        assert r.piece not in back[key]
        back[key][r.piece] = part
    got = collections.Counter((k[0], b"".join(p[i] for i in sorted(p)).decode()) for k, p in back.items())
    assert got == collections.Counter((i, f"{t or ''}\n") for i, t in ROWS)


def test_bins_of_no_rows(spark):
    docs = table(spark).limit(0)
    assert bin_texts(pack(docs), docs).collect() == []


def test_written_shards_hold_every_row_once(spark):
    docs = table(spark)
    path = scratch_path(spark, "shards")
    write_shards(docs, path, shards=3)
    back = spark.read.parquet(path)
    # The rows' own shard and slot columns stay; the new ones have an underscore more.
    assert set(back.columns) == {*docs.columns, "shard_", "slot__"}
    key = lambda rows: collections.Counter(map(str, rows))
    assert key(back.select(docs.columns).collect()) == key(docs.collect())
    for shard in (0, 1, 2):
        assert sorted(r.slot__ for r in back.where(F.col("shard_") == shard).collect()) == list(range(back.where(F.col("shard_") == shard).count()))
    empty = scratch_path(spark, "shards")
    write_shards(docs.limit(0), empty)


def test_written_shards_without_clashes(spark):
    path = scratch_path(spark, "shards")
    write_shards(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id bigint, text string"), path, 2)
    assert sorted(spark.read.parquet(path).columns) == ["doc_id", "shard", "slot", "text"]


def test_passages_are_cut(spark):
    texts = ["keep One two THREE end", None, "", "one two three", "é one, two; three! one two three", "two three"]
    rows = [(i % 4 or None, t, "x", 1) for i, t in enumerate(texts)] + [(1, texts[0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _passages string, spans int").repartition(2)
    items = spark.createDataFrame([(1, "one two three"), (None, "end"), (2, None)], "item_id bigint, text string")
    out = without_passages(docs, items)
    assert out.schema == docs.schema
    plain = lambda t: None if t is None else re.sub(r"(?i)one\W+two\W+three(\W+(one\W+two\W+three|end))*", "", t)
    want = collections.Counter((i, plain(t) if t != texts[4] else "é ") for i, t, *_ in rows)
    got = collections.Counter((r.doc_id, r.text) for r in out.collect())
    # An item without an id is no item of the benchmark, so its one word stays.
    assert got == collections.Counter({(i, t if t != "keep " else "keep  end"): n for (i, t), n in want.items()})
    assert without_passages(docs.limit(0), items).collect() == []


def working_names() -> list[str]:
    """Every text in the sources of the subpackage and the pipeline that could name a column."""
    found = set()
    folder = pathlib.Path(cohortmill.llm.__file__).parent
    for path in [*folder.glob("*.py"), pathlib.Path(corpus_pipeline.__file__)]:
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str):
                found |= set(re.findall(r"\b[a-z_][a-z0-9_]*\b", node.value)) if len(node.value) < 400 else set()
    return sorted(found - {"doc_id", "text", "lang", "source", "n_chars"})


def test_stages_with_every_working_name_as_an_extra_column(spark, tmp_path):
    names = working_names()
    assert {"dropped_id", "item_ids", "kept", "spans", "text_md5", "begin"} <= set(names)
    spark.createDataFrame([(1, 0), (3, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "token = abcdefghijkl0123"), (4, None), (None, "x")]
    base = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = base.select("*", *[F.lit("own").alias(n) for n in names])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
            assert docs.select(names[::40]).distinct().collect() == [tuple(["own"] * len(names[::40]))]
    assert {r.doc_id for r in docs.collect()} == {1, 3, 4, None}
