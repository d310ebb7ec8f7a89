"""Repeated rows without a doc_id: no links through them, and none of them lost."""

import collections

import pytest

import corpus_pipeline
from cohortmill.llm.neardup import near_duplicates
from cohortmill.llm.sharding import byte_shards

FIVE, NINE = "one two three four five six seven", "red green blue white black pink grey"


@pytest.mark.parametrize("n_null", [1, 3])
def test_null_ids_tie_nothing_together(spark, n_null):
    rows = [(5, FIVE), (9, NINE), *[(None, FIVE), (None, NINE)] * n_null]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out if r.doc_id is not None) == [(5, 5, True), (9, 9, True)]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)] * (2 * n_null)
    kept = collections.Counter(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept[5] == kept[9] == 1


def test_an_id_with_several_texts_is_one_document(spark):
    rows = [(5, FIVE), (7, FIVE), (7, NINE), (9, NINE), (9, "a text of its own"), (9, None), (11, "a text of its own")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    linked = {r.doc_id: r for r in out if r.n_shingles}
    assert {i: (r.component_id, r.kept) for i, r in linked.items()} == {i: (5, i == 5) for i in (5, 7, 9, 11)}


def test_shards_keep_repeated_texts_without_an_id(spark):
    rows = [*[(None, FIVE), (None, NINE), (None, None)] * 3, *[(i, f"{FIVE} {i % 10}") for i in range(40)]]
    out = byte_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=2, group_share=1).collect()
    size = lambda text: len(text or "") + 1
    assert collections.Counter((r.doc_id, r["size"]) for r in out) == collections.Counter((i, size(t)) for i, t in rows)
    for shard in {r.shard for r in out}:
        own = sorted(r.slot for r in out if r.shard == shard)
        assert own == list(range(len(own)))
