"""Near-duplicate documents by one-permutation MinHash with optimal densification.

One hash per shingle: its high part names a bin, its smallest value in the bin is the
signature.  An empty bin borrows from the bin that a universal hash of (bin, attempt)
names, attempt after attempt, the same for every document.  Bands of the signature are
buckets.  Candidates of a bucket are a star around its best connected document, so a
bucket of n gives n - 1 pairs.  Links are confirmed on full shingle sets.

A link between two leaves of a star is not lost.  Let D(x) be the shingles in which leaf x
differs from the center.  If leaf b is not linked with the center but with leaf a, sizes
bound how many shingles D(a) and D(b) share from below, so the first few of each, in one
order, meet (prefix filter).  Leaves of different components that meet so are confirmed
too.  Most differences are a leaf's own, so few leaves meet, however many a star has.

Defined results: words are split at ASCII white space after lower-casing A-Z.  A text with
fewer words than a shingle is one shingle; null or word-less texts have an empty set and are
linked with nothing.  A doc_id is one node however many rows carry it.  Rows without a doc_id
get no component and are kept.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import textbytes as tb
from cohortmill.llm.components import components
from cohortmill.llm.lineage import cut

SHINGLE_WORDS = 5
PERCENT = 80
#: 32 bands of 5 bins: a pair at similarity 0.8 misses all bands once in 300,000 times.
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text in a row, and the offsets of each."""
    data, offsets = tb.buffer_of(column)
    data = tb.lower_ascii(data)
    starts, ends, first = tb.word_bounds(data, offsets, tb.NOT_SPACE)
    hashes = tb.word_hashes(data, starts, ends)
    sets, bounds = [], [0]
    for row in range(len(offsets) - 1):
        own = hashes[first[row] : first[row + 1]]
        width = min(words, len(own))
        if width:
            count = len(own) - width + 1
            joined = np.full(count, np.uint64(width))
            for k in range(width):
                joined = tb.mixed(joined * np.uint64(0xD6E8FEB86659FD93) + own[k : k + count])
            joined = np.unique(joined)
            sets.append(joined)
            bounds.append(bounds[-1] + len(joined))
        else:
            bounds.append(bounds[-1])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array(bounds)


def densified(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Signatures (documents x bins) of non-empty sets of sorted hashes."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    cell = row * BINS + (((values >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    lead = np.concatenate([[True], cell[1:] != cell[:-1]])  # sorted: the first of a bin is its least
    signature = np.zeros(n * BINS, dtype=np.uint64)
    signature[cell[lead]] = values[lead]
    filled = np.zeros(n * BINS, dtype=bool)
    filled[cell[lead]] = True
    empty, attempt = np.flatnonzero(~filled), 0
    bins = np.arange(BINS, dtype=np.uint64)
    while len(empty):
        attempt += 1
        donor = (tb.mixed(bins * np.uint64(1 << 32) + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)
        source = empty - empty % BINS + donor[empty % BINS]
        ready = filled[source]
        signature[empty[ready]] = signature[source[ready]]
        empty = empty[~ready]
    return signature.reshape(n, BINS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS))
    for k in range(ROWS):
        keys = tb.mixed(keys * np.uint64(0xD6E8FEB86659FD93) + signature[:, k::ROWS][:, :BANDS])
    return keys


def _signatures(words: int):
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.pieces(batches):
            values, bounds = shingle_sets(batch.column("text"), words)
            size = np.diff(bounds)
            has = np.flatnonzero(size)
            part = np.concatenate([[0], np.cumsum(size[has])])
            keys = np.zeros((len(size), BANDS), dtype=np.uint64)
            sums = np.zeros((2, len(size)), dtype=np.uint64)
            if len(has):
                keys[has] = band_keys(densified(values, part))
                for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
                    sums[k, has] = np.add.reduceat(tb.mixed(values ^ np.uint64(salt)), part[:-1])
            kept = np.where(size > 0, BANDS, 0)
            flat = pa.array(keys[has].reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(size), *map(pa.array, sums.view(np.int64)), lists],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return results


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Set size, a 128-bit digest of the whole set, and the band buckets of each document."""
    return tb.map_texts(
        docs.select("doc_id", "text"),
        _signatures(words),
        "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>",
    )


def _similar(common: int, total: int, percent: int) -> bool:
    """``total``: the two set sizes added."""
    return common > 0 and 100 * common >= percent * (total - common)


def _confirmed(words: int, percent: int):
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _pairs(batches, words):
            linked = []
            for x, y in sets:
                both = np.sort(np.concatenate([x, y]))
                linked.append(_similar(int(np.count_nonzero(both[1:] == both[:-1])), len(both), percent))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return results


def _pairs(batches: Iterator[pa.RecordBatch], words: int):
    for batch in tb.pieces(batches, "text_b"):
        a, a_at = shingle_sets(batch.column("text_a"), words)
        b, b_at = shingle_sets(batch.column("text_b"), words)
        yield batch, [(a[a_at[i] : a_at[i + 1]], b[b_at[i] : b_at[i + 1]]) for i in range(batch.num_rows)]


def difference_prefixes(
    center: np.ndarray, leaf: np.ndarray, percent: int
) -> tuple[bool, np.ndarray, np.ndarray, int]:
    """Whether a leaf is linked with its center, two prefixes of its difference, and its size.

    Two sets of sizes S in sum reach the similarity if their difference is at most
    k * S, k = (100 - percent) / (100 + percent).  Shingles that the center lacks come
    first in the order, as few leaves share those.  The first prefix is for meeting a leaf
    that is not linked with the center; the second, for one that is not linked itself.
    """
    common = np.isin(leaf, center, assume_unique=True)
    n_common = int(common.sum())
    linked = _similar(n_common, len(center) + len(leaf), percent)
    differs = np.concatenate([leaf[~common], center[~np.isin(center, leaf, assume_unique=True)]])
    size, top, bottom = len(differs), 100 - percent, 100 + percent
    # Shared with such a leaf: more than (|D| + k * (|center| - |leaf|)) / 2.
    with_unlinked = (size * bottom + top * (len(center) - len(leaf))) // (2 * bottom) + 1
    first = differs[: size - max(1, with_unlinked) + 1]
    if linked:
        return True, first, differs[:0], size
    # Shared at least: |D| - k * (sizes), the other size at most 100 / percent of the own.
    at_least = size - (top * len(leaf) * (percent + 100)) // (bottom * percent)
    return False, first, differs[: size - max(1, at_least) + 1], size


def _compared(words: int, percent: int):
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _pairs(batches, words):
            rows = [difference_prefixes(x, y, percent) for x, y in sets]
            lists = lambda k: pa.array([row[k].view(np.int64) for row in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a"),
                    batch.column("b"),
                    pa.array([row[0] for row in rows], pa.bool_()),
                    lists(1),
                    lists(2),
                    pa.array([row[3] for row in rows], pa.int64()),
                    pa.array([len(y) for _, y in sets], pa.int64()),
                ],
                ["center", "node", "linked", "first", "second", "n_differ", "n_leaf"],
            )

    return results


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b)."""
    texts = docs.select("doc_id", "text")
    return (
        pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )


def confirm(pairs: DataFrame, docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    return tb.map_texts(_with_texts(pairs, docs), _confirmed(words, percent), "a bigint, b bigint")


def compare_stars(stars: DataFrame, docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Each star edge: linked, the prefixes of the leaf's difference, sizes of it and of the leaf."""
    return tb.map_texts(
        _with_texts(stars.select(F.col("center").alias("a"), F.col("node").alias("b")), docs),
        _compared(words, percent),
        "center bigint, node bigint, linked boolean, first array<bigint>, second array<bigint>, "
        "n_differ bigint, n_leaf bigint",
    )


def _buckets(nodes: DataFrame) -> DataFrame:
    """Rows (bucket, node, weight) of buckets with several nodes; weight: neighbours in all buckets."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut(rows.join(several, "bucket"))
    weight = shared.groupBy("node").agg(F.sum(F.col("size") - 1).alias("weight"))
    return cut(shared.drop("size").join(weight, "node"))


def star_edges(buckets: DataFrame) -> DataFrame:
    """Distinct (center, node): in each bucket the best connected node with each other one."""
    centers = (
        buckets.groupBy("bucket")
        .agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("best"))
        .select("bucket", (-F.col("best.minus")).alias("center"))
    )
    return (
        buckets.join(centers, "bucket").where(F.col("node") != F.col("center")).select("center", "node").distinct()
    )


def leaf_pairs(compared: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct (a, b) of leaves of one star that may be linked and are in different components.

    A shingle at place i of a difference of size d leaves room for d - i common ones, and
    the first common one of a linked pair leaves enough (positional filter).
    """
    placed = compared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = (
        placed.groupBy("center")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("center")
    )
    open_stars = cut(placed.join(several, "center"))

    def side(rows: DataFrame, name: str, prefix: str) -> DataFrame:
        return rows.select(
            "center",
            F.col("node").alias(name),
            F.col("component").alias(f"c_{name}"),
            F.col("n_differ").alias(f"d_{name}"),
            F.col("n_leaf").alias(f"n_{name}"),
            F.posexplode(prefix).alias(f"i_{name}", "shingle"),
        )

    a, b = side(open_stars, "a", "first"), side(open_stars.where("NOT linked"), "b", "second")
    needed = (F.col("d_a") + F.col("d_b")) * (100 + percent) - (100 - percent) * (F.col("n_a") + F.col("n_b"))
    room = F.least(F.col("d_a") - F.col("i_a"), F.col("d_b") - F.col("i_b")) * 2 * (100 + percent)
    return (
        a.join(b, (a["center"] == b["center"]) & (a["shingle"] == b["shingle"]) & (F.col("c_a") != F.col("c_b")) & (needed <= room))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and kept for every row of ``docs``."""
    signed = cut(signatures(docs, words))
    # Equal sets are one node, named by the smallest doc_id; copies make no pairs.
    classes = (
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    )
    # A row without a doc_id is no node: it would tie together whatever null-id rows copy.
    members = cut(
        signed.drop("bands").join(classes, ["set_a", "set_b"], "left").withColumn("node", F.expr("IF(doc_id IS NOT NULL, node, NULL)"))
    )
    # One row of each class goes on.  Its id is part of the join, so the rows of a large class do not meet.
    keys = ["set_a", "set_b", "doc_id"]
    nodes = signed.join(classes.withColumnRenamed("node", "doc_id"), keys).dropDuplicates(keys)
    buckets = _buckets(nodes.select(F.col("doc_id").alias("node"), "bands"))
    compared = cut(compare_stars(star_edges(buckets), docs, words, percent))
    links = compared.where("linked").select("center", "node")
    found = components(links)
    more = cut(leaf_pairs(compared, found, percent))
    # A doc_id with several texts ties their sets together, each to the smallest node of the id.
    ids = members.where("node IS NOT NULL").select("doc_id", F.col("node").alias("b"))
    least = ids.groupBy("doc_id").agg(F.min("b").alias("a"), F.max("b").alias("high")).where("a <> high").drop("high")
    same_id = ids.join(least, "doc_id").where("a <> b").select("a", "b").distinct()
    extra = cut(same_id if more.isEmpty() else confirm(more, docs, words, percent).union(same_id))
    if not extra.isEmpty():
        found = components(links.union(extra))
    named = members.join(found, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id")
    )
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
