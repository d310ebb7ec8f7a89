"""Quality scores by a hashed word n-gram logistic regression.

1. Words are runs of letters and digits and runs of other signs, as written.  A text's features are
   its n-grams of one to three words, hashed to ``1 << BITS`` places, and one place that every
   three-word n-gram seen before in the same text counts for.  The value of a feature is log(1 + count),
   and each text's values are scaled to length 1 beside a constant of ``CONSTANT``.
2. Training is follow-the-regularised-leader with a step of its own for each place.  Labelled rows are
   dealt to ``REPLICAS`` by a digest; each replica passes over its rows, in the order of another digest,
   from the same state, one row at a time; the states are averaged by an aggregate, and the next epoch begins there.
   States travel as whole numbers, so sums do not depend on the order in which tasks end.
3. A score is the logistic function of one sparse dot product.

Labels are learnt from a sample of at most about ``train_rows`` rows (a parameter), never from rows with
crc32(doc_id) mod 5 = 0.  Only texts are inputs of a score; whole texts are read.  A replica holds its
state and a batch of rows, and the driver the places with a weight.

Defined results: a null text is an empty one and is scored by the constant alone.  Labels other than 0 and 1
are ignored; of contrary labels of one id the lower one holds; a null doc_id is never trained on
and not held out.  Without labels of both kinds every score is the smoothed share of label 1.  Rows are
scored one by one, repeated ones alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import textbytes as tb
from cohortmill.llm.lineage import cut

TRAIN_ROWS, BITS, NGRAMS, REPLICAS, EPOCHS = 10_000, 18, 3, 4, 5
#: Step size, its start, and the two penalties of the leader; value of the constant feature.
ALPHA, BETA, L1, L2, CONSTANT = 5.0, 1.0, 0.02, 0.02, 1.0
#: State values travel as multiples of this.
UNIT = 2.0**-30

_SIGN = ~(tb._byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])) & tb.NOT_SPACE
_LETTER = tb.NOT_SPACE & ~_SIGN
_CHAIN = np.uint64(0x9E3779B97F4A7C15)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def features(batch: pa.RecordBatch, bits: int = BITS, ngrams: int = NGRAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, value and the first feature of each row (one more at the end); places rise within a row.

    Place 0 is the constant and place 1 counts repeated n-grams.
    """
    data, offsets = tb.buffer_of(batch.column("text"))
    starts, ends = (np.concatenate(x) for x in zip(*(tb.word_bounds(data, offsets, m)[:2] for m in (_LETTER, _SIGN))))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    words = tb.word_hashes(data, starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    rows, places = [np.arange(batch.num_rows)], [np.zeros(batch.num_rows, dtype=np.int64)]
    gram = words
    for size in range(1, ngrams + 1):
        if size > 1:
            gram = tb.mixed(gram[:-1] * _CHAIN + words[size - 1 :])
        inside = row[: len(gram)] == row[size - 1 :]
        rows.append(row[: len(gram)][inside])
        places.append((gram[inside] % np.uint64((1 << bits) - 2)).astype(np.int64) + 2)
        if size == ngrams:
            # Every occurrence of a whole n-gram after its first in the text.
            key = np.sort((rows[-1] << 40) | (gram[inside] >> np.uint64(24)).astype(np.int64))
            again = key[1:][key[1:] == key[:-1]] >> 40
            rows.append(again)
            places.append(np.ones(len(again), dtype=np.int64))
    found, count = np.unique((np.concatenate(rows) << bits) | np.concatenate(places), return_counts=True)
    row, place = found >> bits, found & ((1 << bits) - 1)
    value = np.log1p(count)
    constant = place == 0
    value[constant] = 0
    length = np.sqrt(np.bincount(row, weights=value**2, minlength=batch.num_rows))
    value = value / np.where(length > 0, length, 1)[row]
    value[constant] = CONSTANT
    return place, value, np.searchsorted(row, np.arange(batch.num_rows + 1))


class Leader:
    """Follow the regularised leader, one step size per place."""

    def __init__(self, bits: int, places=(), z=(), n=()) -> None:
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        at = np.asarray(places, dtype=np.int64)
        self.z[at], self.n[at] = z, n

    def weights(self, places) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        # The constant carries the share of label 1 and is not drawn to zero.
        l1 = np.where(np.arange(len(self.z))[places] == 0, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        gradient = (1 / (1 + math.exp(-min(max(float(w @ values), -35), 35))) - label) * values
        n = self.n[places]
        after = n + gradient**2
        self.z[places] += gradient - (np.sqrt(after) - np.sqrt(n)) / ALPHA * w
        self.n[places] = after


@dataclass
class Model:
    """Places with a weight, in rising order; place 0 holds the constant."""

    places: np.ndarray
    weights: np.ndarray
    bits: int = BITS
    ngrams: int = NGRAMS

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        place, value, first = features(batch, self.bits, self.ngrams)
        dense = np.zeros(1 << self.bits)
        dense[self.places] = self.weights
        if not batch.num_rows:
            return np.zeros(0)
        # Row by row, so that a score does not depend on the rows beside it; each has the constant.
        sums = np.add.reduceat(dense[place] * value, first[:-1])
        return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def _labelled(docs: DataFrame, labels: DataFrame, column: str, train_rows: int) -> DataFrame:
    """(text, label, replica, turn) of at most about ``train_rows`` rows that are not held out."""
    usable = (
        labels.select(F.col("doc_id").alias("labelled_id"), F.col(column).cast("int").alias("label"))
        .where("labelled_id IS NOT NULL AND label IN (0, 1)")
        .where(~is_held_out(F.col("labelled_id")))
        .groupBy("labelled_id")
        .agg(F.min("label").alias("label"))
    )
    rows = docs.select("doc_id", "text").join(usable, F.col("doc_id") == F.col("labelled_id"))
    rows = rows.select("doc_id", "text", "label")
    n = usable.count()
    if n > train_rows:
        share = (1 << 20) * train_rows // n
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < share)
    replica = F.pmod(F.xxhash64("doc_id", F.lit("replica")), F.lit(REPLICAS)).cast("int")
    return rows.select("text", "label", replica.alias("replica"), F.xxhash64("doc_id", "text", F.lit("turn")).alias("turn"))


def fit(
    docs: DataFrame, labels: DataFrame, column: str = "quality", train_rows: int = TRAIN_ROWS,
    bits: int = BITS, ngrams: int = NGRAMS, epochs: int = EPOCHS,
) -> Model:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.pieces(batches):
            place, value, first = features(batch, bits, ngrams)
            first = pa.array(first, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"), batch.column("replica"), batch.column("turn"),
                    pa.ListArray.from_arrays(first, pa.array(place, pa.int32())),
                    pa.ListArray.from_arrays(first, pa.array(value, pa.float32())),
                ],
                ["label", "replica", "turn", "places", "values"],
            )

    hashed_rows = tb.map_texts(
        _labelled(docs, labels, column, train_rows), hashed,
        "label int, replica int, turn bigint, places array<int>, values array<float>",
    )
    # Dealt out and put in order once; every epoch then reads the stored partitions in place.
    dealt = hashed_rows.repartition(REPLICAS, "replica").sortWithinPartitions("replica", "turn", "label")
    sample = cut(dealt.select("label", "replica", "places", "values"))
    seen = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        odds = (seen.get(1, 0) + 0.5) / (seen.get(0, 0) + 0.5)
        return Model(np.zeros(1, dtype=np.int64), np.array([math.log(odds) / CONSTANT]), bits, ngrams)

    state = (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))
    for _ in range(epochs):
        state = _epoch(sample, state, bits)
    places, z, n = state
    weights = Leader(bits, places, z, n).weights(places)
    kept = weights != 0
    return Model(places[kept], weights[kept], bits, ngrams)


def _epoch(sample: DataFrame, state: tuple, bits: int) -> tuple:
    """Average of the replicas' states after a pass over their rows, each from ``state``."""

    def state_of(leader: Leader) -> pa.RecordBatch:
        touched = np.flatnonzero(leader.n)
        columns = [touched.astype(np.int32), *(np.round(x[touched] / UNIT).astype(np.int64) for x in (leader.z, leader.n))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "z", "n"])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The states of the replicas of a partition, one after the other."""
        now, leader = None, None
        for batch in batches:
            places, values = batch.column("places"), batch.column("values")
            first = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy())])
            place, value = places.flatten().to_numpy(), values.flatten().to_numpy().astype(np.float64)
            for i, (replica, label) in enumerate(zip(batch.column("replica").to_pylist(), batch.column("label").to_pylist())):
                if replica != now:
                    if leader is not None:
                        yield state_of(leader)
                    now, leader = replica, Leader(bits, *state)
                span = slice(first[i], first[i + 1])
                leader.learn(place[span], value[span], label)
        if leader is not None:
            yield state_of(leader)

    states = sample.mapInArrow(passed, "place int, z bigint, n bigint")
    replicas = sample.select("replica").distinct().count()
    summed = states.groupBy("place").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()  # 1 << bits rows at most
    place, z, n = (summed[name].to_numpy() for name in ("place", "z", "n"))
    order = np.argsort(place)
    return place[order].astype(np.int64), z[order] * (UNIT / replicas), n[order] * (UNIT / replicas)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and score of every row."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(model.scores(batch))], ["doc_id", "held_out", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return tb.map_texts(rows, results, "doc_id bigint, held_out boolean, score double")
