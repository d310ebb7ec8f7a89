"""Removal of repeated passages by a distributed merge sort of front-coded suffix runs.

A byte goes if a string of ``length`` bytes around it also starts anywhere else.  Suffixes
are sorted at *anchors* only: a position whose following gram has the least hash in some
stretch of grams that every string of ``length`` bytes holds whole.  Equal strings thus
share an anchor at the same offset, so nothing is missed, and grams that occur once in the
corpus drop out before any string is moved.

1. Every text's anchors; grams are counted over the corpus (combined before the shuffle).
2. Each task sorts the suffixes at its repeated anchors and writes front-coded runs (length
   of the prefix shared with the run's previous suffix, then the rest), a piece of the
   gram space each.
3. A task per piece merges the runs with a loser tree that carries common-prefix lengths:
   a comparison starts where the known prefix ends, and often needs no byte at all.  The
   merged order gives, between neighbours, how far texts agree to the right; the text to
   the left is compared in the same way, and together they give the spans.
4. Spans go back to their documents.

A gram with more than ``max_group`` occurrences never meets in one task: the windows
around its anchors are counted by digest instead, combined before the shuffle.

Defined results: null is empty.  Rows are documents; two equal rows are two occurrences.
Matches never cross documents.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import textbytes as tb
from cohortmill.llm.lineage import cut

LENGTH, GRAM = 400, 64
#: Occurrences of one gram that may meet in a task, bytes of strings of a sorted run and of a piece.
MAX_GROUP, RUN_BYTES, PIECE_BYTES = 20_000, 16 << 20, 16 << 20
#: Groups up to this size compare all members at once.
SMALL_GROUP = 48


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of one text whose gram is least in some stretch of grams, and the gram hashes."""
    width = length - gram + 1
    if len(data) < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    n = len(data) - gram + 1
    at = np.arange(n)
    hashes = tb.SpanHash(data).of(at, at + gram)
    least = _sliding(np.minimum, hashes, width)
    # Chosen: the largest minimum among the stretches around a position is its own hash.
    most = _sliding(np.maximum, np.pad(least, (width - 1, width - 1)), width)
    chosen = np.flatnonzero(most[:n] == hashes)
    return chosen, hashes[chosen]


def _sliding(function, values: np.ndarray, width: int) -> np.ndarray:
    """``function`` over every ``width`` neighbours: prefixes and suffixes of blocks."""
    n = len(values)
    padded = np.pad(values, (0, -n % width), mode="edge").reshape(-1, width)
    ahead = function.accumulate(padded, axis=1).reshape(-1)
    behind = function.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = n - width + 1
    return function(behind[:count], ahead[width - 1 : width - 1 + count])


def _find_anchors(length: int, gram: int):
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.pieces(batches):
            data, offsets = tb.buffer_of(batch.column("text"))
            rows, places, grams = [], [], []
            for row in np.flatnonzero(np.diff(offsets) >= length):
                at, hashes = anchors(data[offsets[row] : offsets[row + 1]], length, gram)
                rows.append(np.full(len(at), row))
                places.append(at)
                grams.append(hashes)
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(row),
                        batch.column("digest").take(row),
                        pa.array(np.concatenate(places).astype(np.int64)),
                        pa.array(np.concatenate(grams).view(np.int64)),
                    ],
                    ["id", "digest", "place", "gram"],
                )

    return results


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, reading only what follows the known one."""
    size = min(len(a), len(b)) - known
    differ = int.from_bytes(a[known : known + size]) ^ int.from_bytes(b[known : known + size])
    return known + size - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merges sorted runs of (shared prefix with the run's previous, string, payload).

    Every loser keeps the length of the prefix it shares with the winner it lost to.  A
    longer shared prefix with the last output means a smaller string, so bytes are read
    only between equals, from the known prefix on.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes, object]]]) -> None:
        self.runs = runs
        self.heads: list[tuple[int, bytes, object] | None] = [next(run, None) for run in runs]
        self.shared = [0 if head else -1 for head in self.heads]
        self.size = len(runs)
        self.losers = [-1] * self.size
        self.winner = self._play(1) if self.size else -1

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = self._match(a, b)
        return winner

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """The player with the smaller head first."""
        known, other = self.shared[a], self.shared[b]
        if known != other:
            return (a, b) if known > other else (b, a)
        if known < 0:
            return a, b
        x, y = self.heads[a][1], self.heads[b][1]
        meet = common_prefix(x, y, known)
        if meet == len(x) or (meet < len(y) and x[meet] < y[meet]):
            self.shared[b] = meet
            return a, b
        self.shared[a] = meet
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, object]]:
        """(prefix shared with the previous output, string, payload) in order."""
        while self.size and (head := self.heads[self.winner]) is not None:
            run = self.winner
            yield self.shared[run], head[1], head[2]
            self.heads[run] = following = next(self.runs[run], None)
            self.shared[run] = following[0] if following else -1
            node = (run + self.size) // 2
            while node:
                run, self.losers[node] = self._match(run, self.losers[node])
                node //= 2
            self.winner = run


def _front_coded(strings: dict[tuple[bytes, bytes], list[tuple[int, int, int]]]) -> dict[str, list]:
    """One sorted run: suffixes as (shared, rest), what precedes each, and its occurrences."""
    run = {"shared": [], "rest": [], "before": [], "owners": [], "ids": [], "digests": [], "places": []}
    previous = b""
    for right, left in sorted(strings):
        meet = common_prefix(previous, right, 0)
        run["shared"].append(meet)
        run["rest"].append(right[meet:])
        run["before"].append(left)
        owners = strings[right, left]
        run["owners"].append(len(owners))
        for name, values in zip(("ids", "digests", "places"), zip(*owners)):
            run[name].extend(values)
        previous = right
    return run


_RUN_TYPES = [
    ("part", pa.int64()),
    ("shared", pa.list_(pa.int32())),
    ("rest", pa.list_(pa.binary())),
    ("before", pa.list_(pa.binary())),
    ("owners", pa.list_(pa.int32())),
    ("ids", pa.list_(pa.int64())),
    ("digests", pa.list_(pa.int64())),
    ("places", pa.list_(pa.int64())),
]
_RUN_SCHEMA = (
    "part bigint, shared array<int>, rest array<binary>, before array<binary>, owners array<int>, "
    "ids array<bigint>, digests array<bigint>, places array<bigint>"
)


def _sorted_runs(length: int, gram: int, parts: int, run_bytes: int):
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        size = 0

        def runs() -> Iterator[pa.RecordBatch]:
            for part, strings in held.items():
                run = _front_coded(strings) | {"part": part}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run[name]], kind) for name, kind in _RUN_TYPES], [name for name, _ in _RUN_TYPES]
                )

        for batch in tb.pieces(batches):
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_py().encode()
                owner = batch.column("id")[row].as_py(), batch.column("digest")[row].as_py()
                places = np.array(batch.column("places")[row].as_py(), dtype=np.int64)
                data = np.frombuffer(text, dtype=np.uint8)
                grams = tb.SpanHash(data).of(places, places + gram)
                for place, part in zip(places.tolist(), (grams % np.uint64(parts)).tolist()):
                    string = text[place : place + length], text[max(0, place + gram - length) : place][::-1]
                    own = held.setdefault(part, {})
                    if string not in own:
                        own[string] = []
                        size += 2 * length
                    own[string].append((*owner, place))
                if size >= run_bytes:
                    yield from runs()
                    held.clear()
                    size = 0
        yield from runs()

    return results


def _decoded(row: dict) -> Iterator[tuple[int, bytes, object]]:
    """A run's suffixes again whole; payload: what precedes, and the occurrences."""
    previous, at = b"", 0
    for shared, rest, before, owners in zip(row["shared"], row["rest"], row["before"], row["owners"]):
        previous = previous[:shared] + rest
        stop = at + owners
        yield shared, previous, (before, row["ids"][at:stop], row["digests"][at:stop], row["places"][at:stop])
        at = stop


def reaches(
    rights: list[int], shared: list[int], before: list[bytes], several: list[bool], length: int
) -> list[tuple[int, int]]:
    """For each member of a gram's group, how far left and right of the anchor it repeats.

    ``rights``: length of each suffix, in sorted order; ``shared``: prefix shared with the
    one before; ``before``: the reversed text to the left; ``several``: occurs more than
    once as it is.  (0, 0) where no string of ``length`` bytes repeats.
    """
    n = len(rights)
    if n <= 2:
        # Most groups: a member repeats by itself, or with the other as far as both agree.
        pair = (common_prefix(before[0], before[1], 0), shared[1]) if n == 2 else (0, 0)
        found = []
        for right, left, again in zip(rights, map(len, before), several):
            ways = [way for way in (pair, (left, right) if again else (0, 0)) if sum(way) >= length]
            found.append((max(way[0] for way in ways), max(way[1] for way in ways)) if ways else (0, 0))
        return found
    lefts = np.array([len(x) for x in before])
    rights = np.array(rights)
    shared = np.array(shared)
    order = sorted(range(n), key=before.__getitem__)
    agree = np.array([0] + [common_prefix(before[a], before[b], 0) for a, b in zip(order, order[1:])])
    own = np.array(several) & (lefts + rights >= length)
    if n <= SMALL_GROUP:
        right, left = np.zeros((n, n), np.int64), np.zeros((n, n), np.int64)
        order = np.array(order)
        for i in range(n - 1):
            right[i, i + 1 :] = np.minimum.accumulate(shared[i + 1 :])
            left[order[i], order[i + 1 :]] = np.minimum.accumulate(agree[i + 1 :])
        right, left = right + right.T, left + left.T
        right[range(n), range(n)] = np.where(own, rights, 0)
        left[range(n), range(n)] = np.where(own, lefts, 0)
        valid = right + left >= length
        return list(zip((left * valid).max(axis=1).tolist(), (right * valid).max(axis=1).tolist()))
    # Larger groups: at a split into l bytes to the left and the others to the right, members with equal
    # parts on both sides are a class.  Classes change only where l passes a prefix that neighbours share.
    most, least = np.full(n, -1), np.full(n, length + 1)
    place = np.empty(n, np.int64)
    place[np.array(order)] = np.arange(n)
    begins = np.unique(np.concatenate([[0], agree + 1, length - shared]))
    begins = begins[(begins >= 0) & (begins <= length)]
    for l, last in zip(begins.tolist(), [*(begins[1:] - 1).tolist(), length]):
        key = np.cumsum(shared < length - l) * (n + 1) + np.cumsum(agree < l)[place]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        first, final = np.maximum(l, length - rights), np.minimum(last, lefts)
        repeats = ((count[which] > 1) | own) & (first <= final)
        most = np.where(repeats, np.maximum(most, final), most)
        least = np.where(repeats, np.minimum(least, first), least)
    return [(a, length - b) if a >= 0 else (0, 0) for a, b in zip(most.tolist(), least.tolist())]


_SPAN_SCHEMA = "id bigint, digest bigint, start bigint, end bigint"


def _merge(length: int, gram: int):
    def spans_of(group: list) -> Iterator[tuple[int, int, int, int]]:
        if len(group) == 1 and len(group[0][2][1]) == 1:
            return
        found = reaches(
            [len(x[1]) for x in group], [0, *(x[0] for x in group[1:])], [x[2][0] for x in group],
            [len(x[2][1]) > 1 for x in group], length,
        )
        for (left, right), (_, _, (_, *owners)) in zip(found, group):
            if right:
                for identity, digest, place in zip(*owners):
                    yield identity, digest, place - left, place + right

    def results(table: pa.Table) -> pa.Table:
        rows = [_decoded(row) for batch in table.to_batches() for row in _rows(batch)]
        spans: list[tuple[int, int, int, int]] = []
        group: list = []
        for item in LoserTree(rows):
            if item[0] < gram and group:
                spans.extend(spans_of(group))
                group = []
            group.append(item)
        if group:
            spans.extend(spans_of(group))
        columns = zip(*spans) if spans else [[]] * 4
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["id", "digest", "start", "end"])

    return results


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for row in range(batch.num_rows):
        yield {name: batch.column(name)[row].as_py() for name in batch.schema.names}


def _window_digests(length: int, gram: int):
    """Digest and start of every distinct window of a row that holds one of its listed anchors whole."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.pieces(batches):
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[row].as_py().encode(), dtype=np.uint8)
                inside = np.zeros(len(data) + 2, dtype=np.int64)
                places = np.array(batch.column("places")[row].as_py(), dtype=np.int64)
                np.add.at(inside, np.maximum(0, places + gram - length), 1)
                np.add.at(inside, np.minimum(places, len(data) - length) + 1, -1)
                at = np.flatnonzero(np.cumsum(inside)[: len(data) - length + 1] > 0)
                hashes = tb.SpanHash(data).of(at, at + length)
                same = pa.array(np.full(len(at), row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(same), batch.column("digest").take(same), pa.array(at),
                     pa.array(hashes.view(np.int64))],
                    ["id", "digest", "start", "window"],
                )

    return results


def _final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tb.pieces(batches):
        data, offsets = tb.buffer_of(batch.column("text"))
        spans = batch.column("spans")
        removed, kept, digests = [], [], []
        for row in range(batch.num_rows):
            text = data[offsets[row] : offsets[row + 1]]
            own = spans[row].as_py()
            if not own:
                removed.append([])
                digests.append(hashlib.sha256(text.tobytes()).hexdigest())
                continue
            change = np.zeros(len(text) + 1, dtype=np.int64)
            for span in own:
                change[span["start"]] += 1
                change[span["end"]] -= 1
            gone = np.cumsum(change[:-1]) > 0
            start, end = tb.merged_runs(gone)
            removed.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())])
            digests.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array([sum(x["end"] - x["start"] for x in row) for row in removed], pa.int64()),
                pa.array([len(row) for row in removed], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(removed, kind),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def _listed(places: DataFrame) -> DataFrame:
    return places.groupBy("id", "digest").agg(F.sort_array(F.collect_set("place")).alias("places"))


def repeated_spans(
    texts: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    max_group: int = MAX_GROUP,
    run_bytes: int = RUN_BYTES,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """(id, digest, start, end) of repeated spans; ``texts`` has id, digest, text and may have more."""
    places = tb.map_texts(texts.select("id", "digest", "text"), _find_anchors(length, gram), "id bigint, digest bigint, place bigint, gram bigint")
    counted = places.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(places.join(counted, "gram").select("id", "digest", "place", "n"))
    usual = shared.where(F.col("n") <= max_group)
    total, hot = shared.agg(
        F.count(F.when(F.col("n") <= max_group, 1)), F.count(F.when(F.col("n") > max_group, 1))
    ).first()
    parts = 1 + total * 2 * length // piece_bytes
    runs = tb.map_texts(
        texts.join(_listed(usual).hint("shuffle_hash"), ["id", "digest"]),
        _sorted_runs(length, gram, parts, run_bytes),
        _RUN_SCHEMA,
    )
    spans = runs.groupBy("part").applyInArrow(_merge(length, gram), _SPAN_SCHEMA)
    if not hot:
        return spans
    windows = tb.map_texts(
        texts.join(_listed(shared.where(F.col("n") > max_group)).hint("shuffle_hash"), ["id", "digest"]),
        _window_digests(length, gram),
        "id bigint, digest bigint, start bigint, window bigint",
    )
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    return spans.union(
        windows.join(twice, "window").select("id", "digest", "start", (F.col("start") + length).alias("end"))
    )


def remove_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """Per row of ``docs``: n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans."""
    texts = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64("doc_id", "text").alias("digest"),
    )
    # Both joins with the texts take the same columns and are one job, so the texts are shuffled once.
    spans = repeated_spans(texts, **parameters)
    listed = spans.groupBy("id", "digest").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return tb.map_texts(
        texts.join(listed.hint("shuffle_hash"), ["id", "digest"], "left").select("doc_id", "text", "spans"),
        _final,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<start:bigint,end:bigint>>",
    )
