"""Benchmark decontamination by an FM-index over each shard of training text.

A task cuts its documents into shards, builds one FM-index per shard (suffix order, the
Burrows-Wheeler transform in a wavelet tree, sampled suffix positions) and runs all test
phrases backwards through it.  Occurrences merge into the spans to remove.

The alphabet is the vocabulary of the test phrases.  A training word outside it can be in
no occurrence, so it ends a run of text, and runs shorter than the shortest phrase are not
indexed; both are exact.  Nothing is shuffled: one document's result needs only its text.

Defined results: null or word-less texts have no hits.  Items without words, or null ones,
have no windows.  Rows are handled one by one, so repeated rows and null ids give a row each.
Extra columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import textbytes as tb

WINDOW_WORDS = 10
#: Suffix positions kept: one in so many, and every start of a run.
SAMPLE_RATE = 8
#: UTF-8 bytes of test items that a task holds at a time; more items make more blocks.
BLOCK_BYTES = 2 << 20

SPANS = "array<struct<start:bigint,end:bigint>>"
_SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    f"contaminated boolean, item_ids array<string>, spans {SPANS}"
)


class WaveletTree:
    """Rank of any symbol at any position, level by level over the symbols' bits."""

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        self.levels = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift) & 1
            ones = np.zeros(len(bits) + 1, dtype=np.int64)
            np.cumsum(bits, out=ones[1:])
            self.levels.append((shift, ones, len(bits) - int(ones[-1])))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``position``, for arrays of both."""
        first = np.zeros_like(position)
        for shift, ones, zeros in self.levels:
            is_one = ((symbol >> shift) & 1).astype(bool)
            a, b = ones[first], ones[position]
            first = np.where(is_one, zeros + a, first - a)
            position = np.where(is_one, zeros + b, position - b)
        return position - first


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions in suffix order; zeros end a run, and differ from each other by place.

    Prefix doubling that sorts only what is still tied.
    """
    n = len(text)
    breaks = text == 0
    key = text + int(breaks.sum())
    key[breaks] = np.arange(int(breaks.sum()))
    order = np.argsort(key, kind="stable")
    step = 1

    def starts_of(sorted_key: np.ndarray) -> np.ndarray:
        return np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])

    lead = starts_of(key[order])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(lead, np.arange(n), 0))
    while True:
        alone = lead & np.concatenate([lead[1:], [True]])
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order
        at = order[slots]
        follow = rank[np.minimum(at + step, n - 1)]
        head = rank[at]
        again = np.lexsort((follow, head))
        order[slots] = at[again]
        head, follow = head[again], follow[again]
        new = np.concatenate([[True], (head[1:] != head[:-1]) | (follow[1:] != follow[:-1])])
        lead[slots] = new
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        step *= 2


class FmIndex:
    """Backward search and sampled locating over runs of word numbers (1 up) ended by zeros."""

    def __init__(self, text: np.ndarray, n_symbols: int) -> None:
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.tree = WaveletTree(self.bwt, n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        kept = (order % SAMPLE_RATE == 0) | (self.bwt == 0)
        self.kept, self.kept_before = kept, np.concatenate([[0], np.cumsum(kept)])
        self.places = order[kept]

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of each phrase of one length."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), len(self.bwt), dtype=np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        dead = np.ones(len(phrases), dtype=bool)
        dead[live] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back to the nearest kept position."""
        found = np.empty(len(rows), dtype=np.int64)
        walking, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(walking):
            here = self.kept[rows]
            found[walking[here]] = self.places[self.kept_before[rows[here]]] + steps
            walking, rows = walking[~here], rows[~here]
            symbol = self.bwt[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return found


class Phrases:
    """Distinct windows of one block of items as word numbers, and the items of each window."""

    def __init__(self, items: list[tuple[str, str]], width: int) -> None:
        data, offsets = tb.buffer_of(pa.array([text for _, text in items], pa.string()))
        data = tb.lower_ascii(data)
        starts, ends, first = tb.word_bounds(data, offsets, tb.LETTER_OR_DIGIT)
        hashes = tb.word_hashes(data, starts, ends)
        self.vocabulary = np.unique(hashes)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        number = np.searchsorted(self.vocabulary, hashes) + 1
        windows: dict[tuple[int, ...], set[str]] = {}
        for i, (item_id, _) in enumerate(items):
            words = number[first[i] : first[i + 1]].tolist()
            for at in range(max(1, len(words) - width + 1) if words else 0):
                windows.setdefault(tuple(words[at : at + width]), set()).add(item_id)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for window in windows:
            by_length.setdefault(len(window), []).append(window)
        self.groups = [
            (n, np.array(group, dtype=np.int64), [sorted(windows[w]) for w in group])
            for n, group in sorted(by_length.items())
        ]
        self.shortest = self.groups[0][0] if self.groups else 0

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 0 for words of no item."""
        out = np.zeros(len(hashes), dtype=np.int64)
        if len(self.vocabulary):
            maybe = np.flatnonzero(self.filter[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[at] == hashes[maybe], at + 1, 0)
        return out

    def occurrences(
        self, numbers: np.ndarray, first: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list[str]]]]:
        """Per window length: length, first word of each occurrence, its window, the windows' items."""
        if not self.groups or not len(numbers):
            return
        # A run ends at a word of no item and at the end of its document.
        padded = np.insert(numbers, first[1:-1], 0)
        place = np.insert(np.arange(len(numbers)), first[1:-1], -1)
        begin, end = tb.merged_runs(padded > 0)
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return
        size = end - begin + 1
        offset = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(offset[-1]) - np.repeat(offset[:-1], size) + np.repeat(begin, size)
        last = offset[1:] - 1
        source[last] = 0
        text = padded[source]
        text[last] = 0
        index = FmIndex(text, len(self.vocabulary) + 1)
        for length, group, items in self.groups:
            low, high = index.ranges(group)
            count = high - low
            which = np.repeat(np.arange(len(group)), count)
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            yield length, place[source[index.locate(rows)]], which, items


def _scan(phrases: Phrases, batches: Iterator[pa.RecordBatch], later: bool = False) -> Iterator[tuple]:
    """Each piece with its hit words and items; a ``later`` block takes over the hits of those before it."""
    for batch in tb.pieces(batches):
        data, offsets = tb.buffer_of(batch.column("text"))
        data = tb.lower_ascii(data)
        starts, ends, first = tb.word_bounds(data, offsets, tb.LETTER_OR_DIGIT)
        hashes = tb.word_hashes(data, starts, ends)
        n = batch.num_rows
        change = np.zeros(len(starts) + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        known = [set(x) for x in batch.column("item_ids").to_pylist()] if later else None
        for length, words, which, owners in phrases.occurrences(phrases.numbers(hashes), first):
            np.add.at(change, words, 1)
            np.add.at(change, words + length, -1)
            rows = np.searchsorted(first, words, side="right") - 1
            for pair in np.unique(rows * len(owners) + which).tolist():
                items.setdefault(pair // len(owners), set()).update(owners[pair % len(owners)])
        if known is not None:
            begin, end = batch.column("from_word").to_pylist(), batch.column("to_word").to_pylist()
            for row in range(n):
                if known[row]:
                    items.setdefault(row, set()).update(known[row])
                    change[first[row] + np.array(begin[row], dtype=np.int64)] += 1
                    change[first[row] + np.array(end[row], dtype=np.int64)] -= 1
        hit = np.cumsum(change[:-1]) > 0
        hits = np.concatenate([[0], np.cumsum(hit)])
        yield batch, hit, hits, first, starts, ends, offsets, items


def _spans_of(row, hit, first, starts, ends, offsets):
    """Merged removal spans of one text: bytes from the first to the last hit word of each run."""
    begin, end = tb.merged_runs(hit[first[row] : first[row + 1]])
    base = first[row]
    return begin, end, starts[base + begin] - offsets[row], ends[base + end - 1] - offsets[row]


def _mapper(block: list[tuple[str, str]], width: int, last: bool, later: bool):
    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(block, width)
        for batch, hit, hits, first, starts, ends, offsets, items in _scan(phrases, batches, later):
            n = batch.num_rows
            ids = [sorted(items.get(row, ())) for row in range(n)]
            spans = [
                _spans_of(row, hit, first, starts, ends, offsets) if ids[row] else None for row in range(n)
            ]
            if not last:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text"),
                        pa.array(ids, pa.list_(pa.string())),
                        pa.array([s[0].tolist() if s else [] for s in spans], pa.list_(pa.int64())),
                        pa.array([s[1].tolist() if s else [] for s in spans], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text", "item_ids", "from_word", "to_word"],
                )
                continue
            n_hit = hits[first[1:]] - hits[first[:-1]]
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(first)),
                    pa.array(n_hit),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids]),
                    pa.array(n_hit > 0),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array(
                        [
                            [{"start": a, "end": b} for a, b in zip(s[2].tolist(), s[3].tolist())] if s else []
                            for s in spans
                        ],
                        pa.list_(span),
                    ),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids", "spans"],
            )

    return results


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The stated test items in blocks of bounded size, so that a task never holds more than one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        yield [(row.item_id, row.text) for row in part.collect()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: word and hit counts, the items found, and byte spans to remove.

    A window is ``window_words`` consecutive words of an item (the whole item if it has
    fewer); a document word inside any occurrence of a window is hit.
    """
    found = docs.select("doc_id", "text")
    blocks = list(_blocks(benchmark, block_bytes)) or [[]]
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        schema = _SCHEMA if last else (
            "doc_id bigint, text string, item_ids array<string>, from_word array<bigint>, to_word array<bigint>"
        )
        found = tb.map_texts(found, _mapper(block, window_words, last, i > 0), schema)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of a test item, all columns as they were."""
    columns = docs.columns
    blocks = list(_blocks(benchmark, BLOCK_BYTES))

    def clean(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(block, WINDOW_WORDS)
        for batch, _, hits, first, *_ in _scan(phrases, batches):
            n_hit = hits[first[1:]] - hits[first[:-1]]
            yield batch.filter(pa.array(n_hit == 0))

    for block in blocks:
        docs = tb.map_texts(docs, lambda batches, block=block: clean(batches, block), docs.schema)
    return docs.select(columns)


def without_passages(docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """All rows of ``docs``, all columns as they were but the hit passages cut out of ``text``.

    A passage reaches from the first to the last byte of a run of hit words.  A null text stays null; rows are
    handled one by one, so repeated rows and ids, and rows without one, stay what they are.
    """
    columns = docs.columns
    held = "_passages"
    while held in columns:
        held += "_"
    rows = docs.withColumn(held, F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)"))

    def found(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(block, window_words)
        for batch, hit, hits, first, starts, ends, offsets, _ in _scan(phrases, batches):
            spans = batch.column(held).to_pylist()
            for row in np.flatnonzero(hits[first[1:]] > hits[first[:-1]]).tolist():
                _, _, begin, end = _spans_of(row, hit, first, starts, ends, offsets)
                spans[row] += [{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())]
            at = batch.schema.get_field_index(held)
            yield batch.set_column(at, batch.schema.field(at), pa.array(spans, batch.schema.field(at).type))

    for block in _blocks(benchmark, BLOCK_BYTES):
        rows = tb.map_texts(rows, lambda batches, block=block: found(batches, block), rows.schema)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.pieces(batches):
            spans = [_joined((s["start"], s["end"]) for s in row) for row in batch.column(held).to_pylist()]
            texts = [cut_passages(text, own) for text, own in zip(batch.column("text").to_pylist(), spans)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return tb.map_texts(rows, cut_out, rows.schema).select(columns)


def _joined(spans: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def cut_passages(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the removal spans (UTF-8 byte offsets, sorted, apart)."""
    if text is None or not spans:
        return text
    data, at, kept = text.encode(), 0, []
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]]).decode()
