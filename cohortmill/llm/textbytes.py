"""Whole-batch word splitting and hashing over the UTF-8 bytes of a text column.

Arrow hands a task its texts as one byte buffer with offsets.  Everything here works on
such a buffer at once, so no Python code runs per character or per word.  Bytes from
0x80 on are never white space, digits or ASCII letters, so byte rules equal the
code-point rules of the word patterns used by the operators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch and bytes of text handled at a time; a longer text is one piece.
BATCH_ROWS = 500
PIECE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _byte_class(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
NOT_SPACE = ~_byte_class([0x20, *range(0x09, 0x0E)])
LETTER_OR_DIGIT = _byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small; never raises a smaller setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def map_texts(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over batches small enough for whole texts."""
    small_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of at most ``PIECE_BYTES`` of text, one row at least; no row is left out."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column).cast(pa.binary())).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < batch.num_rows:
            base = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, base + PIECE_BYTES, side="right")))
            yield batch.slice(row, stop - row)
            row = stop


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offsets of each; a null has no bytes."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(offsets), dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, members: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and per text the index of its first word (one more at the end)."""
    inside = members[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    after = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Powers:
    """Powers of the hash base and of its inverse, grown when a piece is longer."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES)
            self.up = np.cumprod(np.full(size, _BASE, dtype=np.uint64))
            self.down = np.cumprod(np.full(size, _BASE_INVERSE, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any byte spans of one buffer, equal for equal bytes anywhere."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = POWERS.of(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHash(data).of(starts, ends)


def merged_runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    steps = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
