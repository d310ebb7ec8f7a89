"""Toxicity scores of restored texts.

1. A character language model: letter pairs counted over every document.
2. Deobfuscation as a noisy channel: a token with digits or signs among its letters, with
   letters repeated, or spelt out character by character, becomes a lattice of
   the letters each character may stand for (or of nothing, for signs and repeats); Viterbi
   picks the word that the language model and the channel make most likely.
3. A document's words, as written and as restored, are looked up in a table of words and
   word beginnings that tell toxic texts from others; a logistic model turns the weights
   found into a score.

The table and the logistic model are fitted on a bounded sample of labelled rows
(``train_rows``): one half for the weights, the other for the logistic model.  Rows with
crc32(doc_id) mod 5 = 0 are held out.  Only texts are inputs of a score.

Defined results: a null text is empty, and gets the score of a text without any finding.
Without labelled rows of both kinds every score is the smoothed share of toxic ones.  Rows
are handled one by one; extra columns are ignored; a null doc_id is never trained on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import textbytes as tb
from cohortmill.llm.lineage import cut

#: Labelled rows used for fitting, words and beginnings kept, and bytes of the beginnings.
TRAIN_ROWS, FEATURES, PREFIXES = 20_000, 4_096, range(3, 9)
MIN_TOXIC_ROWS = 3

#: Letters a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou",
}
#: Log-probabilities of the channel.
AS_IS, DISGUISED, REPEATED, DROPPED_SIGN, DROPPED_DISGUISE = 0.0, -0.7, -0.3, -0.4, -4.0

LETTERS = tb._byte_class([*range(0x61, 0x7B), *range(0x80, 0x100)])
_DIGITS = tb._byte_class(range(0x30, 0x3A))
_LEET = tb._byte_class(map(ord, STANDS_FOR))
_SIGNS = re.escape("".join(c for c in STANDS_FOR if not c.isdigit()))
_EDGE = re.compile(rf"^[^\w{_SIGNS}]+|[^\w{_SIGNS}]+$")
#: One character after the other of a spelt word, and letters with one and the same sign between.
_SINGLE = re.compile(rf"([^\W_]+|[{_SIGNS}]+)")
_REPEAT = re.compile(r"(.)\1")
_DIVIDED = re.compile(r"^[^\W_]([^\w])[^\W_](?:\1[^\W_])+$")

_START = 26
_ALPHABET = {chr(97 + i): i for i in range(26)}


def _letter_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter pairs a-z; 26 stands before a word's first letter and after its last."""
    counts = np.zeros(27 * 27, dtype=np.int64)
    code = np.full(256, 27, dtype=np.int64)
    code[0x61:0x7B] = np.arange(26)
    code[~LETTERS] = 26
    for batch in tb.pieces(batches):
        data, offsets = tb.buffer_of(batch.column("text"))
        if not len(data):
            continue
        codes = np.insert(code[tb.lower_ascii(data)], offsets, 26)
        left, right = codes[:-1], codes[1:]
        known = (left < 27) & (right < 27) & ((left != 26) | (right != 26))
        counts += np.bincount(left[known] * 27 + right[known], minlength=27 * 27)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["pair", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log-probabilities of the next letter (27 x 27), from all documents."""
    counted = tb.map_texts(docs.select("text"), _letter_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.full(27 * 27, 0.5)
    for row in counted.collect():  # 729 rows at most
        counts[row.pair] += row.n
    counts = counts.reshape(27, 27)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def restore(token: str, model: list[list[float]], keep_repeats: bool = False) -> str:
    """The most likely word behind a token: Viterbi over its character lattice."""
    states: dict[int, tuple[float, str]] = {_START: (0.0, "")}
    previous = ""
    for char in token:
        options: list[tuple[str, float]] = []
        if char in _ALPHABET:
            options.append((char, AS_IS))
        elif char in STANDS_FOR:
            options += [(x, DISGUISED) for x in STANDS_FOR[char]]
        elif char.isalpha():
            options.append((char, AS_IS))
        # Signs may stand for nothing, and so may a repeated character; a digit always stands for a letter.
        if char == previous and not keep_repeats:
            dropped = REPEATED
        elif char.isalnum():
            dropped = None
        else:
            dropped = DROPPED_DISGUISE if char in STANDS_FOR else DROPPED_SIGN
        following: dict[int, tuple[float, str]] = {}
        for last, (score, word) in states.items():
            if dropped is not None:
                kept = following.get(last)
                if kept is None or kept[0] < score + dropped:
                    following[last] = (score + dropped, word)
            for letter, cost in options:
                code = _ALPHABET.get(letter, _START)
                new = score + cost + model[last][code]
                kept = following.get(code)
                if kept is None or kept[0] < new:
                    following[code] = (new, word + letter)
        states, previous = following, char
    return max((score + model[last][_START], word) for last, (score, word) in states.items())[1]


def _pick(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, str]]:
    rows = np.searchsorted(offsets, first, side="right") - 1
    for row, a, b in zip(rows.tolist(), first.tolist(), last.tolist()):
        yield row, data[a:b].tobytes().decode("utf-8", "replace")


def spelt(text: str) -> Iterator[str]:
    """Words that a stretch of single characters may spell: all of it and each part between
    equal separators, with and without an outer character (an article may stand before it)."""
    parts = _SINGLE.split(text)
    units, between = parts[1::2], parts[2:-1:2]
    words, begin = [units], 0
    for k in range(1, len(units) + 1):
        if k == len(units) or (k - 1 > begin and between[k - 1] != between[begin]):
            if 2 < k - begin < len(units):
                words.append(units[begin:k])
            begin = k
    for word in words:
        yield "".join(word)
        if len(word) > 3:
            yield "".join(word[1:])
            yield "".join(word[:-1])


def disguised(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str]]:
    """(row, token) of the tokens in lower-cased texts that need restoring.

    Tokens with a leet sign or a digit, with signs between letters or with a letter twice
    in a row, and stretches of three or more single characters (or one character repeated)
    with any separators.  Only characters that stand for nothing are stripped.  Numbers and
    runs of one sign alone are left as they are.
    """
    if len(data) < 2:
        return
    letter, leet, digit = LETTERS[data], _LEET[data], _DIGITS[data]

    def within(flags: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[last] - sums[first]

    starts, ends, _ = tb.word_bounds(data, offsets, tb.NOT_SPACE)
    same = np.zeros(len(data), dtype=bool)
    same[1:] = (data[1:] == data[:-1]) & letter[1:]
    breaks = np.zeros(len(data), dtype=bool)  # a letter that follows something else
    breaks[1:] = letter[1:] & ~letter[:-1]
    letters, signs = within(letter, starts, ends), within(leet & ~digit, starts, ends)
    odd = (within(leet, starts, ends) > 0) & ((letters > 0) | ((signs > 0) & (within(digit, starts, ends) > 0)))
    odd |= (within(same, np.minimum(starts + 1, ends), ends) > 0) | (within(breaks, np.minimum(starts + 1, ends), ends) - (~letter[starts]) > 0)
    for row, token in _pick(data, offsets, starts[odd], ends[odd]):
        token = _EDGE.sub("", token)
        if token:
            yield row, token
            if _DIVIDED.match(token):
                yield row, token[::2]

    starts, ends, _ = tb.word_bounds(data, offsets, LETTERS | _LEET)
    if len(starts) < 3:
        return
    characters = within((data & 0xC0) != 0x80, starts, ends)
    other = np.zeros(len(data), dtype=bool)
    other[1:] = data[1:] != data[:-1]
    single = (characters == 1) | (within(other, starts + 1, ends) == 0)
    row = np.searchsorted(offsets, starts, side="right")
    begin, end = tb.merged_runs(single[1:] & single[:-1] & (row[1:] == row[:-1]))
    first, last = starts[begin], ends[end]
    long = (end - begin >= 2) & (within(letter, first, last) > 0)
    for row, text in _pick(data, offsets, first[long], last[long]):
        for token in spelt(text):
            yield row, token


class Restorer:
    """Restores tokens of texts and remembers those seen lately."""

    KEPT = 100_000

    def __init__(self, model: np.ndarray) -> None:
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    def word(self, token: str) -> str:
        word = self.known.get(token)
        if word is None:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            word = restore(token, self.model)
            # A doubled letter may also be meant.
            if _REPEAT.search(token) and (doubled := restore(token, self.model, True)) != word:
                word = f"{word} {doubled}"
            self.known[token] = word
        return word

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The restored words of each text."""
        out: list[list[str]] = [[] for _ in range(len(offsets) - 1)]
        for row, token in disguised(data, offsets):
            out[row].append(self.word(token))
        return [" ".join(words) for words in out]


_WORD, _BEGINNING, _MANY = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x27BB2EE687B0B0FD)


def _features_of(
    data: np.ndarray, offsets: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, word hash) of the words and beginnings that ``wanted`` passes, and words per row."""
    starts, ends, first = tb.word_bounds(data, offsets, LETTERS)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hasher = tb.SpanHash(data)
    words = hasher.of(starts, ends)
    rows, features, owners = [], [], []

    def add(keep: np.ndarray | None, feature: np.ndarray) -> None:
        ok = np.flatnonzero(wanted(feature))
        at = ok if keep is None else keep[ok]
        rows.append(row[at])
        features.append(feature[ok])
        owners.append(words[at])

    add(None, words ^ _WORD)
    for n in PREFIXES:
        longer = np.flatnonzero(ends - starts > n)
        add(longer, hasher.of(starts[longer], starts[longer] + n) ^ _BEGINNING)
    return np.concatenate(rows), np.concatenate(features), np.concatenate(owners)


def _row_features(batch: pa.RecordBatch, restorer: Restorer, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) with the number of distinct words behind each, and the words per row."""
    data, offsets = tb.buffer_of(batch.column("text"))
    data = tb.lower_ascii(data)
    row, feature, word = _features_of(data, offsets, wanted)
    n_words = np.diff(tb.word_bounds(data, offsets, LETTERS)[2])
    restored = restorer.texts(data, offsets)
    if any(restored):
        more, more_offsets = tb.buffer_of(pa.array(restored, pa.string()))
        extra = _features_of(more, more_offsets, wanted)
        row, feature, word = (np.concatenate(pair) for pair in zip((row, feature, word), extra))
    if not len(row):
        return row, feature, np.zeros(0, np.int64), n_words
    order = np.lexsort((word, feature, row))
    row, feature, word = row[order], feature[order], word[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])])
    differs = new | np.concatenate([[True], word[1:] != word[:-1]])
    lead = np.flatnonzero(new)
    return row[lead], feature[lead], np.add.reduceat(differs.astype(np.int64), lead), n_words


def _with_many(row, feature, words):
    """Each feature again under another name where three words or more of the text share it."""
    many = words >= 3
    return np.concatenate([row, row[many]]), np.concatenate([feature, feature[many] ^ _MANY])


def _everything(feature: np.ndarray) -> np.ndarray:
    return np.ones(len(feature), dtype=bool)


class Table:
    """Weights of features, looked up for many at once."""

    def __init__(self, features: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(features)
        self.features, self.weights = features[order], weights[order]
        # A feature may be wanted for its own sake or for that of its "many" form.
        self.wanted = np.unique(np.concatenate([self.features, self.features ^ _MANY]))
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.wanted & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def passes(self, feature: np.ndarray) -> np.ndarray:
        out = self.filter[(feature & np.uint64((1 << 20) - 1)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.wanted, feature[maybe]), len(self.wanted) - 1)
            out[maybe] = self.wanted[at] == feature[maybe]
        return out

    def of(self, feature: np.ndarray) -> np.ndarray:
        if not len(self.features):
            return np.zeros(len(feature))
        at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
        return np.where(self.features[at] == feature, self.weights[at], 0.0)


def _inputs(batch: pa.RecordBatch, restorer: Restorer, table: Table) -> np.ndarray:
    """What the logistic model sees of each row: a constant, the greatest weight, the sum of
    the five greatest, and how many findings there are, by themselves and per word."""
    row, feature, words, n_words = _row_features(batch, restorer, table.passes)
    row, feature = _with_many(row, feature, words)
    weight = table.of(feature)
    found = weight > 0
    row, weight = row[found], weight[found]
    out = np.zeros((batch.num_rows, 5))
    out[:, 0] = 1
    if len(row):
        order = np.lexsort((-weight, row))
        row, weight = row[order], weight[order]
        first = np.searchsorted(row, np.arange(batch.num_rows))
        rank = np.arange(len(row)) - first[row]
        np.maximum.at(out[:, 1], row, weight)
        np.add.at(out[:, 2], row[rank < 5], weight[rank < 5] / 5)
        count = np.bincount(row, minlength=batch.num_rows)
        out[:, 3] = np.log1p(count)
        out[:, 4] = np.sqrt(count / (n_words + 5.0))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps of a ridge-regularised logistic regression."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - penalty @ beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        beta += step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return beta


@dataclass
class Model:
    letters: np.ndarray
    features: np.ndarray
    weights: np.ndarray
    beta: np.ndarray


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """At most about ``train_rows`` labelled rows that are not held out, by a digest of the id."""
    usable = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~is_held_out(F.col("doc_id")))
        .dropDuplicates(["doc_id"])
    )
    n = usable.count()
    if n > train_rows:
        usable = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < (1 << 20) * train_rows // n)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    return docs.select("doc_id", "text").join(usable, "doc_id").select("text", "toxic", half.alias("half"))


def _count_features(letters: np.ndarray, table: Table | None):
    """(feature, rows): rows of the given texts that have each feature, summed per batch."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters)
        for batch in tb.pieces(batches):
            row, feature, words, _ = _row_features(batch, restorer, table.passes if table else _everything)
            _, feature = _with_many(row, feature, words)
            names, counts = np.unique(feature, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(counts)], ["feature", "n"])

    return results


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, n_features: int = FEATURES) -> Model:
    letters = letter_model(docs)
    sample = cut(_labelled(docs, labels, train_rows))
    size = {(r.half, r.toxic): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    toxic, clean = size.get((0, 1), 0), size.get((0, 0), 0)
    share = (sum(n for (_, t), n in size.items() if t == 1) + 0.5) / (sum(size.values()) + 1.0)
    nothing = Model(letters, np.zeros(0, np.uint64), np.zeros(0), np.array([math.log(share / (1 - share)), 0, 0, 0, 0]))
    if not toxic or not clean:
        return nothing

    def counts(rows: DataFrame, table: Table | None) -> DataFrame:
        found = tb.map_texts(rows.select("text"), _count_features(letters, table), "feature bigint, n bigint")
        return found.groupBy("feature").agg(F.sum("n").alias("n"))

    # Features of toxic rows first; only the most frequent ones are looked for in the others.
    often = (
        counts(sample.where("half = 0 AND toxic = 1"), None)
        .where(F.col("n") >= MIN_TOXIC_ROWS)
        .orderBy(F.desc("n"), "feature")
        .limit(16 * n_features)
        .collect()
    )
    if not often:
        return nothing
    names = np.array([r.feature for r in often], dtype=np.int64).view(np.uint64)
    in_toxic = np.array([r.n for r in often], dtype=float)
    asked = Table(names, np.ones(len(names)))
    elsewhere = counts(sample.where("half = 0 AND toxic = 0"), asked).join(
        docs.sparkSession.createDataFrame(pa.table({"feature": names.view(np.int64)})), "feature", "left_semi"
    )
    at = {r.feature: r.n for r in elsewhere.collect()}
    in_clean = np.array([at.get(int(f), 0) for f in names.view(np.int64)], dtype=float)
    # Log-odds less 1.64 standard errors: a rare feature has to be clearer than a frequent one.
    odds = np.log((in_toxic + 0.5) / (toxic + 1)) - np.log((in_clean + 0.5) / (clean + 1))
    weight = odds - 1.64 * np.sqrt(1 / (in_toxic + 0.5) + 1 / (in_clean + 0.5))
    best = np.argsort(-weight, kind="stable")[:n_features]
    best = best[weight[best] > 0.3]
    table = Table(names[best], weight[best])

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters)
        for batch in tb.pieces(batches):
            x = _inputs(batch, restorer, table)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *(pa.array(x[:, k]) for k in range(1, 5))], ["toxic", "a", "b", "c", "d"]
            )

    rows = tb.map_texts(
        sample.where("half = 1").select("text", "toxic"), inputs, "toxic int, a double, b double, c double, d double"
    ).collect()  # train_rows at most
    y = np.array([r.toxic for r in rows], dtype=float)
    if not 0 < y.sum() < len(y):
        return nothing
    x = np.array([(1.0, r.a, r.b, r.c, r.d) for r in rows])
    return Model(letters, table.features, table.weights, _logistic(x, y))


def _scores(model: Model, table: Table, restorer: Restorer, batch: pa.RecordBatch) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_inputs(batch, restorer, table) @ model.beta, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, restorer = Table(model.features, model.weights), Restorer(model.letters)
        for batch in tb.pieces(batches):
            p = _scores(model, table, restorer, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return tb.map_texts(rows, results, "doc_id bigint, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were."""

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, restorer = Table(model.features, model.weights), Restorer(model.letters)
        for batch in tb.pieces(batches):
            yield batch.filter(pa.array(_scores(model, table, restorer, batch) < 0.5))

    return tb.map_texts(docs, results, docs.schema)
