"""Conflict-constrained best-fit packing of documents into bins.

A document is cut into full pieces of ``capacity`` and a rest.  Bins are held in order of
what is left in them; each carries the sources and the duplicate clusters inside it as
bitmaps.  A piece goes, largest first, to the tightest bin that can take it: the search
starts at the first bin with enough room and goes on to its successors while source or
cluster conflict.  If none is left, a bin is opened.

Rule: no bin holds two pieces of one duplicate cluster, nor more than ``per_source`` pieces
of one source.  Pieces are dealt evenly to packing groups by a digest that also holds the
number of the copy and of the piece, so neither a hot source, a hot cluster nor a row that
repeats fills one group.  Only ids, sources, clusters and sizes are shuffled, no text.

Defined results: size is UTF-8 bytes plus one; a null text has size 1.  The cluster of a
text is its digest after lower-casing and closing up white space, unless a column names it.
A null source is a source.  Repeated rows are packed each, numbered by ``copy``.  The pieces of a
long text fill a bin each, but for the bytes of a character that would be cut.  ``source`` is the one
column needed beside doc_id and text; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.lineage import cut

CAPACITY, PER_SOURCE = 16_384, 4
#: Pieces that one task packs together.
GROUP_PIECES = 4_000

_SCHEMA = (
    "doc_id bigint, copy bigint, piece bigint, size bigint, begin bigint, grp bigint, bin bigint, start bigint, "
    "room bigint, text_md5 string"
)


def best_fit(
    pieces: list[tuple[int, object, object]], capacity: int, per_source: int
) -> list[tuple[int, int, int]]:
    """(bin, offset, room left after it) for each (size, source, cluster), in the given order.

    Bins stand in a list sorted by (room, bin).  Sources and clusters are numbered by first
    use; a bin's clusters are one bitmap, its sources one bitmap per level of use.
    """
    rooms: list[tuple[int, int]] = []
    clusters: list[int] = []
    sources: list[list[int]] = []
    cluster_bits: dict[object, int] = {}
    source_bits: dict[object, int] = {}
    placed = []
    for size, source, cluster in pieces:
        cluster_bit = 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
        source_bit = 1 << source_bits.setdefault(source, len(source_bits))
        at = bisect_left(rooms, (size, -1))
        while at < len(rooms):
            _, number = rooms[at]
            if not clusters[number] & cluster_bit and not sources[number][-1] & source_bit:
                break
            at += 1
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number = capacity, len(clusters)
            clusters.append(0)
            sources.append([0] * per_source)
        clusters[number] |= cluster_bit
        levels = sources[number]
        levels[next(k for k in range(per_source) if not levels[k] & source_bit)] |= source_bit
        placed.append((number, capacity - room, room - size))
        insort(rooms, (room - size, number))
    return placed


def _pack(capacity: int, per_source: int):
    def results(table: pa.Table) -> pa.Table:
        rows = table.select(["doc_id", "copy", "piece", "size", "begin", "source", "cluster", "text_md5", "grp"]).to_pylist()
        rows.sort(
            key=lambda r: (
                -r["size"], r["doc_id"] is not None, r["doc_id"] or 0, r["cluster"], r["copy"], r["piece"], r["text_md5"]
            )
        )
        placed = best_fit([(r["size"], r["source"], r["cluster"]) for r in rows], capacity, per_source)
        names = ["doc_id", "copy", "piece", "size", "begin", "grp"]
        columns = [pa.array([r[n] for r in rows], pa.int64()) for n in names]
        columns += [pa.array([p[k] for p in placed], pa.int64()) for k in range(3)]
        columns.append(pa.array([r["text_md5"] for r in rows], pa.string()))
        return pa.table(columns, [*names, "bin", "start", "room", "text_md5"])

    return results


def _character_start(data: Column, at: Column) -> Column:
    """The byte at or before ``at`` that begins a character; a UTF-8 character has three further bytes at most."""
    inside = lambda back: F.hex(F.substring(data, (at - back + 1).cast("int"), F.lit(1))).between("80", "BF")
    return at - F.when(~inside(0), 0).when(~inside(1), 1).when(~inside(2), 2).otherwise(3)


def _begins(text: Column, capacity: int) -> Column:
    """Where the pieces of a text begin, so that none is larger than ``capacity`` or cuts a character."""
    data = text.cast("binary")
    size = F.octet_length(text) + 1
    # With three bytes to spare every cut may move back to the start of its character.
    step = max(1, capacity - 3)
    last = F.floor((size - 1) / step)
    cuts = F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda k: _character_start(data, k * step))
    return F.when(size <= capacity, F.array(F.lit(0).cast("bigint"))).otherwise(cuts)


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, cluster_column: str | None = None) -> DataFrame:
    """doc_id, copy, piece, size, begin, source, cluster, text_md5 of every piece; equal rows are counted, then numbered.

    ``begin`` is the piece's first byte in its text.  A piece ends where a character does, unless ``capacity``
    is below four bytes.
    """
    text = F.coalesce("text", F.lit(""))
    cluster = (
        F.col(cluster_column).cast("string")
        if cluster_column
        else F.md5(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")).cast("binary"))
    )
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(cluster, F.lit("")).alias("cluster"),
        F.md5(text.cast("binary")).alias("text_md5"),
        (F.octet_length(text) + 1).cast("bigint").alias("bytes"),
        _begins(text, capacity).alias("begins"),
    )
    counted = rows.groupBy("doc_id", "source", "cluster", "text_md5", "bytes", "begins").agg(F.count("*").alias("copies"))
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    cut_up = numbered.select("*", F.posexplode("begins").alias("at", "begin"))
    following = F.coalesce(F.get("begins", F.col("at") + 1), F.col("bytes"))
    return cut_up.select(
        "doc_id", "copy", F.col("at").cast("bigint").alias("piece"), "source", "cluster", "text_md5", "begin",
        (following - F.col("begin")).cast("bigint").alias("size"),
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    cluster_column: str | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, copy, piece, size, bin_id, start (its offset in the bin), begin (in its text), text_md5.

    ``bin_id`` is the packing group and the bin's number in it.  (doc_id, text_md5, copy, piece) tells pieces
    apart, also where rows without a doc_id or of one doc_id have different texts.
    """
    pieces = cut(pieces_of(docs, capacity, cluster_column))
    groups = 1 + pieces.count() // group_pieces
    dealt = pieces.withColumn(
        "grp", F.pmod(F.xxhash64("doc_id", "cluster", "copy", "piece"), F.lit(groups)).cast("bigint")
    )
    placed = dealt.groupBy("grp").applyInArrow(_pack(capacity, per_source), _SCHEMA)
    return placed.select(
        "doc_id", "copy", "piece", "size", F.format_string("%d-%d", "grp", "bin").alias("bin_id"), "start", "begin", "text_md5"
    )


def bin_texts(placed: DataFrame, docs: DataFrame) -> DataFrame:
    """(bin_id, content): the pieces of each bin in order, each document ended by a newline, as bytes.

    ``placed`` is what ``pack`` gave for ``docs``.  Every piece of every row is there, also of rows that
    repeat a doc_id or have none; an empty table gives no bins.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("_id"),
        F.md5(text.cast("binary")).alias("_md5"),
        F.concat(text, F.lit("\n")).cast("binary").alias("_data"),
    ).dropDuplicates(["_id", "_md5"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_md5") == F.col("_md5"))
    cut_up = placed.join(texts, same).select(
        "bin_id", "start",
        F.substring("_data", (F.col("begin") + 1).cast("int"), F.col("size").cast("int")).alias("bytes"),
    )
    held = cut_up.groupBy("bin_id").agg(F.sort_array(F.collect_list(F.struct("start", "bytes"))).alias("parts"))
    return held.select(
        "bin_id",
        F.aggregate(F.transform("parts", lambda p: p["bytes"]), F.lit(b""), lambda a, b: F.concat(a, b)).alias("content"),
    )
