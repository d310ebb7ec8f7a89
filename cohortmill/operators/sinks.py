"""Writers, and manifests that commit a set of tables at once.

Rows go from executors to storage; nothing is collected, and nothing that was written is read again.
Every writer of a table returns its rows, counted by the tasks that write them.  The count sits above the
last shuffle, where Spark takes the first result of a partition only, so a task that runs twice
counts once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Written:
    """One table of an export."""

    table: str
    rows: int
    path: str


MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)


#: Text of one file where a table is written to as few files as may be.  One task writes a file.
FILE_BYTES = 256 << 20


def few_files(df: DataFrame) -> int:
    """How many files of about ``FILE_BYTES`` hold the table as text; one pass sums up the lengths."""
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    total = df.agg(F.sum(sum(lengths, F.lit(0).cast("bigint")))).first()[0]
    return max(1, -(-(total or 0) // FILE_BYTES))


def _observed(df: DataFrame, files: int | None) -> tuple[DataFrame, Observation]:
    seen = Observation(f"written-{uuid.uuid4().hex}")
    out = df if files is None else df.coalesce(files)
    return out.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_csv(df: DataFrame, path: str, single_file: bool = False, files: int | None = None) -> int:
    """CSV with a header; quotes are doubled, and line breaks and spaces are kept.  Returns the rows.

    ``single_file`` is for tables with one row per cluster or per K; others that want few files
    give ``files``, which ``few_files`` counts.
    """
    out, seen = _observed(df, 1 if single_file else files)
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return seen.get["rows"]


def write_parquet(df: DataFrame, path: str) -> int:
    """Parquet; returns the rows."""
    out, seen = _observed(df, None)
    out.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_json_lines(df: DataFrame, path: str, single_file: bool = False) -> int:
    """One JSON object a line; returns the rows."""
    out, seen = _observed(df, 1 if single_file else None)
    out.write.mode("overwrite").json(path)
    return seen.get["rows"]


def write_lines(lines: DataFrame, path: str) -> None:
    """Text report from ``(line_no, line)``: a few dozen lines, one file, in order."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)


def listing(spark: SparkSession, written: Sequence[Written]) -> DataFrame:
    """(table, rows, path) of what writers returned."""
    return spark.createDataFrame([(w.table, w.rows, w.path) for w in written], MANIFEST_SCHEMA)


class ExportStore:
    """Sets of exported tables under one folder, of which readers see whole ones only.

    A run writes below ``runs/<its own name>``.  ``commit`` then puts one file into ``manifests``, first
    under another name and then by renaming, which a file system does at once or not at all.  A run that dies before
    leaves the last manifest and its tables as they were; one that dies amid the commit leaves a file that no
    reader looks at.  Numbers rise, and of two runs that commit the same number only one succeeds; the
    other takes the next.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(context._jsc.hadoopConfiguration())

    def new_run(self) -> str:
        """A folder nothing else writes to."""
        return f"{self.folder}/runs/{uuid.uuid4().hex}"

    def numbers(self) -> list[int]:
        """Committed manifests, the newest first."""
        at = self._path(f"{self.folder}/manifests")
        if not self._files.exists(at):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(at)]
        return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)

    def commit(self, written: Sequence[Written]) -> int:
        """Make these tables the newest set; returns its number."""
        body = "".join(json.dumps(asdict(w)) + "\n" for w in written).encode()
        aside = self._path(f"{self.folder}/manifests/.{uuid.uuid4().hex}")
        stream = self._files.create(aside, False)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        while True:
            number = max(self.numbers(), default=0) + 1
            target = self._path(f"{self.folder}/manifests/{number:010d}.json")
            if not self._files.exists(target) and self._files.rename(aside, target):
                return number

    def manifest(self, number: int | None = None) -> DataFrame:
        """(table, rows, path) of a committed set, by default the newest; without any rows before the first."""
        if number is None:
            number = max(self.numbers(), default=None)
        if number is None:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.folder}/manifests/{number:010d}.json")

    def path(self, table: str, number: int | None = None) -> str:
        """Where a table of a committed set is."""
        found = self.manifest(number).where(F.col("table") == table).first()
        if found is None:
            raise KeyError(f"no committed table {table!r} in {self.folder}")
        return found["path"]

    def remove_unlisted(self, keep: int = 2) -> int:
        """Remove the tables of runs that none of the newest ``keep`` manifests names; returns how many runs went.

        Not while another run writes: its folder is not listed yet either.
        """
        at = self._path(f"{self.folder}/runs")
        if not self._files.exists(at):
            return 0
        named = {
            row["path"].split("/runs/", 1)[1].split("/", 1)[0]
            for number in self.numbers()[:keep]
            for row in self.manifest(number).collect()  # one row per table
        }
        gone = [f.getPath() for f in self._files.listStatus(at) if f.getPath().getName() not in named]
        for path in gone:
            self._files.delete(path, True)
        return len(gone)
