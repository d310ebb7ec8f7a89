"""Cleaning of ``documents`` in five stages, each by one of the corpus operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and reread as the next stage's ``docs``.

1. toxicity: rows predicted toxic go;
2. near_dedup: of linked documents (five-word shingles, 0.8) the one with the smallest id stays;
3. decontamination: rows that hold a window of a benchmark item go;
4. secrets: spans are replaced in the text, n_chars follows, every row stays;
5. packing: the pieces of all that is left in bins.

Defined results: a null text is clean of everything and packed as an empty one.  Rows that
repeat a doc_id are kept or dropped together by stage 2, and a row without a doc_id stays.
Extra columns travel along to stage 4 unchanged.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.decontaminate import without_contaminated
from cohortmill.llm.neardup import near_duplicates
from cohortmill.llm.packing import pack
from cohortmill.llm.secrets import redact
from cohortmill.llm.toxicity import fit, without_toxic
from cohortmill.storage import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(dropped.hint("shuffle_hash"), docs["doc_id"] == dropped["dropped_id"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Fitted scores and best-fit placement are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
