"""One registered query per operator: the operator over its whole table, and digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm import classifier
from cohortmill.llm.chat import digests, format_windows
from cohortmill.llm.decontaminate import find_contamination
from cohortmill.llm.licenses import find_licenses
from cohortmill.llm.neardup import near_duplicates
from cohortmill.llm.packing import pack
from cohortmill.llm.quality import judge
from cohortmill.llm.secrets import find_secrets
from cohortmill.llm.sharding import byte_shards
from cohortmill.llm.spelling import spelling_groups
from cohortmill.llm.suffixdedup import remove_repeats
from cohortmill.llm.toxicity import fit, score
from cohortmill.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract fixes two-word shingles here."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: shard sizes near equal."""
    return byte_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: The conversation that a formatter must survive: control strings as texts.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT -1L AS conv_id, id AS turn, IF(id = 0, 'user', 'assistant') AS role FROM range(2)")
    extra = extra.withColumn("text", F.lit(CONTROL_TEXT))
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_windows(given.unionByName(extra)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("failed_rule")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract fixes the limit at 0.3."""
    docs = table(spark, sf_dir, "documents")
    scored = classifier.score(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_secret_scans,
        op3_best_fit_packing,
        op4_sharding,
        op5_suffix_array_dedup,
        op6_license_scans,
        op7_benchmark_decontamination,
        op8_chat_formatting,
        op9_toxicity,
        op10_quality_rules,
        op11_quality_classifier,
        op12_embedding_whitening,
        op13_spelling_variant_grouping,
    )
}
