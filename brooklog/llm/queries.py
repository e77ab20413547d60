"""The registered queries of this package, and SQL twins where SQL can say it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm import (
    decontaminate,
    hard_negatives,
    jaccard_join,
    kneser_ney,
    licenses,
    line_dedup,
    quality,
    runs,
    sentencepiece_scan,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_counts,
)


#: Vocabulary files of public tokenizers.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the split pattern that goes with ``byte_bpe_50k.tiktoken``.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
ROOT = str(Path(__file__).resolve().parents[2])


def workers_find_package(spark: SparkSession) -> None:
    """Where the package is not installed, Python workers look beside the driver's."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.notices(spark))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    vocabulary = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    return token_counts.count_tokens(docs, vocabulary, PATTERN, rule="most")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return suffix_dedup.drop_repeats(docs, texts=False)


#: Shards of op4.
SHARDS = 24


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.plan(_table(spark, sf_dir, "documents"), SHARDS)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return substring_dedup.drop_repeats(docs, texts=False)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(docs, items)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepiece_scan.report(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(_table(spark, sf_dir, "documents"), runs.planted)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(vectors, moved, F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_token_counts,
        op3_suffix_dedup,
        op4_sharding,
        op5_quality_rules,
        op6_ngram_jaccard_join,
        op7_line_dedup,
        op8_substring_dedup,
        op9_benchmark_decontamination,
        op10_sentencepiece,
        op11_lm_scoring,
        op12_periodic_runs,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op4_sharding": sharding.plan_sql(SHARDS),
    "op5_quality_rules": quality.REPORT_SQL,
    "op7_line_dedup": line_dedup.REPORT_SQL,
    "op9_benchmark_decontamination": decontaminate.CONTAINED_SQL.format(
        docs="documents", items="benchmark", threshold=decontaminate.THRESHOLD
    ),
    "op13_hard_negatives": hard_negatives.MINE_SQL,
}
