"""A corpus from raw documents: rules, line and near-duplicate removal, benchmark, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again before the next stage takes it. All but the last keep the columns
of ``documents``. A document that a stage rejects is not seen by later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brooklog.llm import decontaminate, jaccard_join, line_dedup, quality, sentencepiece_scan
from brooklog.llm.queries import TOKENIZERS, workers_find_package
from brooklog.scratch import write_out

#: Words of a shingle, and the least similarity in hundredths, of near duplicates.
SHINGLE = 5
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules.

    Null and empty texts have too few words; repeated rows are judged alike.
    """
    return quality.keep(docs)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came earlier, if any word is left.

    A text without repeated lines, null too, stays as it is. Of rows that repeat doc_id and text
    none removes lines of another; a null doc_id comes last.
    """
    return line_dedup.without_repeats(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that is linked by similar shingle sets.

    Of rows that repeat doc_id and text one stays. Texts without words, null or not, all stay.
    """
    workers_find_package(spark)
    return jaccard_join.one_of_each(docs, PERCENT, SHINGLE)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; null and empty texts contain none."""
    workers_find_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_items(docs, items)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each row's text, none for null and empty ones, and whether they decode to it."""
    workers_find_package(spark)
    return sentencepiece_scan.report(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", deduplicate_lines),
    ("ngram_jaccard_join", join_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("sentencepiece", encode_pieces),
]

#: SQL can't express the last stage; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
