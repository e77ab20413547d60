"""Record-level steps: project, tag, rewrite, filter, split, merge, count words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.functions.text import quote_number, words

NO_TIME_PARTITION = "__none__"


def values_of(log: DataFrame) -> DataFrame:
    """Only the record values."""
    return log.select(F.col("value").cast("string").alias("value"))


def tag_time_partition(log: DataFrame, parser: Callable[[Column], Column]) -> DataFrame:
    """Label each record with the time partition its message belongs to.

    ``parser`` maps the message column to a string column. Messages without a
    label, null messages included, go to ``__none__``.
    """
    return log.select(
        "topic",
        "partition",
        "offset",
        F.coalesce(parser(F.col("value")), F.lit(NO_TIME_PARTITION)).alias("time_partition"),
        F.col("value").alias("message"),
    )


def with_topic_partition(df: DataFrame, index_map: DataFrame, index: str = "idx") -> DataFrame:
    """Replace a position by the topic and partition it stands for."""
    return df.join(index_map, index).drop(index)


def rewrite_number_as_string(
    df: DataFrame, field: str, column: str = "value", blank: str = "", closers: str = ","
) -> DataFrame:
    """Quote the numeric JSON field ``field`` in lines that mention it."""
    return df.withColumn(column, quote_number(F.col(column), field, blank, closers))


def keep_containing(df: DataFrame, token: str, column: str = "value") -> DataFrame:
    return df.where(F.col(column).contains(token))


def keep(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def route(
    df: DataFrame, branches: dict[str, Column], rest: str = "rest", name: str = "route"
) -> DataFrame:
    """Label each record with the first branch whose predicate holds.

    Writing with ``partitionBy(name)`` then splits the stream in one pass.
    """
    label = None
    for branch, predicate in branches.items():
        label = F.when(predicate, branch) if label is None else label.when(predicate, branch)
    return df.withColumn(name, F.lit(rest) if label is None else label.otherwise(rest))


def split(df: DataFrame, branches: dict[str, Column], rest: str = "rest") -> dict[str, DataFrame]:
    """One frame per branch, each record in exactly one of them."""
    routed = route(df, branches, rest, "_route")
    return {
        name: routed.where(F.col("_route") == name).drop("_route") for name in [*branches, rest]
    }


def merge(streams: dict[str, DataFrame], name: str = "source") -> DataFrame:
    """Union of several inputs; absent columns become null."""
    merged = None
    for source, df in streams.items():
        df = df.withColumn(name, F.lit(source))
        merged = df if merged is None else merged.unionByName(df, allowMissingColumns=True)
    if merged is None:
        raise ValueError("nothing to merge")
    return merged


def word_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """How often each word occurs; words are split at blanks and line ends."""
    return (
        lines.select(F.explode(words(F.col(column))).alias("word"))
        .where("word <> ''")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def map_records(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply ``fn`` to Arrow-sized pieces of ``df``, for code SQL cannot express."""

    def over_pieces(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in pieces:
            yield fn(piece)

    return df.mapInPandas(over_pieces, schema)
