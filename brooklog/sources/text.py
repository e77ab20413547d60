"""Line files as input, and as a log that is fed step by step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.operators.ordered import number_rows


def read_lines(
    spark: SparkSession, path: str, stream: bool = False, line_end: str | None = None
) -> DataFrame:
    """One row ``value`` per line of the files at ``path``."""
    reader = spark.readStream if stream else spark.read
    if line_end is not None:
        reader = reader.option("lineSep", line_end)
    return reader.text(path)


def replay(
    df: DataFrame,
    order: Sequence[str],
    step: Column,
    partitions: int,
    topic: str | None = None,
) -> DataFrame:
    """Lay unkeyed messages round-robin over ``partitions``, in increments.

    ``step`` is an expression over ``seq``, the message's place in ``order``.
    """
    numbered = number_rows(df, [], order, "seq")
    placed = (
        numbered.withColumn("partition", (F.col("seq") % partitions).cast("int"))
        .withColumn("offset", F.floor(F.col("seq") / partitions).cast("bigint"))
        .withColumn("step", step.cast("int"))
    )
    return placed.withColumn("topic", F.lit(topic)) if topic is not None else placed


def step_of(sizes: Sequence[int]) -> Column:
    """Step number for increments of the given sizes; the rest follows at once."""
    seq, end, step = F.col("seq"), 0, None
    for number, size in enumerate(sizes):
        end += size
        here = seq < end
        step = F.when(here, number) if step is None else step.when(here, number)
    return F.lit(0) if step is None else step.otherwise(len(sizes))
