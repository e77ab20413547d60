"""File sinks. None of them passes the data through one task or the driver.

The writers do not shuffle: records that come from a log scan are already
grouped by topic partition and ordered by offset. For input that is not,
``rebalance`` groups it first, and adaptive execution splits hot groups and
joins small ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.operators.records import NO_TIME_PARTITION
from brooklog.schemas import TOPIC_PARTITION


def rebalance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *columns)


def write_by_partition(
    df: DataFrame,
    path: str,
    value: str = "value",
    in_order: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Newline-framed values, one folder per topic partition.

    ``in_order`` spreads the records by range of (topic, partition, offset):
    every file then holds consecutive offsets, and a large topic partition is
    several such files.
    """
    rows = df.select(*TOPIC_PARTITION, "offset", F.col(value).alias("value"))
    if in_order:
        by = [*TOPIC_PARTITION, "offset"]
        rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    rows.drop("offset").write.mode(mode).partitionBy(*TOPIC_PARTITION).text(path)


def write_time_partitioned(
    tagged: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Tagged records, one folder per topic and time partition.

    Rows are regrouped by folder first; a large folder is split into several files.
    """
    rows = tagged.withColumn(
        "time_partition", F.coalesce("time_partition", F.lit(NO_TIME_PARTITION))
    )
    if fmt == "text":
        rows = rows.select("topic", "time_partition", F.col("message").alias("value"))
    folders = ["topic", "time_partition"]
    rows = rebalance(rows, folders)
    rows.write.mode(mode).format(fmt).partitionBy(*folders).save(path)


def write_ordered_text(
    df: DataFrame, path: str, order: Sequence[str], value: str = "value"
) -> None:
    """All lines in one global order: the part files in name order are the text.

    Reading (or concatenating) the parts by name gives what a single file
    would hold, yet no task sees more than its range.
    """
    columns = list(dict.fromkeys([*order, value]))
    rows = df.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select(F.col(value).alias("value")).write.text(path)


def append_values(df: DataFrame, path: str, value: str = "value") -> None:
    """Add the values of one cycle to a table that collects all cycles."""
    df.select(F.col(value).alias("value")).write.mode("append").parquet(path)


class BatchFolders:
    """Each cycle's records in a folder of its own, replaced when redelivered.

    Writing a cycle twice therefore leaves one copy: delivery is at least once,
    the result is exactly once. ``regroup`` shuffles the rows by ``partition_by``
    first, for about one file per folder; large folders are split.
    """

    def __init__(
        self,
        path: str,
        partition_by: Sequence[str] = (),
        fmt: str = "parquet",
        regroup: bool = True,
    ):
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.fmt = fmt
        self.regroup = regroup and bool(partition_by)

    def __call__(self, df: DataFrame, cycle_id: int) -> DataFrame | None:
        if self.regroup:
            df = rebalance(df, self.partition_by)
        writer = df.write.mode("overwrite").format(self.fmt)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.save(f"{self.path}/cycle_id={cycle_id}")
        return None

    def read(self, spark, schema: str) -> DataFrame:
        layout = f"{schema}, cycle_id BIGINT"
        return spark.read.format(self.fmt).schema(layout).load(self.path)
