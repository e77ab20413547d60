"""Which offsets to read next: starts, caps, gaps, lag and the flush rule.

All inputs hold one row per topic partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.schemas import TOPIC_PARTITION

# fixed values: the default settings
DEFAULT_MAX_RECORDS = 1000
DEFAULT_FLUSH_INTERVAL_MS = 1000


def resolve_starts(catalog: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Where each listed partition goes on: its checkpoint, else its earliest offset."""
    committed = checkpoint.select(*TOPIC_PARTITION, F.col("until_offset").alias("committed"))
    return catalog.join(committed, TOPIC_PARTITION, "left").withColumn(
        "start", F.coalesce("committed", "earliest")
    )


def find_gaps(catalog: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Partitions whose next record is no longer there."""
    return (
        resolve_starts(catalog, checkpoint)
        .where("committed < earliest")
        .select(
            *TOPIC_PARTITION,
            F.col("committed").alias("missing_from"),
            F.col("earliest").alias("missing_to"),
            (F.col("earliest") - F.col("committed")).alias("missing_count"),
        )
    )


def plan_ranges(
    catalog: DataFrame,
    checkpoint: DataFrame,
    max_records: int = DEFAULT_MAX_RECORDS,
    on_gap: str = "report",
) -> DataFrame:
    """One non-empty range per partition with at most ``max_records`` offsets.

    ``on_gap``: ``report`` starts at the checkpoint all the same, ``skip`` at
    the earliest record, ``fail`` raises when the plan is used.
    """
    return plan_with_context(catalog, checkpoint, max_records, on_gap).select(
        *TOPIC_PARTITION, "from_offset", "until_offset"
    ).where("until_offset > from_offset")


def plan_with_context(
    catalog: DataFrame,
    checkpoint: DataFrame,
    max_records: int = DEFAULT_MAX_RECORDS,
    on_gap: str = "report",
) -> DataFrame:
    """The plan of every listed partition, next to what it was made from."""
    starts = resolve_starts(catalog, checkpoint)
    lost = F.col("committed") < F.col("earliest")
    if on_gap == "skip":
        starts = starts.withColumn("start", F.greatest("start", "earliest"))
    elif on_gap == "fail":
        text = F.concat_ws(" ", F.lit("missing messages:"), "topic", F.col("partition"))
        starts = starts.withColumn(
            "start", F.when(lost, F.raise_error(text).cast("bigint")).otherwise(F.col("start"))
        )
    elif on_gap != "report":
        raise ValueError(f"unknown on_gap: {on_gap}")
    until = F.least(F.col("start") + max(1, int(max_records)), F.col("latest"))
    return starts.select(
        *TOPIC_PARTITION,
        "committed",
        "earliest",
        "latest",
        F.col("start").alias("from_offset"),
        until.alias("until_offset"),
    )


def plan_backfill(catalog: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Everything from the previous end to the latest offset, empty ranges kept."""
    if previous is None:
        starts = catalog.withColumn("start", F.col("earliest"))
    else:
        starts = resolve_starts(catalog, previous)
    return starts.select(
        *TOPIC_PARTITION,
        F.coalesce("start", F.lit(0)).cast("bigint").alias("from_offset"),
        F.col("latest").alias("until_offset"),
    )


def ranges_of_topic(ranges: DataFrame, topic: str) -> DataFrame:
    return ranges.where(F.col("topic") == topic)


def planned_count(ranges: DataFrame) -> DataFrame:
    """One row: how many records the ranges stand for."""
    return ranges.agg(_total().alias("records"))


def _total() -> Column:
    return F.coalesce(F.sum(F.col("until_offset") - F.col("from_offset")), F.lit(0))


def partition_lag(catalog: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Records between the checkpoint (or the earliest offset) and the end."""
    return resolve_starts(catalog, checkpoint).select(
        *TOPIC_PARTITION,
        F.col("start").alias("next_offset"),
        "latest",
        (F.col("latest") - F.col("start")).alias("lag"),
    )


def flush_due(
    planned,
    last_flush_ms,
    now_ms,
    interval_ms: int = DEFAULT_FLUSH_INTERVAL_MS,
    min_total_records: int = DEFAULT_MAX_RECORDS,
):
    """True when enough time has passed or enough records are waiting.

    Takes columns or plain numbers.
    """
    return (now_ms - last_flush_ms >= interval_ms) | (planned >= min_total_records)


def flush_decision(
    ranges: DataFrame,
    last_flush_ms: int,
    now_ms: int,
    interval_ms: int = DEFAULT_FLUSH_INTERVAL_MS,
    min_total_records: int = DEFAULT_MAX_RECORDS,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Planned records and the flush decision, in total or per key."""
    rule = flush_due(
        F.col("planned"), F.lit(last_flush_ms), F.lit(now_ms), interval_ms, min_total_records
    )
    return ranges.groupBy(*keys).agg(_total().alias("planned")).withColumn("flush", rule)
