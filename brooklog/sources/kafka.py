"""Kafka as source and sink behind the same columns as the table log.

Needs Spark's Kafka connector on the class path. Only the option texts can be
tested without a broker.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog import schemas


def range_options(ranges: Iterable) -> dict[str, str]:
    """Reader options that read exactly the given offset ranges.

    ``ranges`` are rows (topic, partition, from_offset, until_offset).
    """
    assign: dict[str, list[int]] = {}
    starts: dict[str, dict[str, int]] = {}
    ends: dict[str, dict[str, int]] = {}
    for topic, partition, begin, until in sorted(tuple(r) for r in ranges):
        assign.setdefault(topic, []).append(partition)
        starts.setdefault(topic, {})[str(partition)] = begin
        ends.setdefault(topic, {})[str(partition)] = until
    return {
        "assign": json.dumps(assign),
        "startingOffsets": json.dumps(starts),
        "endingOffsets": json.dumps(ends),
    }


def topic_options(
    include: list[str] | None = None, pattern: str | None = None
) -> dict[str, str]:
    """Options for the topics in ``include`` that match ``pattern``, as far as given."""
    if include:
        chosen = [t for t in include if pattern is None or re.search(pattern, t)]
        if not chosen:
            raise ValueError("no topic is left to read")
        return {"subscribe": ",".join(chosen)}
    return {"subscribePattern": pattern or "(?!.*__consumer_offsets).*"}


def flush_options(
    flush_interval_ms: int = 1000, min_records: int = 1000, max_records: int | None = None
) -> dict[str, str]:
    """Stream options with the flush rule: enough records or enough time."""
    options = {
        "minOffsetsPerTrigger": str(min_records),
        "maxTriggerDelay": f"{flush_interval_ms}ms",
    }
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def as_log(records: DataFrame) -> DataFrame:
    """Kafka source columns in the layout of the table log."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


class KafkaLog:
    """Scans offset ranges of a broker; ``catalog`` tells what can be read.

    The catalog is a frame (topic, partition, earliest, latest) or a function
    that returns one, since Spark has no call that lists broker offsets.
    """

    def __init__(self, spark: SparkSession, servers: str, catalog, **options: str):
        self.spark = spark
        self.options = {"kafka.bootstrap.servers": servers, "failOnDataLoss": "true", **options}
        self._catalog = catalog

    def catalog(self) -> DataFrame:
        return self._catalog() if callable(self._catalog) else self._catalog

    def scan(self, ranges: DataFrame) -> DataFrame:
        """Records of planned ranges; records that are lost meanwhile fail the scan."""
        # one row per topic partition: metadata, needed as text options
        rows = ranges.select("topic", "partition", "from_offset", "until_offset").collect()
        if not rows:
            return self.spark.createDataFrame([], schemas.LOG)
        reader = self.spark.read.format("kafka").options(**self.options)
        return as_log(reader.options(**range_options(rows)).load())

    def stream(self, **options: str) -> DataFrame:
        reader = self.spark.readStream.format("kafka").options(**self.options)
        return as_log(reader.options(**options).load())


def publish(df: DataFrame, servers: str, topic: str, value: str = "value") -> None:
    """Send one unkeyed message per row."""
    (
        df.select(F.col(value).cast("string").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
