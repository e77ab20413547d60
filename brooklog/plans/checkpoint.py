"""Checkpoints: merge what a cycle advanced, keep a ledger, load it again."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklog import schemas
from brooklog.schemas import TOPIC_PARTITION
from brooklog.scratch import create_once, delete_folder, file_names, read_if_there, read_text

RANGE_COLUMNS = [*TOPIC_PARTITION, "from_offset", "until_offset"]


def chain(delta: DataFrame) -> DataFrame:
    """One range per key out of several that follow each other, and whether they do."""
    in_order = Window.partitionBy(*TOPIC_PARTITION).orderBy("from_offset", "until_offset")
    return (
        delta.withColumn("_before", F.lag("until_offset").over(in_order))
        .groupBy(*TOPIC_PARTITION)
        .agg(
            F.min("from_offset").alias("_from"),
            F.max("until_offset").alias("_until"),
            F.min(F.coalesce(F.col("_before") == F.col("from_offset"), F.lit(True))).alias(
                "_chained"
            ),
        )
    )


def _joined(checkpoint: DataFrame, delta: DataFrame) -> DataFrame:
    old = checkpoint.select(*RANGE_COLUMNS)
    follows = F.coalesce(F.col("until_offset") == F.col("_from"), F.lit(True))
    return old.join(chain(delta), TOPIC_PARTITION, "full").withColumn(
        "_connected", follows & F.coalesce("_chained", F.lit(True))
    )


def disconnected(checkpoint: DataFrame, delta: DataFrame) -> DataFrame:
    """Keys whose delta does not start where the checkpoint ends."""
    return _joined(checkpoint, delta).where(~F.col("_connected")).select(
        *TOPIC_PARTITION,
        F.col("until_offset").alias("expected_from"),
        F.col("_from").alias("delta_from"),
    )


def merge_checkpoint(checkpoint: DataFrame, delta: DataFrame) -> DataFrame:
    """Checkpoint advanced by the delta; unknown keys are added, others kept.

    Using a row whose delta leaves a gap or overlaps raises an error.
    """
    text = F.concat_ws(
        " ", F.lit("ranges leave a gap or overlap:"), "topic", "partition", "until_offset", "_from"
    )
    until = F.coalesce("_until", "until_offset")
    return _joined(checkpoint, delta).select(
        *TOPIC_PARTITION,
        F.coalesce("from_offset", "_from").alias("from_offset"),
        F.when(F.col("_connected"), until)
        .otherwise(F.raise_error(text).cast("bigint"))
        .alias("until_offset"),
    )


def next_offsets(ledger: DataFrame) -> DataFrame:
    """Where each topic partition goes on after the latest cycle that touched it."""
    return ledger.groupBy(*TOPIC_PARTITION).agg(
        F.max_by("until_offset", "cycle_id").alias("next_offset")
    )


def last_checkpoint(ledger: DataFrame) -> DataFrame:
    """The checkpoint a ledger stands for; true range starts are kept."""
    return ledger.groupBy(*TOPIC_PARTITION).agg(
        F.min_by("from_offset", "cycle_id").alias("from_offset"),
        F.max_by("until_offset", "cycle_id").alias("until_offset"),
    )


def of_topic(checkpoint: DataFrame, topic: str, partitions: int) -> DataFrame:
    """The checkpoint of one topic's partitions 0 to ``partitions`` - 1.

    Partitions that were never committed have no row and start at their
    earliest offset.
    """
    wanted = (F.col("topic") == topic) & F.col("partition").between(0, partitions - 1)
    return checkpoint.where(wanted)


def delta_of(records: DataFrame) -> DataFrame:
    """The ranges a set of records covers, for sinks that wrote only part."""
    return records.groupBy(*TOPIC_PARTITION).agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


class ConflictingCommit(RuntimeError):
    """Another driver has committed this cycle; plan again from what it committed."""


class Ledger:
    """Committed checkpoints of one pipeline.

    A commit writes the whole checkpoint (a row per topic partition) to a folder of its own
    and then puts the cycle's marker in place, which names that folder and, where the sink
    reports it, the output. A marker is created once: of two drivers that run the same
    cycle one commits, and the other gets an error and plans again. So a cycle counts as
    committed, with its output, from one moment on.
    """

    def __init__(self, spark: SparkSession, path: str, pipeline: str):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/pipeline={pipeline}"
        self.pipeline = pipeline

    def _marker(self, cycle_id: int) -> dict:
        text = read_text(self.spark, f"{self.path}/commits/{cycle_id}")
        return json.loads(text) if text else {}

    def cycles(self, up_to: int | None = None) -> list[int]:
        """Numbers of the committed cycles, newest first."""
        names = file_names(self.spark, f"{self.path}/commits")
        found = sorted((int(n) for n in names if n.isdigit()), reverse=True)
        return [c for c in found if up_to is None or c <= up_to]

    def rows(self) -> DataFrame:
        """The checkpoints of all cycles that are not forgotten."""
        paths = [f"{self.path}/attempts/{self._marker(c)['attempt']}" for c in self.cycles()]
        if not paths:
            return read_if_there(self.spark, f"{self.path}/none", schemas.LEDGER)
        return self.spark.read.schema(schemas.LEDGER).parquet(*paths)

    def outputs(self, up_to: int | None = None) -> dict[int, str]:
        """What each committed cycle wrote, as its sink named it."""
        found = {cycle: self._marker(cycle).get("output") for cycle in self.cycles(up_to)}
        return {cycle: output for cycle, output in found.items() if output}

    def last_cycle(self, up_to: int | None = None) -> int:
        """The newest committed cycle (up to ``up_to``), 0 if there is none."""
        return next(iter(self.cycles(up_to)), 0)

    def load(self, cycle_id: int | None = None) -> DataFrame:
        """The checkpoint after ``cycle_id`` (default: the newest cycle).

        A cycle that committed nothing leaves the checkpoint of the one before it.
        """
        last = self.last_cycle(cycle_id)
        if not last:
            return read_if_there(self.spark, f"{self.path}/none", schemas.RANGES)
        path = f"{self.path}/attempts/{self._marker(last)['attempt']}"
        return self.spark.read.schema(schemas.LEDGER).parquet(path).select(*RANGE_COLUMNS)

    def commit(self, cycle_id: int, checkpoint: DataFrame, output: str | None = None) -> None:
        """Store a checkpoint; an empty one without output is not stored.

        Committing a cycle again is accepted if the checkpoint is the same, as it is when
        a batch is repeated, and else raises ``ConflictingCommit``.
        """
        attempt = uuid.uuid4().hex
        path = f"{self.path}/attempts/{attempt}"
        # one row per topic partition
        checkpoint.select(
            F.lit(self.pipeline).alias("pipeline"),
            F.lit(cycle_id).cast("bigint").alias("cycle_id"),
            *RANGE_COLUMNS,
            F.current_timestamp().alias("committed_at"),
        ).coalesce(1).write.parquet(path)
        stored = self.spark.read.schema(schemas.LEDGER).parquet(path).select(*RANGE_COLUMNS)
        if output is None and stored.isEmpty():
            delete_folder(self.spark, path)
            return
        marker = json.dumps({"attempt": attempt, "output": output})
        if create_once(self.spark, f"{self.path}/commits/{cycle_id}", marker):
            return
        there = self.load(cycle_id)
        same = sorted(map(tuple, stored.collect())) == sorted(map(tuple, there.collect()))
        delete_folder(self.spark, path)
        if output is not None or not same:
            raise ConflictingCommit(f"cycle {cycle_id} of {self.pipeline} is committed already")

    def expire(self, keep: int = 1000) -> None:
        """Forget all but the newest cycles; the newest alone holds the checkpoint."""
        last = self.last_cycle()
        for cycle in self.cycles(last - max(1, keep)):
            attempt = self._marker(cycle).get("attempt")
            delete_folder(self.spark, f"{self.path}/commits/{cycle}")
            delete_folder(self.spark, f"{self.path}/attempts/{attempt}")
