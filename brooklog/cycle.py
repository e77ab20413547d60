"""Bounded cycles over a log: plan, read, transform, write, commit.

A cycle reads at most ``max_records`` offsets per topic partition from where
the ledger ends, and commits only after the write. A cycle that fails at any
step leaves the ledger as it was, so the next one reads the same offsets again
under the same cycle id and replaces what was written.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brooklog import observe
from brooklog.observe import (
    CHECKPOINT,
    CORE,
    IN_BYTES,
    IN_RECORDS,
    OUT_BYTES,
    OUT_RECORDS,
    READER,
    TRANSFORMER,
    WRITE_MILLIS,
    WRITER,
    EventTables,
)
from brooklog.plans import ranges as plans
from brooklog.plans.checkpoint import Ledger, disconnected, merge_checkpoint
from brooklog.schemas import TOPIC_PARTITION
from brooklog.scratch import drop_path, fresh_path, write_out
from brooklog.sinks.segments import Written
from brooklog.sources.log_table import select_topics


class Source(Protocol):
    def catalog(self) -> DataFrame: ...

    def scan(self, ranges: DataFrame) -> DataFrame: ...


#: Cycles after which the ledger forgets old ones.
EXPIRE_EVERY = 100

Sink = Callable[[DataFrame, int], DataFrame | Written | None]


@dataclass
class CycleOutcome:
    cycle_id: int
    planned: int = 0
    flushed: bool = False
    committed: bool = False
    failed_at: str | None = None


class LogCycle:
    """One pipeline: a source, an optional transform, a sink and a ledger.

    ``sink(records, cycle_id)`` must write a cycle before it returns, and may
    return the offset ranges it really wrote; then only those are committed. It may also name
    its output (``Written``), which the ledger then commits together with the offsets.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        source: Source,
        sink: Sink,
        home: str,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        max_records: int = plans.DEFAULT_MAX_RECORDS,
        flush_interval_ms: int = plans.DEFAULT_FLUSH_INTERVAL_MS,
        min_total_records: int | None = None,
        topics: Callable[[DataFrame], DataFrame] = select_topics,
        on_gap: str = "report",
    ):
        self.spark = spark
        self.source = source
        self.sink = sink
        self.transform = transform or (lambda records: records)
        self.max_records = max(1, max_records)
        self.flush_interval_ms = flush_interval_ms
        self.min_total_records = (
            self.max_records if min_total_records is None else min_total_records
        )
        self.topics = topics
        self.on_gap = on_gap
        self.ledger = Ledger(spark, f"{home}/ledger", name)
        self.events = EventTables(spark, f"{home}/events", name)
        self.last_flush_ms = 0
        self._plan_at: str | None = None

    def run_once(self) -> CycleOutcome:
        """Run one cycle. Failures are reported in the events, not raised."""
        outcome = CycleOutcome(cycle_id=0)
        self._module = CHECKPOINT
        try:
            self._run(outcome)
            if outcome.committed and outcome.cycle_id % EXPIRE_EVERY == 0:
                self.ledger.expire()
        except Exception as failure:
            outcome.failed_at = self._module
            self.events.error(outcome.cycle_id, self._module, failure)
        if self._plan_at:
            drop_path(self.spark, self._plan_at)
            self._plan_at = None
        self.events.status(outcome.cycle_id, CORE, observe.ENDED)
        try:
            self.events.flush()
        except Exception:
            # the events stay collected and go out with the next cycle's
            outcome.failed_at = outcome.failed_at or CORE
        return outcome

    def _run(self, outcome: CycleOutcome) -> None:
        last = self.ledger.last_cycle()
        outcome.cycle_id = cycle_id = last + 1
        self.events.status(cycle_id, CORE, observe.STARTED)
        checkpoint = self.ledger.load(last)
        self.events.status(cycle_id, CHECKPOINT, f"resuming after cycle {last}")

        self._module = READER
        catalog = self.topics(self.source.catalog())
        # the log may grow while the cycle runs, so the plan is fixed here
        plan = plans.plan_with_context(catalog, checkpoint, self.max_records, self.on_gap)
        self._plan_at = fresh_path(self.spark, "plan")
        plan = write_out(plan, "plan", self._plan_at)
        ranges = plan.where("until_offset > from_offset")
        # offsets a gap made the plan skip count as passed
        delta = ranges.select(
            *TOPIC_PARTITION,
            F.coalesce("committed", "from_offset").alias("from_offset"),
            "until_offset",
        )
        total = plan.agg(
            F.coalesce(F.sum(F.expr("greatest(until_offset - from_offset, 0)")), F.lit(0)),
            F.count_if(F.col("committed") < F.col("earliest")),
        ).first()
        outcome.planned, lost = total
        if lost:
            # at most one row per topic partition
            for gap in plan.where("committed < earliest").collect():
                self.events.error(
                    cycle_id,
                    READER,
                    f"records lost in {gap.topic}/{gap.partition}: "
                    f"offsets {gap.committed} to {gap.earliest - 1}",
                )
        self.events.metrics(cycle_id, READER, {IN_RECORDS: outcome.planned})
        now_ms = int(time.time() * 1000)
        if not plans.flush_due(
            outcome.planned,
            self.last_flush_ms,
            now_ms,
            self.flush_interval_ms,
            self.min_total_records,
        ):
            self.events.status(cycle_id, READER, "waiting for more records or time")
            return
        outcome.flushed = True
        self.last_flush_ms = now_ms
        self.events.status(cycle_id, READER, "cycle is due")
        if outcome.planned == 0:
            return

        self._module = TRANSFORMER
        read, written = Observation(), Observation()
        records = self.source.scan(ranges)
        records = records.observe(read, *observe.record_metrics(observe.text_column(records)))
        out = self.transform(records)
        out = out.observe(written, *observe.record_metrics(observe.text_column(out)))

        self._module = WRITER
        begin = time.monotonic()
        result = self.sink(out, cycle_id)
        spent = int((time.monotonic() - begin) * 1000)
        output, partial = None, result
        if isinstance(result, Written):
            output, partial = result.output, result.delta
        seen = observed(self.spark, read, written)
        self._report(cycle_id, *seen, partial, spent)
        self.events.status(cycle_id, WRITER, "records are written")

        self._module = CHECKPOINT
        if partial is not None:
            delta = partial
            loose = disconnected(checkpoint, delta).first()
            if loose is not None:
                raise ValueError(f"written ranges leave a gap or overlap: {loose}")
        self.ledger.commit(cycle_id, merge_checkpoint(checkpoint, delta), output)
        self.events.status(cycle_id, CHECKPOINT, "offsets are committed")
        outcome.committed = True

    def _report(
        self,
        cycle_id: int,
        read: dict,
        written: dict,
        partial: DataFrame | None,
        write_millis: int,
    ) -> None:
        """What was read and written; a sink that returns ranges tells what it wrote itself."""
        out = {OUT_RECORDS: written.get("records", 0), OUT_BYTES: written.get("bytes", 0)}
        if partial is not None:
            size = F.sum("bytes") if "bytes" in partial.columns else F.lit(None).cast("long")
            records, size = partial.agg(F.sum(F.expr("until_offset - from_offset")), size).first()
            out = {OUT_RECORDS: records or 0} | ({} if size is None else {OUT_BYTES: size})
        if not written:
            self.events.status(cycle_id, WRITER, "the sink did not read its records")
        self.events.metrics(cycle_id, READER, {IN_BYTES: read.get("bytes", 0)})
        self.events.metrics(
            cycle_id,
            TRANSFORMER,
            {IN_RECORDS: read.get("records", 0), OUT_RECORDS: written.get("records", 0)},
        )
        self.events.metrics(
            cycle_id,
            WRITER,
            {
                IN_RECORDS: written.get("records", 0),
                IN_BYTES: written.get("bytes", 0),
                **out,
                WRITE_MILLIS: write_millis,
            },
        )

    def drain(self, attempts: int = 1) -> list[CycleOutcome]:
        """Run cycles until nothing is planned or ``attempts`` fail in a row."""
        outcomes, failures = [], 0
        while failures < attempts:
            outcome = self.run_once()
            outcomes.append(outcome)
            failures = failures + 1 if outcome.failed_at else 0
            if not outcome.failed_at and outcome.planned == 0:
                break
        return outcomes


def observed(spark: SparkSession, *observations: Observation) -> list[dict]:
    """What was observed, or nothing where no action has run on the observed frame.

    Spark tells in order, some time after an action: when a later action has been told of,
    all before it have. So nothing is missed however late that is.
    """
    last = Observation()
    spark.range(1).observe(last, F.count(F.lit(1)).alias("n")).collect()
    _ = last.get
    return [_told(observation) for observation in observations]


def _told(observation: Observation, patience_s: float = 1.0) -> dict:
    """What has been told of an observation; asking for one that was not would never end."""
    found: list[dict] = []
    waiting = threading.Thread(target=lambda: found.append(observation.get), daemon=True)
    waiting.start()
    waiting.join(patience_s)
    return found[0] if found else {}


def resume_from(ledger: Ledger, offsets: DataFrame, cycle_id: int = 1) -> None:
    """Commit offsets that another process reached (topic, partition, until_offset)."""
    ledger.commit(cycle_id, offsets.withColumn("from_offset", F.lit(0).cast("bigint")))
