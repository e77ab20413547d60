"""Queries over the log itself: listing, planning, scanning, checkpoints."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brooklog.cycle import LogCycle, resume_from
from brooklog.functions.time_partition import column_time
from brooklog.observe import ENDED, STARTED, partition_summary
from brooklog.operators.records import tag_time_partition, with_topic_partition
from brooklog.plans import checkpoint as cp
from brooklog.plans import ranges as plans
from brooklog.schemas import TAGGED
from brooklog.scratch import fresh_path, write_out
from brooklog.sinks.files import BatchFolders
from brooklog.sinks.segments import SegmentSink
from brooklog.sources import log_table as logs
from brooklog.sources.text import replay
from brooklog.workloads.tables import (
    CATALOG_SQL,
    LEDGER_SQL,
    LOG_SQL,
    MIXED_SQL,
    PARTITIONS,
    catalog_of,
    event_records,
    ledger_rows,
    log_records,
    log_table,
    mixed_checkpoint,
    quarter_cap,
    table,
    trimmed_log,
)

SUMMED = "topic STRING, partition INT, offset BIGINT, value STRING"
LOG_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]


def log_scan_all(spark, sf_dir):
    return log_records(spark, sf_dir).select(*LOG_COLUMNS)


def publish_increments(spark, sf_dir):
    records = event_records(spark, sf_dir)
    log = logs.LogTable(spark, fresh_path(spark, "log"))
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    # records without a time are in the second half
    first_half = F.coalesce(F.col("timestamp") < middle, F.lit(False))
    for part in (records.where(first_half), records.where(~first_half)):
        log.publish(part, ["timestamp", "event_id"])
    return log.records().select(*LOG_COLUMNS)


def replay_steps(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    total = events.count()
    steps = replay(events, ["ts", "event_id"], F.floor(F.col("seq") * 4 / total), PARTITIONS)
    return steps.select("event_id", "step", "partition", "offset")


def topic_select(spark, sf_dir):
    log = log_records(spark, sf_dir)
    modes = {
        "exclude": logs.select_topics(log, exclude_containing=["__consumer_offsets", "_error"]),
        "include": logs.select_topics(log, include=["topic_click", "topic_view"]),
        "pattern": logs.select_topics(log, pattern="^topic_[c-p]"),
        "predicate": logs.select_topics(log, predicate=lambda t: F.length(t) > 10),
    }
    found = None
    for mode, chosen in modes.items():
        per_topic = (
            chosen.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("records"))
            .withColumn("mode", F.lit(mode))
        )
        found = per_topic if found is None else found.unionByName(per_topic)
    return found


def partition_catalog(spark, sf_dir):
    return logs.partition_catalog(log_records(spark, sf_dir))


def _mixed_plan(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    checkpoint = mixed_checkpoint(catalog)
    return catalog, checkpoint, plans.plan_ranges(catalog, checkpoint, quarter_cap(catalog))


def plan_ranges(spark, sf_dir):
    return _mixed_plan(spark, sf_dir)[2]


def scan_ranges(spark, sf_dir):
    ranges = _mixed_plan(spark, sf_dir)[2]
    return logs.scan_ranges(log_records(spark, sf_dir), ranges).select(*LOG_COLUMNS)


def planned_count(spark, sf_dir):
    return plans.planned_count(_mixed_plan(spark, sf_dir)[2])


def gap_report(spark, sf_dir):
    """What a checkpoint misses of a log that was trimmed behind it."""
    catalog = write_out(trimmed_log(spark, sf_dir).catalog(), "catalog")
    behind = mixed_checkpoint(catalog).withColumn(
        "until_offset",
        F.when(F.col("partition") == 2, F.expr("until_offset div 7")).otherwise(
            F.col("until_offset")
        ),
    )
    return plans.find_gaps(catalog, behind)


def trimmed_scan(spark, sf_dir):
    """All that a trimmed and compacted log still has."""
    log = trimmed_log(spark, sf_dir)
    return partition_summary(log.scan(plans.plan_backfill(log.catalog())))


def lagging_scan(spark, sf_dir):
    """One partition from its beginning, the others from their last tenth on."""
    log = log_table(spark, sf_dir)
    lags = (F.col("topic") == "topic_click") & (F.col("partition") == 0)
    ranges = log.catalog().select(
        "topic", "partition",
        F.when(lags, F.lit(0)).otherwise(F.expr("latest - latest div 10")).cast("bigint").alias("from_offset"),
        F.col("latest").alias("until_offset"),
    )
    return partition_summary(log.scan(ranges))


def backfill_plan(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    plan = plans.plan_backfill(catalog, mixed_checkpoint(catalog))
    return plans.ranges_of_topic(plan, "topic_click")


def backfill_scan(spark, sf_dir):
    plan = plans.plan_backfill(catalog_of(spark, sf_dir))
    return partition_summary(logs.scan_ranges(log_records(spark, sf_dir), plan))


def merge_checkpoint(spark, sf_dir):
    _, checkpoint, ranges = _mixed_plan(spark, sf_dir)
    return cp.merge_checkpoint(checkpoint, ranges)


def next_offsets(spark, sf_dir):
    return cp.next_offsets(ledger_rows(catalog_of(spark, sf_dir)))


def last_checkpoint(spark, sf_dir):
    return cp.last_checkpoint(ledger_rows(catalog_of(spark, sf_dir)))


def partial_commit(spark, sf_dir):
    _, checkpoint, ranges = _mixed_plan(spark, sf_dir)
    log = log_records(spark, sf_dir)
    # the sink takes no error records, so their ranges stay uncommitted
    accepted = logs.scan_ranges(log, ranges).where("topic <> 'topic_error'")
    written = write_out(accepted.select("topic", "partition", "offset", "value"), "partial")
    return cp.merge_checkpoint(checkpoint, cp.delta_of(written))


def partition_lag(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    return plans.partition_lag(catalog, cp.last_checkpoint(ledger_rows(catalog)))


def flush_decision(spark, sf_dir):
    catalog, _, ranges = _mixed_plan(spark, sf_dir)
    return plans.flush_decision(
        ranges, 5000, 5001, min_total_records=3 * quarter_cap(catalog), keys=("topic",)
    )


def partition_write_summary(spark, sf_dir):
    return partition_summary(log_records(spark, sf_dir))


def index_lookup(spark, sf_dir):
    # one row per topic partition
    places = Window.partitionBy(F.lit(0)).orderBy("topic", "partition")
    index_map = write_out(
        catalog_of(spark, sf_dir).select(
            (F.row_number().over(places) - 1).alias("idx"), "topic", "partition"
        ),
        "index",
    )
    positions = (
        log_records(spark, sf_dir)
        .join(index_map, ["topic", "partition"])
        .select("idx", "key", "value")
    )
    return with_topic_partition(positions, index_map).select("key", "topic", "partition", "value")


# --- whole cycles --------------------------------------------------------------

_drained: dict[tuple[str, str], LogCycle] = {}
TAGGED_BY = ["topic", "time_partition"]


def drained_cycle(spark, sf_dir) -> LogCycle:
    """The event log moved to time-partitioned files in three capped cycles."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _drained:
        log = log_table(spark, sf_dir)
        home = fresh_path(spark, "cycle")
        cap = log.catalog().agg(F.expr("max(latest) div 3 + 1")).first()[0]
        cycle = LogCycle(
            spark,
            "events",
            log,
            BatchFolders(f"{home}/out", TAGGED_BY),
            home,
            transform=lambda df: tag_time_partition(df, column_time("timestamp")),
            max_records=cap,
            flush_interval_ms=0,
        )
        outcomes = cycle.drain()
        failed = [o for o in outcomes if o.failed_at]
        if failed:
            message = cycle.events.status_table().where("status = 'ERROR'").first().message
            raise RuntimeError(f"cycle failed: {message}")
        _drained[at] = cycle
    return _drained[at]


def cycle_output(spark, sf_dir):
    out = drained_cycle(spark, sf_dir).sink.read(spark, TAGGED)
    return out.groupBy("topic", "partition", "time_partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("offset").alias("offsets"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum(F.length("message")).alias("chars"),
    )


def cycle_ledger(spark, sf_dir):
    return drained_cycle(spark, sf_dir).ledger.rows().drop("pipeline", "committed_at")


def cycle_metrics(spark, sf_dir):
    metrics = drained_cycle(spark, sf_dir).events.metric_table().where("metric <> 'WriteMillis'")
    return metrics.groupBy("module", "metric").agg(F.sum("value").alias("total"))


_retried: dict[tuple[str, str], LogCycle] = {}


class FailsOnce:
    """A sink whose first write reaches its folder and fails all the same."""

    def __init__(self, sink):
        self.sink, self.failed = sink, False

    def __call__(self, records, cycle_id):
        self.sink(records, cycle_id)
        if not self.failed:
            self.failed = True
            raise RuntimeError("the connection broke after the write")


def retried_cycle(spark, sf_dir) -> LogCycle:
    """A cycle over the whole log that fails in its first attempt and is run again."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _retried:
        log = log_table(spark, sf_dir)
        home = fresh_path(spark, "cycle")
        cycle = LogCycle(
            spark, "retried", log, FailsOnce(BatchFolders(f"{home}/out")), home,
            max_records=log.catalog().agg(F.max("latest")).first()[0], flush_interval_ms=0,
        )
        first, second = cycle.run_once(), cycle.run_once()
        if first.failed_at != "Writer" or not second.committed:
            raise RuntimeError("the first attempt should fail and the second commit")
        _retried[at] = cycle
    return _retried[at]


def retry_after_failed_write(spark, sf_dir):
    out = retried_cycle(spark, sf_dir).sink.sink
    return partition_summary(out.read(spark, SUMMED))


def cycle_status(spark, sf_dir):
    rows = retried_cycle(spark, sf_dir).events.status_table()
    return rows.groupBy("cycle_id", "module", "status").agg(F.count(F.lit(1)).alias("events"))


def cycle_boundaries(spark, sf_dir):
    """How often each cycle was started and ended, and what its attempts read in all."""
    events = retried_cycle(spark, sf_dir).events
    marks = events.status_table().where("module = 'Core'").groupBy("cycle_id").agg(
        F.count_if(F.col("message") == STARTED).alias("started"),
        F.count_if(F.col("message") == ENDED).alias("ended"),
    )
    planned = events.metric_table().where("module = 'Reader' AND metric = 'InRecords'")
    planned = planned.groupBy("cycle_id").agg(F.sum("value").alias("planned"))
    return marks.join(planned, "cycle_id")


def resume_external(spark, sf_dir):
    log = log_table(spark, sf_dir)
    home = fresh_path(spark, "cycle")
    sink = BatchFolders(f"{home}/out")
    ends = log.catalog()
    cycle = LogCycle(
        spark, "resumed", log, sink, home, max_records=ends.agg(F.max("latest")).first()[0]
    )
    resume_from(cycle.ledger, ends.selectExpr("topic", "partition", "latest div 2 AS until_offset"))
    outcome = cycle.run_once()
    if not outcome.committed:
        raise RuntimeError(f"cycle failed at {outcome.failed_at}")
    return partition_summary(sink.read(spark, SUMMED))


def redelivery(spark, sf_dir):
    sink = BatchFolders(fresh_path(spark, "redelivered"), ["topic"])
    records = log_records(spark, sf_dir)
    for _ in range(2):
        sink(records, 1)
    return partition_summary(sink.read(spark, SUMMED))


# --- cycles that report what they wrote -----------------------------------------


class FailsIn:
    """A sink that writes and then fails, in the first attempt of one cycle."""

    def __init__(self, sink, cycle_id):
        self.sink, self.cycle_id, self.failed = sink, cycle_id, False

    def __call__(self, records, cycle_id):
        written = self.sink(records, cycle_id)
        if cycle_id == self.cycle_id and not self.failed:
            self.failed = True
            raise RuntimeError("the connection broke after the write")
        return written


_reported: dict[tuple[str, str], tuple] = {}


def reported_cycle(spark, sf_dir):
    """The log moved in three capped cycles, the second of which fails once after its write.

    Returns the cycle, its sink, and what could be read right after the failure.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _reported:
        log = log_table(spark, sf_dir)
        home = fresh_path(spark, "cycle")
        sink = SegmentSink(f"{home}/out")
        cap = (log.catalog().agg(F.max("latest")).first()[0] or 0) // 3 + 1
        cycle = LogCycle(
            spark, "reported", log, FailsIn(sink, 2), home, max_records=cap, flush_interval_ms=0
        )
        outcomes = [cycle.run_once(), cycle.run_once()]
        between = sink.read(spark, cycle.ledger, SUMMED)
        between = write_out(partition_summary(between), "between")
        if outcomes[0].committed and outcomes[1].failed_at != "Writer":
            raise RuntimeError("the second cycle should fail in its sink")
        failed = [o for o in cycle.drain() if o.failed_at]
        if failed:
            message = cycle.events.status_table().where("status = 'ERROR'").first().message
            raise RuntimeError(f"cycle failed: {message}")
        _reported[at] = (cycle, sink, between)
    return _reported[at]


def snapshot_after_failure(spark, sf_dir):
    """Committed records after the second cycle failed behind its write, and at the end."""
    cycle, sink, between = reported_cycle(spark, sf_dir)
    end = partition_summary(sink.read(spark, cycle.ledger, SUMMED))
    return between.withColumn("moment", F.lit("failed")).unionByName(
        end.withColumn("moment", F.lit("end"))
    )


def write_times(spark, sf_dir):
    """What the tasks told of each topic partition, and whether they told a time for it."""
    cycle, sink, _ = reported_cycle(spark, sf_dir)
    return sink.writes(spark, cycle.ledger).groupBy("cycle_id", "topic", "partition").agg(
        F.min("from_offset").alias("from_offset"),
        F.max("until_offset").alias("until_offset"),
        F.sum("records").alias("records"),
        F.sum("bytes").alias("bytes"),
        (F.min("nanos") > 0).alias("timed"),
    )


def cycle_partial_sink(spark, sf_dir):
    """A sink that takes no error records: their offsets stay uncommitted, run after run."""
    log = log_table(spark, sf_dir)
    home = fresh_path(spark, "cycle")
    sink = SegmentSink(f"{home}/out", accepts=F.col("topic") != "topic_error", partial=True)
    cycle = LogCycle(
        spark, "partial", log, sink, home,
        max_records=log.catalog().agg(F.max("latest")).first()[0] or 1, flush_interval_ms=0,
    )
    for _ in range(2):
        cycle.run_once()
    return cycle.ledger.load()


def fenced_commit(spark, sf_dir):
    """Two drivers commit the same cycle: the slower is refused and plans the next one."""
    catalog = catalog_of(spark, sf_dir)
    home = fresh_path(spark, "ledger")
    first, second = (cp.Ledger(spark, home, "shared") for _ in range(2))
    seen = second.load()  # nothing yet, as for the first
    empty = catalog.selectExpr("topic", "partition", "0L AS from_offset", "latest div 4 AS until_offset")
    first.commit(1, empty)
    half = catalog.selectExpr("topic", "partition", "0L AS from_offset", "latest div 2 AS until_offset")
    try:
        second.commit(1, cp.merge_checkpoint(seen, half))
        refused = catalog.isEmpty()
    except cp.ConflictingCommit:
        refused = True
    rest = catalog.selectExpr("topic", "partition", "latest div 4 AS from_offset", "latest AS until_offset")
    second.commit(2, cp.merge_checkpoint(second.load(), rest))
    return first.rows().select("cycle_id", *cp.RANGE_COLUMNS, F.lit(refused).alias("refused"))


QUERIES = {
    f.__name__: f
    for f in (
        log_scan_all,
        publish_increments,
        replay_steps,
        topic_select,
        partition_catalog,
        plan_ranges,
        scan_ranges,
        planned_count,
        gap_report,
        trimmed_scan,
        lagging_scan,
        snapshot_after_failure,
        write_times,
        cycle_partial_sink,
        fenced_commit,
        backfill_plan,
        backfill_scan,
        merge_checkpoint,
        next_offsets,
        last_checkpoint,
        partial_commit,
        partition_lag,
        flush_decision,
        partition_write_summary,
        index_lookup,
        cycle_output,
        cycle_ledger,
        cycle_metrics,
        retry_after_failed_write,
        cycle_status,
        cycle_boundaries,
        resume_external,
        redelivery,
    )
}

_ALL_SQL = f"""WITH {LOG_SQL}
SELECT topic, "partition", "offset", "timestamp", key, value FROM log"""

_SUMMARY = """count(*) AS records, min("offset") AS first_offset, max("offset") AS last_offset,
       CAST(sum(strlen(value)) AS BIGINT) AS bytes"""

_SUMMARY_SQL = f"""WITH {LOG_SQL}
SELECT topic, "partition", {_SUMMARY} FROM log GROUP BY topic, "partition" """

ORACLES = {
    "log_scan_all": _ALL_SQL,
    "publish_increments": _ALL_SQL,
    "replay_steps": """
WITH numbered AS (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS seq,
         count(*) OVER () AS total FROM events)
SELECT event_id, CAST(seq * 4 // total AS INT) AS step,
       CAST(seq % 5 AS INT) AS "partition", CAST(seq // 5 AS BIGINT) AS "offset"
FROM numbered""",
    "topic_select": f"""
WITH {LOG_SQL},
chosen AS (
  SELECT topic, 'exclude' AS mode FROM log WHERE NOT contains(topic, '_error')
  UNION ALL SELECT topic, 'include' FROM log WHERE topic IN ('topic_click', 'topic_view')
  UNION ALL SELECT topic, 'pattern' FROM log WHERE regexp_matches(topic, '^topic_[c-p]')
  UNION ALL SELECT topic, 'predicate' FROM log WHERE length(topic) > 10)
SELECT topic, mode, count(*) AS records FROM chosen GROUP BY topic, mode""",
    "partition_catalog": f"""WITH {CATALOG_SQL}
SELECT topic, "partition", earliest, latest FROM catalog""",
    "plan_ranges": f"""WITH {MIXED_SQL}
SELECT topic, "partition", from_offset, until_offset FROM ranges""",
    "scan_ranges": f"""WITH {MIXED_SQL}
SELECT l.topic, l."partition", l."offset", l."timestamp", l.key, l.value
FROM log l JOIN ranges r ON r.topic = l.topic AND r."partition" = l."partition"
 AND l."offset" >= r.from_offset AND l."offset" < r.until_offset""",
    "planned_count": f"""WITH {MIXED_SQL}
SELECT CAST(coalesce(sum(until_offset - from_offset), 0) AS BIGINT) AS records FROM ranges""",
    "gap_report": f"""WITH {MIXED_SQL},
kept AS (
  SELECT l.topic, l."partition", min(l."offset") AS earliest
  FROM log l JOIN catalog c ON c.topic = l.topic AND c."partition" = l."partition"
  WHERE l."offset" >= c.latest // 8 GROUP BY l.topic, l."partition"),
behind AS (
  SELECT topic, "partition",
         CASE WHEN "partition" = 2 THEN until_offset // 7 ELSE until_offset END AS until_offset
  FROM checkpoint)
SELECT k.topic, k."partition", b.until_offset AS missing_from, k.earliest AS missing_to,
       k.earliest - b.until_offset AS missing_count
FROM kept k JOIN behind b ON b.topic = k.topic AND b."partition" = k."partition"
WHERE b.until_offset < k.earliest""",
    "trimmed_scan": f"""WITH {CATALOG_SQL}
SELECT l.topic, l."partition", {_SUMMARY}
FROM log l JOIN catalog c ON c.topic = l.topic AND c."partition" = l."partition"
WHERE l."offset" >= c.latest // 8 GROUP BY l.topic, l."partition" """,
    "lagging_scan": f"""WITH {CATALOG_SQL}
SELECT l.topic, l."partition", {_SUMMARY}
FROM log l JOIN catalog c ON c.topic = l.topic AND c."partition" = l."partition"
WHERE l."offset" >= c.latest - c.latest // 10 OR (l.topic = 'topic_click' AND l."partition" = 0)
GROUP BY l.topic, l."partition" """,
    "snapshot_after_failure": f"""WITH {CATALOG_SQL},
cap AS (SELECT max(latest) // 3 + 1 AS n FROM catalog)
SELECT topic, "partition", {_SUMMARY}, 'failed' AS moment
FROM log, cap WHERE "offset" < n GROUP BY topic, "partition"
UNION ALL SELECT topic, "partition", {_SUMMARY}, 'end' FROM log GROUP BY topic, "partition" """,
    "write_times": f"""WITH {CATALOG_SQL},
cap AS (SELECT max(latest) // 3 + 1 AS n FROM catalog)
SELECT "offset" // n + 1 AS cycle_id, topic, "partition", min("offset") AS from_offset,
       max("offset") + 1 AS until_offset, count(*) AS records,
       CAST(sum(strlen(value)) AS BIGINT) AS bytes, true AS timed
FROM log, cap GROUP BY ALL""",
    "cycle_partial_sink": f"""WITH {CATALOG_SQL}
SELECT topic, "partition", CAST(0 AS BIGINT) AS from_offset, latest AS until_offset
FROM catalog WHERE topic <> 'topic_error'""",
    "fenced_commit": f"""WITH {CATALOG_SQL}
SELECT CAST(1 AS BIGINT) AS cycle_id, topic, "partition", CAST(0 AS BIGINT) AS from_offset,
       latest // 4 AS until_offset, true AS refused FROM catalog
UNION ALL SELECT 2, topic, "partition", 0, latest, true FROM catalog""",
    "backfill_plan": f"""WITH {MIXED_SQL}
SELECT topic, "partition", "start" AS from_offset, latest AS until_offset
FROM starts WHERE topic = 'topic_click'""",
    "backfill_scan": _SUMMARY_SQL,
    "merge_checkpoint": f"""WITH {MIXED_SQL}
SELECT coalesce(k.topic, r.topic) AS topic, coalesce(k."partition", r."partition") AS "partition",
       coalesce(k.from_offset, r.from_offset) AS from_offset,
       coalesce(r.until_offset, k.until_offset) AS until_offset
FROM checkpoint k FULL JOIN ranges r ON r.topic = k.topic AND r."partition" = k."partition" """,
    "next_offsets": f"""WITH {LEDGER_SQL}
SELECT topic, "partition", arg_max(until_offset, cycle_id) AS next_offset
FROM ledger GROUP BY topic, "partition" """,
    "last_checkpoint": f"""WITH {LEDGER_SQL}
SELECT topic, "partition", arg_min(from_offset, cycle_id) AS from_offset,
       arg_max(until_offset, cycle_id) AS until_offset
FROM ledger GROUP BY topic, "partition" """,
    "partial_commit": f"""WITH {MIXED_SQL},
written AS (SELECT * FROM ranges WHERE topic <> 'topic_error')
SELECT coalesce(k.topic, r.topic) AS topic, coalesce(k."partition", r."partition") AS "partition",
       coalesce(k.from_offset, r.from_offset) AS from_offset,
       coalesce(r.until_offset, k.until_offset) AS until_offset
FROM checkpoint k FULL JOIN written r ON r.topic = k.topic AND r."partition" = k."partition" """,
    "partition_lag": f"""WITH {LEDGER_SQL},
last AS (SELECT topic, "partition", arg_max(until_offset, cycle_id) AS until_offset
         FROM ledger GROUP BY topic, "partition")
SELECT c.topic, c."partition", coalesce(l.until_offset, c.earliest) AS next_offset, c.latest,
       c.latest - coalesce(l.until_offset, c.earliest) AS lag
FROM catalog c LEFT JOIN last l ON l.topic = c.topic AND l."partition" = c."partition" """,
    "flush_decision": f"""WITH {MIXED_SQL}
SELECT topic, CAST(sum(until_offset - from_offset) AS BIGINT) AS planned,
       (5001 - 5000 >= 1000) OR sum(until_offset - from_offset) >= 3 * any_value(n) AS flush
FROM ranges, cap GROUP BY topic""",
    "partition_write_summary": _SUMMARY_SQL,
    "index_lookup": f"""WITH {LOG_SQL} SELECT key, topic, "partition", value FROM log""",
    "cycle_output": f"""WITH {LOG_SQL}
SELECT topic, "partition", strftime("timestamp", '%Y/%m/%d') AS time_partition,
       count(*) AS records, count(DISTINCT "offset") AS offsets,
       min("offset") AS first_offset, max("offset") AS last_offset,
       CAST(sum(length(value)) AS BIGINT) AS chars
FROM log GROUP BY ALL""",
    "cycle_ledger": f"""WITH {CATALOG_SQL},
cap AS (SELECT max(latest) // 3 + 1 AS n FROM catalog)
SELECT cycle_id, topic, "partition", CAST(0 AS BIGINT) AS from_offset,
       least(cycle_id * n, latest) AS until_offset
FROM catalog, cap, (VALUES (CAST(1 AS BIGINT)), (2), (3)) c(cycle_id)""",
    "cycle_metrics": """
WITH totals AS (SELECT count(*) AS n, CAST(sum(strlen(props)) AS BIGINT) AS b FROM events)
SELECT 'Reader' AS module, 'InRecords' AS metric, n AS total FROM totals
UNION ALL SELECT 'Reader', 'InBytes', b FROM totals
UNION ALL SELECT 'Transformer', 'InRecords', n FROM totals
UNION ALL SELECT 'Transformer', 'OutRecords', n FROM totals
UNION ALL SELECT 'Writer', 'InRecords', n FROM totals
UNION ALL SELECT 'Writer', 'OutRecords', n FROM totals
UNION ALL SELECT 'Writer', 'InBytes', b FROM totals
UNION ALL SELECT 'Writer', 'OutBytes', b FROM totals""",
    "resume_external": f"""WITH {CATALOG_SQL}
SELECT l.topic, l."partition", {_SUMMARY}
FROM log l JOIN catalog c ON c.topic = l.topic AND c."partition" = l."partition"
WHERE l."offset" >= c.latest // 2 GROUP BY l.topic, l."partition" """,
    "redelivery": _SUMMARY_SQL,
    "retry_after_failed_write": _SUMMARY_SQL,
    "cycle_status": """
SELECT CAST(1 AS BIGINT) AS cycle_id, module, status, CAST(n AS BIGINT) AS events
FROM (VALUES ('Core', 'OK', 4), ('CheckpointService', 'OK', 3), ('Reader', 'OK', 2),
             ('Writer', 'ERROR', 1), ('Writer', 'OK', 1)) t(module, status, n)
WHERE (SELECT count(*) FROM events) > 0""",
    "cycle_boundaries": """
SELECT CAST(1 AS BIGINT) AS cycle_id, CAST(2 AS BIGINT) AS started, CAST(2 AS BIGINT) AS ended,
       2 * count(*) AS planned FROM events""",
}
