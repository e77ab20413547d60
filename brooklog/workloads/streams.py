"""Streaming runs over the whole tables, each with the result of its batch twin.

A run reads everything there is, stops, and its output is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklog.functions.time_partition import column_time
from brooklog.observe import EventTables, partition_summary, progress_metrics, record_metrics
from brooklog.operators import aggregates as agg
from brooklog.operators.joins import busy_keys, enrich, interval_join, salted_interval_join
from brooklog.operators.records import merge, route, tag_time_partition
from brooklog.plans.checkpoint import Ledger
from brooklog.schemas import TAGGED
from brooklog.scratch import fresh_path, write_out
from brooklog.sinks.files import BatchFolders
from brooklog.sources.log_stream import stream_records
from brooklog.sources.offset_ranges import capped_batches, stream_ranges
from brooklog.streaming.runner import (
    ChangedRows,
    KeepFirst,
    event_time,
    keep_first_by_key,
    run_available,
)
from brooklog.workloads import analytics
from brooklog.workloads.records import _branches
from brooklog.workloads.tables import (
    CATALOG_SQL,
    LOG_SQL,
    half_cap,
    log_stream,
    log_table,
    table,
    table_stream,
    trimmed_log,
)

SUMS_SCHEMA = "n BIGINT, cents BIGINT"


def _events(spark, sf_dir, delay="1 hour"):
    return event_time(table_stream(spark, sf_dir, "events"), "ts", delay)


def _zone_free(df):
    """Back to wall-clock times, as in the input tables."""
    for field in df.schema:
        if field.dataType.typeName() == "timestamp":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp_ntz"))
    return df


#: Polling interval of streams that hand out one capped batch at a time.
POLL = "10 milliseconds"


def _changed(spark, stream, schema, keys):
    home = fresh_path(spark, "stream")
    sink = ChangedRows(f"{home}/out", schema, keys)
    run_available(stream, sink, f"{home}/state", "update", late_rows="fail")
    return _zone_free(sink.read(spark))


def _appended(spark, stream, schema):
    home = fresh_path(spark, "stream")
    sink = BatchFolders(f"{home}/out")
    run_available(stream, sink, f"{home}/state", late_rows="fail")
    return _zone_free(sink.read(spark, schema).drop("cycle_id"))


WINDOW_KEYS = ["window_start", "window_end", "event_type"]
WINDOW_SCHEMA = (
    f"window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING, {SUMS_SCHEMA}"
)


def stream_window_tumbling(spark, sf_dir):
    windows = agg.windowed(
        _events(spark, sf_dir), "ts", "1 day", analytics.sum_list(), ["event_type"]
    )
    return _changed(spark, windows, WINDOW_SCHEMA, WINDOW_KEYS)


def stream_window_sliding(spark, sf_dir):
    windows = agg.windowed(
        _events(spark, sf_dir), "ts", "2 days", analytics.sum_list(), ["event_type"], "1 day"
    )
    return _changed(spark, windows, WINDOW_SCHEMA, WINDOW_KEYS)


def stream_window_session(spark, sf_dir):
    """Each session is given out once, when it is closed, and leaves the state.

    The last ones are closed by a row of no user, far behind all others.
    """
    home = fresh_path(spark, "stream")
    events = table_stream(spark, sf_dir, "events")
    closing = events.sparkSession.range(1).select(
        F.expr("TIMESTAMP_NTZ '9999-01-01 00:00:00'").alias("ts"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.lit(0.0).alias("value"),
    )
    # the folder is empty at first: its row would end all sessions
    closing.where("false").write.parquet(f"{home}/closing")
    ends = spark.readStream.schema(closing.schema).parquet(f"{home}/closing")
    both = event_time(events.select(*closing.columns).unionByName(ends), "ts", "1 hour")
    sessions = agg.closed_sessions(both, "ts", "6 hours", analytics.sums(), ["user_id"])
    sink = BatchFolders(f"{home}/out")
    run_available(sessions, sink, f"{home}/state", late_rows="fail")
    closing.write.mode("append").parquet(f"{home}/closing")
    run_available(sessions, sink, f"{home}/state", late_rows="fail")
    schema = f"user_id BIGINT, session_start TIMESTAMP, session_end TIMESTAMP, {SUMS_SCHEMA}"
    return _zone_free(sink.read(spark, schema).drop("cycle_id"))


def stream_accumulated_total(spark, sf_dir):
    totals = agg.accumulated(
        table_stream(spark, sf_dir, "events"), ["user_id"], analytics.sum_list()
    )
    return _changed(spark, totals, f"user_id BIGINT, {SUMS_SCHEMA}", ["user_id"])


def stream_enrich_customer(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    events = table_stream(spark, sf_dir, "events")
    return _appended(
        spark,
        enrich(events, customer, {"user_id": "c_custkey"}).select(*analytics.ENRICHED),
        "event_id BIGINT, user_id BIGINT, event_type STRING, c_name STRING, c_mktsegment STRING",
    )


def stream_click_to_purchase(spark, sf_dir):
    clicks, _ = analytics.click_and_purchase(_events(spark, sf_dir, "1 day"))
    _, purchases = analytics.click_and_purchase(_events(spark, sf_dir, "1 day"))
    pairs = interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", "1 day")
    return _appended(
        spark,
        pairs,
        "click_id BIGINT, user_id BIGINT, click_ts TIMESTAMP, purchase_id BIGINT, "
        "purchase_ts TIMESTAMP",
    )


def stream_route_split(spark, sf_dir):
    home = fresh_path(spark, "stream")
    events = table_stream(spark, sf_dir, "events").select("event_id", "event_type", "value")
    sink = BatchFolders(f"{home}/out", ["route"])
    run_available(route(events, _branches()), sink, f"{home}/state")
    return sink.read(spark, "event_id BIGINT, event_type STRING, route STRING").drop("cycle_id")


def stream_merge(spark, sf_dir):
    web = table_stream(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("customer"), "event_type"
    )
    shop = table_stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), "o_orderstatus"
    )
    return _appended(
        spark,
        merge({"web": web, "shop": shop}),
        "id BIGINT, customer BIGINT, event_type STRING, source STRING, o_orderstatus STRING",
    )


def stream_click_to_purchase_salted(spark, sf_dir):
    """The same pairs, with the state of busy users spread by the clicks they had."""
    clicks, _ = analytics.click_and_purchase(_events(spark, sf_dir, "1 day"))
    _, purchases = analytics.click_and_purchase(_events(spark, sf_dir, "1 day"))
    counted, _ = analytics.click_and_purchase(table(spark, sf_dir, "events"))
    counts = write_out(counted.groupBy("user_id").agg(F.count(F.lit(1)).alias("clicks")), "clicks")
    usual = counts.agg(F.avg("clicks")).first()[0] or 0
    busy = write_out(busy_keys(counts, ["user_id"], "clicks", int(usual) + 1), "busy")
    pairs = salted_interval_join(
        clicks, purchases, ["user_id"], "click_ts", "purchase_ts", "1 day", busy, F.col("click_id")
    )
    return _appended(
        spark,
        pairs,
        "click_id BIGINT, user_id BIGINT, click_ts TIMESTAMP, purchase_id BIGINT, "
        "purchase_ts TIMESTAMP",
    )


def stream_time_partitioned(spark, sf_dir):
    home = fresh_path(spark, "stream")
    tagged = tag_time_partition(log_stream(spark, sf_dir), column_time("timestamp"))
    sink = BatchFolders(f"{home}/out", ["topic", "time_partition"])
    run_available(tagged, sink, f"{home}/state", every=POLL)
    return sink.read(spark, TAGGED).drop("cycle_id")


def stream_deduplicate(spark, sf_dir):
    """Every record delivered twice, in several batches and no order, kept once."""
    twice = log_stream(spark, sf_dir).unionByName(log_stream(spark, sf_dir))
    home = fresh_path(spark, "stream")
    sink = BatchFolders(f"{home}/out")
    run_available(twice, KeepFirst(sink, f"{home}/covered"), f"{home}/state", every=POLL)
    return partition_summary(
        sink.read(spark, "topic STRING, partition INT, offset BIGINT, value STRING")
    )


def stream_deduplicate_keyed(spark, sf_dir):
    """Every event delivered twice without an offset, kept once by its id."""
    events = table_stream(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    twice = events.unionByName(table_stream(spark, sf_dir, "events").select(*events.columns))
    first = keep_first_by_key(twice, ["event_id"], "ts", "1 hour")
    kept = _appended(spark, first, "event_id BIGINT, event_type STRING, ts TIMESTAMP")
    return kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids")
    )


def stream_records_summary(spark, sf_dir):
    """The trimmed log, planned by its file index and read on the executors."""
    log = trimmed_log(spark, sf_dir)
    home = fresh_path(spark, "stream")
    sink = BatchFolders(f"{home}/out")
    run_available(stream_records(spark, log, half_cap(log)), sink, f"{home}/state", every=POLL)
    return partition_summary(
        sink.read(spark, "topic STRING, partition INT, offset BIGINT, value STRING")
    )


def stream_ledger(spark, sf_dir):
    home = fresh_path(spark, "stream")
    ledger = Ledger(spark, f"{home}/ledger", "events")
    log, ranges = _capped(spark, sf_dir)
    write = capped_batches(log, BatchFolders(f"{home}/out", ["topic"]), ledger)
    run_available(ranges, write, f"{home}/state", every=POLL)
    return ledger.load()


def stream_gap_errors(spark, sf_dir):
    """Ranges planned before a trim, read after it: an error for each partition that lost records."""
    log = trimmed_log(spark, sf_dir)
    home = fresh_path(spark, "stream")
    events = EventTables(spark, f"{home}/events", "late")
    read = capped_batches(log, BatchFolders(f"{home}/out"), events=events)
    ends = log.catalog().selectExpr("topic", "partition", "0L AS from_offset", "latest AS until_offset")
    read(ends, 0)
    errors = events.status_table().where("status = 'ERROR'")
    part = lambda k: F.regexp_extract(
        "message", r"in (.*)/(\d+): offsets (\d+) to (\d+)", k
    )
    return errors.select(
        part(1).alias("topic"),
        part(2).cast("int").alias("partition"),
        part(3).cast("bigint").alias("missing_from"),
        (part(4).cast("bigint") + 1).alias("missing_to"),
    )


def stream_metrics(spark, sf_dir):
    """Observed record and byte counts of the batches, added up."""
    home = fresh_path(spark, "stream")
    log = log_stream(spark, sf_dir).observe("read", *record_metrics("value"))
    query = run_available(log, BatchFolders(f"{home}/out"), f"{home}/state", every=POLL)
    rows = spark.createDataFrame(
        progress_metrics(query), "batch_id BIGINT, stage STRING, metric STRING, value BIGINT"
    )
    return rows.groupBy("stage", "metric").agg(F.sum("value").alias("total"))


def _capped(spark, sf_dir):
    """The log's ranges in batches of at most half of the longest partition each."""
    log = log_table(spark, sf_dir)
    return log, stream_ranges(spark, log, half_cap(log))


def stream_capped(spark, sf_dir):
    log, ranges = _capped(spark, sf_dir)
    home = fresh_path(spark, "stream")
    sink = BatchFolders(f"{home}/out")
    run_available(ranges, capped_batches(log, sink), f"{home}/state", every=POLL)
    out = sink.read(spark, "topic STRING, partition INT, offset BIGINT, value STRING")
    return partition_summary(out)


QUERIES = {
    f.__name__: f
    for f in (
        stream_window_tumbling,
        stream_window_sliding,
        stream_window_session,
        stream_accumulated_total,
        stream_enrich_customer,
        stream_click_to_purchase,
        stream_route_split,
        stream_merge,
        stream_time_partitioned,
        stream_deduplicate,
        stream_deduplicate_keyed,
        stream_click_to_purchase_salted,
        stream_records_summary,
        stream_gap_errors,
        stream_ledger,
        stream_metrics,
        stream_capped,
    )
}


def _oracles() -> dict[str, str]:
    from brooklog.workloads import log, records

    return {
        "stream_window_tumbling": analytics.TUMBLING_SQL,
        "stream_window_sliding": analytics.SLIDING_SQL,
        "stream_window_session": analytics.SESSION_SQL,
        "stream_accumulated_total": analytics.ACCUMULATED_SQL,
        "stream_enrich_customer": analytics.ENRICH_SQL,
        "stream_click_to_purchase": analytics.PAIRS_SQL,
        "stream_route_split": records.ORACLES["route_split"],
        "stream_merge": records.ORACLES["merge_streams"],
        "stream_time_partitioned": records.ORACLES["tag_time_partition"],
        "stream_deduplicate": log.ORACLES["backfill_scan"],
        "stream_deduplicate_keyed": """
SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS ids
FROM events GROUP BY event_type""",
        "stream_click_to_purchase_salted": analytics.PAIRS_SQL,
        "stream_records_summary": log.ORACLES["trimmed_scan"],
        "stream_gap_errors": f"""WITH {CATALOG_SQL}
SELECT topic, "partition", CAST(0 AS BIGINT) AS missing_from, latest // 8 AS missing_to
FROM catalog WHERE latest // 8 > 0""",
        "stream_ledger": f"""WITH {LOG_SQL}
SELECT topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset
FROM log GROUP BY topic, "partition" """,
        "stream_capped": log.ORACLES["backfill_scan"],
        "stream_metrics": """
SELECT 'read' AS stage, 'records' AS metric, count(*) AS total FROM events
UNION ALL SELECT 'read', 'bytes', CAST(sum(strlen(props)) AS BIGINT) FROM events""",
    }


ORACLES = _oracles()
