"""Streaming runs over several batches against their batch twins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brooklog.observe import EventTables, all_progress, partition_summary, progress_metrics, record_metrics
from brooklog.operators import aggregates as agg
from brooklog.operators.joins import busy_keys, enrich, interval_join, salted_interval_join
from brooklog.operators.records import merge, route
from brooklog.operators.reconcile import reconcile
from brooklog.plans.checkpoint import Ledger
from brooklog.scratch import file_names
from brooklog.sinks.files import BatchFolders
from brooklog.sources.log_stream import stream_records
from brooklog.sources.log_table import LogTable
from brooklog.sources.offset_ranges import capped_batches, stream_ranges
from brooklog.sources.text import read_lines
from brooklog.streaming.runner import (
    ChangedRows,
    KeepFirst,
    event_time,
    keep_first_by_key,
    run_available,
    start,
)
from brooklog.workloads import analytics
from brooklog.workloads.streams import SUMS_SCHEMA, WINDOW_KEYS, WINDOW_SCHEMA
from brooklog.workloads.tables import half_cap, log_stream, log_table, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def slices(spark, tmp_path_factory):
    """Events in four files; the folders differ in the order they were written."""
    events = table(spark, SF_DIR, "events")
    quarter = events.count() // 4

    def write(order):
        path = str(tmp_path_factory.mktemp("slices") / "events")
        for part in order:
            rows = events.where(F.expr(f"least(event_id div {quarter}, 3) = {part}"))
            rows.coalesce(1).write.mode("append").parquet(path)
        return path

    return {"in time": write([0, 1, 2, 3]), "late": write([0, 2, 3, 1])}


def files(spark, path):
    schema = table(spark, SF_DIR, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream(spark, path, delay="1 hour"):
    return event_time(files(spark, path), "ts", delay)


def zone_free(mine):
    for field in mine.schema:
        if field.dataType.typeName() == "timestamp":
            mine = mine.withColumn(field.name, F.col(field.name).cast("timestamp_ntz"))
    return mine


def same(mine, batch):
    return reconcile(batch, zone_free(mine).select(*batch.columns)).count() == 0


def batches(query):
    return [p["batchId"] for p in query.recentProgress if p["numInputRows"]]


def test_tumbling_windows_in_four_batches(spark, slices, home):
    sink = ChangedRows(f"{home}/out", WINDOW_SCHEMA, WINDOW_KEYS)
    windows = agg.windowed(
        stream(spark, slices["in time"]), "ts", "1 day", analytics.sum_list(), ["event_type"]
    )
    query = run_available(windows, sink, f"{home}/state", "update")
    assert len(batches(query)) == 4
    got = sink.read(spark)
    assert same(got, analytics.window_tumbling(spark, SF_DIR))


def test_sessions_in_four_batches(spark, slices, home):
    schema = (
        "user_id BIGINT, cell STRUCT<start: TIMESTAMP, end: TIMESTAMP>, "
        f"first_ts TIMESTAMP, last_ts TIMESTAMP, {SUMS_SCHEMA}"
    )
    sink = ChangedRows(f"{home}/out", schema, ["user_id", "cell"], merge_every=3)
    cells = agg.session_cells(
        stream(spark, slices["in time"]), "ts", "6 hours", analytics.sums(), ["user_id"]
    )
    run_available(cells, sink, f"{home}/state", "update")
    cells = sink.read(spark)
    got = agg.sessions_from_cells(cells, "6 hours", ["n", "cents"], ["user_id"])
    assert same(got, analytics.window_session(spark, SF_DIR))


def test_totals_in_four_batches(spark, slices, home):
    sink = ChangedRows(f"{home}/out", f"user_id BIGINT, {SUMS_SCHEMA}", ["user_id"], merge_every=2)
    totals = agg.accumulated(
        stream(spark, slices["late"]), ["user_id"], analytics.sum_list()
    )
    run_available(totals, sink, f"{home}/state", "update")
    assert same(sink.read(spark), analytics.accumulated_total(spark, SF_DIR))
    # what is kept is one base, not every batch
    assert file_names(spark, f"{home}/out/base") == file_names(spark, f"{home}/out/merged") == ["3"]
    assert file_names(spark, f"{home}/out/changes") == []


def test_changed_rows_survive_a_repeated_merge(spark, home):
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v long")
    sink = ChangedRows(f"{home}/out", "k long, v long", ["k"], merge_every=2)
    assert sink.read(spark).count() == 0
    sink(rows((1, 10), (2, 20)), 0)
    sink(rows((1, 11)), 1)
    got = lambda: sorted(map(tuple, sink.read(spark).collect()))
    assert got() == [(1, 11), (2, 20)]
    sink(rows((1, 11)), 1)  # Spark repeats the batch whose merge is done
    sink(rows((2, 21), (3, 30)), 2)
    sink(rows((2, 22), (3, 30)), 2)  # and one that is not merged yet, with the later state
    assert got() == [(1, 11), (2, 22), (3, 30)]


def test_closed_sessions_in_four_batches(spark, slices, home):
    sessions = agg.closed_sessions(
        stream(spark, slices["in time"]), "ts", "6 hours", analytics.sums(), ["user_id"]
    )
    sink = BatchFolders(f"{home}/out")
    query = run_available(sessions, sink, f"{home}/state", late_rows="fail")
    schema = f"user_id BIGINT, session_start TIMESTAMP, session_end TIMESTAMP, {SUMS_SCHEMA}"
    got = sink.read(spark, schema)
    assert got.select("cycle_id").distinct().count() > 2
    whole = analytics.window_session(spark, SF_DIR)
    found = reconcile(whole, zone_free(got).select(*whole.columns))
    # nothing but whole sessions, each once; only the last ones are still open
    assert found.where("status = 'extra'").count() == 0
    end = whole.agg(F.max("session_end")).first()[0]
    open_ = found.select((F.lit(end) - F.col("session_end")).alias("since"))
    assert open_.where("since > INTERVAL 7 HOUR").count() == 0  # the gap and the delay
    last = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][-1]
    assert last == found.count() < whole.count() // 4


def test_sessions_one_gap_apart_are_one(spark, home):
    rows = [("2024-01-01 00:00:00", 1), ("2024-01-01 06:00:00", 1), ("2024-01-01 12:00:00.000001", 1)]
    rows += [("2025-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "ts string, user_id long").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(f"{home}/in")
    events = event_time(spark.readStream.schema(df.schema).parquet(f"{home}/in"), "ts", "1 hour")
    sessions = agg.closed_sessions(events, "ts", "6 hours", {"n": F.lit(1)}, ["user_id"])
    sink = BatchFolders(f"{home}/out")
    run_available(sessions, sink, f"{home}/state")
    got = sink.read(spark, "user_id BIGINT, session_start TIMESTAMP, session_end TIMESTAMP, n BIGINT")
    assert sorted(r.n for r in got.collect()) == [1, 2]


PAIRS = (
    "click_id BIGINT, user_id BIGINT, click_ts TIMESTAMP, purchase_id BIGINT, "
    "purchase_ts TIMESTAMP"
)


def pairs(spark, path, home, delay):
    clicks, _ = analytics.click_and_purchase(stream(spark, path, delay))
    _, purchases = analytics.click_and_purchase(stream(spark, path, delay))
    joined = interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", "1 day")
    sink = BatchFolders(f"{home}/out")
    query = run_available(joined, sink, f"{home}/state")
    dropped = sum(o["numRowsRemoved"] for p in query.recentProgress for o in p["stateOperators"])
    return sink.read(spark, PAIRS), dropped


def test_stream_join_in_four_batches(spark, slices, home):
    got, dropped = pairs(spark, slices["in time"], home, "1 day")
    assert same(got, analytics.click_to_purchase(spark, SF_DIR))
    assert dropped > 0  # the watermark bounds the state


def test_stream_join_with_late_slices(spark, slices, home):
    """A delay longer than the disorder keeps every pair; a short one may not add any."""
    want = analytics.click_to_purchase(spark, SF_DIR)
    assert same(pairs(spark, slices["late"], f"{home}/long", "40 days")[0], want)
    short, _ = pairs(spark, slices["late"], f"{home}/short", "1 minute")
    extra = reconcile(want.select("click_id", "purchase_id"), short.select("click_id", "purchase_id"))
    assert extra.where("status = 'extra'").count() == 0
    assert extra.where("status = 'missing'").count() > 0


def test_enrichment_of_a_stream(spark, slices, home):
    customer = table(spark, SF_DIR, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = enrich(stream(spark, slices["in time"]), customer, {"user_id": "c_custkey"})
    sink = BatchFolders(f"{home}/out")
    run_available(joined.select(*analytics.ENRICHED), sink, f"{home}/state")
    got = sink.read(
        spark,
        "event_id BIGINT, user_id BIGINT, event_type STRING, c_name STRING, c_mktsegment STRING",
    )
    assert same(got, analytics.enrich_customer(spark, SF_DIR))


def test_routing_and_merging_streams(spark, slices, home):
    both = merge(
        {"a": stream(spark, slices["in time"]), "b": stream(spark, slices["late"])}
    )
    routed = route(both, {"clicks": F.col("event_type") == "click"}).select("event_id", "route")
    sink = BatchFolders(f"{home}/out", ["route"])
    run_available(routed, sink, f"{home}/state")
    got = sink.read(spark, "event_id BIGINT, route STRING")
    clicks = table(spark, SF_DIR, "events").where("event_type = 'click'").count()
    total = table(spark, SF_DIR, "events").count()
    assert got.where("route = 'clicks'").count() == 2 * clicks
    assert got.count() == 2 * total


@pytest.mark.parametrize("after_write", [False, True])
def test_restart_after_a_failed_write_leaves_one_copy(spark, slices, home, after_write):
    folders = BatchFolders(f"{home}/out")
    calls = []

    def sink(df, batch_id):
        calls.append(batch_id)
        broken = len(calls) == 2
        if after_write or not broken:
            folders(df, batch_id)
        if broken:
            raise OSError("sink is down")

    events = stream(spark, slices["in time"]).select("event_id")
    notes = EventTables(spark, f"{home}/events", "p")
    with pytest.raises(Exception, match="sink is down"):
        run_available(events, sink, f"{home}/state", events=notes)
    run_available(events, sink, f"{home}/state", events=notes)
    assert calls == [0, 1, 1, 2, 3]
    seen = sorted((r.cycle_id, r.status) for r in notes.status_table().collect())
    assert seen == [(0, "OK"), (1, "ERROR"), (1, "OK"), (2, "OK"), (3, "OK")]
    read = notes.metric_table().where("metric = 'InRecords'").agg(F.sum("value")).first()[0]
    assert read == table(spark, SF_DIR, "events").count()
    got = folders.read(spark, "event_id BIGINT").drop("cycle_id")
    assert reconcile(table(spark, SF_DIR, "events").select("event_id"), got).count() == 0


def test_a_later_run_reads_only_what_is_new(spark, home):
    lines = f"{home}/lines"
    sink = BatchFolders(f"{home}/out")
    for text in (["a", "b"], ["c"]):
        spark.createDataFrame([(t,) for t in text], "value STRING").write.mode("append").text(lines)
        run_available(read_lines(spark, lines, stream=True), sink, f"{home}/state")
    got = sink.read(spark, "value STRING")
    assert sorted((r.cycle_id, r.value) for r in got.collect()) == [(0, "a"), (0, "b"), (1, "c")]


def test_polling_query_can_be_stopped(spark, slices, home):
    sink = BatchFolders(f"{home}/out")
    query = start(
        stream(spark, slices["in time"]).select("event_id"), sink, f"{home}/state",
        every="100 milliseconds",
    )
    query.processAllAvailable()
    query.stop()
    assert sink.read(spark, "event_id BIGINT").count() == table(spark, SF_DIR, "events").count()


@pytest.mark.parametrize("way", [1, -1])
def test_redelivered_records_are_dropped_in_any_order(spark, home, way):
    """Batches that overlap, leave holes and fill them later, in both directions."""
    parts = [(0, 40), (30, 60), (80, 120), (0, 60), (55, 85), (110, 130)][::way]
    sink = BatchFolders(f"{home}/out")
    first = KeepFirst(sink, f"{home}/covered")
    for batch_id, (low, high) in enumerate(parts):
        rows = spark.range(low, high).unionByName(spark.range(low, low + 5)).selectExpr(
            "'t' AS topic", "CAST(id % 2 AS INT) AS partition", "id DIV 2 AS offset"
        )
        first(rows, batch_id)
        if batch_id == 3:
            first(rows, batch_id)  # a batch that is run again
    got = sink.read(spark, "topic STRING, partition INT, offset BIGINT")
    assert got.count() == got.select("partition", "offset").distinct().count() == 130
    covered = sorted(tuple(r) for r in first.covered(spark, 99).collect())
    assert covered == [("t", 0, 0, 65), ("t", 1, 0, 65)]


def test_ledger_follows_planned_ranges_over_several_batches(spark, home):
    log = log_table(spark, SF_DIR)
    ledger = Ledger(spark, f"{home}/ledger", "p")
    write = capped_batches(log, BatchFolders(f"{home}/out"), ledger)
    cap = log.catalog().agg(F.max("latest")).first()[0] // 3 + 1
    query = run_available(
        stream_ranges(spark, log, cap), write, f"{home}/state", every="10 milliseconds"
    )
    assert len([p for p in all_progress(query) if p["numInputRows"]]) == 3
    want = log.catalog().selectExpr(
        "topic", "partition", "earliest AS from_offset", "latest AS until_offset"
    )
    assert reconcile(want, ledger.load()).count() == 0 and ledger.last_cycle() == 3


def test_rows_behind_the_watermark_are_an_error(spark, slices, home):
    windows = agg.windowed(
        stream(spark, slices["late"], "1 minute"), "ts", "1 day", analytics.sum_list(), ["event_type"]
    )
    events = EventTables(spark, f"{home}/events", "p")
    with pytest.raises(RuntimeError, match="watermark"):
        run_available(
            windows, ChangedRows(f"{home}/out", WINDOW_SCHEMA, WINDOW_KEYS), f"{home}/state",
            "update", events, late_rows="fail",
        )
    assert events.status_table().where("status = 'ERROR'").count() > 0


def test_no_batch_is_forgotten(spark, home):
    """Spark keeps the progress of a few batches only; here two."""
    log = log_table(spark, SF_DIR)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        cap = log.catalog().agg(F.max("latest")).first()[0] // 5 + 1
        observed = stream_records(spark, log, cap).observe("read", *record_metrics("value"))
        # polled with a cap of a fifth, so that there are more batches than Spark remembers
        sink = BatchFolders(f"{home}/out")
        query = run_available(observed, sink, f"{home}/state", every="10 milliseconds")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = progress_metrics(query)
    assert sum(r[3] for r in rows if r[2] == "records") == log.records().count()
    assert len({r[0] for r in rows}) > 2


def test_observed_metrics_add_up(spark, slices, home):
    events = stream(spark, slices["in time"]).withColumnRenamed("props", "value_text")
    observed = events.observe("read", *record_metrics("value_text"))
    query = run_available(observed, BatchFolders(f"{home}/out"), f"{home}/state")
    rows = progress_metrics(query)
    assert len({r[0] for r in rows}) == 4
    total = table(spark, SF_DIR, "events").count()
    assert sum(r[3] for r in rows if r[2] == "records") == total


def test_per_partition_cap_in_a_stream(spark, home):
    log = log_table(spark, SF_DIR)
    ends = {(r.topic, r.partition): r.latest for r in log.catalog().collect()}
    cap = max(ends.values()) // 2 + 1
    sink = BatchFolders(f"{home}/out")
    schema = "topic STRING, partition INT, offset BIGINT, value STRING"
    for run in (1, 2, 3):
        query = run_available(
            stream_ranges(spark, log, cap), capped_batches(log, sink), f"{home}/state"
        )
        found = partition_summary(sink.read(spark, schema)).collect()
        got = {(r.topic, r.partition): (r.records, r.last_offset + 1) for r in found}
        assert got == {k: (min(run * cap, end),) * 2 for k, end in ends.items()}
    assert not batches(query)


def test_records_of_a_log_in_capped_batches(spark, home):
    log = log_table(spark, SF_DIR)
    sink = BatchFolders(f"{home}/out")
    query = run_available(
        stream_records(spark, log, half_cap(log)), sink, f"{home}/state", every="10 milliseconds"
    )
    assert len([p for p in all_progress(query) if p["numInputRows"]]) == 2
    layout = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ, key STRING, value STRING"
    got = sink.read(spark, layout).drop("cycle_id")
    assert reconcile(log.records().select(*got.columns), got).count() == 0


def test_a_stream_of_records_goes_on_where_it_was(spark, home):
    log = LogTable(spark, f"{home}/log")
    records = numbered(spark, 60)
    log.publish(records.where("id < 30"), ["id"])
    stream = stream_records(spark, log, 4)  # one folder for its progress, in both runs
    sink = BatchFolders(f"{home}/out")
    count = lambda: sink.read(spark, "offset BIGINT, value STRING").selectExpr(
        "count(*)", "count(DISTINCT value)"
    ).first()
    run_available(stream, sink, f"{home}/state", every="10 milliseconds")
    assert tuple(count()) == (30, 30)
    log.publish(records.where("id >= 30"), ["id"])
    log.compact()
    query = run_available(stream, sink, f"{home}/state", every="10 milliseconds")
    assert tuple(count()) == (60, 60)
    assert max(p["numInputRows"] for p in all_progress(query)) == 8


def numbered(spark, n):
    return spark.range(n).selectExpr(
        "'t' AS topic", "CAST(id % 2 AS INT) AS partition", "CAST(NULL AS TIMESTAMP_NTZ) AS timestamp",
        "CAST(NULL AS STRING) AS key", "CAST(id AS STRING) AS value", "id",
    )


def test_a_stream_tells_or_fails_where_records_are_lost(spark, home):
    log = LogTable(spark, f"{home}/log")
    log.publish(numbered(spark, 40), ["id"])
    events = EventTables(spark, f"{home}/events", "p")
    planned = log.catalog().selectExpr("topic", "partition", "0L AS from_offset", "latest AS until_offset")
    planned = spark.createDataFrame(planned.collect(), planned.schema)
    run_available(stream_records(spark, log, 5, "fail"), BatchFolders(f"{home}/a"), f"{home}/sa", every="10 milliseconds")
    log.trim(spark.createDataFrame([("t", 1, 7)], "topic string, partition int, earliest long"))
    capped_batches(log, BatchFolders(f"{home}/out"), events=events)(planned, 0)
    told = [r.message for r in events.status_table().where("status = 'ERROR'").collect()]
    assert told == ["records lost in t/1: offsets 0 to 6"]
    assert BatchFolders(f"{home}/out").read(spark, "offset BIGINT").count() == 33
    # a query that had read up to 5 finds offsets 5 and 6 gone
    stream = stream_records(spark, log, 3, "fail")
    query = start(stream, BatchFolders(f"{home}/b"), f"{home}/sb", every="10 milliseconds")
    query.processAllAvailable()
    query.stop()
    log.trim(spark.createDataFrame([("t", 0, 20), ("t", 1, 20)], "topic string, partition int, earliest long"))
    log.publish(numbered(spark, 4), ["id"])
    assert log.scan(planned).count() == 0
    skipping = stream_records(spark, log, on_gap="skip")
    run_available(skipping, BatchFolders(f"{home}/c"), f"{home}/sc")
    assert BatchFolders(f"{home}/c").read(spark, "offset BIGINT").count() == 4


def test_salted_stream_join_spreads_a_busy_key(spark, home):
    """Two thirds of all clicks are of one user."""
    clicks = spark.range(300).selectExpr(
        "id AS click_id", "IF(id % 3 < 2, 0, id) AS user_id",
        "timestamp_seconds(1704067200 + id * 60) AS click_ts",
    )
    purchases = spark.range(0, 300, 7).selectExpr(
        "id AS purchase_id", "IF(id % 3 < 2, 0, id) AS user_id",
        "timestamp_seconds(1704067230 + id * 60) AS purchase_ts",
    )
    for name, df in (("clicks", clicks), ("purchases", purchases)):
        df.repartition(2).write.parquet(f"{home}/{name}")
    read = lambda name, ts: event_time(
        spark.readStream.schema(spark.read.parquet(f"{home}/{name}").schema)
        .option("maxFilesPerTrigger", 1).parquet(f"{home}/{name}"), ts, "1 day")
    busy = busy_keys(clicks.groupBy("user_id").count(), ["user_id"], "count", 50)
    assert [tuple(r) for r in busy.collect()] == [(0, 4)]
    joined = salted_interval_join(
        read("clicks", "click_ts"), read("purchases", "purchase_ts"), ["user_id"], "click_ts",
        "purchase_ts", "1 hour", busy, F.col("click_id"),
    )
    sink = BatchFolders(f"{home}/out")
    run_available(joined, sink, f"{home}/state")
    want = interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", "1 hour")
    got = sink.read(spark, "click_id BIGINT, purchase_id BIGINT")
    assert reconcile(want.select("click_id", "purchase_id"), got.select("click_id", "purchase_id")).count() == 0
    assert want.count() > 100


def test_keyed_copies_within_and_behind_the_delay(spark, home):
    rows = [(0, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"), (0, "2024-01-01 00:10:00")]
    later = [(1, "2024-01-01 00:40:00"), (2, "2024-01-05 00:00:00")]
    late = [(1, "2024-01-01 00:40:00"), (3, "2024-01-05 00:01:00")]
    # a batch knows as late what was behind the watermark of the batch before
    for part in (rows, later, [(2, "2024-01-05 00:00:30")], late):
        df = spark.createDataFrame(part, "k long, ts string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{home}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    first = keep_first_by_key(stream, ["k"], "ts", "1 hour")
    sink = BatchFolders(f"{home}/out")
    events = EventTables(spark, f"{home}/events", "p")
    run_available(first, sink, f"{home}/state", events=events)
    assert sorted(r.k for r in sink.read(spark, "k long").collect()) == [0, 1, 2, 3]
    told = [r.message for r in events.status_table().where("status = 'ERROR'").collect()]
    assert told == ["1 rows came behind the watermark"]


def test_queries_of_the_log_take_several_batches(spark, home):
    log = log_table(spark, SF_DIR)
    for name, sink in (("plain", BatchFolders(f"{home}/a")), ("once", KeepFirst(BatchFolders(f"{home}/b"), f"{home}/k"))):
        query = run_available(log_stream(spark, SF_DIR), sink, f"{home}/{name}", every="10 milliseconds")
        assert len([p for p in all_progress(query) if p["numInputRows"]]) > 1
    assert len(file_names(spark, f"{home}/k")) == 2
    assert log.version() == 1
