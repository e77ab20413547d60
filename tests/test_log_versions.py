"""The log's catalog of versions, and the sink that reports what it wrote."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brooklog import schemas
from brooklog.cycle import LogCycle
from brooklog.operators.reconcile import reconcile_log
from brooklog.plans import ranges as plans
from brooklog.plans.checkpoint import ConflictingCommit, Ledger
from brooklog.scratch import create_once, file_names, read_text
from brooklog.sinks.segments import SegmentSink, manifest
from brooklog.sources import log_table as logs
from brooklog.sources.log_table import ConflictingChange, LogTable

SUMMED = "topic STRING, partition INT, offset BIGINT, value STRING"
FLOORS = "topic string, partition int, earliest long"


def numbered(spark, n, start=0):
    return spark.range(start, n).selectExpr(
        "IF(id % 3 = 0, 'a', 'b=/ %') AS topic", "CAST(id % 2 AS INT) AS partition",
        "CAST(NULL AS TIMESTAMP_NTZ) AS timestamp", "CAST(NULL AS STRING) AS key",
        "CAST(id AS STRING) AS value", "id",
    )


@pytest.fixture
def log(spark, home):
    return LogTable(spark, f"{home}/log")


def values(df):
    return sorted(int(r.value) for r in df.collect())


def test_only_one_of_two_files_is_created(spark, home):
    assert create_once(spark, f"{home}/x/1", "first") and not create_once(spark, f"{home}/x/1", "second")
    assert read_text(spark, f"{home}/x/1") == "first" and read_text(spark, f"{home}/x/2") is None
    assert file_names(spark, f"{home}/x") == ["1"] and file_names(spark, f"{home}/none") == []


def test_a_slower_publisher_is_refused(spark, home, log):
    log.publish(numbered(spark, 30), ["id"])
    other = LogTable(spark, log.root)
    version = other.version

    def overtaken():
        """The other one publishes after this one has looked."""
        found = version()
        other.version = version
        log.publish(numbered(spark, 40, 30), ["id"])
        return found

    other.version = overtaken
    with pytest.raises(ConflictingChange):
        other.publish(numbered(spark, 90, 60), ["id"])
    # its files are there, but not part of the log
    assert values(log.records()) == list(range(40))
    other.publish(numbered(spark, 90, 60), ["id"])
    assert values(log.records()) == [*range(40), *range(60, 90)]
    assert log.vacuum() == 1 and values(log.records()) == [*range(40), *range(60, 90)]


def test_the_state_is_kept_in_few_tables(spark, log, monkeypatch):
    monkeypatch.setattr(logs, "SNAPSHOT_EVERY", 3)
    for k in range(7):
        log.publish(numbered(spark, 10 * k + 10, 10 * k), ["id"])
    read = log._changes(log.version())[0].inputFiles()
    assert values(log.records()) == list(range(70)) and len(read) <= 4
    ends = {(r.topic, r.partition): r.latest for r in log.catalog().collect()}
    assert sum(ends.values()) == 70


def test_trimmed_records_are_gone_and_offsets_go_on(spark, log):
    for k in range(3):
        log.publish(numbered(spark, 30 * k + 30, 30 * k), ["id"])
    before = {(r.topic, r.partition): (r.earliest, r.latest) for r in log.catalog().collect()}
    assert before == {("a", 0): (0, 15), ("a", 1): (0, 15), ("b=/ %", 0): (0, 30), ("b=/ %", 1): (0, 30)}
    log.trim(spark.createDataFrame([("a", 0, 7), ("a", 1, 99), ("none", 0, 3)], FLOORS))
    after = {(r.topic, r.partition): (r.earliest, r.latest) for r in log.catalog().collect()}
    assert after == before | {("a", 0): (7, 15), ("a", 1): (15, 15)}
    log.trim(spark.createDataFrame([("a", 0, 2)], FLOORS))  # a lower floor changes nothing
    assert log.records().where("topic = 'a'").count() == 8
    whole = plans.plan_backfill(log.catalog()).withColumn("from_offset", F.lit(0))
    assert log.scan(whole).count() == 68
    gaps = plans.find_gaps(log.catalog(), spark.createDataFrame([("a", 0, 0, 3), ("a", 1, 0, 15)], schemas.RANGES))
    assert [tuple(r) for r in gaps.collect()] == [("a", 0, 3, 7, 4)]
    log.publish(numbered(spark, 96, 90), ["id"])
    assert {r.offset for r in log.records().where("topic = 'a' AND partition = 1").collect()} == {15}
    assert log.vacuum() == 0


def test_compaction_changes_files_and_nothing_else(spark, log):
    for k in range(4):
        log.publish(numbered(spark, 20 * k + 20, 20 * k), ["id"])
    log.trim(spark.createDataFrame([("a", 0, 5)], FLOORS))
    was = sorted(map(tuple, log.records().collect()), key=str)
    ends = sorted(map(tuple, log.catalog().collect()))
    older = log.records()
    assert log.compact() == log.version() and log.compact(2) is None
    assert log.files().groupBy("topic", "partition").count().agg(F.max("count")).first()[0] == 1
    assert sorted(map(tuple, log.records().collect()), key=str) == was
    assert sorted(map(tuple, older.collect()), key=str) == was  # files are still there
    assert sorted(map(tuple, log.catalog().collect())) == ends
    assert log.vacuum() == 4 and sorted(map(tuple, log.records().collect()), key=str) == was


def test_a_lagging_partition_opens_no_files_of_others(spark, log):
    for k in range(5):
        log.publish(numbered(spark, 20 * k + 20, 20 * k), ["id"])
    lag = [("a", 0, 0, 99), ("a", 1, 15, 99)]
    found = log.scan(spark.createDataFrame(lag, schemas.RANGES))
    read = [f for f in found.inputFiles() if "/records/" in f]
    ends = {(r.topic, r.partition): r.latest for r in log.catalog().collect()}
    assert found.count() == ends["a", 0] + ends["a", 1] - 15
    # five files of the one that lags, and of the other the last only
    assert len([f for f in read if "partition=0" in f]) == 5
    assert len([f for f in read if "partition=1" in f]) == 1
    assert all("topic=a/" in f for f in read)


# --- ledger --------------------------------------------------------------------


def checkpoint(spark, until):
    return spark.createDataFrame([("t", 0, 0, until)], schemas.RANGES)


def test_one_of_two_drivers_commits_a_cycle(spark, home):
    one, two = Ledger(spark, home, "p"), Ledger(spark, home, "p")
    one.commit(1, checkpoint(spark, 5))
    two.commit(1, checkpoint(spark, 5))  # a repeated batch, the same
    with pytest.raises(ConflictingCommit):
        two.commit(1, checkpoint(spark, 6))
    with pytest.raises(ConflictingCommit):
        two.commit(1, checkpoint(spark, 5), output="elsewhere")
    assert [r.until_offset for r in two.load().collect()] == [5]
    assert len(file_names(spark, f"{home}/pipeline=p/attempts")) == 1


def cycle_of(spark, log, home, sink, **more):
    more = {"max_records": 10, "flush_interval_ms": 0} | more
    return LogCycle(spark, "p", log, sink, home, **more)


def test_a_slower_driver_plans_again(spark, home, log):
    log.publish(numbered(spark, 60), ["id"])
    sink = SegmentSink(f"{home}/out")
    one, two = cycle_of(spark, log, home, sink), cycle_of(spark, log, home, sink)

    def overtaken(records, cycle_id):
        written = sink(records, cycle_id)
        one.run_once()
        return written

    two.sink = overtaken
    outcome = two.run_once()
    assert outcome.failed_at == "CheckpointService" and not outcome.committed
    two.sink = sink
    assert not [o for o in two.drain() if o.failed_at]
    # what the slower one wrote for the first cycle is not seen
    assert values(sink.read(spark, one.ledger, SUMMED)) == list(range(60))
    assert {r.cycle_id for r in sink.writes(spark, one.ledger).collect()} == {1, 2}


# --- the sink that reports -----------------------------------------------------


def test_messages_cover_what_was_written(spark, home, log):
    log.publish(numbered(spark, 50), ["id"])
    sink = SegmentSink(f"{home}/out", partial=True)
    written = sink(log.records(), 1)
    rows = manifest(spark, written.output)
    per = {(r.topic, r.partition): r for r in rows.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("low"), F.max("until_offset").alias("high"),
        F.sum("records").alias("n"), F.sum("bytes").alias("bytes"), F.min("nanos").alias("nanos")).collect()}
    ends = {(r.topic, r.partition): r.latest for r in log.catalog().collect()}
    assert {k: (r.low, r.high, r.n) for k, r in per.items()} == {k: (0, e, e) for k, e in ends.items()}
    assert sum(r.bytes for r in per.values()) == 10 + 80 and all(r.nanos > 0 for r in per.values())
    names = {f"{r.file}" for r in rows.collect()}
    assert names == set(file_names(spark, f"{written.output}/data"))
    assert written.delta.columns == rows.columns


def test_a_failed_task_leaves_no_write(spark, home, log):
    log.publish(numbered(spark, 50), ["id"])
    bad = log.records().withColumn(
        "value", F.when(F.col("value") == "33", F.raise_error(F.lit("no"))).otherwise(F.col("value"))
    )
    sink = SegmentSink(f"{home}/out")
    with pytest.raises(Exception, match="no"):
        sink(bad, 1)
    attempt = file_names(spark, f"{home}/out/cycle_id=1")[0]
    left = f"{home}/out/cycle_id=1/{attempt}"
    assert file_names(spark, f"{left}/manifest") == []
    ledger = Ledger(spark, f"{home}/ledger", "p")
    assert sink.read(spark, ledger, SUMMED).count() == 0 and sink.writes(spark, ledger).count() == 0


def test_files_of_lost_tasks_are_not_read(spark, home, log):
    log.publish(numbered(spark, 30), ["id"])
    sink = SegmentSink(f"{home}/out")
    cycle = cycle_of(spark, log, home, sink, max_records=100)
    assert cycle.run_once().committed
    output = cycle.ledger.outputs()[1]
    log.records().write.mode("append").parquet(f"{output}/data")
    assert values(sink.read(spark, cycle.ledger, SUMMED)) == list(range(30))


def test_what_a_sink_does_not_take_is_read_again(spark, home, log):
    log.publish(numbered(spark, 30), ["id"])
    sink = SegmentSink(f"{home}/out", accepts=F.col("topic") == "a", partial=True)
    cycle = cycle_of(spark, log, home, sink, max_records=100)
    assert cycle.run_once().committed and cycle.run_once().committed
    assert {(r.topic, r.until_offset) for r in cycle.ledger.load().collect()} == {("a", 5)}
    metrics = {(r.cycle_id, r.module, r.metric): r.value for r in cycle.events.metric_table().collect()}
    assert metrics[1, "Writer", "OutRecords"] == 10 and metrics[2, "Writer", "OutRecords"] == 0
    cycle.sink = SegmentSink(f"{home}/out")
    assert cycle.run_once().committed
    assert values(sink.read(spark, cycle.ledger, SUMMED)) == list(range(30))


# --- reconciliation by digests -------------------------------------------------


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_digests_find_every_difference(spark, log, block):
    log.publish(numbered(spark, 200), ["id"])
    sent = log.records()
    assert reconcile_log(sent, sent, ["value", "key"], block).count() == 0
    lost = sent.where("NOT (topic = 'a' AND offset IN (3, 30))")
    changed = lost.withColumn("value", F.expr("IF(topic <> 'a' AND offset = 9 AND partition = 1, NULL, value)"))
    got = changed.unionByName(sent.where("topic = 'a' AND offset = 5 AND partition = 0"))
    found = {(r.topic, r.partition, r.offset, r.value, r.status, r.copies) for r in reconcile_log(sent, got, ["value", "key"], block).collect()}
    other = sent.where("topic <> 'a' AND offset = 9 AND partition = 1").first()
    want = {("a", r.partition, r.offset, r.value, "missing", 1) for r in sent.where("topic = 'a' AND offset IN (3, 30)").collect()}
    want |= {(other.topic, 1, 9, other.value, "missing", 1), (other.topic, 1, 9, None, "extra", 1)}
    five = sent.where("topic = 'a' AND offset = 5 AND partition = 0").first()
    assert found == want | {("a", 0, 5, five.value, "extra", 1)}
