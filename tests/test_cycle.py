from __future__ import annotations

import pytest

from brooklog import schemas
from brooklog.cycle import LogCycle
from brooklog.observe import partition_summary
from brooklog.operators.records import tag_time_partition
from brooklog.functions.time_partition import json_time
from brooklog.plans.checkpoint import Ledger, delta_of
from brooklog.sinks.files import BatchFolders
from brooklog.sources.log_table import LogTable
from brooklog.sources.text import replay, step_of

OUT = "topic STRING, partition INT, offset BIGINT, value STRING"


class ListedLog:
    """A log held in one frame; records can be added and trimmed."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = []
        self.trimmed = 0

    def add(self, *rows):
        self.rows += rows

    def records(self):
        kept = [(t, p, o, None, None, v) for t, p, o, v in self.rows if o >= self.trimmed]
        return self.spark.createDataFrame(kept, schemas.LOG)

    def catalog(self):
        ends = {}
        for t, p, o, _ in self.rows:
            ends[t, p] = max(ends.get((t, p), 0), o + 1)
        return self.spark.createDataFrame(
            [(t, p, min(self.trimmed, end), end) for (t, p), end in ends.items()],
            schemas.CATALOG,
        )

    def scan(self, ranges):
        from brooklog.sources.log_table import scan_ranges

        return scan_ranges(self.records(), ranges, written=True)


@pytest.fixture
def log(spark):
    listed = ListedLog(spark)
    listed.add(*[("t", p, o, f"{p}-{o}") for p in range(2) for o in range(5)])
    return listed


def cycle_of(spark, log, home, **options):
    options = {"flush_interval_ms": 0, "max_records": 3, **options}
    sink = options.pop("sink", None) or BatchFolders(f"{home}/out")
    return LogCycle(spark, "p", log, sink, home, **options)


def collected(spark, home):
    return sorted(r.value for r in BatchFolders(f"{home}/out").read(spark, OUT).collect())


def ledger(cycle):
    return sorted(tuple(r) for r in cycle.ledger.load().collect())


def test_increments_of_6_4_4_with_a_cap_of_one(spark, home):
    lines = spark.createDataFrame([(n, f"m{n:02d}") for n in range(14)], "n INT, value STRING")
    fed = replay(lines, ["n"], step_of([6, 4]), 5, topic="testTopic")
    rows = fed.select("step", "topic", "partition", "offset", "value").collect()
    log = ListedLog(spark)
    cycle = cycle_of(spark, log, home, max_records=1)
    sizes = []
    for step, size in enumerate((6, 4, 4)):
        sent = [tuple(r)[1:] for r in rows if r.step == step]
        assert len(sent) == size
        log.add(*sent)
        sizes.append(cycle.run_once().planned)
    assert sizes == [5, 5, 4]
    assert collected(spark, home) == [f"m{n:02d}" for n in range(14)]


def test_cap_new_partitions_and_draining(spark, log, home):
    cycle = cycle_of(spark, log, home)
    assert [o.planned for o in cycle.drain()] == [6, 4, 0]
    log.add(("u", 7, 0, "new"))
    assert [o.planned for o in cycle.drain()] == [1, 0]
    assert len(collected(spark, home)) == 11
    assert ledger(cycle) == [("t", 0, 0, 5), ("t", 1, 0, 5), ("u", 7, 0, 1)]


def test_internal_topics_are_not_read(spark, log, home):
    log.add(("__consumer_offsets", 0, 0, "x"))
    cycle = cycle_of(spark, log, home)
    cycle.drain()
    assert len(collected(spark, home)) == 10


def statuses(cycle):
    return [
        (r.module, r.status)
        for r in cycle.events.status_table().where("module <> 'Core'").orderBy("at").collect()
    ]


def test_waits_until_time_or_records_suffice(spark, log, home):
    cycle = cycle_of(
        spark, log, home, flush_interval_ms=10**9, max_records=1, min_total_records=3
    )
    # the first cycle flushes, as nothing was flushed before
    assert cycle.run_once().committed
    second = cycle.run_once()
    assert (second.flushed, second.planned, second.committed) == (False, 2, False)
    assert ledger(cycle) == [("t", 0, 0, 1), ("t", 1, 0, 1)]
    cycle.max_records = 2
    assert cycle.run_once().committed


def test_a_failing_transform_writes_nothing(spark, log, home):
    def broken(df):
        raise RuntimeError("no transform")

    cycle = cycle_of(spark, log, home, transform=broken)
    assert cycle.run_once().failed_at == "Transformer"
    assert cycle.last_flush_ms > 0
    assert ledger(cycle) == []
    error = cycle.events.status_table().where("status = 'ERROR'").first()
    assert error.module == "Transformer"
    assert "no transform" in error.message and "Traceback" in error.message


@pytest.mark.parametrize("after_write", [False, True])
def test_a_failing_write_is_repeated_without_duplicates(spark, log, home, after_write):
    folders = BatchFolders(f"{home}/out")
    fail = [True]

    def sink(df, cycle_id):
        if after_write or not fail[0]:
            folders(df, cycle_id)
        if fail[0]:
            fail[0] = False
            raise OSError("sink is down")

    cycle = cycle_of(spark, log, home, sink=sink)
    assert cycle.run_once().failed_at == "Writer"
    assert ledger(cycle) == []
    log.add(("t", 0, 5, "0-5"))
    cycle.drain()
    assert len(collected(spark, home)) == 11
    assert len(set(collected(spark, home))) == 11


def test_a_failing_commit_is_repeated_without_duplicates(spark, log, home, monkeypatch):
    cycle = cycle_of(spark, log, home)
    with monkeypatch.context() as patch:
        patch.setattr(cycle.ledger, "commit", lambda *a: (_ for _ in ()).throw(OSError("full")))
        assert cycle.run_once().failed_at == "CheckpointService"
    assert len(collected(spark, home)) == 6
    cycle.drain()
    assert len(collected(spark, home)) == 10


def test_a_broken_source_is_reported(spark, log, home, monkeypatch):
    cycle = cycle_of(spark, log, home)
    monkeypatch.setattr(log, "catalog", lambda: 1 / 0)
    assert cycle.run_once().failed_at == "Reader"
    assert ("Reader", "ERROR") in statuses(cycle)
    assert len(cycle.drain(attempts=2)) == 2


def test_partial_write_commits_what_was_written(spark, log, home):
    folders = BatchFolders(f"{home}/out")

    def sink(df, cycle_id):
        kept = df.where("partition = 1 AND offset < 2")
        folders(kept, cycle_id)
        return delta_of(kept)

    cycle = cycle_of(spark, log, home, sink=sink)
    assert cycle.run_once().committed
    assert ledger(cycle) == [("t", 1, 0, 2)]


def test_unconnected_partial_write_is_refused(spark, log, home):
    def sink(df, cycle_id):
        df.write.format("noop").mode("overwrite").save()
        return delta_of(df.where("offset > 0"))

    cycle = cycle_of(spark, log, home, sink=sink)
    cycle.ledger.commit(1, spark.createDataFrame([("t", 0, 0, 0), ("t", 1, 0, 0)], schemas.RANGES))
    assert cycle.run_once().failed_at == "CheckpointService"
    assert cycle.ledger.last_cycle() == 1


@pytest.mark.parametrize("on_gap, first_cycle", [("report", 1), ("skip", 4)])
def test_gaps_are_reported_and_reading_goes_on(spark, log, home, on_gap, first_cycle):
    cycle = cycle_of(spark, log, home, on_gap=on_gap)
    cycle.ledger.commit(1, spark.createDataFrame([("t", 0, 0, 1), ("t", 1, 0, 1)], schemas.RANGES))
    log.trimmed = 3
    outcome = cycle.run_once()
    assert outcome.committed
    errors = cycle.events.status_table().where("status = 'ERROR'").collect()
    assert sorted(e.message for e in errors) == [
        "records lost in t/0: offsets 1 to 2",
        "records lost in t/1: offsets 1 to 2",
    ]
    # offsets 1 to 3 planned, of which only 3 exists; or 3 and 4 when skipping
    found = collected(spark, home)
    assert len(found) == (2 if on_gap == "report" else 4)
    cycle.drain()
    assert collected(spark, home) == ["0-3", "0-4", "1-3", "1-4"]
    assert ledger(cycle) == [("t", 0, 0, 5), ("t", 1, 0, 5)]


def test_gap_may_fail_the_cycle(spark, log, home):
    cycle = cycle_of(spark, log, home, on_gap="fail")
    cycle.ledger.commit(1, spark.createDataFrame([("t", 0, 0, 1)], schemas.RANGES))
    log.trimmed = 3
    assert cycle.run_once().failed_at == "Reader"


def test_metrics_and_status_rows(spark, log, home):
    log.add(("t", 0, 5, None))
    cycle = cycle_of(
        spark,
        log,
        home,
        max_records=100,
        transform=lambda df: tag_time_partition(df, json_time("$.ts")).where("offset > 0"),
    )
    cycle.run_once()
    found = {
        (r.cycle_id, r.module, r.metric): r.value
        for r in cycle.events.metric_table().collect()
    }
    assert found.pop((1, "Writer", "WriteMillis")) > 0
    assert found == {
        (1, "Reader", "InRecords"): 11,
        (1, "Reader", "InBytes"): 30,
        (1, "Transformer", "InRecords"): 11,
        (1, "Transformer", "OutRecords"): 9,
        (1, "Writer", "InRecords"): 9,
        (1, "Writer", "OutRecords"): 9,
        (1, "Writer", "InBytes"): 24,
        (1, "Writer", "OutBytes"): 24,
    }
    assert statuses(cycle) == [
        ("CheckpointService", "OK"),
        ("Reader", "OK"),
        ("Writer", "OK"),
        ("CheckpointService", "OK"),
    ]


def test_a_sink_without_an_action_ends_the_cycle(spark, log, home):
    cycle = cycle_of(spark, log, home)
    cycle.sink = lambda records, cycle_id: None
    outcome = cycle.run_once()
    assert outcome.flushed and outcome.failed_at is None
    messages = [r.message for r in cycle.events.status_table().collect()]
    assert "the sink did not read its records" in messages


def test_an_empty_commit_is_not_stored(spark, home):
    ledger = Ledger(spark, f"{home}/ledger", "p")
    ledger.commit(1, spark.createDataFrame([], schemas.RANGES))
    assert ledger.last_cycle() == 0
    ledger.commit(2, spark.createDataFrame([("t", 0, 0, 5)], schemas.RANGES))
    assert ledger.load(7).first().until_offset == 5 and ledger.load(1).count() == 0


def test_log_table_appends_behind_its_end(spark, home):
    log = LogTable(spark, f"{home}/log")
    assert log.catalog().count() == 0 and log.records().count() == 0
    records = spark.range(100).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS topic", "CAST(id % 2 AS INT) AS partition",
        "CAST(NULL AS TIMESTAMP_NTZ) AS timestamp", "CAST(NULL AS STRING) AS key",
        "CAST(id AS STRING) AS value", "id",
    )
    log.publish(records.where("id < 60"), ["id"])
    # a publish that failed before its catalog was written leaves files that do not count
    left = records.selectExpr("topic", "partition", "id AS offset", "timestamp", "key", "value")
    left.write.partitionBy("topic", "partition").parquet(f"{log.records_path}/batch=2")
    assert log.records().count() == 60
    log.publish(records.where("id >= 60"), ["id"])
    summary = {(r.topic, r.partition): r for r in partition_summary(log.records()).collect()}
    assert sum(r.records for r in summary.values()) == 100
    for r in summary.values():
        assert (r.first_offset, r.last_offset) == (0, r.records - 1)
    in_order = log.records().where("topic = 'b' AND partition = 1").orderBy("offset")
    ids = [int(r.value) for r in in_order.collect()]
    assert ids == sorted(ids)
    ends = {(r.topic, r.partition): r.latest for r in log.catalog().collect()}
    assert ends == {k: r.records for k, r in summary.items()}


def test_a_scan_lists_only_the_batches_it_needs(spark, home):
    log = LogTable(spark, f"{home}/log")
    records = spark.range(90).selectExpr(
        "'t' AS topic", "CAST(id % 2 AS INT) AS partition", "CAST(NULL AS TIMESTAMP_NTZ) AS timestamp",
        "CAST(NULL AS STRING) AS key", "CAST(id AS STRING) AS value", "id",
    )
    for low in (0, 30, 60):
        log.publish(records.where(f"id >= {low} AND id < {low + 30}"), ["id"])
    ranges = spark.createDataFrame([("t", 0, 16, 20), ("t", 1, 29, 30)], schemas.RANGES)
    found = log.scan(ranges)
    assert sorted(int(r.value) for r in found.collect()) == [32, 34, 36, 38, 59]
    read = [path for path in found.inputFiles() if "/records/" in path]
    assert read and all("/batch=2/" in path for path in read)
    across = spark.createDataFrame([("t", 0, 14, 31), ("x", 0, 0, 9)], schemas.RANGES)
    assert log.scan(across).count() == 17
    assert log.scan(across.where("topic = 'x'")).count() == 0


def test_scan_of_no_ranges(spark, log):
    from brooklog.sources.log_table import scan_ranges

    none = spark.createDataFrame([], schemas.RANGES)
    assert scan_ranges(log.records(), none).count() == 0
    some = spark.createDataFrame([("t", 0, 1, 3), ("t", 1, 4, 4)], schemas.RANGES)
    assert sorted(r.value for r in scan_ranges(log.records(), some).collect()) == ["0-1", "0-2"]
