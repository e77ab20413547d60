from __future__ import annotations

import json
import re
from pathlib import Path

import pytest

from brooklog import schemas
from brooklog.operators.reconcile import reconcile
from brooklog.scratch import (
    drop_path,
    fresh_path,
    has_data,
    numbered_folders,
    scratch_root,
    write_out,
)
from brooklog.sinks import files
from brooklog.sources import kafka
from brooklog.sources.log_table import select_topics
from brooklog.sources.text import read_lines, replay, step_of


@pytest.fixture
def log(spark):
    rows = [("t", p, o, None, None, f"{p}:{o:03d}") for p in (0, 1) for o in range(200)]
    return spark.createDataFrame(rows, schemas.LOG).repartition(6)


def lines_of(folder):
    """Text of the part files in name order."""
    return [
        line
        for part in sorted(Path(folder).glob("part-*"))
        for line in part.read_text().splitlines()
    ]


def test_one_folder_per_topic_partition_in_offset_order(spark, log, home):
    files.write_by_partition(log, f"{home}/out", in_order=True)
    for p in (0, 1):
        want = [f"{p}:{o:03d}" for o in range(200)]
        assert lines_of(f"{home}/out/topic=t/partition={p}") == want


def test_without_order_the_lines_are_the_same(spark, log, home):
    files.write_by_partition(log, f"{home}/out")
    assert len(lines_of(f"{home}/out/topic=t/partition=0")) == 200


def test_ordered_text_is_one_text(spark, log, home):
    files.write_ordered_text(log, f"{home}/out", ["partition", "offset"])
    assert lines_of(f"{home}/out") == [f"{p}:{o:03d}" for p in (0, 1) for o in range(200)]
    assert read_lines(spark, f"{home}/out").count() == 400


@pytest.mark.parametrize("fmt", ["parquet", "json", "text"])
def test_time_partitions(spark, home, fmt):
    rows = [("t", 0, 0, "2024/01/01", "a"), ("t", 0, 1, None, "b")]
    files.write_time_partitioned(spark.createDataFrame(rows, schemas.TAGGED), f"{home}/out", fmt)
    back = spark.read.format(fmt).load(f"{home}/out")
    name = "value" if fmt == "text" else "message"
    found = sorted((r.topic, r.time_partition, r[name]) for r in back.collect())
    assert found == [("t", "2024/01/01", "a"), ("t", "__none__", "b")]


def test_rebalanced_write_keeps_all_rows(spark, log, home):
    files.write_by_partition(files.rebalance(log, ["topic", "partition"]), f"{home}/out")
    assert spark.read.text(f"{home}/out").count() == 400


def test_append_collects_cycles(spark, home):
    for text in ("a", "b", "a"):
        files.append_values(spark.createDataFrame([(text,)], "value STRING"), f"{home}/out")
    assert sorted(r.value for r in spark.read.parquet(f"{home}/out").collect()) == ["a", "a", "b"]


def test_repeated_cycle_replaces_its_folder(spark, log, home):
    sink = files.BatchFolders(f"{home}/out", ["topic"])
    sink(log, 1)
    sink(log.where("offset < 10"), 2)
    sink(log, 1)
    assert sink.read(spark, schemas.LOG).count() == 420


def test_regrouped_cycles_have_fewer_files(spark, log, home):
    counts = {}
    for regroup in (False, True):
        sink = files.BatchFolders(f"{home}/{regroup}", ["partition"], regroup=regroup)
        sink(log, 1)
        assert reconcile(log, sink.read(spark, schemas.LOG).drop("cycle_id")).count() == 0
        counts[regroup] = len(list(Path(home, str(regroup)).rglob("*.parquet")))
    assert counts == {False: 12, True: 2}


def test_numbered_folders(spark, home):
    for name in ("n=2", "n=10", "n=x", "m=11", "n=3"):
        Path(home, name).mkdir()
    Path(home, "n=10", "part-0").touch()
    assert numbered_folders(spark, home, "n=") == [10, 3, 2]
    assert numbered_folders(spark, f"{home}/none", "n=") == []
    assert has_data(spark, f"{home}/n=10") and not has_data(spark, f"{home}/n=3")


def test_replay_lays_messages_round_robin(spark):
    lines = spark.createDataFrame([(n,) for n in range(14)], "n INT")
    fed = replay(lines, ["n"], step_of([6, 4]), 5, topic="t").orderBy("n").collect()
    assert [r.step for r in fed] == [0] * 6 + [1] * 4 + [2] * 4
    assert [(r.partition, r.offset) for r in fed] == [(n % 5, n // 5) for n in range(14)]
    assert step_of([]) is not None


def test_topic_choice(spark):
    topics = spark.createDataFrame(
        [("__consumer_offsets",), ("x__consumer_offsets_y",), ("orders",), ("clicks",)],
        "topic STRING",
    )

    def chosen(**how):
        return sorted(r.topic for r in select_topics(topics, **how).collect())

    assert chosen() == ["clicks", "orders"]
    assert chosen(include=["orders", "__consumer_offsets"]) == ["orders"]
    assert chosen(pattern="^c") == ["clicks"]
    assert chosen(predicate=lambda t: t.endswith("rs")) == ["orders"]
    assert len(chosen(exclude_containing=())) == 4


def test_kafka_options():
    options = kafka.range_options([("b", 1, 5, 9), ("a", 0, 0, 2), ("b", 0, 7, 8)])
    assert json.loads(options["assign"]) == {"a": [0], "b": [0, 1]}
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 0}, "b": {"0": 7, "1": 5}}
    assert json.loads(options["endingOffsets"]) == {"a": {"0": 2}, "b": {"0": 8, "1": 9}}
    assert kafka.topic_options(["a", "b"]) == {"subscribe": "a,b"}
    assert kafka.topic_options(pattern="a.*") == {"subscribePattern": "a.*"}
    default = kafka.topic_options()["subscribePattern"]
    assert [t for t in ("orders", "__consumer_offsets", "x__consumer_offsets") if
            re.fullmatch(default, t)] == ["orders"]
    assert kafka.flush_options(500, 10) == {
        "minOffsetsPerTrigger": "10",
        "maxTriggerDelay": "500ms",
    }


def test_kafka_scan_of_no_ranges(spark):
    listed = spark.createDataFrame([], schemas.CATALOG)
    log = kafka.KafkaLog(spark, "nowhere:9092", lambda: listed)
    assert log.catalog().count() == 0
    assert log.scan(spark.createDataFrame([], schemas.RANGES)).count() == 0


def test_kafka_columns_become_log_columns(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"v"), "t", 3, 9, None)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP",
    )
    log = kafka.as_log(raw)
    assert [f.dataType.simpleString() for f in log.schema] == [
        "string", "int", "bigint", "timestamp_ntz", "string", "string",
    ]
    assert tuple(log.first()) == ("t", 3, 9, None, "k", "v")


def test_working_tables(spark):
    kept = write_out(spark.range(5), "numbers")
    path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert path.startswith(scratch_root(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    drop_path(spark, path)
    assert not Path(path).exists()
    with pytest.raises(ValueError):
        drop_path(spark, "/elsewhere")
