from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from brooklog import schemas
from brooklog.cycle import resume_from
from brooklog.plans import checkpoint as cp


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.RANGES)


def rows(df):
    return sorted(
        tuple(r) for r in df.select("topic", "partition", "from_offset", "until_offset").collect()
    )


OLD = [("t", 0, 0, 100)]


@pytest.mark.parametrize(
    "delta, expected",
    [
        ([("t", 0, 100, 150)], [("t", 0, 0, 150)]),
        ([("t", 1, 7, 9)], [("t", 0, 0, 100), ("t", 1, 7, 9)]),
        ([], [("t", 0, 0, 100)]),
        ([("t", 0, 120, 150), ("t", 0, 100, 120)], [("t", 0, 0, 150)]),
    ],
)
def test_merge(spark, delta, expected):
    assert rows(cp.merge_checkpoint(frame(spark, OLD), frame(spark, delta))) == expected
    assert cp.disconnected(frame(spark, OLD), frame(spark, delta)).count() == 0


@pytest.mark.parametrize(
    "delta",
    [
        [("t", 0, 120, 150)],
        [("t", 0, 90, 150)],
        [("t", 0, 100, 120), ("t", 0, 121, 150)],
        [("t", 1, 0, 5), ("t", 1, 4, 8)],
    ],
)
def test_unconnected_delta_is_refused(spark, delta):
    with pytest.raises(PySparkException, match="gap or overlap"):
        cp.merge_checkpoint(frame(spark, OLD), frame(spark, delta)).collect()
    assert cp.disconnected(frame(spark, OLD), frame(spark, delta)).count() == 1


def test_unconnected_delta_is_not_committed(spark, home):
    ledger = cp.Ledger(spark, home, "p")
    ledger.commit(1, frame(spark, OLD))
    with pytest.raises(PySparkException, match="gap or overlap"):
        ledger.commit(2, cp.merge_checkpoint(ledger.load(), frame(spark, [("t", 0, 90, 150)])))
    assert ledger.last_cycle() == 1
    assert rows(ledger.load()) == OLD


@given(sizes=st.lists(st.integers(0, 50), min_size=1, max_size=4), begin=st.integers(0, 9))
@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_chained_deltas_merge_alike_one_by_one_and_at_once(spark, sizes, begin):
    old = [("t", 0, begin, begin + 10), ("u", 3, 1, 2)]
    deltas, end = [], begin + 10
    for size in sizes:
        deltas.append(("t", 0, end, end + size))
        end += size
    step = frame(spark, old)
    for delta in deltas:
        step = cp.merge_checkpoint(step, frame(spark, [delta]))
    assert rows(step) == [("t", 0, begin, end), ("u", 3, 1, 2)]
    assert rows(cp.merge_checkpoint(frame(spark, old), frame(spark, deltas))) == rows(step)
    loose = [*deltas, ("t", 0, end + 1, end + 2)]
    with pytest.raises(PySparkException, match="gap or overlap"):
        cp.merge_checkpoint(frame(spark, old), frame(spark, loose)).collect()


@pytest.mark.parametrize("until", [1234567890, 1357924680])
def test_round_trip(spark, home, until):
    stored = [("testTopic", p, 0, until) for p in range(5)]
    cp.Ledger(spark, home, "p").commit(1, frame(spark, stored))
    assert rows(cp.Ledger(spark, home, "p").load()) == stored
    assert cp.Ledger(spark, home, "other").last_cycle() == 0


def test_offsets_committed_elsewhere_are_resumed(spark, home):
    offsets = spark.createDataFrame(
        [("testTopic", p, 456) for p in range(5)],
        "topic STRING, partition INT, until_offset BIGINT",
    )
    resume_from(cp.Ledger(spark.newSession(), home, "p"), offsets)
    loaded = cp.next_offsets(cp.Ledger(spark, home, "p").rows())
    assert {r.next_offset for r in loaded.collect()} == {456}
    assert loaded.count() == 5


def test_unread_ledger_is_an_empty_checkpoint(spark, home):
    ledger = cp.Ledger(spark, f"{home}/nothing", "p")
    assert ledger.last_cycle() == 0
    assert ledger.load().count() == 0


def test_topic_and_partition_do_not_run_together(spark, home):
    stored = [("t", 12, 0, 5), ("t1", 2, 0, 6)]
    cp.Ledger(spark, home, "p").commit(1, frame(spark, stored))
    assert rows(cp.Ledger(spark, home, "p").load()) == stored


def test_checkpoint_of_one_topic(spark):
    stored = frame(spark, [("t", 0, 0, 5), ("t", 1, 0, 6), ("t", 2, 0, 7), ("u", 0, 0, 8)])
    assert rows(cp.of_topic(stored, "t", 2)) == [("t", 0, 0, 5), ("t", 1, 0, 6)]


def test_old_cycles_can_be_forgotten(spark, home):
    ledger = cp.Ledger(spark, home, "p")
    for cycle in (1, 2, 3):
        ledger.commit(cycle, frame(spark, [("t", 0, 0, cycle)]))
    ledger.expire(keep=2)
    assert {r.cycle_id for r in ledger.rows().collect()} == {2, 3}
    assert rows(ledger.load()) == [("t", 0, 0, 3)]
    ledger.expire(keep=0)
    assert rows(ledger.load()) == [("t", 0, 0, 3)]
