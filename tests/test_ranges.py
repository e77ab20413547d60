from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from brooklog import schemas
from brooklog.plans import ranges as plans

RANGES = schemas.RANGES
CATALOG = schemas.CATALOG


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def planned(df):
    return rows(df, "topic", "partition", "from_offset", "until_offset")


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [("t", 0, 0, 50), ("t", 1, 20, 50), ("t", 2, 0, 0), ("t", 3, 5, 9)], CATALOG
    )


def test_new_partitions_start_at_the_earliest_offset(spark, catalog):
    none = spark.createDataFrame([], RANGES)
    assert planned(plans.plan_ranges(catalog, none, 10)) == [
        ("t", 0, 0, 10),
        ("t", 1, 20, 30),
        ("t", 3, 5, 9),
    ]


def test_checkpointed_partitions_go_on_and_unlisted_ones_are_not_read(spark, catalog):
    checkpoint = spark.createDataFrame(
        [("t", 0, 0, 45), ("t", 1, 0, 60), ("t", 9, 0, 5)], RANGES
    )
    # 1 lies beyond the end, 9 is no longer listed
    assert planned(plans.plan_ranges(catalog, checkpoint, 10)) == [
        ("t", 0, 45, 50),
        ("t", 3, 5, 9),
    ]


def test_cap_is_at_least_one(spark, catalog):
    none = spark.createDataFrame([], RANGES)
    assert planned(plans.plan_ranges(catalog, none, 0))[0] == ("t", 0, 0, 1)


def test_default_cap(spark):
    catalog = spark.createDataFrame([("t", 0, 0, 5000)], CATALOG)
    assert planned(plans.plan_ranges(catalog, spark.createDataFrame([], RANGES))) == [
        ("t", 0, 0, 1000)
    ]


def test_gap_is_reported_and_the_start_stays(spark, catalog):
    checkpoint = spark.createDataFrame([("t", 1, 0, 12)], RANGES)
    gaps = plans.find_gaps(catalog, checkpoint)
    assert rows(gaps, *gaps.columns) == [("t", 1, 12, 20, 8)]
    assert ("t", 1, 12, 22) in planned(plans.plan_ranges(catalog, checkpoint, 10))
    assert ("t", 1, 20, 30) in planned(
        plans.plan_ranges(catalog, checkpoint, 10, on_gap="skip")
    )
    with pytest.raises(PySparkException, match="missing messages"):
        plans.plan_ranges(catalog, checkpoint, 10, on_gap="fail").collect()
    with pytest.raises(ValueError):
        plans.plan_ranges(catalog, checkpoint, 10, on_gap="other")


def test_backfill_keeps_empty_ranges_and_has_no_cap(spark, catalog):
    previous = spark.createDataFrame([("t", 0, 0, 50)], RANGES)
    assert planned(plans.plan_backfill(catalog, previous)) == [
        ("t", 0, 50, 50),
        ("t", 1, 20, 50),
        ("t", 2, 0, 0),
        ("t", 3, 5, 9),
    ]
    assert planned(plans.plan_backfill(catalog))[0] == ("t", 0, 0, 50)


def test_planned_count_of_nothing_is_zero(spark):
    none = spark.createDataFrame([], RANGES)
    assert plans.planned_count(none).first()[0] == 0


@pytest.mark.parametrize(
    "last, now, waiting, due",
    [(0, 1_700_000_000_000, 0, True), (5000, 5999, 999, False), (5000, 6000, 0, True),
     (5000, 5001, 1000, True)],
)
def test_flush_rule(spark, last, now, waiting, due):
    assert plans.flush_due(waiting, last, now) is due
    ranges = spark.createDataFrame([("t", 0, 0, waiting)], RANGES)
    assert plans.flush_decision(ranges, last, now).first().flush is due


def test_lag(spark, catalog):
    checkpoint = spark.createDataFrame([("t", 0, 0, 45)], RANGES)
    lag = plans.partition_lag(catalog, checkpoint)
    assert rows(lag, "partition", "lag") == [(0, 5), (1, 30), (2, 0), (3, 4)]
