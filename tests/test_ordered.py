"""Operators that must hold up when one key has most of the rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from brooklog.operators.aggregates import session_windows, sliding_sums, windowed
from brooklog.operators.joins import enrich, interval_join
from brooklog.operators.ordered import number_rows, ordered_slices, running_sum


def skewed(spark, n=3000):
    """Two thirds of the rows belong to key 0, half of them at one instant."""
    return spark.range(n).selectExpr(
        "id",
        "CASE WHEN id % 3 > 0 THEN 0L ELSE id % 7 END AS k",
        "CASE WHEN id % 2 = 0 THEN 5L ELSE (id * 7919) % 1000 END AS t",
        "id % 11 - 3 AS v",
    )


def test_numbers_are_dense_per_key_and_in_order(spark):
    numbered = number_rows(skewed(spark), ["k"], ["t", "id"], "nth", partitions=16)
    assert numbered.schema["nth"].dataType.simpleString() == "bigint"
    got = numbered.toPandas()
    want = got.sort_values(["k", "t", "id"])
    assert (want.groupby("k").cumcount() == want["nth"]).all()
    assert len(got) == 3000


def test_numbers_over_everything(spark):
    got = number_rows(skewed(spark), [], ["t", "id"], "nth", partitions=8).toPandas()
    assert got.sort_values(["t", "id"])["nth"].tolist() == list(range(3000))


def test_a_hot_key_is_spread_over_tasks(spark):
    slices = ordered_slices(skewed(spark, 20000), ["k"], ["t", "id"], partitions=16)
    per_slice = slices.groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert slices.where("k = 0").select("_slice").distinct().count() >= 8
    assert per_slice < 20000 / 8


def test_running_sum(spark):
    rows = skewed(spark)
    got = running_sum(rows, ["k"], ["t", "id"], "v", "so_far", partitions=16).toPandas()
    want = got.sort_values(["k", "t", "id"])
    assert (want.groupby("k")["v"].cumsum() == want["so_far"]).all()


START = datetime(2024, 1, 1)


def timed(spark, minutes):
    rows = [(k, START + timedelta(minutes=m)) for k, m in minutes]
    return spark.createDataFrame(rows, "k BIGINT, ts TIMESTAMP_NTZ")


def brute_sessions(rows, gap):
    sessions = []
    for k, m in sorted(rows):
        if sessions and sessions[-1][0] == k and m - sessions[-1][2] <= gap:
            sessions[-1][2] = m
            sessions[-1][3] += 1
        else:
            sessions.append([k, m, m, 1])
    return [(k, a, b + gap, n) for k, a, b, n in sessions]


def test_sessions_against_brute_force(spark):
    rows = [(i % 3 if i % 5 == 0 else 0, (i * i * 37) % 9000) for i in range(400)]
    rows += [(9, 0), (9, 60), (9, 121), (9, 180), (9, 241)]  # exactly one gap apart, or more
    got = session_windows(timed(spark, rows), "ts", "60 minutes", {"n": F.lit(1)}, ["k"])
    found = sorted(
        (r.k, *(int((t - START).total_seconds() // 60) for t in (r.session_start, r.session_end)), r.n)
        for r in got.collect()
    )
    assert found == sorted(brute_sessions(rows, 60))
    assert sum(r[3] for r in found) == len(rows)


def test_sessions_match_the_built_in_window(spark):
    rows = [(i % 4, (i * 7919) % 20000) for i in range(500)]
    df = timed(spark, rows)
    ours = session_windows(df, "ts", "30 minutes", {"n": F.lit(1)}, ["k"])
    theirs = df.groupBy("k", F.session_window("ts", "30 minutes").alias("w")).count()
    theirs = theirs.select("k", "w.start", "w.end", "count")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_sliding_sums_match_the_built_in_window(spark):
    df = timed(spark, [(i % 3, (i * 61) % 4000) for i in range(300)])
    panes = sliding_sums(df, "ts", "4 hours", "1 hour", {"n": F.lit(1)}, ["k"])
    direct = windowed(df, "ts", "4 hours", [F.sum(F.lit(1)).alias("n")], ["k"], "1 hour")
    assert sorted(map(tuple, panes.collect())) == sorted(map(tuple, direct.collect()))


def test_panes_must_fill_the_window(spark):
    with pytest.raises(ValueError, match="multiple"):
        sliding_sums(timed(spark, [(1, 1)]), "ts", "3 hours", "2 hours", {"n": F.lit(1)}, ["k"])


def test_interval_join_against_brute_force(spark):
    left = [(i % 3 if i % 4 == 0 else 0, (i * 53) % 3000) for i in range(120)] + [(7, 60)]
    right = [(i % 3 if i % 4 == 0 else 0, (i * 97) % 3000) for i in range(120)] + [(7, 60), (7, 120)]
    a = timed(spark, left).withColumnRenamed("ts", "a_ts")
    b = timed(spark, right).withColumnRenamed("ts", "b_ts")
    got = interval_join(a, b, ["k"], "a_ts", "b_ts", "60 minutes")
    assert got.columns == ["k", "a_ts", "b_ts"]
    found = sorted(
        (r.k, (r.a_ts - START).total_seconds() // 60, (r.b_ts - START).total_seconds() // 60)
        for r in got.collect()
    )
    want = sorted((k, m, n) for k, m in left for j, n in right if k == j and m <= n <= m + 60)
    assert found == want
    assert (7, 60, 60) in found and (7, 60, 120) in found


def test_enrich_keeps_unmatched_rows(spark):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "user INT, e STRING")
    users = spark.createDataFrame([(1, "ann")], "id INT, name STRING")
    left = enrich(events, users, {"user": "id"})
    assert left.columns == ["user", "e", "name"]
    assert sorted((r.e, r.name) for r in left.collect()) == [("a", "ann"), ("b", None), ("c", None)]
    assert enrich(events, users, {"user": "id"}, "inner").count() == 1


def test_pandas_agrees_on_running_sum_with_gaps(spark):
    df = spark.createDataFrame(
        pd.DataFrame({"k": [1, 1, 2, 2, 2], "t": [3, 1, 9, 8, 7], "v": [10, 1, 5, 6, 7]})
    )
    summed = running_sum(df, ["k"], ["t"], "v", "s")
    got = {(r.k, r.t): r.s for r in summed.collect()}
    assert got == {(1, 1): 1, (1, 3): 11, (2, 7): 7, (2, 8): 13, (2, 9): 18}


def test_rows_without_a_key_are_kept(spark):
    df = spark.createDataFrame(
        [(None, 1, 5), (None, 2, None), (1, 1, None), (1, 2, 3)], "k INT, t INT, v BIGINT"
    )
    sums = {(r.k, r.t): r.s for r in running_sum(df, ["k"], ["t"], "v", "s", 4).collect()}
    assert sums == {(None, 1): 5, (None, 2): 5, (1, 1): None, (1, 2): 3}
    numbers = {(r.k, r.t): r.n for r in number_rows(df, ["k"], ["t"], "n", 4).collect()}
    assert numbers == {(None, 1): 0, (None, 2): 1, (1, 1): 0, (1, 2): 1}
