from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brooklog import schemas
from brooklog.functions.time_partition import json_time, python_time
from brooklog.operators import records as ops
from brooklog.operators.aggregates import batch_size
from brooklog.operators.reconcile import reconcile


@pytest.mark.parametrize(
    "line, expected",
    [
        ('{"loanRate":3.25,"x":1}', '{"loanRate":"3.25","x":1}'),
        ('{"loanRate":3.25}', '{"loanRate":3.25}'),
        ('{"loanRate": 3.25,"a":1}', '{"loanRate": 3.25,"a":1}'),
        ('{"loanRate":-1,"a":1}', '{"loanRate":-1,"a":1}'),
        ('{"loanRate":1e5,"a":1}', '{"loanRate":1e5,"a":1}'),
        ('{"loanRate":1,"loanRate":2,}', '{"loanRate":"1","loanRate":"2",}'),
        ("no such field", "no such field"),
        (None, None),
    ],
)
def test_field_rewrite(spark, line, expected):
    lines = spark.createDataFrame([(line,)], "value STRING")
    assert ops.rewrite_number_as_string(lines, "loanRate").first().value == expected


def log(spark, values):
    return spark.createDataFrame(
        [("t", 0, n, None, None, v) for n, v in enumerate(values)], schemas.LOG
    )


def labels(tagged):
    return [r.time_partition for r in tagged.orderBy("offset").collect()]


def test_time_partition_of_messages(spark):
    messages = ['{"ts":"2024-01-31 23:59:59"}', '{"ts":"soon"}', "{}", "not json", None]
    tagged = ops.tag_time_partition(log(spark, messages), json_time("$.ts"))
    assert labels(tagged) == ["2024/01/31"] + ["__none__"] * 4
    assert tagged.columns == ["topic", "partition", "offset", "time_partition", "message"]


def test_python_parser_sees_each_message(spark):
    tagged = ops.tag_time_partition(
        log(spark, ["ab", "c", None]), python_time(lambda m: m.upper() if m else None)
    )
    assert labels(tagged) == ["AB", "C", "__none__"]


def test_every_record_takes_the_first_branch_that_fits(spark):
    numbers = spark.range(10)
    parts = ops.split(numbers, {"low": F.col("id") < 5, "even": F.col("id") % 2 == 0})
    found = {name: sorted(r.id for r in df.collect()) for name, df in parts.items()}
    assert found == {"low": [0, 1, 2, 3, 4], "even": [6, 8], "rest": [5, 7, 9]}
    assert ops.route(numbers, {}).select("route").distinct().collect()[0].route == "rest"


def test_merge_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, left STRING")
    b = spark.createDataFrame([(2, "y")], "id INT, right STRING")
    merged = ops.merge({"a": a, "b": b}).select("id", "left", "right", "source")
    assert sorted(map(tuple, merged.collect())) == [(1, "x", None, "a"), (2, None, "y", "b")]
    with pytest.raises(ValueError):
        ops.merge({})


def test_words(spark):
    lines = spark.createDataFrame([("a  b a ",), ("b\na",), ("",), (None,)], "value STRING")
    counted = {r.word: r.n for r in ops.word_counts(lines).collect()}
    assert counted == {"a": 3, "b": 2}


def test_sizes_count_characters_and_bytes(spark):
    lines = spark.createDataFrame([("aé",), ("€",), (None,)], "value STRING")
    assert tuple(batch_size(lines, "value").first()) == (3, 3, 6)
    assert tuple(batch_size(lines.limit(0), "value").first()) == (0, 0, 0)


def test_index_lookup(spark):
    index_map = spark.createDataFrame(
        [(0, "t", 4), (1, "u", 2)], "idx INT, topic STRING, partition INT"
    )
    records = spark.createDataFrame([(1, "m"), (0, "n")], "idx INT, value STRING")
    found = ops.with_topic_partition(records, index_map)
    assert sorted(map(tuple, found.collect())) == [("m", "u", 2), ("n", "t", 4)]


def test_reconcile_counts_copies_and_nulls(spark):
    sent = spark.createDataFrame([("a",), ("a",), ("a",), (None,), ("c",)], "value STRING")
    got = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "value STRING")
    found = sorted(map(tuple, reconcile(sent, got).collect()))
    assert found == [("a", "missing", 2), ("b", "extra", 2)]
    assert reconcile(sent, sent).count() == 0


def test_map_records(spark):
    out = ops.map_records(spark.range(100), lambda p: p.assign(twice=p.id * 2), "id LONG, twice LONG")
    assert out.where("twice <> id * 2").count() == 0
    assert out.count() == 100
