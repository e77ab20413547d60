"""Queries over single records: project, tag, rewrite, filter, route, sinks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from brooklog.functions.time_partition import column_time, json_time, series_time
from brooklog.operators import records as ops
from brooklog.operators.aggregates import batch_size as size_of
from brooklog.operators.reconcile import reconcile as compare
from brooklog.operators.reconcile import reconcile_log
from brooklog.scratch import fresh_path
from brooklog.sinks import files
from brooklog.sources.text import read_lines
from brooklog.workloads.tables import LOG_SQL, log_records, table


def value_projection(spark, sf_dir):
    return ops.values_of(log_records(spark, sf_dir))


def tag_time_partition(spark, sf_dir):
    return ops.tag_time_partition(log_records(spark, sf_dir), column_time("timestamp"))


def tag_from_message(spark, sf_dir):
    log = log_records(spark, sf_dir).withColumn(
        "value", F.to_json(F.struct(F.col("key").alias("id"), F.col("timestamp").alias("at")))
    )
    return ops.tag_time_partition(log, json_time("$.at")).drop("message")


def tag_python_parser(spark, sf_dir):
    def tens(messages):
        digits = messages.fillna("").str.replace(r"\D", "", regex=True)
        known = pd.to_numeric(digits.where(digits != ""), errors="coerce").astype("Int64") // 10
        return known.astype("string").str.zfill(2).astype(object).where(known.notna(), None)

    return ops.tag_time_partition(log_records(spark, sf_dir), series_time(tens))


def field_rewrite(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return ops.rewrite_number_as_string(events, "k", blank=" ", closers=",}")


def contains_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return ops.keep_containing(events, '"k": 7')


def predicate_filter(spark, sf_dir):
    return ops.keep(
        table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"),
        (F.col("event_type") == "purchase") & (F.col("value") >= 50),
    )


def map_records(spark, sf_dir):
    def doubled(events: pd.DataFrame) -> pd.DataFrame:
        k = events["props"].str.extract(r"(\d+)", expand=False).astype("int64")
        return pd.DataFrame({"event_id": events["event_id"], "doubled": k * 2})

    events = table(spark, sf_dir, "events").select("event_id", "props")
    return ops.map_records(events, doubled, "event_id BIGINT, doubled BIGINT")


BRANCHES = {
    "sales": "event_type = 'purchase'",
    "alerts": "event_type = 'error' AND value >= 100",
}


def _branches():
    return {name: F.expr(text) for name, text in BRANCHES.items()}


def route_split(spark, sf_dir):
    """Written once, split by folder, read back."""
    path = fresh_path(spark, "routes")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    ops.route(events, _branches()).write.partitionBy("route").parquet(path)
    return spark.read.parquet(path).select("event_id", "event_type", "route")


def merge_streams(spark, sf_dir):
    web = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("customer"), "event_type"
    )
    shop = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), "o_orderstatus"
    )
    return ops.merge({"web": web, "shop": shop})


def batch_size(spark, sf_dir):
    return size_of(log_records(spark, sf_dir), "value", ["topic", "partition"])


def text_size(spark, sf_dir):
    return size_of(table(spark, sf_dir, "documents"), "text", ["lang"])


def text_scan(spark, sf_dir):
    """Document lines written as text files and scanned line by line."""
    path = fresh_path(spark, "lines")
    documents = table(spark, sf_dir, "documents")
    documents.select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    lines = read_lines(spark, path, line_end="\n")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("copies"))


def word_count(spark, sf_dir):
    return ops.word_counts(table(spark, sf_dir, "documents"), "text")


def reconcile(spark, sf_dir):
    names = ["user_id", "event_type", "props"]
    sent = table(spark, sf_dir, "events")
    lossy = sent.where("value <= 200").select(*names)
    repeated = sent.where("event_type = 'signup'").select(*names)
    return compare(sent, lossy.unionByName(repeated), names)


def reconcile_equal(spark, sf_dir):
    """The log against the events it came from: no rows."""
    sent = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    return compare(sent, ops.values_of(log_records(spark, sf_dir)))


def reconcile_digests(spark, sf_dir):
    """The log against a copy that lost some records and has others twice, by digests."""
    log = log_records(spark, sf_dir)
    rare = (F.col("topic") == "topic_error") & (F.col("partition") == 1)
    lossy = log.where(~(rare & (F.col("offset") % 5 == 0)))
    twice = log.where((F.col("topic") == "topic_view") & (F.col("offset") == 3))
    found = reconcile_log(log, lossy.unionByName(twice), ["value"], 64)
    return found.select("topic", "partition", "offset", "value", "status", "copies")


def sink_by_partition(spark, sf_dir):
    path = fresh_path(spark, "by-partition")
    files.write_by_partition(log_records(spark, sf_dir), path, in_order=True)
    back = spark.read.schema("value STRING, topic STRING, partition INT").text(path)
    return size_of(back, "value", ["topic", "partition"])


def sink_time_partitioned(spark, sf_dir):
    path = fresh_path(spark, "by-time")
    files.write_time_partitioned(tag_time_partition(spark, sf_dir), path)
    return (
        spark.read.parquet(path)
        .groupBy("topic", "time_partition")
        .agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("message")).alias("chars"))
    )


def sink_ordered_text(spark, sf_dir):
    """Every event as a line, in time order over all files, read back."""
    path = fresh_path(spark, "ordered")
    lines = table(spark, sf_dir, "events").select(
        "ts", "event_id", F.concat_ws(" ", "event_id", "event_type", "props").alias("value")
    )
    files.write_ordered_text(lines, path, ["ts", "event_id"])
    return read_lines(spark, path)


def sink_append(spark, sf_dir):
    """The log's values in two appends to a single table of values."""
    path = fresh_path(spark, "collected")
    log = log_records(spark, sf_dir)
    for half in (0, 1):
        files.append_values(log.where(F.col("partition") % 2 == half), path)
    return spark.read.parquet(path).groupBy("value").agg(F.count(F.lit(1)).alias("copies"))


QUERIES = {
    f.__name__: f
    for f in (
        value_projection,
        tag_time_partition,
        tag_from_message,
        tag_python_parser,
        field_rewrite,
        contains_filter,
        predicate_filter,
        map_records,
        route_split,
        merge_streams,
        batch_size,
        text_size,
        text_scan,
        word_count,
        reconcile,
        reconcile_equal,
        reconcile_digests,
        sink_by_partition,
        sink_time_partitioned,
        sink_ordered_text,
        sink_append,
    )
}

_SIZES = """count(*) AS records, CAST(coalesce(sum(length(value)), 0) AS BIGINT) AS chars,
       CAST(coalesce(sum(strlen(value)), 0) AS BIGINT) AS bytes"""

ORACLES = {
    "value_projection": "SELECT props AS value FROM events",
    "tag_time_partition": f"""WITH {LOG_SQL}
SELECT topic, "partition", "offset", strftime("timestamp", '%Y/%m/%d') AS time_partition,
       value AS message FROM log""",
    "tag_from_message": f"""WITH {LOG_SQL}
SELECT topic, "partition", "offset", strftime("timestamp", '%Y/%m/%d') AS time_partition
FROM log""",
    "tag_python_parser": f"""WITH {LOG_SQL}
SELECT topic, "partition", "offset",
       lpad(CAST(CAST(regexp_extract(value, '[0-9]+') AS INT) // 10 AS VARCHAR), 2, '0')
         AS time_partition,
       value AS message FROM log""",
    "field_rewrite": r"""
SELECT event_id, regexp_replace(props, '("k": )([0-9.]+)([,}])', '\1"\2"\3', 'g') AS value
FROM events""",
    "contains_filter": """SELECT event_id, props AS value FROM events
WHERE contains(props, '"k": 7')""",
    "predicate_filter": """SELECT event_id, user_id, event_type, value FROM events
WHERE event_type = 'purchase' AND value >= 50""",
    "map_records": """SELECT event_id,
       CAST(regexp_extract(props, '[0-9]+') AS BIGINT) * 2 AS doubled FROM events""",
    "route_split": f"""SELECT event_id, event_type,
       CASE WHEN {BRANCHES['sales']} THEN 'sales' WHEN {BRANCHES['alerts']} THEN 'alerts'
            ELSE 'rest' END AS route FROM events""",
    "merge_streams": """
SELECT event_id AS id, user_id AS customer, event_type, 'web' AS source,
       CAST(NULL AS VARCHAR) AS o_orderstatus FROM events
UNION ALL
SELECT o_orderkey, o_custkey, NULL, 'shop', o_orderstatus FROM orders""",
    "batch_size": f"""WITH {LOG_SQL}
SELECT topic, "partition", {_SIZES} FROM log GROUP BY topic, "partition" """,
    "text_size": f"""
SELECT lang, {_SIZES} FROM (SELECT lang, text AS value FROM documents) GROUP BY lang""",
    "text_scan": r"""
SELECT value, count(*) AS copies
FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""",
    "word_count": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS word FROM documents)
WHERE word <> '' GROUP BY word""",
    "reconcile": """
WITH both_sides AS (
  SELECT user_id, event_type, props, 1 AS n FROM events
  UNION ALL SELECT user_id, event_type, props, -1 FROM events WHERE value <= 200
  UNION ALL SELECT user_id, event_type, props, -1 FROM events WHERE event_type = 'signup')
SELECT user_id, event_type, props,
       CASE WHEN sum(n) > 0 THEN 'missing' ELSE 'extra' END AS status,
       CAST(abs(sum(n)) AS BIGINT) AS copies
FROM both_sides GROUP BY user_id, event_type, props HAVING sum(n) <> 0""",
    "reconcile_equal": f"""WITH {LOG_SQL}
SELECT value, 'missing' AS status, CAST(1 AS BIGINT) AS copies FROM
  (SELECT value FROM log EXCEPT ALL SELECT props FROM events)""",
    "reconcile_digests": f"""WITH {LOG_SQL}
SELECT topic, "partition", "offset", value, 'missing' AS status, CAST(1 AS BIGINT) AS copies
FROM log WHERE topic = 'topic_error' AND "partition" = 1 AND "offset" % 5 = 0
UNION ALL SELECT topic, "partition", "offset", value, 'extra', 1
FROM log WHERE topic = 'topic_view' AND "offset" = 3""",
    "sink_by_partition": f"""WITH {LOG_SQL}
SELECT topic, "partition", {_SIZES} FROM log GROUP BY topic, "partition" """,
    "sink_time_partitioned": """
SELECT concat('topic_', event_type) AS topic, strftime(ts, '%Y/%m/%d') AS time_partition,
       count(*) AS records, CAST(sum(length(props)) AS BIGINT) AS chars
FROM events GROUP BY ALL""",
    "sink_ordered_text": """SELECT concat_ws(' ', event_id, event_type, props) AS value
FROM events""",
    "sink_append": "SELECT props AS value, count(*) AS copies FROM events GROUP BY props",
}
