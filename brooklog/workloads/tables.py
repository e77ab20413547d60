"""The given tables, and the log that Spark derives from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.scratch import fresh_path, write_out
from brooklog.sources.log_stream import stream_records
from brooklog.sources.log_table import LogTable

PARTITIONS = 5
_logs: dict[tuple[str, str], LogTable] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the tables hold UTC wall-clock times
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    # a pattern, because a stream's plain path must be a folder
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log records that have no offsets yet."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("topic_"), "event_type").alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        "event_id",
    )


def log_table(spark: SparkSession, sf_dir: str) -> LogTable:
    """The published event log, written once per application and folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _logs:
        log = LogTable(spark, fresh_path(spark, "log"))
        log.publish(event_records(spark, sf_dir), ["timestamp", "event_id"])
        _logs[at] = log
    return _logs[at]


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_table(spark, sf_dir).records()


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's records as a stream, in batches of half of the longest partition at most."""
    log = log_table(spark, sf_dir)
    return stream_records(spark, log, half_cap(log))


def half_cap(log: LogTable) -> int:
    longest = log.catalog().agg(F.expr("max(latest - earliest)")).first()[0]
    return (longest or 0) // 2 + 1


_trimmed: dict[tuple[str, str], LogTable] = {}


def trimmed_log(spark: SparkSession, sf_dir: str) -> LogTable:
    """The log published in three parts, trimmed by an eighth, its files joined."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _trimmed:
        log = LogTable(spark, fresh_path(spark, "log"))
        records = event_records(spark, sf_dir)
        # records without a time are in the last part
        day = F.coalesce(F.dayofmonth("timestamp"), F.lit(31))
        for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
            log.publish(records.where(part), ["timestamp", "event_id"])
        log.trim(log.catalog().selectExpr("topic", "partition", "latest div 8 AS earliest"))
        log.compact()
        _trimmed[at] = log
    return _trimmed[at]


def catalog_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's own catalog, as a small table of known size; records are not read."""
    return write_out(log_table(spark, sf_dir).catalog(), "catalog")


def mixed_checkpoint(catalog: DataFrame) -> DataFrame:
    """Partition 0 is read to its end, 1 lies beyond it, 2 and 3 stand at a
    third, 4 was never read."""
    until = (
        F.when(F.col("partition") == 0, F.col("latest"))
        .when(F.col("partition") == 1, F.col("latest") + 7)
        .otherwise(F.expr("latest div 3"))
    )
    return catalog.where("partition <> 4").select(
        "topic", "partition", F.lit(0).cast("bigint").alias("from_offset"),
        until.alias("until_offset"),
    )


def quarter_cap(catalog: DataFrame) -> int:
    """A per-partition cap that binds at every size: a quarter of the longest."""
    return catalog.agg(F.expr("max(latest) div 4")).first()[0]


def ledger_rows(catalog: DataFrame) -> DataFrame:
    """Two cycles: the first quarter everywhere, the second in partitions 0 to 2."""
    first = catalog.selectExpr(
        "1L AS cycle_id", "topic", "partition", "0L AS from_offset",
        "latest div 4 AS until_offset",
    )
    second = catalog.where("partition <= 2").selectExpr(
        "2L AS cycle_id", "topic", "partition", "latest div 4 AS from_offset",
        "latest div 2 AS until_offset",
    )
    return first.unionByName(second)


# --- the same inputs for DuckDB ------------------------------------------------

LOG_SQL = """
log AS (
  SELECT concat('topic_', event_type) AS topic,
         CAST(user_id % 5 AS INT) AS "partition",
         CAST(row_number() OVER (PARTITION BY event_type, user_id % 5
                                 ORDER BY ts, event_id) - 1 AS BIGINT) AS "offset",
         ts AS "timestamp",
         CAST(event_id AS VARCHAR) AS key,
         props AS value,
         event_id
  FROM events)"""

CATALOG_SQL = (
    LOG_SQL
    + """,
catalog AS (
  SELECT topic, "partition", min("offset") AS earliest, max("offset") + 1 AS latest
  FROM log GROUP BY topic, "partition")"""
)

MIXED_SQL = (
    CATALOG_SQL
    + """,
cap AS (SELECT max(latest) // 4 AS n FROM catalog),
checkpoint AS (
  SELECT topic, "partition", CAST(0 AS BIGINT) AS from_offset,
         CASE "partition" WHEN 0 THEN latest WHEN 1 THEN latest + 7
              ELSE latest // 3 END AS until_offset
  FROM catalog WHERE "partition" <> 4),
starts AS (
  SELECT c.topic, c."partition", c.latest, coalesce(k.until_offset, c.earliest) AS "start"
  FROM catalog c LEFT JOIN checkpoint k
    ON k.topic = c.topic AND k."partition" = c."partition"),
ranges AS (
  SELECT topic, "partition", "start" AS from_offset,
         least("start" + n, latest) AS until_offset
  FROM starts, cap WHERE least("start" + n, latest) > "start")"""
)

LEDGER_SQL = (
    CATALOG_SQL
    + """,
ledger AS (
  SELECT 1 AS cycle_id, topic, "partition", CAST(0 AS BIGINT) AS from_offset,
         latest // 4 AS until_offset FROM catalog
  UNION ALL
  SELECT 2, topic, "partition", latest // 4, latest // 2 FROM catalog
  WHERE "partition" <= 2)"""
)
