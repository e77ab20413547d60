"""Run streaming queries so that each batch leaves exactly one copy.

Spark's own checkpoint decides where a query resumes. A batch that is run again
after a failure overwrites its folder, so results stay whole and single.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklog import schemas
from brooklog.observe import (
    CORE,
    IN_RECORDS,
    READER,
    WRITE_MILLIS,
    WRITER,
    EventTables,
    ProgressLog,
    all_progress,
    progress_metrics,
)
from brooklog.operators.ordered import number_rows
from brooklog.plans.checkpoint import RANGE_COLUMNS
from brooklog.schemas import TOPIC_PARTITION
from brooklog.scratch import (
    create_once,
    delete_folder,
    file_names,
    has_data,
    numbered_folders,
    read_if_there,
)


#: Seconds in which Spark must have reported a query's last batch after it ended.
TOLD_WITHIN_S = 120


def event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Zoned event time with a watermark; zone-free input is read as session time.

    The session's zone should be UTC, where every day has 24 hours.
    """
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def start(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], object],
    checkpoint: str,
    output_mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start ``stream``; ``every`` polls at an interval, else it stops at the end."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id)

    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_available(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], object],
    checkpoint: str,
    output_mode: str = "append",
    events: EventTables | None = None,
    every: str | None = None,
    late_rows: str = "report",
) -> StreamingQuery:
    """Process everything there is now, then stop.

    With ``events``, batches, late rows and failures are noted there (``report``). With
    ``every`` the source is polled until it has no more, for sources that hand out
    one batch at a time. ``late_rows="fail"`` raises an error if rows came behind the
    watermark and were dropped.
    """
    spark = stream.sparkSession
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = start(stream, write_batch, checkpoint, output_mode, every)
        try:
            if every:
                query.processAllAvailable()
                query.stop()
            else:
                query.awaitTermination()
        finally:
            if not log.end_of(query.runId).wait(TOLD_WITHIN_S):
                raise RuntimeError("the end of the query was not reported: counts may be missing")
            query.all_progress = log.of(query.runId)
            if events is not None:
                report(query, events)
    finally:
        spark.streams.removeListener(log)
    lost = dropped_rows(query)
    if late_rows == "fail" and lost:
        raise RuntimeError(f"{lost} rows came behind the watermark and were dropped")
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, in all batches."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in all_progress(query)
        for state in progress["stateOperators"]
    )


def report(query: StreamingQuery, events: EventTables) -> None:
    """Note a query's batches, what they observed, and its failure if it failed."""
    for progress in all_progress(query):
        batch_id, spent = progress["batchId"], progress["durationMs"]
        if not progress["numInputRows"]:
            continue
        events.status(batch_id, CORE, f"batch of {progress['numInputRows']} rows done")
        events.metrics(batch_id, READER, {IN_RECORDS: progress["numInputRows"]})
        events.metrics(batch_id, WRITER, {WRITE_MILLIS: spent.get("addBatch", 0)})
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in progress["stateOperators"])
        if late:
            events.error(batch_id, CORE, f"{late} rows came behind the watermark")
    for batch_id, name, metric, value in progress_metrics(query):
        events.metrics(batch_id, name, {metric: value})
    failure = query.exception()
    if failure is not None:
        last = query.lastProgress
        events.error(last["batchId"] + 1 if last else 0, CORE, failure)
    events.flush()


class ChangedRows:
    """Sink for update mode: each batch appends the rows whose state changed.

    ``read`` gives the newest row per key. Batches stay small however large the
    state is, and no window is held back until a watermark passes it. Every
    ``merge_every`` batches the changes are merged into a base, a row per key, and dropped:
    what is kept and read is the state and a few batches, not all that ever changed.
    """

    def __init__(self, path: str, schema: str, keys: Sequence[str], merge_every: int = 10):
        self.path = path.rstrip("/")
        self.schema = f"{schema}, batch_id BIGINT"
        self.keys = list(keys)
        self.merge_every = merge_every

    def _base(self, spark, up_to: int | None = None) -> int | None:
        """The last batch in the newest base; its marker is made when it is whole."""
        names = file_names(spark, f"{self.path}/merged")
        found = [int(n) for n in names if n.isdigit()]
        return max((n for n in found if up_to is None or n <= up_to), default=None)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        base = self._base(spark)
        if base is not None and batch_id <= base:
            return  # a repeated batch that is in the base already
        rows = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/{batch_id}")
        if (batch_id + 1) % self.merge_every == 0:
            self.merge(spark, batch_id)

    def merge(self, spark, batch_id: int) -> None:
        """Make a base of all batches up to this one, and drop what it replaces."""
        before = self._base(spark)
        self._newest(spark).write.mode("overwrite").parquet(f"{self.path}/base/{batch_id}")
        create_once(spark, f"{self.path}/merged/{batch_id}", "")
        for name in file_names(spark, f"{self.path}/changes"):
            if int(name) <= batch_id:
                delete_folder(spark, f"{self.path}/changes/{name}")
        if before is not None:
            delete_folder(spark, f"{self.path}/base/{before}")
            delete_folder(spark, f"{self.path}/merged/{before}")

    def _newest(self, spark) -> DataFrame:
        base = self._base(spark)
        changes = [int(n) for n in file_names(spark, f"{self.path}/changes")]
        folders = [f"{self.path}/changes/{n}" for n in sorted(changes) if base is None or n > base]
        folders += [f"{self.path}/base/{base}"] if base is not None else []
        if not folders:
            return read_if_there(spark, f"{self.path}/none", self.schema)
        rows = spark.read.schema(self.schema).parquet(*folders)
        if len(folders) == 1:
            return rows
        rest = [c for c in rows.columns if c not in self.keys]
        newest = F.max_by(F.struct(*rest), "batch_id").alias("_newest")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_newest.*")

    def read(self, spark) -> DataFrame:
        return self._newest(spark).drop("batch_id")


class KeepFirst:
    """Sink that passes on each record once, however often and in whatever order it comes.

    It remembers the offset ranges that were passed on, a few rows per topic
    partition, one folder per batch; a repeated batch starts from the folder before it,
    and older ones are dropped. No event time is needed, so no record is ever too late.
    """

    def __init__(self, sink: Callable[[DataFrame, int], object], home: str):
        self.sink = sink
        self.path = home.rstrip("/")

    def covered(self, spark, batch_id: int) -> DataFrame:
        """Ranges passed on before this batch."""
        for done in numbered_folders(spark, self.path, "batch_id="):
            if done < batch_id and has_data(spark, f"{self.path}/batch_id={done}"):
                return spark.read.schema(schemas.RANGES).parquet(f"{self.path}/batch_id={done}")
        return read_if_there(spark, f"{self.path}/none", schemas.RANGES)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = self.covered(spark, batch_id).selectExpr(
            "topic AS _t", "partition AS _p", "from_offset", "until_offset"
        )
        seen = (
            (F.col("topic") == F.col("_t"))
            & (F.col("partition") == F.col("_p"))
            & (F.col("offset") >= F.col("from_offset"))
            & (F.col("offset") < F.col("until_offset"))
        )
        fresh = df.dropDuplicates([*TOPIC_PARTITION, "offset"]).join(before, seen, "left_anti")
        self.sink(fresh, batch_id)
        ranges = before.toDF(*RANGE_COLUMNS).unionByName(offset_runs(df))
        target = f"{self.path}/batch_id={batch_id}"
        joined_up(ranges).coalesce(1).write.mode("overwrite").parquet(target)
        older = [n for n in numbered_folders(spark, self.path, "batch_id=") if n < batch_id]
        for done in older[1:]:
            delete_folder(spark, f"{self.path}/batch_id={done}")


def keep_first_by_key(
    stream: DataFrame, keys: Sequence[str], ts: str, delay: str
) -> DataFrame:
    """The first row of each key, for records that have no offsets.

    A key is remembered for ``delay`` of event time; a copy that comes later than that behind
    the newest row is dropped as late, which ``run_available`` reports or fails on.
    """
    return event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def offset_runs(records: DataFrame) -> DataFrame:
    """Ranges of offsets without gaps, per topic partition."""
    offsets = records.select(*TOPIC_PARTITION, "offset").distinct()
    run = (F.col("offset") - F.col("_nth")).alias("_run")
    return (
        number_rows(offsets, TOPIC_PARTITION, ["offset"], "_nth")
        .groupBy(*TOPIC_PARTITION, run)
        .agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
        .drop("_run")
    )


def joined_up(ranges: DataFrame) -> DataFrame:
    """Ranges that touch or overlap as one; a few rows per topic partition."""
    in_order = Window.partitionBy(*TOPIC_PARTITION).orderBy("from_offset", "until_offset")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("from_offset") > F.max("until_offset").over(before), F.lit(True))
    return (
        ranges.withColumn("_opens", opens.cast("int"))
        .withColumn("_run", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*TOPIC_PARTITION, "_run")
        .agg(
            F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")
        )
        .drop("_run")
    )
