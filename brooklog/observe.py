"""Status and metric tables: what each cycle did, as rows that can be queried."""

from __future__ import annotations

import json
import threading
import traceback
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from brooklog import schemas
from brooklog.schemas import TOPIC_PARTITION
from brooklog.scratch import read_if_there

# fixed values: status codes, module types and metric names
OK, ERROR = "OK", "ERROR"
CORE, READER, TRANSFORMER, WRITER, CHECKPOINT = (
    "Core",
    "Reader",
    "Transformer",
    "Writer",
    "CheckpointService",
)
IN_RECORDS, IN_BYTES, OUT_RECORDS, OUT_BYTES = "InRecords", "InBytes", "OutRecords", "OutBytes"
WRITE_MILLIS = "WriteMillis"
# messages of the rows that mark where a cycle begins and ends
STARTED, ENDED = "cycle started", "cycle ended"


# status and metric rows share one table, so that a cycle ends with one append
EVENTS = (
    "pipeline STRING, cycle_id BIGINT, module STRING, name STRING, message STRING, "
    "value BIGINT, at TIMESTAMP"
)
EVENT_COLUMNS = [c.split()[0] for c in EVENTS.split(", ")]
STATUS_COLUMNS = [c.split()[0] for c in schemas.STATUS.split(", ")]
METRIC_COLUMNS = [c.split()[0] for c in schemas.METRIC.split(", ")]


class EventTables:
    """Collects a cycle's events and appends them when the cycle ends."""

    def __init__(self, spark: SparkSession, path: str, pipeline: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.pipeline = pipeline
        self._status: list[tuple] = []
        self._metrics: list[tuple] = []

    def status(self, cycle_id: int, module: str, message: str) -> None:
        self._status.append((self.pipeline, cycle_id, module, OK, message, _now()))

    def error(self, cycle_id: int, module: str, failure: BaseException | str) -> None:
        if isinstance(failure, BaseException):
            failure = f"{failure}\n{''.join(traceback.format_exception(failure))}"
        self._status.append((self.pipeline, cycle_id, module, ERROR, failure, _now()))

    def metrics(self, cycle_id: int, module: str, values: dict[str, int]) -> None:
        for name, value in values.items():
            row = (self.pipeline, cycle_id, module, name, int(value or 0), _now())
            self._metrics.append(row)

    def flush(self) -> None:
        """Append the collected events: a handful of rows, in one small file."""
        rows = [(*head, None, at) for *head, at in self._status]
        rows += [(*head, None, value, at) for *head, value, at in self._metrics]
        if rows:
            table = pa.Table.from_pylist([dict(zip(EVENT_COLUMNS, row)) for row in rows])
            events = self.spark.createDataFrame(table, EVENTS).coalesce(1)
            events.write.mode("append").parquet(self.path)
            self._status.clear()
            self._metrics.clear()

    def _events(self) -> DataFrame:
        return read_if_there(self.spark, self.path, EVENTS)

    def status_table(self) -> DataFrame:
        rows = self._events().where("value IS NULL")
        return rows.drop("value").withColumnRenamed("name", "status").select(*STATUS_COLUMNS)

    def metric_table(self) -> DataFrame:
        rows = self._events().where("value IS NOT NULL")
        return rows.withColumnRenamed("name", "metric").select(*METRIC_COLUMNS)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def record_metrics(value: str | None) -> list:
    """Observed expressions: records and, if there is a text column, its size."""
    size = F.sum(F.octet_length(value).cast("bigint")) if value else F.lit(0).cast("bigint")
    return [F.count(F.lit(1)).alias("records"), F.coalesce(size, F.lit(0)).alias("bytes")]


def text_column(df: DataFrame) -> str | None:
    return next((c for c in ("value", "message") if c in df.columns), None)


def partition_summary(log: DataFrame, value: str = "value") -> DataFrame:
    """Records, offsets and bytes per topic partition."""
    return log.groupBy(*TOPIC_PARTITION).agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.coalesce(F.sum(F.octet_length(value).cast("bigint")), F.lit(0)).alias("bytes"),
    )


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every batch; a query itself forgets all but the last hundred."""

    def __init__(self) -> None:
        self.batches: dict[str, list[dict]] = {}
        self.ended: dict[str, threading.Event] = {}

    def of(self, run_id: str) -> list[dict]:
        return self.batches.setdefault(run_id, [])

    def end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.of(str(event.progress.runId)).append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


def all_progress(query) -> list[dict]:
    """Progress of all batches of a query that ``runner`` ran, else of the last ones."""
    return getattr(query, "all_progress", None) or query.recentProgress


def progress_metrics(query) -> list[tuple[int, str, str, int]]:
    """(batch, observation, metric, value) out of a streaming query's progress."""
    rows = []
    for progress in all_progress(query):
        for name, row in (progress.get("observedMetrics") or {}).items():
            values = row.asDict() if hasattr(row, "asDict") else dict(row)
            rows += [(progress["batchId"], name, k, v) for k, v in values.items()]
    return rows
