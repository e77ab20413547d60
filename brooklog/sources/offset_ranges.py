"""A streaming source whose rows are the next offset ranges of a log.

Kafka's own limit is one total per batch; this source caps every topic
partition by itself. It only hands out ranges, a row per topic partition, and
Spark's checkpoint keeps how far they went; the records of a batch are then
read by an ordinary distributed scan of the log (``capped_batches``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from brooklog import schemas
from brooklog.observe import EventTables
from brooklog.plans.checkpoint import Ledger, merge_checkpoint
from brooklog.scratch import write_out
from brooklog.sources.log_stream import catalog_reader, local_uri, report_gaps
from brooklog.sources.log_table import LogTable


def offset_ranges_source(name: str = "offset_ranges") -> type[DataSource]:
    """The source class, made here so that workers need not import this package.

    Options: ``root`` of a log, and ``maxRecordsPerPartition`` (default 1000, at least 1).
    """
    layout, read_catalog = schemas.RANGES, catalog_reader()

    class RangeReader(SimpleDataSourceStreamReader):
        # An offset maps "partition:topic" to the exclusive end reached there
        # ("until") and to where reading of it once began ("first").

        def __init__(self, options):
            self.root = options["root"]
            self.cap = max(1, int(options.get("maxRecordsPerPartition", "1000")))
            self.state = None

        def initialOffset(self):
            return {}

        def read(self, start):
            self.state = read_catalog(self.root, self.state)
            end = dict(start)
            for (topic, partition), (earliest, latest) in self.state[2].items():
                key = f"{partition}:{topic}"
                at = start.get(key, {"first": earliest, "until": earliest})
                until = min(at["until"] + self.cap, latest)
                if until > at["until"]:
                    end[key] = {"first": at["first"], "until": until}
            return self.readBetweenOffsets(start, end), end

        def readBetweenOffsets(self, start, end):
            rows = []
            for key, reached in sorted(end.items()):
                begin = start[key]["until"] if key in start else reached["first"]
                if reached["until"] > begin:
                    partition, topic = key.split(":", 1)
                    rows.append((topic, int(partition), begin, reached["until"]))
            return iter(rows)

        def commit(self, end):
            pass

    class OffsetRanges(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return layout

        def simpleStreamReader(self, schema):
            return RangeReader(self.options)

    return OffsetRanges


def stream_ranges(spark: SparkSession, log: LogTable, max_records: int = 1000) -> DataFrame:
    """The next ranges of ``log`` as a stream, one batch per trigger."""
    spark.dataSource.register(offset_ranges_source())
    return (
        spark.readStream.format("offset_ranges")
        .option("root", local_uri(log.root))
        .option("maxRecordsPerPartition", str(max_records))
        .load()
    )


def capped_batches(
    log: LogTable,
    write_batch: Callable[[DataFrame, int], object],
    ledger: Ledger | None = None,
    events: EventTables | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch function for a stream of ranges: scan their records and write them.

    With a ledger the planned ranges are then committed; the batch id is the
    cycle id less one, so a repeated batch finds its own commit. With ``events``,
    offsets that the log has lost since they were planned are noted there as errors.
    """

    def scan_and_write(ranges: DataFrame, batch_id: int) -> None:
        # a row per topic partition, which the steps below share
        ranges = write_out(ranges, "ranges")
        if events is not None:
            report_gaps(log, ranges, events, batch_id)
            events.flush()
        write_batch(log.scan(ranges), batch_id)
        if ledger is not None:
            merged = merge_checkpoint(ledger.load(batch_id), ranges)
            ledger.commit(batch_id + 1, merged)

    return scan_and_write
