"""A streaming source of a log's records: planned from the catalog, read on the executors.

A batch is a range of offsets for each topic partition, and a task for each few files that hold
records of it, by the first and last offset that the catalog tells of each. Only versions
of the catalog that are committed are seen.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from brooklog import schemas
from brooklog.observe import READER, EventTables
from brooklog.scratch import fresh_path
from brooklog.sources.log_table import ADDED, DROPPED, FLOOR, LogTable


def catalog_reader() -> Callable:
    """The function that reads a log's catalog in a Python process of its own.

    Made here, like the sources, so that such a process need not import this package.
    """
    added, dropped, floor = ADDED, DROPPED, FLOOR

    def read(root: str, known=None):
        """(version, files, {(topic, partition): (earliest, latest)}); ``known`` if it is new."""
        import json

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        listed = store.get_file_info(fs.FileSelector(f"{base}/catalog/commits", allow_not_found=True))
        newest = max((int(i.base_name) for i in listed if i.base_name.isdigit()), default=0)
        if known and known[0] == newest:
            return known
        parts, version, whole = [], newest, False
        while version and not whole:
            with store.open_input_file(f"{base}/catalog/commits/{version}") as source:
                marker = json.loads(source.read())
            folder = f"{base}/catalog/changes/{marker['changes']}"
            for info in store.get_file_info(fs.FileSelector(folder)):
                if info.base_name.startswith("part-"):
                    parts.append(pq.read_table(store.open_input_file(info.path)))
            whole, version = marker["whole"], version - 1
        if not parts:
            return newest, None, {}
        changes = pa.concat_tables(parts, promote_options="permissive")
        kind = changes.column("change")
        files = changes.filter(pc.equal(kind, added))
        gone = changes.filter(pc.equal(kind, dropped)).column("file")
        files = files.filter(pc.invert(pc.is_in(files.column("file"), gone.combine_chunks())))
        keys = ["topic", "partition"]
        spans = {}
        sums = files.group_by(keys).aggregate([("earliest", "min"), ("latest", "max")])
        for row in sums.to_pylist():
            spans[row["topic"], row["partition"]] = (row["earliest_min"], row["latest_max"])
        floors = changes.filter(pc.equal(kind, floor)).group_by(keys)
        for row in floors.aggregate([("earliest", "max"), ("latest", "max")]).to_pylist():
            low, high = spans.get((row["topic"], row["partition"]), (row["latest_max"],) * 2)
            high = max(high, row["latest_max"])
            spans[row["topic"], row["partition"]] = (min(max(low, row["earliest_max"]), high), high)
        return newest, files, spans

    return read


def log_records_source(name: str = "log_records") -> type[DataSource]:
    """Options: ``root`` of the log; ``maxRecordsPerPartition`` of a batch (none: all there is),
    which needs ``progress``, a folder of this query's own; ``onGap``: ``skip`` records
    that were trimmed before they were read, or ``fail``; ``recordsPerTask``.
    """
    layout, read_catalog = schemas.LOG, catalog_reader()

    class Files(InputPartition):
        def __init__(self, topic, partition, begin, until, files):
            super().__init__(None)
            self.topic, self.partition, self.begin, self.until = topic, partition, begin, until
            self.files = files

    class LogReader(DataSourceStreamReader):
        # An offset maps "partition:topic" to the exclusive end reached there ("until") and to
        # where reading of it once began ("first").

        def __init__(self, options):
            self.root = options["root"]
            self.cap = int(options.get("maxRecordsPerPartition", "0"))
            self.per_task = int(options.get("recordsPerTask", str(1 << 20)))
            self.on_gap = options.get("onGap", "skip")
            self.progress = options.get("progress")
            if self.cap > 0 and not self.progress:
                raise ValueError("maxRecordsPerPartition needs a folder for progress")
            self.state, self.end = None, None

        def initialOffset(self):
            return {}

        def _remembered(self):
            """Where the query was when its process ended; Spark does not tell."""
            import json

            from pyarrow import fs

            if not self.progress:
                return {}
            store, folder = fs.FileSystem.from_uri(self.progress)
            if store.get_file_info(f"{folder}/end").type == fs.FileType.NotFound:
                return {}
            with store.open_input_file(f"{folder}/end") as source:
                return json.loads(source.read())

        def _remember(self, end):
            import json

            from pyarrow import fs

            store, folder = fs.FileSystem.from_uri(self.progress)
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/draft") as out:
                out.write(json.dumps(end).encode())
            store.move(f"{folder}/draft", f"{folder}/end")

        def latestOffset(self):
            self.state = read_catalog(self.root, self.state)
            if self.end is None:
                self.end = self._remembered()
            end = dict(self.end)
            for (topic, partition), (earliest, latest) in self.state[2].items():
                key = f"{partition}:{topic}"
                at = end.get(key, {"first": earliest, "until": earliest})
                until = min(max(at["until"], earliest) + self.cap, latest) if self.cap > 0 else latest
                end[key] = {"first": at["first"], "until": max(until, at["until"])}
            if self.progress and end != self.end:
                self._remember(end)
            self.end = end
            return end

        def partitions(self, start, end):
            import pyarrow as pa
            import pyarrow.compute as pc

            if self.end is None:
                self.end = end
            self.state = read_catalog(self.root, self.state)
            _, files, spans = self.state
            asked = []
            for key, reached in end.items():
                partition, topic = key.split(":", 1)
                begin = start[key]["until"] if key in start else reached["first"]
                there = spans.get((topic, int(partition)), (begin, begin))[0]
                if begin < min(there, reached["until"]) and self.on_gap == "fail":
                    raise ValueError(f"records lost in {topic}/{partition}: offsets {begin} to {there - 1}")
                if reached["until"] > max(begin, there):
                    asked.append((topic, int(partition), max(begin, there), reached["until"]))
            if not asked or files is None:
                return []
            names = ["topic", "partition", "begin", "until"]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            ranges = pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*asked), kinds)})
            found = files.drop_columns(["change", "batch"]).join(ranges, names[:2], join_type="inner")
            inside = pc.and_(
                pc.less(found["earliest"], found["until"]), pc.greater(found["latest"], found["begin"])
            )
            found = found.filter(inside).sort_by([(n, "ascending") for n in ("topic", "partition", "earliest")])
            parts, records = [], 0
            for row in found.to_pylist():
                own = (row["topic"], row["partition"])
                here = min(row["latest"], row["until"]) - max(row["earliest"], row["begin"])
                last = parts[-1] if parts else None
                if last and (last.topic, last.partition) == own and records + here <= self.per_task:
                    last.files.append(row["file"])
                    records += here
                else:
                    parts.append(Files(*own, row["begin"], row["until"], [row["file"]]))
                    records = here
            return parts

        def read(self, part):
            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.parquet as pq
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(self.root)
            for name in part.files:
                source = pq.ParquetFile(store.open_input_file(f"{base}/records/{name}"))
                at = source.schema_arrow.get_field_index("offset")
                groups = []
                for g in range(source.num_row_groups):
                    seen = source.metadata.row_group(g).column(at).statistics
                    if seen is None or (seen.min < part.until and seen.max >= part.begin):
                        groups.append(g)
                for batch in source.iter_batches(row_groups=groups):
                    offsets = batch.column("offset")
                    inside = pc.and_(
                        pc.greater_equal(offsets, part.begin), pc.less(offsets, part.until)
                    )
                    batch = batch.filter(inside)
                    n = batch.num_rows
                    columns = [pa.repeat(part.topic, n), pa.array([part.partition] * n, pa.int32())]
                    names = ["offset", "timestamp", "key", "value"]
                    columns += [batch.column(c) for c in names]
                    yield pa.RecordBatch.from_arrays(columns, ["topic", "partition", *names])

    class LogRecords(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return layout

        def streamReader(self, schema):
            return LogReader(self.options)

    return LogRecords


def local_uri(path: str) -> str:
    """pyarrow takes file:///folder, where Hadoop also writes file:/folder."""
    return re.sub(r"^file:/(?!/)", "file:///", path)


def stream_records(
    spark: SparkSession, log: LogTable, max_records: int | None = None, on_gap: str = "skip"
) -> DataFrame:
    """The records of ``log`` as a stream, at most ``max_records`` of a partition in a batch.

    A query with ``max_records`` has to be polled (``run_available`` with ``every``).
    """
    spark.dataSource.register(log_records_source())
    reader = spark.readStream.format("log_records").option("root", local_uri(log.root))
    reader = reader.option("onGap", on_gap)
    if max_records is not None:
        reader = reader.option("maxRecordsPerPartition", str(max(1, max_records)))
        reader = reader.option("progress", local_uri(fresh_path(spark, "progress")))
    return reader.load()


def report_gaps(log: LogTable, ranges: DataFrame, events: EventTables, batch_id: int) -> int:
    """Note offsets of a batch's ranges that the log no longer has; how many records those are."""
    there = log.catalog().select("topic", "partition", "earliest")
    lost = ranges.join(there, ["topic", "partition"]).where("from_offset < earliest")
    total = 0
    # at most one row per topic partition
    for row in lost.collect():
        until = min(row.earliest, row.until_offset)
        total += until - row.from_offset
        events.error(
            batch_id,
            READER,
            f"records lost in {row.topic}/{row.partition}: offsets {row.from_offset} to {until - 1}",
        )
    return total
