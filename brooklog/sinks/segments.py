"""A sink that tells what it wrote: files, offset ranges, bytes and time per topic partition.

Each task writes files of its own and hands the driver a commit message for each topic
partition in them. When all tasks are through, the messages become the write's manifest; if
one fails, the files of the others are removed. A write is read through the manifests
that the ledger's committed cycles name, so a cycle that failed after its write, or is
still writing, is not seen, and neither is a file that a lost task left behind.

Rows pass through Python once, as Arrow batches. Where that costs too much and no ranges have to be
reported, ``files.BatchFolders`` writes natively.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from brooklog.plans.checkpoint import Ledger
from brooklog.scratch import read_if_there
from brooklog.sources.log_stream import local_uri

MANIFEST = (
    "file STRING, topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT, "
    "records BIGINT, bytes BIGINT, nanos BIGINT"
)


def segments_source(name: str = "log_segments") -> type[DataSource]:
    """The sink's class, made here so that workers need not import this package.

    Options: ``path``, a folder that only this write uses, and ``value``, the column whose
    size counts as bytes. Rows have topic, partition and offset; those of one topic
    partition should follow each other.
    """
    layout = MANIFEST

    class Wrote(WriterCommitMessage):
        def __init__(self, rows):
            self.rows = rows

    class SegmentWriter(DataSourceArrowWriter):
        def __init__(self, options):
            self.path = options["path"].rstrip("/")
            self.value = options.get("value")

        def _store(self, path):
            from pyarrow import fs

            return fs.FileSystem.from_uri(path)

        def write(self, iterator):
            import time
            import uuid

            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.parquet as pq

            store, folder = self._store(f"{self.path}/data")
            store.create_dir(folder, recursive=True)
            file, out, found = f"{uuid.uuid4().hex}.parquet", None, {}
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                begin = time.monotonic_ns()
                if out is None:
                    out = pq.ParquetWriter(store.open_output_stream(f"{folder}/{file}"), batch.schema)
                out.write_batch(batch)
                spent = time.monotonic_ns() - begin
                own = pa.table(
                    {
                        "topic": batch.column("topic"),
                        "partition": batch.column("partition"),
                        "offset": batch.column("offset"),
                        "bytes": pc.fill_null(pc.binary_length(batch.column(self.value)), 0)
                        if self.value
                        else pa.nulls(batch.num_rows, pa.int32()),
                    }
                )
                sums = own.group_by(["topic", "partition"]).aggregate(
                    [("offset", "min"), ("offset", "max"), ("offset", "count"), ("bytes", "sum")]
                )
                for row in sums.to_pylist():
                    key = (row["topic"], row["partition"])
                    low, high, records, size, nanos = found.get(key, (1 << 62, -1, 0, 0, 0))
                    # a batch's time goes to its topic partitions by their records
                    share = spent * row["offset_count"] // batch.num_rows
                    found[key] = (
                        min(low, row["offset_min"]),
                        max(high, row["offset_max"]),
                        records + row["offset_count"],
                        size + (row["bytes_sum"] or 0),
                        nanos + share,
                    )
            if out is not None:
                begin = time.monotonic_ns()
                out.close()
                rest = (time.monotonic_ns() - begin) // len(found)
                found = {k: (*v[:4], v[4] + rest) for k, v in found.items()}
            return Wrote(
                [
                    (file, topic, partition, low, high + 1, records, size, nanos)
                    for (topic, partition), (low, high, records, size, nanos) in found.items()
                ]
            )

        def commit(self, messages):
            import pyarrow as pa
            import pyarrow.parquet as pq

            rows = [row for message in messages if message for row in message.rows]
            kinds = {"STRING": pa.string(), "INT": pa.int32(), "BIGINT": pa.int64()}
            fields = [field.split() for field in layout.split(", ")]
            table = pa.table(
                {n: pa.array([r[k] for r in rows], kinds[t]) for k, (n, t) in enumerate(fields)}
            )
            store, folder = self._store(f"{self.path}/manifest")
            store.create_dir(folder, recursive=True)
            pq.write_table(table, f"{folder}/part-0.parquet", filesystem=store)

        def abort(self, messages):
            store, folder = self._store(f"{self.path}/data")
            for message in messages:
                for file in {row[0] for row in message.rows} if message else ():
                    store.delete_file(f"{folder}/{file}")

    class Segments(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return SegmentWriter(self.options)

    return Segments


@dataclass(frozen=True)
class Written:
    """What a sink did: the folder it wrote to, and the ranges it took, if not all."""

    output: str
    delta: DataFrame | None = None


class SegmentSink:
    """Cycles written through ``log_segments``, read as of what the ledger has committed.

    ``accepts`` picks the records this sink takes. With ``partial`` it reports the offset
    ranges of those, by topic partition, and only they are committed; the others stay
    to be read again.
    """

    def __init__(self, path: str, accepts: Column | None = None, partial: bool = False):
        self.path = local_uri(path.rstrip("/"))
        self.accepts = accepts
        self.partial = partial

    def __call__(self, df: DataFrame, cycle_id: int) -> Written:
        spark = df.sparkSession
        spark.dataSource.register(segments_source())
        output = f"{self.path}/cycle_id={cycle_id}/{uuid.uuid4().hex}"
        rows = df if self.accepts is None else df.where(self.accepts)
        value = next((c for c in ("value", "message") if c in df.columns), None)
        writer = rows.write.format("log_segments").mode("append").option("path", output)
        (writer.option("value", value) if value else writer).save()
        return Written(output, manifest(spark, output) if self.partial else None)

    def writes(self, spark: SparkSession, ledger: Ledger, up_to: int | None = None) -> DataFrame:
        """The manifests of all committed cycles, with cycle_id and folder."""
        return _union(
            spark,
            [
                manifest(spark, output).selectExpr(
                    "*", f"{cycle}L AS cycle_id", f"'{output}' AS folder"
                )
                for cycle, output in ledger.outputs(up_to).items()
            ],
            f"{MANIFEST}, cycle_id BIGINT, folder STRING",
        )

    def read(
        self, spark: SparkSession, ledger: Ledger, schema: str, up_to: int | None = None
    ) -> DataFrame:
        """The records of all committed cycles (up to ``up_to``)."""
        # a name per file, as Spark lists them itself for any table
        files = self.writes(spark, ledger, up_to).select("folder", "file").distinct().collect()
        if not files:
            return read_if_there(spark, f"{self.path}/none", schema)
        return spark.read.schema(schema).parquet(*[f"{r.folder}/data/{r.file}" for r in files])


def manifest(spark: SparkSession, output: str) -> DataFrame:
    """The commit messages of one write."""
    return spark.read.schema(MANIFEST).parquet(f"{output}/manifest")


def _union(spark: SparkSession, frames: list[DataFrame], schema: str) -> DataFrame:
    if not frames:
        return read_if_there(spark, "/none", schema)
    found = frames[0]
    for more in frames[1:]:
        found = found.unionByName(more)
    return found
