"""A partitioned log kept as parquet files, with a versioned catalog of them.

Records are in ``records/batch=…/attempt=…/topic=…/partition=…``. The catalog is a row of numbered
versions, each a small table of changes: files that came, with the first and last offset
in them, files that went, and the floors below which records were trimmed. A version counts from
the moment its marker is created, which only one of several writers can do; every
``SNAPSHOT_EVERY`` versions one holds the whole state. Readers take the newest version, so
they see whole batches, and no file that a failed or slower writer left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog import schemas
from brooklog.operators.ordered import number_rows
from brooklog.schemas import TOPIC_PARTITION
from brooklog.scratch import (
    create_once,
    delete_folder,
    drop_path,
    file_names,
    fresh_path,
    read_if_there,
    read_text,
    write_out,
)

# fixed value: the broker's own topic
INTERNAL_TOPICS = ("__consumer_offsets",)

#: Versions of the catalog after which one holds the whole state.
SNAPSHOT_EVERY = 10
ADDED, DROPPED, FLOOR = "added", "dropped", "floor"


class ConflictingChange(RuntimeError):
    """Another writer has changed the log meanwhile; start again from what it left."""


class LogTable:
    """Publish to, list, scan, trim and compact one log table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def records_path(self) -> str:
        return f"{self.root}/records"

    @property
    def catalog_path(self) -> str:
        return f"{self.root}/catalog"

    # --- the catalog ---------------------------------------------------------

    def version(self) -> int:
        """The newest version, 0 if nothing was published."""
        names = file_names(self.spark, f"{self.catalog_path}/commits")
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _marker(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.catalog_path}/commits/{version}"))

    def _changes(self, version: int) -> tuple[DataFrame, bool]:
        """All changes since the last whole state, and whether files went among them."""
        folders, went, whole = [], False, False
        while version and not whole:
            marker = self._marker(version)
            folders.append(f"{self.catalog_path}/changes/{marker['changes']}")
            went, whole = went or marker["went"], marker["whole"]
            version -= 1
        if not folders:
            return read_if_there(self.spark, f"{self.catalog_path}/none", schemas.CHANGES), False
        return self.spark.read.schema(schemas.CHANGES).parquet(*folders), went

    def files(self, version: int | None = None) -> DataFrame:
        """The log's files: batch, topic, partition, file, earliest and latest (exclusive)."""
        changes, went = self._changes(self.version() if version is None else version)
        files = changes.where(F.col("change") == ADDED)
        if went:
            gone = changes.where(F.col("change") == DROPPED).select("file")
            files = files.join(gone, "file", "left_anti")
        return files.select("batch", *TOPIC_PARTITION, "file", "earliest", "latest")

    def _floors(self, version: int) -> DataFrame:
        floors = self._changes(version)[0].where(F.col("change") == FLOOR)
        return floors.groupBy(*TOPIC_PARTITION).agg(
            F.max("earliest").alias("floor"), F.max("latest").alias("end")
        )

    def catalog(self, version: int | None = None) -> DataFrame:
        """Earliest and latest (exclusive) offset per topic partition."""
        version = self.version() if version is None else version
        floors = self._floors(version).select(
            *TOPIC_PARTITION, F.lit(None).cast("bigint").alias("earliest"), F.col("end").alias("latest"), "floor"
        )
        files = self.files(version).select(
            *TOPIC_PARTITION, "earliest", "latest", F.lit(None).cast("bigint").alias("floor")
        )
        end = F.max("latest")
        return files.unionByName(floors).groupBy(*TOPIC_PARTITION).agg(
            F.least(F.greatest(F.min("earliest"), F.max("floor")), end).alias("earliest"),
            end.alias("latest"),
        )

    def _commit(self, version: int, changes: DataFrame, went: bool, whole: bool = False) -> None:
        name = uuid.uuid4().hex
        # a row per file that came or went
        changes.coalesce(1).write.parquet(f"{self.catalog_path}/changes/{name}")
        marker = json.dumps({"changes": name, "went": went, "whole": whole})
        if not create_once(self.spark, f"{self.catalog_path}/commits/{version}", marker):
            raise ConflictingChange(f"version {version} of {self.root} is there already")
        if not whole and version % SNAPSHOT_EVERY == 0:
            floors = self._floors(version).select(
                F.lit(FLOOR).alias("change"), F.lit(None).cast("bigint").alias("batch"), *TOPIC_PARTITION,
                F.lit(None).cast("string").alias("file"), F.col("floor").alias("earliest"), F.col("end").alias("latest"),
            )
            files = self.files(version).select(F.lit(ADDED).alias("change"), "*")
            try:
                self._commit(version + 1, files.unionByName(floors), False, True)
            except ConflictingChange:
                pass  # another writer was faster; a later version will hold the state

    # --- reading -------------------------------------------------------------

    def _read(self, files: DataFrame) -> DataFrame:
        """Records of some of the log's files, with their file's batch."""
        # a name per file, as Spark lists them itself for any table
        names = [row.file for row in files.select("file").distinct().collect()]
        layout = f"batch BIGINT, attempt STRING, {schemas.LOG}"
        if not names:
            return read_if_there(self.spark, f"{self.records_path}/none", layout).drop("attempt")
        reader = self.spark.read.schema(layout).option("basePath", self.records_path)
        paths = [f"{self.records_path}/{name}" for name in sorted(names)]
        return reader.parquet(*paths).drop("attempt")

    def records(self) -> DataFrame:
        """All records that are there."""
        version = self.version()
        records = self._read(self.files(version)).drop("batch")
        floors = self._floors(version)
        if not floors.isEmpty():
            floors = write_out(floors.drop("end"), "floors")
            records = records.join(floors, TOPIC_PARTITION, "left").where(
                "floor IS NULL OR offset >= floor"
            ).drop("floor")
        return records

    def scan(self, ranges: DataFrame) -> DataFrame:
        """Records of the planned ranges.

        The catalog tells which files hold them; no other file is listed or opened, so a
        scan costs the same however old the log is, and a partition that lags behind costs
        the others nothing.
        """
        version = self.version()
        asked = ranges.select(*TOPIC_PARTITION, "from_offset", "until_offset")
        there = self.catalog(version).select(*TOPIC_PARTITION, F.col("earliest").alias("floor"))
        asked = asked.join(there, TOPIC_PARTITION).select(
            *TOPIC_PARTITION, F.greatest("from_offset", "floor").alias("from_offset"), "until_offset"
        )
        wanted = write_out(self.overlapping(asked, version), "ranges")
        low, high = wanted.agg(F.min("from_offset"), F.max("until_offset")).first()
        records = self._read(wanted).drop("batch")
        if low is None:
            return records
        spans = wanted.select(*TOPIC_PARTITION, "from_offset", "until_offset").distinct()
        return (
            records.where((F.col("offset") >= low) & (F.col("offset") < high))
            .join(spans, TOPIC_PARTITION)
            .where("offset >= from_offset AND offset < until_offset")
            .drop("from_offset", "until_offset")
        )

    def overlapping(self, ranges: DataFrame, version: int | None = None) -> DataFrame:
        """The files that hold records of the ranges, with the range of each."""
        return (
            self.files(version)
            .join(ranges.select(*TOPIC_PARTITION, "from_offset", "until_offset"), TOPIC_PARTITION)
            .where("greatest(earliest, from_offset) < least(latest, until_offset)")
        )

    # --- writing -------------------------------------------------------------

    def publish(
        self,
        records: DataFrame,
        order: Sequence[str],
        partitions: int | None = None,
    ) -> int:
        """Append records (``topic, partition, timestamp, key, value`` plus the
        order columns) behind the present end of each topic partition.

        Offsets follow ``order``, which must be unique within a topic partition. Raises
        ``ConflictingChange`` if another writer was faster: its records then have the offsets.
        """
        version = self.version()
        ends = self.catalog(version).select(*TOPIC_PARTITION, F.col("latest").alias("_end"))
        staging = fresh_path(self.spark, "slices")
        numbered = number_rows(
            records, TOPIC_PARTITION, order, "_nth", partitions, staging=staging
        )
        placed = numbered.join(ends, TOPIC_PARTITION, "left").select(
            "topic",
            "partition",
            (F.coalesce("_end", F.lit(0)) + F.col("_nth")).alias("offset"),
            "timestamp",
            "key",
            "value",
        )
        # slices come back as sorted files, so each task writes few directories
        added = self._write(version + 1, placed.sortWithinPartitions("topic", "partition", "offset"))
        self._commit(version + 1, added, False)
        drop_path(self.spark, staging)
        return version + 1

    def _write(self, batch: int, records: DataFrame) -> DataFrame:
        """Write records as files of a batch; the changes that make them part of the log."""
        target = f"{self.records_path}/batch={batch}/attempt={uuid.uuid4().hex}"
        records.write.partitionBy(*TOPIC_PARTITION).parquet(target)
        written = read_if_there(self.spark, target, schemas.LOG)
        # Spark gives the path with % codes, but a plus sign as it is
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        name = F.regexp_extract(path, r".*/records/(batch=\d+/attempt=.*)", 1)
        return (
            written.select(*TOPIC_PARTITION, "offset", name.alias("file"))
            .groupBy(*TOPIC_PARTITION, "file")
            .agg(F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest"))
            .select(
                F.lit(ADDED).alias("change"), F.lit(batch).cast("bigint").alias("batch"),
                *TOPIC_PARTITION, "file", "earliest", "latest",
            )
        )

    def trim(self, floors: DataFrame) -> int:
        """Forget the records below each topic partition's new ``earliest`` offset.

        Floors beyond the end stand for the end, and lower ones than before change nothing.
        Offsets go on where they were. ``vacuum`` removes the files.
        """
        version = self.version()
        ends = self.catalog(version).withColumnRenamed("earliest", "before")
        floors = floors.select(*TOPIC_PARTITION, "earliest").join(ends, TOPIC_PARTITION).select(
            F.lit(FLOOR).alias("change"), F.lit(None).cast("bigint").alias("batch"), *TOPIC_PARTITION,
            F.lit(None).cast("string").alias("file"),
            F.greatest("before", F.least("earliest", "latest")).alias("earliest"), "latest",
        )
        floors = write_out(floors, "floors")
        low = floors.select(*TOPIC_PARTITION, F.col("earliest").alias("floor"))
        gone = self.files(version).join(low, TOPIC_PARTITION).where("latest <= floor").select(
            F.lit(DROPPED).alias("change"), "batch", *TOPIC_PARTITION, "file", "earliest", "latest"
        )
        self._commit(version + 1, floors.unionByName(gone), True)
        return version + 1

    def compact(self, at_least: int = 2) -> int | None:
        """Join the files of topic partitions that have ``at_least`` so many into new ones.

        Offsets and records stay as they are. Returns the new version, None if nothing was to do.
        """
        version = self.version()
        files = self.files(version)
        many = files.groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("n"))
        many = many.where(F.col("n") >= at_least).drop("n")
        old = write_out(files.join(many, TOPIC_PARTITION, "left_semi"), "old")
        if old.isEmpty():
            return None
        floors = self._floors(version).drop("end")
        records = self._read(old).drop("batch").join(floors, TOPIC_PARTITION, "left")
        records = records.where("floor IS NULL OR offset >= floor").drop("floor")
        by = [*TOPIC_PARTITION, "offset"]
        added = self._write(version + 1, records.repartitionByRange(*by).sortWithinPartitions(*by))
        gone = old.select(
            F.lit(DROPPED).alias("change"), "batch", *TOPIC_PARTITION, "file", "earliest", "latest"
        )
        self._commit(version + 1, added.unionByName(gone), True)
        return version + 1

    def vacuum(self) -> int:
        """Remove attempts that the newest version has no file of; how many those were.

        For times when nobody publishes, compacts or reads an older version.
        """
        used = {r.a for r in self.files().selectExpr("substring_index(file, '/', 2) AS a").distinct().collect()}
        removed = 0
        for batch in file_names(self.spark, self.records_path):
            for attempt in file_names(self.spark, f"{self.records_path}/{batch}"):
                if f"{batch}/{attempt}" not in used:
                    delete_folder(self.spark, f"{self.records_path}/{batch}/{attempt}")
                    removed += 1
        return removed


def partition_catalog(log: DataFrame) -> DataFrame:
    """Earliest and latest (exclusive) offset found in the records themselves."""
    return log.groupBy(*TOPIC_PARTITION).agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest")
    )


def select_topics(
    df: DataFrame,
    include: Sequence[str] | None = None,
    exclude_containing: Sequence[str] = INTERNAL_TOPICS,
    pattern: str | None = None,
    predicate: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rows of the chosen topics.

    Topics whose name contains an excluded text are dropped; the others must
    pass every given test: a list, a regular expression, a column predicate.
    """
    topic = F.col("topic")
    for text in exclude_containing:
        df = df.where(~topic.contains(text))
    if include is not None:
        df = df.where(topic.isin(list(include)))
    if pattern is not None:
        df = df.where(topic.rlike(pattern))
    if predicate is not None:
        df = df.where(predicate(topic))
    return df


def scan_ranges(log: DataFrame, ranges: DataFrame, written: bool = False) -> DataFrame:
    """The records whose offset lies in the range of their topic partition.

    The ranges are written out first, unless they are ``written`` already:
    Catalyst then knows their size, joins them without moving the log when they
    are small, and prunes the log's topic and partition directories by them.
    The outermost offsets become plain bounds that reach the parquet reader.
    """
    fixed = ranges.select(*TOPIC_PARTITION, "from_offset", "until_offset")
    if not written:
        fixed = write_out(fixed, "ranges")
    low, high = fixed.agg(F.min("from_offset"), F.max("until_offset")).first()
    if low is None:
        return log.where(F.lit(False))
    bounded = log.where((F.col("offset") >= low) & (F.col("offset") < high))
    return (
        bounded.join(fixed.where("until_offset > from_offset"), TOPIC_PARTITION)
        .where("offset >= from_offset AND offset < until_offset")
        .drop("from_offset", "until_offset")
    )
