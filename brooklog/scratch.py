"""Working tables in the shared folder named by ``spark.checkpoint.dir``.

A written table cuts lineage in a way that outlives lost executors, fixes the
outcome of a non-deterministic step, and gives Catalyst the real size of small
inputs, so that it broadcasts them only when they fit its own threshold.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The folder of working tables; where none is set, one in the shared warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/brooklog-scratch"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path that nothing has been written to yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh working table (or to ``path``) and return the table."""
    spark = df.sparkSession
    path = path or fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix`` + number at ``path``, newest first."""
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(target)]
    numbers = [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    return sorted((int(n) for n in numbers if n.isdigit()), reverse=True)


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether a finished write put a file into the folder."""
    files, target = _hadoop(spark, folder)
    names = [entry.getPath().getName() for entry in files.listStatus(target)]
    return any(n.startswith("part-") for n in names)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The parquet table at ``path``, or no rows if nothing was written yet."""
    files, target = _hadoop(spark, path)
    if files.exists(target):
        return spark.read.schema(schema).parquet(path)
    nothing = F.from_json(F.lit("{}"), schema).alias("row")
    return spark.range(0).select(nothing).select("row.*")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a working table this library wrote."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"not a working table: {path}")
    delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.delete(target, True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder, none if it is not there."""
    files, target = _hadoop(spark, folder)
    if not files.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(target))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place if there is none yet: of several callers one gets True.

    The file appears whole, by a link on local disks and elsewhere by a rename, which
    fails in HDFS where the name is taken. Stores that rename over other files can't fence.
    """
    files, target = _hadoop(spark, path)
    _, draft = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.draft")
    files.mkdirs(target.getParent())
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getScheme() != "file":
            return files.rename(draft, target)
        os.link(draft.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        files.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if it is not there."""
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return None
    source = files.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
