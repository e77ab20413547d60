"""Row numbers and running sums over ordered groups of any size.

A plain window puts each group into one task. Here rows are range-partitioned on
(keys, order), so one group may span many tasks; each task's slice is summed on
its own, and the sums of the slices before it are added as a base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklog.scratch import write_out

# monotonically_increasing_id keeps the row's place in its task in 33 low bits
_PLACE_BITS = (1 << 33) - 1

def ordered_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    partitions: int | None = None,
    staging: str | None = None,
) -> DataFrame:
    """``df`` sorted by (keys, order), with ``_slice`` (which task) and ``_place``.

    Written out, because slice borders come from sampling and must not change
    between the pass that sums the slices and the pass that uses the sums.
    ``staging`` names the folder, for callers that drop it afterwards.
    """
    by = [*keys, *order]
    spread = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return write_out(
        spread.sortWithinPartitions(*by).select(
            "*",
            F.spark_partition_id().alias("_slice"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias("_place"),
        ),
        "slices",
        staging,
    )


def slice_bases(slices: DataFrame, keys: Sequence[str], measure: Column) -> DataFrame:
    """Per (key, slice): the measure summed over the key's earlier slices.

    ``_base`` is null where nothing came before; ``_first`` is the key's first
    place in the slice.
    """
    per_slice = slices.groupBy(*keys, "_slice").agg(
        measure.alias("_sum"), F.min("_place").alias("_first")
    )
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return per_slice.select(*keys, "_slice", "_first", F.sum("_sum").over(earlier).alias("_base"))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    partitions: int | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Add ``name``: 0, 1, 2, … per key in the given order (order must be unique)."""
    slices = ordered_slices(df, keys, order, partitions, staging)
    # at most one row per (key, slice); written out so that its size is known
    bases = write_out(slice_bases(slices, keys, F.count(F.lit(1))), "bases")
    for key in keys:
        bases = bases.withColumnRenamed(key, f"_b_{key}")
    same = slices["_slice"] == bases["_slice"]
    for key in keys:
        same = same & slices[key].eqNullSafe(bases[f"_b_{key}"])
    return slices.join(bases, same).select(
        *df.columns,
        (F.coalesce("_base", F.lit(0)) + F.col("_place") - F.col("_first")).alias(name),
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the key's rows so far."""
    slices = ordered_slices(df, keys, order, partitions)
    # each slice is opened by a row that carries the sum of the slices before
    openers = slice_bases(slices, keys, F.sum(value)).select(
        *keys, "_slice", F.lit(-1).cast("bigint").alias("_place"), F.col("_base").alias("_add")
    )
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = slices.withColumn("_add", F.col(value)).unionByName(openers, allowMissingColumns=True)
    return (
        rows.withColumn(name, F.sum("_add").over(so_far))
        .where("_place >= 0")
        .select(*df.columns, name)
    )
