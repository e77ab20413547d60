"""Joins of logs with tables and with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, table: DataFrame, on: dict[str, str], how: str = "left") -> DataFrame:
    """Look each row up in a table; ``on`` maps row columns to table columns.

    No broadcast hint: Catalyst broadcasts the table only when its measured
    size fits, and adaptive execution splits hot keys of the larger case.
    ``df`` may be a stream.
    """
    condition = F.lit(True)
    for left, right in on.items():
        condition = condition & (df[left] == table[right])
    return df.join(table, condition, how).drop(*[table[c] for c in on.values()])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    within: str,
) -> DataFrame:
    """Pairs of equal keys with ``right_ts`` in [left_ts, left_ts + within].

    Both sides are also matched on a time bucket one ``within`` wide: a right
    row lies in the left row's bucket or the next, so left rows appear in two
    buckets, each pair is met once, and a hot key is spread over its buckets
    instead of being compared with itself as a whole. Works on batches and on
    watermarked streams alike.
    """
    span = F.expr(f"INTERVAL {within}")
    # adding nothing drops the event-time mark that the window column carries
    nothing = F.expr("INTERVAL '0' SECOND")
    starts = left.withColumn("_w", F.window(left_ts, within).start + nothing)
    a = starts.withColumn("_bucket", F.explode(F.array("_w", F.col("_w") + span))).drop("_w")
    b = right.withColumn("_bucket", F.window(right_ts, within).start + nothing)
    for name in [*keys, "_bucket"]:
        b = b.withColumnRenamed(name, f"_r_{name}")
    condition = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + span)
    for name in [*keys, "_bucket"]:
        condition = condition & (F.col(name) == F.col(f"_r_{name}"))
    return a.join(b, condition).drop("_bucket", *[f"_r_{k}" for k in [*keys, "_bucket"]])


def busy_keys(counts: DataFrame, keys: Sequence[str], rows: str, most: int) -> DataFrame:
    """(keys, salts): keys of over ``most`` rows, and into how many parts to spread each."""
    return counts.where(F.col(rows) > most).select(
        *keys, F.ceil(F.col(rows) / most).cast("int").alias("salts")
    )


def salted_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    within: str,
    busy: DataFrame,
    part_by: Column,
) -> DataFrame:
    """``interval_join`` whose left rows of busy keys are spread over several state partitions.

    A streaming join keeps all rows of a key and bucket in one partition's state, which
    adaptive execution does not split. ``busy`` has (keys, salts), from counts seen before
    (``busy_keys``); its rows are few. A left row of such a key goes to one part,
    by ``part_by``; right rows go to all of them, so each pair is met once, as before.
    """
    salts = F.coalesce("salts", F.lit(1))
    a = left.join(busy, list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(part_by), salts).cast("int")
    )
    b = right.join(busy, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    pairs = interval_join(
        a.drop("salts"), b.drop("salts"), [*keys, "_salt"], left_ts, right_ts, within
    )
    return pairs.drop("_salt")
