"""Compare two record sets as multisets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.schemas import TOPIC_PARTITION
from brooklog.scratch import write_out


def reconcile(
    sent: DataFrame, collected: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Records whose number of copies differs; no rows means both sides agree.

    ``missing`` records were sent more often than collected, ``extra`` ones the
    other way round; ``copies`` says by how many. Copies are netted before the
    shuffle, so a record repeated any number of times moves once per task.
    """
    names = list(columns or sent.columns)
    both = sent.select(*names, F.lit(1).alias("_n")).unionByName(
        collected.select(*names, F.lit(-1).alias("_n"))
    )
    return (
        both.groupBy(*names)
        .agg(F.sum("_n").alias("_n"))
        .where("_n <> 0")
        .select(
            *names,
            F.when(F.col("_n") > 0, "missing").otherwise("extra").alias("status"),
            F.abs("_n").alias("copies"),
        )
    )


#: Offsets whose records share a digest.
BLOCK = 1 << 16


def block_digests(records: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(topic, partition, block, records, d1, d2): digests of each block of offsets.

    Digests are sums of two hashes of each record, so they don't depend on the order, tell
    how often a record occurs, and add up to those of larger blocks.
    """
    hashes = [F.xxhash64(F.lit(k), "offset", *columns).cast("decimal(38,0)") for k in (1, 2)]
    return records.groupBy(
        *TOPIC_PARTITION, F.expr(f"offset div {block}").alias("block")
    ).agg(
        F.count(F.lit(1)).alias("records"),
        *[F.sum(h).alias(f"d{k}") for k, h in enumerate(hashes, 1)],
    )


def unequal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose digests differ, or are on one side only."""
    sums = ["records", "d1", "d2"]
    both = left.select(*keys, *sums).unionByName(
        right.select(*keys, *[(-F.col(c)).alias(c) for c in sums])
    )
    totals = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return totals.where(" OR ".join(f"{c} <> 0" for c in sums)).select(*keys)


def reconcile_log(
    sent: DataFrame, collected: DataFrame, columns: Sequence[str], block: int = BLOCK
) -> DataFrame:
    """Records (topic, partition, offset, ``columns``) whose number of copies differs.

    Both sides are digested by block of offsets, without moving a record. Digests are compared
    by topic partition first and by block where those differ, and records only of unequal
    blocks, as ``reconcile`` does. Two sides that agree cost one scan each. Different blocks
    go unseen with a chance of about 2**-126.
    """
    names = [*TOPIC_PARTITION, "offset", *columns]
    sides = [write_out(block_digests(side, columns, block), "digests") for side in (sent, collected)]
    rolled = [
        side.groupBy(*TOPIC_PARTITION).agg(*[F.sum(c).alias(c) for c in ("records", "d1", "d2")])
        for side in sides
    ]
    parts = write_out(unequal(*rolled, TOPIC_PARTITION), "unequal")
    keys = [*TOPIC_PARTITION, "block"]
    blocks = unequal(*[side.join(parts, TOPIC_PARTITION, "left_semi") for side in sides], keys)
    blocks = write_out(blocks, "unequal")
    rows = [
        side.select(*names, F.expr(f"offset div {block}").alias("block"))
        .join(blocks, keys, "left_semi")
        .select(*names)
        for side in (sent, collected)
    ]
    return reconcile(*rows, names)
