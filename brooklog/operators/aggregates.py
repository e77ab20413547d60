"""Counts, sizes, event-time windows and sessions."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def batch_size(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Records, characters and UTF-8 bytes, in total or per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.length(value)), F.lit(0)).alias("chars"),
        F.coalesce(F.sum(F.octet_length(value).cast("bigint")), F.lit(0)).alias("bytes"),
    )


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    aggs: Sequence[Column],
    keys: Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """Aggregate per event-time window; the same call serves batch and stream."""
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(span.alias("w"), *keys)
        .agg(*aggs)
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *keys,
            *df.agg(*aggs).columns,
        )
    )


def sliding_sums(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    sums: dict[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Sliding-window sums built from one pane per slide.

    Rows are summed once per pane, and only the panes are copied into the
    windows that hold them, so the copies do not grow with size / slide times
    the input. ``size`` must be a multiple of ``slide``.
    """
    if pd.Timedelta(size) % pd.Timedelta(slide) != pd.Timedelta(0):
        raise ValueError(f"{size} is not a multiple of {slide}")
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(
        *[F.sum(expr).alias(name) for name, expr in sums.items()]
    )
    return windowed(
        panes.withColumn("pane_start", F.col("pane.start")),
        "pane_start",
        size,
        [F.sum(name).alias(name) for name in sums],
        keys,
        slide,
    )


def session_cells(
    df: DataFrame, ts: str, gap: str, sums: dict[str, Column], keys: Sequence[str]
) -> DataFrame:
    """Sum rows per (key, cell), a cell being one gap wide.

    Two rows of one cell are less than a gap apart, hence in one session: this
    shrinks any hot key to one row per cell before anything is sorted. It is a
    plain keyed aggregation, so it also runs as a streaming query.
    """
    return df.groupBy(*keys, F.window(ts, gap).alias("cell")).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        *[F.sum(expr).alias(name) for name, expr in sums.items()],
    )


def sessions_from_cells(
    cells: DataFrame, gap: str, sums: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Join neighbouring cells whose rows are at most one gap apart."""
    in_order = Window.partitionBy(*keys).orderBy("cell.start")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.expr(f"INTERVAL {gap}")
    previous = F.lag("last_ts").over(in_order)
    opens = F.when(F.col("first_ts") <= previous + pause, 0).otherwise(1)
    return (
        cells.withColumn("_opens", opens)
        .withColumn("_session", F.sum("_opens").over(so_far))
        .groupBy(*keys, "_session")
        .agg(
            F.min("first_ts").alias("session_start"),
            (F.max("last_ts") + pause).alias("session_end"),
            *[F.sum(name).alias(name) for name in sums],
        )
        .drop("_session")
    )


def session_windows(
    df: DataFrame, ts: str, gap: str, sums: dict[str, Column], keys: Sequence[str]
) -> DataFrame:
    """Sessions per key: rows at most ``gap`` apart belong together."""
    cells = session_cells(df, ts, gap, sums, keys)
    return sessions_from_cells(cells, gap, list(sums), keys)


def closed_sessions(
    stream: DataFrame, ts: str, gap: str, sums: dict[str, Column], keys: Sequence[str]
) -> DataFrame:
    """Sessions of a watermarked stream, each given out once, when no row can reach it any more.

    Runs in append mode. A key's open sessions are its state, merged as rows come; a closed one
    leaves it. Rows of one key and batch are joined up where they are before they are moved,
    if ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is set.
    """
    # Spark joins windows that touch, so rows exactly one gap apart are together
    window = F.session_window(ts, gap).alias("_session")
    found = stream.groupBy(*keys, window).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    return found.select(
        *keys,
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        *sums,
    )


def accumulated(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """State over all input so far; in a stream, one changing row per key."""
    return df.groupBy(*keys).agg(*aggs)
