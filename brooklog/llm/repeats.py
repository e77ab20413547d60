"""Repeated passages found from winnowed anchors, for symbols that are words or bytes.

A *window* is ``length`` consecutive symbols of one text. Its *anchor* is the
gram of ``gram`` symbols in it with the smallest hash (the leftmost of equals),
so equal windows have equal anchors at equal places. Consecutive windows with
one and the same anchor form a *segment*, which is kept as a row: the anchor's
hash, a hash of all its symbols, and where it stands. Texts are thus compared by
about two rows per ``length`` symbols, and only those whose anchor occurs again
are looked at further.

Order: an occurrence is earlier if (doc_id, text, place) is smaller, a null
doc_id coming last. Rows that repeat doc_id and text are one and the same
occurrence, so neither is a copy of the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.blocks import blocks, find_words, mix, rolling, signed, window_starts
from brooklog.scratch import drop_path, fresh_path, write_out

#: Stands for a null doc_id in comparisons.
LAST = (1 << 63) - 1
_PLACE = np.uint64((1 << 24) - 1)
#: Finished writes drop their own shuffle files, instead of keeping them until the
#: driver happens to collect its garbage; and Spark's runtime filters (of at most
#: 8 MB) keep texts out of a shuffle whose join would drop them, from any size on.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


@contextmanager
def shuffles_dropped(spark: SparkSession, more: dict[str, str] | None = None):
    """Run the writes inside with ``_SETTINGS``, and with ``more``."""
    settings = _SETTINGS | (more or {})
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class Shape:
    unit: str  # "words" or "bytes"
    length: int
    gram: int

    @property
    def span(self) -> int:
        return self.length - self.gram + 1


def identity() -> tuple[Column, Column]:
    """doc, which orders the rows, and tag, a 64-bit hash that tells texts of one doc apart."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    return doc, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tag")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, tag, text): see ``identity``."""
    return docs.select(*identity(), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < width:
        rest = width - size
        out = np.minimum(out[:-rest], out[rest:])
    return out


@dataclass
class Symbols:
    """The symbols of a block, their prefix sums for two hashes, and where texts start."""

    first: np.ndarray
    sums: tuple[np.ndarray, np.ndarray]
    starts: np.ndarray | None  # byte range of each word
    ends: np.ndarray | None

    def runs(self, which: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return rolling(11 + which).runs(self.sums[which], begin, end)


def symbols_of(data: np.ndarray, offsets: np.ndarray, unit: str, two: bool = True) -> Symbols:
    a, b = rolling(11), rolling(12)
    if unit == "bytes":
        sums = (a.of_bytes(data), b.of_bytes(data) if two else None)
        return Symbols(offsets, sums, None, None)
    words = find_words(data, offsets)
    h = [r.runs(r.of_bytes(data), words.starts, words.ends) for r in (a, b)[: 1 + two]]
    sums = (a.sums(h[0]), b.sums(h[1]) if two else None)
    return Symbols(words.first, sums, words.starts, words.ends)


def segments_of(symbols: Symbols, shape: Shape):
    """Segments of a block: text, first window, windows, anchor's place after it, hashes."""
    starts, text = window_starts(symbols.first, shape.length)
    if len(starts) == 0:
        return None
    grams = len(symbols.sums[0]) - shape.gram
    at = np.arange(grams)
    hashes = symbols.runs(0, at, at + shape.gram)
    ranked = (hashes & ~_PLACE) | (at.astype(np.uint64) & _PLACE)
    low = sliding_min(ranked, shape.span)[starts] & _PLACE
    anchor = starts + ((low - starts.astype(np.uint64)) & _PLACE).astype(np.int64)
    heads = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(heads, append=len(starts))
    begin, place = starts[heads], anchor[heads]
    own = text[heads]
    content = symbols.runs(1, begin, begin + count - 1 + shape.length)
    content = mix(content ^ (place - begin).astype(np.uint64))
    return own, begin, count, place - begin, hashes[place], content


SEGMENTS = "anchor long, content long, doc long, tag long, at int, windows short, lead short"


def segments(docs: DataFrame, shape: Shape) -> DataFrame:
    """All segments of all texts, as rows of ``SEGMENTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "content", "doc", "tag", "at", "windows", "lead"]
        for batch in batches:
            ids, tags = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            for block in blocks(batch.column("text")):
                symbols = symbols_of(block.data, block.offsets, shape.unit)
                found = segments_of(symbols, shape)
                if found is None:
                    continue
                text, begin, count, lead, anchor, content = found
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(anchor)),
                        pa.array(signed(content)),
                        pa.array(ids[block.first + text]),
                        pa.array(tags[block.first + text]),
                        pa.array((begin - symbols.first[text]).astype(np.int32)),
                        pa.array(count.astype(np.int16)),
                        pa.array(lead.astype(np.int16)),
                    ],
                    names=names,
                )

    return keyed(docs).mapInArrow(run, SEGMENTS)


def position(at: Column | str = "at") -> Column:
    return F.struct("doc", "tag", F.col(at).alias("at") if isinstance(at, str) else at.alias("at"))


def repeated_segments(docs: DataFrame, shape: Shape) -> DataFrame:
    """Segments whose anchor occurs more than once anywhere, as a written table.

    Anchors are counted before their rows are shuffled, so a hot one is one row
    per task; the join that keeps their rows can be split by Spark.
    """
    spark = docs.sparkSession
    at = fresh_path(spark, "found")
    found = segments(docs, shape)
    # grams of bytes are so many that it costs less to write their segments than to hash them
    # twice; for words it is the other way round
    if shape.unit == "bytes":
        found = write_out(found, "found", at)
    again = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # a written table: a join straight behind an aggregation could not be split
    again = write_out(again.select("anchor"), "again")
    kept = write_out(found.join(again, "anchor", "left_semi"), "segments")
    drop_path(spark, at)
    return kept


def settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies and open segments among ``rows``.

    Copies equal an earlier segment in full, so that all their windows are
    repeats of it. The earliest of each kind is open if another kind shares its
    anchor: the two may still have some windows in common.
    """
    earliest = write_out(
        rows.groupBy("anchor", "content").agg(
            F.min(position()).alias("source"), F.count(F.lit(1)).alias("n")
        ),
        "kinds",
    )
    copies = rows.join(earliest.where("n > 1").drop("n"), ["anchor", "content"]).where(
        position() > F.col("source")
    )
    mixed = earliest.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    mixed = write_out(mixed.select("anchor"), "mixed")
    leaders = rows.drop("content").join(
        earliest.join(mixed, "anchor", "left_semi").select(
            "anchor", "source.doc", "source.tag", "source.at"
        ),
        ["anchor", "doc", "tag", "at"],
        "left_semi",
    )
    return copies, leaders


def with_text(docs: DataFrame, rows: DataFrame, fields: list[str]) -> DataFrame:
    """(doc, tag, text, places): each text with its rows' ``fields``, where it has any."""
    places = rows.groupBy("doc", "tag").agg(
        F.sort_array(F.collect_set(F.struct(*fields))).alias("places")
    )
    texts = keyed(docs).join(places, ["doc", "tag"])
    return texts


def remove_spans(
    docs: DataFrame, spans: DataFrame, cut: Callable, schema: str
) -> DataFrame:
    """Apply ``cut`` to blocks of texts with their removed spans.

    ``spans`` has rows (doc, tag, start, size) in symbols, which may overlap and
    repeat. Every row of ``docs`` is kept, also those with equal ids.
    """
    per_text = spans.groupBy("doc", "tag").agg(
        F.collect_list(F.col("start").cast("long")).alias("starts"),
        F.collect_list(F.col("size").cast("long")).alias("sizes"),
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *identity())
    joined = texts.join(per_text, ["doc", "tag"], "left").select(
        "doc_id", "text", "starts", "sizes"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            starts, sizes = batch.column("starts"), batch.column("sizes")
            for block in blocks(batch.column("text")):
                n = len(block.offsets) - 1
                own = starts.slice(block.first, n)
                counts = np.array([len(x) if x is not None else 0 for x in own.to_pylist()])
                yield cut(
                    ids.slice(block.first, n),
                    block,
                    np.repeat(np.arange(n), counts),
                    own.flatten().to_numpy(zero_copy_only=False),
                    sizes.slice(block.first, n).flatten().to_numpy(zero_copy_only=False),
                )

    return joined.mapInArrow(run, schema)


def covered(total: int, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of ``total`` symbols lie in any of the spans."""
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + size, -1)
    return np.cumsum(edges[:-1]) > 0
