"""Remove word passages that occur earlier in the corpus (seed and extend).

Texts are joined on winnowed anchors (``repeats``). Anchors that occur in
segments of one kind only need no extension. All others are extended by their
neighbouring words to the left and to the right, all occurrences at once: two
windows are the same if anchor plus left context and anchor plus right context
are, and the earliest of them is the source of the others. Neighbouring windows whose sources
are neighbours, too, are joined into maximal repeats, and the words of these go.

Nulls and empty texts have no words and lose none. Texts shorter than a window
are left alone. A text may repeat itself. Ties, repeated rows and null ids are
ordered as ``repeats`` says. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brooklog.llm.blocks import blocks, find_words, signed
from brooklog.llm.repeats import (
    LAST,
    Shape,
    covered,
    position,
    remove_spans,
    repeated_segments,
    settle,
    shuffles_dropped,
    symbols_of,
    with_text,
)
from brooklog.scratch import write_out

#: Words of a passage, and of the anchors that find it.
LENGTH = 20
GRAM = 6

_EXTENDED = "left long, right long, doc long, tag long, at int"


def _extend(texts: DataFrame, shape: Shape) -> DataFrame:
    """A row for each window of the given segments, keyed by its two extensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            places = batch.column("places")
            for block in blocks(batch.column("text")):
                n = len(block.offsets) - 1
                own = places.slice(block.first, n)
                counts = np.diff(own.offsets.to_numpy())
                at, windows, lead = (
                    x.to_numpy(zero_copy_only=False).astype(np.int64) for x in own.flatten().flatten()
                )
                text = np.repeat(np.arange(n), counts)
                symbols = symbols_of(block.data, block.offsets, shape.unit)
                row = np.repeat(np.arange(len(at)), windows)
                step = np.arange(len(row)) - (np.cumsum(windows) - windows)[row]
                begin = symbols.first[text][row] + at[row] + step
                anchor = begin + lead[row] - step
                left = symbols.runs(0, begin, anchor + shape.gram)
                right = symbols.runs(1, anchor, begin + shape.length)
                whose = text[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(left)),
                        pa.array(signed(right)),
                        pa.array(ids[block.first + whose]),
                        pa.array(tags[block.first + whose]),
                        pa.array((at[row] + step).astype(np.int32)),
                    ],
                    names=["left", "right", "doc", "tag", "at"],
                )

    return texts.mapInArrow(run, _EXTENDED)


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs of windows that occur earlier, with the place they repeat.

    Returns (doc, tag, at, windows, source): windows ``at`` to ``at + windows - 1``
    of a text equal those from ``source`` on, window by window.
    """
    shape = Shape("words", length, gram)
    rows = repeated_segments(docs, shape)
    copies, leaders = settle(rows)
    open_texts = with_text(docs, leaders, ["at", "windows", "lead"])
    extended = write_out(_extend(open_texts, shape), "extended")
    earliest = (
        extended.groupBy("left", "right")
        .agg(F.min(position()).alias("source"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    single = extended.join(earliest, ["left", "right"]).where(position() > F.col("source"))
    fields = ["doc", "tag", "at", "windows", "source"]
    return copies.select(*fields).unionByName(
        single.withColumn("windows", F.lit(1).cast("short")).select(*fields)
    )


def joined_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, tag, start, size, source_doc, source_tag, shift): maximal repeats, in words.

    Runs of windows of a text whose sources follow each other, too, are one passage: the match
    of text and source, extended to both sides as far as the source stays the earliest. It
    ends where the words differ, or where an earlier source takes over.
    """
    runs = repeats(docs, length, gram).select(
        "doc", "tag", "at", (F.col("at") + F.col("windows")).alias("end"),
        F.col("source.doc").alias("source_doc"), F.col("source.tag").alias("source_tag"),
        (F.col("source.at") - F.col("at")).alias("shift"),
    )
    group = ["doc", "tag", "source_doc", "source_tag", "shift"]
    in_order = Window.partitionBy(*group).orderBy("at", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("at") > before, F.lit(True)).cast("int")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        runs.withColumn("opens", opens)
        .withColumn("passage", F.sum("opens").over(so_far))
        .groupBy(*group, "passage")
        .agg(
            F.min("at").alias("start"),
            (F.max("end") - F.min("at") + length - 1).cast("int").alias("size"),
        )
        .drop("passage")
    )


def maximal_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Passages of at least ``length`` words that occur earlier, as long as possible.

    Returns (doc_id, start, end, source_doc_id, source_start) in words: see ``joined_repeats``.
    """
    back = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return joined_repeats(docs, length, gram).select(
        back("doc").alias("doc_id"),
        "start",
        (F.col("start") + F.col("size")).alias("end"),
        back("source_doc").alias("source_doc_id"),
        (F.col("start") + F.col("shift")).alias("source_start"),
    )


_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cut(length: int, with_kept: bool):
    def cut(ids, block, text, start, size) -> pa.RecordBatch:
        words = find_words(block.data, block.offsets)
        gone = covered(len(words.starts), words.first[text] + start.astype(np.int64), size)
        n_words = np.diff(words.first)
        removed = np.add.reduceat(np.append(gone, False), words.first[:-1]) * (n_words > 0)
        # the kept words of the whole block, each followed by a space
        keep = ~gone
        begins, ends = words.starts[keep], words.ends[keep]
        sizes = ends - begins + 1
        out = np.full(int(sizes.sum()), 0x20, np.uint8)
        to = np.cumsum(sizes) - sizes
        inside = np.arange(len(out)) - np.repeat(to, sizes)
        real = inside < np.repeat(sizes - 1, sizes)
        out[real] = block.data[(np.repeat(begins, sizes) + inside)[real]]
        per_text = np.bincount(words.text[keep], sizes, len(n_words)).astype(np.int64)
        upto = np.cumsum(per_text)
        raw = out.tobytes()
        kept = [raw[b - p : max(b - 1, b - p)] for b, p in zip(upto.tolist(), per_text.tolist())]
        columns = [
            ids.cast(pa.int64()),
            pa.array(n_words),
            pa.array(removed.astype(np.int64)),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
        ]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_kept:
            columns.append(pa.array([k.decode() for k in kept]))
            names.append("kept")
        return pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = True
) -> DataFrame:
    """Each document without the words of its repeated passages.

    Returns (doc_id, n_words, n_removed, kept_sha256, kept); ``kept`` (the words
    left, joined by spaces) is left out if ``texts`` is false.
    """
    with shuffles_dropped(docs.sparkSession):
        spans = joined_repeats(docs, length, gram).select("doc", "tag", "start", "size")
        spans = write_out(spans, "spans")
    schema = _KEPT if texts else _KEPT.rpartition(",")[0]
    return remove_spans(docs, spans, _cut(length, texts), schema)
