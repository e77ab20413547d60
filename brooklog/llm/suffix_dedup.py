"""Remove bytes of 100-byte strings that occur earlier in the corpus.

Strings are compared in a collection Burrows-Wheeler transform with its common
prefixes, built column by column: each round takes one symbol of every string of
the collection, from the last to the first, works out where its suffix goes from
the transform so far, and inserts it (``collection_bwt``). Suffixes that follow
each other with a common prefix of at least ``length`` start with the same string.

Rounds are as many as the longest member has symbols, and each reads the
transform once, so whole documents can't be the members: a corpus is first cut
into pieces of under 1.3 * ``length`` bytes around anchors (``repeats``), of
which those without any counterpart drop out, and pieces that share their core
form a collection of bounded size. The sequential files of the external method
are the arrays of such a collection; Spark's shuffle files hold the rest.

Texts are UTF-8 bytes, null and empty texts have none. A text may repeat itself.
Ties, repeated rows and null ids are ordered as ``repeats`` says. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.llm.blocks import blocks, mix, signed
from brooklog.llm.repeats import (
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

#: Bytes of a string, and of the anchors that find it.
LENGTH = 100
GRAM = 24
#: Pieces have this many starts of strings at most.
STEP = 26
#: Pieces that one collection holds, if a core has no more.
COLLECTION = 8192
#: Cores with more pieces than this are compared string by string.
CORE_LIMIT = COLLECTION // 2


def collection_bwt(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes of a collection of byte strings, one column a round.

    ``data`` must not hold the byte 255, which UTF-8 never does. Returns the
    symbols before all suffixes in their order (0: none, else byte + 1), and the
    length that each suffix has in common with the one before it. Ends of
    strings differ from each other and sort by the strings' numbers.
    """
    codes = data + np.uint8(1)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    # a common prefix is no longer than a string, and one more marks none
    kind = np.min_scalar_type(int(sizes.max(initial=0)) + 1)
    none = kind.type(np.iinfo(kind).max)
    before = np.zeros(n, np.uint8)
    some = sizes > 0
    before[some] = codes[offsets[1:][some] - 1]
    common = np.zeros(n, kind)
    active = np.flatnonzero(some)
    place = active.copy()
    done = 0
    while len(active):
        done += 1
        order = np.argsort(before, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends = int(np.count_nonzero(before == 0))
        mine = rank[place]
        symbol = before[place]
        # common prefixes of the new suffixes, and of those that follow them
        touched = np.zeros(len(order) + 1, bool)
        touched[mine] = True
        touched[mine + 1] = True
        touched[-1] = False
        at = np.flatnonzero(touched)
        same = (at > ends) & (before[order[at]] == before[order[at - 1]])
        at = at[same]
        values = np.zeros(0, kind)
        if len(at):
            edges = np.empty(2 * len(at), np.int64)
            edges[0::2] = order[at - 1] + 1
            edges[1::2] = order[at] + 1
            padded = np.append(common, none)
            values = np.minimum.reduceat(padded, edges)[0::2] + kind.type(1)
        target = n + mine - ends
        old = np.ones(len(before) + len(mine), bool)
        old[target] = False
        rest = sizes[active] - done
        following = np.zeros(len(active), np.uint8)
        more = rest > 0
        following[more] = codes[offsets[:-1][active[more]] + rest[more] - 1]
        grown = np.empty(len(old), np.uint8)
        grown[old] = before
        grown[target] = following
        shared = np.zeros(len(old), kind)
        shared[old] = common
        shared[n + at - ends] = values
        before, common = grown, shared
        active, place = active[more], target[more]
    return before, common


def equal_strings(data: np.ndarray, offsets: np.ndarray, length: int):
    """(member, start, class) of every string of ``length`` bytes; equal ones share a class."""
    before, common = collection_bwt(data, offsets)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    order = np.argsort(before, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ends = int(np.count_nonzero(before == 0))
    classes = np.cumsum(common < length)
    who, place = np.arange(n), np.arange(n)
    found = []
    for done in range(1, int(sizes.max(initial=0)) + 1):
        keep = sizes[who] >= done
        who, place = who[keep], n + rank[place[keep]] - ends
        if done >= length:
            found.append((who, sizes[who] - done, classes[place]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


_PIECES = (
    "anchor long, content long, doc long, tag long, at int, windows short, piece binary"
)


def _pieces(texts: DataFrame, shape: Shape, step: int) -> DataFrame:
    """Cut segments so that all strings of a piece share ``length - step + 1`` bytes.

    That core, hashed, is the piece's new anchor.
    """

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
                # a string that starts ``back`` before its anchor is in cell back // step
                high, low = lead // step, (lead - windows + 1) // step
                cells = high - low + 1
                row = np.repeat(np.arange(len(at)), cells)
                cell = high[row] - (np.arange(len(row)) - (np.cumsum(cells) - cells)[row])
                top = np.minimum(lead[row], cell * step + step - 1)
                bottom = np.maximum(lead[row] - windows[row] + 1, cell * step)
                anchor = block.offsets[text][row] + at[row] + lead[row]
                begin, many = anchor - top, top - bottom + 1
                end = begin + many - 1 + shape.length
                core = anchor - cell * step
                keys = symbols.runs(0, core, core - step + 1 + shape.length)
                content = mix(symbols.runs(1, begin, end) ^ (top - cell * step).astype(np.uint64))
                sizes = end - begin
                flat = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                offsets = np.zeros(len(sizes) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                piece = pa.Array.from_buffers(
                    pa.binary(),
                    len(sizes),
                    [None, pa.py_buffer(offsets), pa.py_buffer(block.data[flat].tobytes())],
                )
                whose = text[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(keys)),
                        pa.array(signed(content)),
                        pa.array(ids[block.first + whose]),
                        pa.array(tags[block.first + whose]),
                        pa.array((begin - block.offsets[whose]).astype(np.int32)),
                        pa.array(many.astype(np.int16)),
                        piece,
                    ],
                    names=["anchor", "content", "doc", "tag", "at", "windows", "piece"],
                )

    return texts.mapInArrow(run, _PIECES)


_SPANS = "doc long, tag long, start int, size int"


def _later_strings(columns: dict[str, np.ndarray], pieces: pa.Array, length: int):
    """Spans of strings that are not the earliest of their class in this collection."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[
        pieces.offset : pieces.offset + len(pieces) + 1
    ].astype(np.int64)
    data = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    who, start, cls = equal_strings(data, offsets - offsets[0], length)
    doc, tag = columns["doc"][who], columns["tag"][who]
    at = columns["at"][who] + start
    order = np.lexsort((at, tag, doc, cls))
    doc, tag, at, cls = doc[order], tag[order], at[order], cls[order]
    head = np.diff(cls, prepend=-1) != 0
    first = np.maximum.accumulate(np.where(head, np.arange(len(cls)), 0))
    later = (doc != doc[first]) | (tag != tag[first]) | (at != at[first])
    doc, tag, at = doc[later], tag[later], at[later]
    order = np.lexsort((at, tag, doc))
    doc, tag, at = doc[order], tag[order], at[order]
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(tag) != 0) | (np.diff(at) > 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc)) - 1
    if len(doc) == 0:
        heads = tails = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[heads]),
            pa.array(tag[heads]),
            pa.array(at[heads].astype(np.int32)),
            pa.array((at[tails] - at[heads] + length).astype(np.int32)),
        ],
        names=["doc", "tag", "start", "size"],
    )


def _in_collections(pieces: DataFrame, length: int, size: int) -> DataFrame:
    """Compare the pieces of each core, several cores to a collection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def compare(table: pa.Table):
            table = table.combine_chunks()
            columns = {c: table.column(c).to_numpy() for c in ("doc", "tag", "at")}
            return _later_strings(columns, table.column("piece").chunk(0), length)

        for batch in batches:
            for k in range(0, batch.num_rows, size):
                part = batch.slice(k, size)
                held.append(part)
                rows += part.num_rows
                if rows >= size:
                    # the last core may go on in the next batch
                    table = pa.Table.from_batches(held)
                    core = table.column("anchor").to_numpy()
                    whole = int(np.searchsorted(core, core[-1]))
                    if whole:
                        yield compare(table.slice(0, whole))
                        held = table.slice(whole).to_batches()
                        rows -= whole
        if rows:
            yield compare(pa.Table.from_batches(held))

    return (
        pieces.select("anchor", "doc", "tag", "at", "piece")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(run, _SPANS)
    )


def _string_by_string(pieces: DataFrame, length: int) -> DataFrame:
    """The same for cores of any number of pieces: strings are grouped by themselves."""
    strings = pieces.select(
        "doc", "tag", "at", "windows", "piece", F.explode(F.expr("sequence(0, windows - 1)")).alias("k")
    ).selectExpr(
        "doc", "tag", "at + k AS at", f"substring(piece, k + 1, {length}) AS string"
    )
    earliest = strings.groupBy("string").agg(F.min(position()).alias("source"))
    return (
        strings.join(earliest, "string")
        .where(position() > F.col("source"))
        .selectExpr("doc", "tag", "at AS start", f"{length} AS size")
    )


def repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    collection: int = COLLECTION,
    core_limit: int = CORE_LIMIT,
) -> DataFrame:
    """Spans (doc, tag, start, size) in bytes that cover all strings occurring earlier."""
    shape = Shape("bytes", length, gram)
    whole = [f"at AS start", f"windows + {length - 1} AS size"]
    copies, leaders = settle(repeated_segments(docs, shape))
    open_texts = with_text(docs, leaders, ["at", "windows", "lead"])
    pieces = write_out(_pieces(open_texts, shape, min(STEP, shape.span)), "pieces")
    again = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = write_out(again.select("anchor"), "again")
    pieces = write_out(pieces.join(again, "anchor", "left_semi"), "pieces")
    piece_copies, mixed = settle(pieces)
    mixed = write_out(mixed, "mixed")
    sizes = mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    hot = write_out(sizes.where(F.col("n") > core_limit).select("anchor"), "hot")
    return (
        copies.selectExpr("doc", "tag", *whole)
        .unionByName(piece_copies.selectExpr("doc", "tag", *whole))
        .unionByName(
            _in_collections(mixed.join(hot, "anchor", "left_anti"), length, collection)
        )
        .unionByName(_string_by_string(mixed.join(hot, "anchor", "left_semi"), length))
    )


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(with_kept: bool):
    def cut(ids, block, text, start, size) -> pa.RecordBatch:
        gone = covered(len(block.data), block.offsets[text] + start.astype(np.int64), size)
        n = len(block.offsets) - 1
        heads = gone.copy()
        heads[1:] &= ~gone[:-1]
        inner = block.offsets[:-1][block.offsets[:-1] < len(gone)]
        heads[inner] = gone[inner]
        gone_upto = np.concatenate([[0], np.cumsum(gone)])
        heads_upto = np.concatenate([[0], np.cumsum(heads)])
        sizes = np.diff(block.offsets)
        removed = np.diff(gone_upto[block.offsets])
        raw = block.data[~gone].tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes - removed)]).tolist()
        kept = [raw[a:b] for a, b in zip(upto[:-1], upto[1:])]
        columns = [
            ids.cast(pa.int64()),
            pa.array(sizes),
            pa.array(removed),
            pa.array(np.diff(heads_upto[block.offsets])),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_kept:
            columns.append(pa.array(kept, pa.binary()))
            names.append("kept")
        assert len(ids) == n
        return pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = True, **limits
) -> DataFrame:
    """Each document without its repeated bytes.

    Returns (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept); ``kept``
    (the bytes left, which may not be UTF-8) is left out if ``texts`` is false.
    """
    with shuffles_dropped(docs.sparkSession):
        spans = write_out(repeats(docs, length, gram, **limits), "spans")
    schema = _KEPT if texts else _KEPT.rpartition(",")[0]
    return remove_spans(docs, spans, _cut(texts), schema)
