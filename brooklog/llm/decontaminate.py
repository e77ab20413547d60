"""Find benchmark items inside documents by size-partitioned MinHash containment.

A short item in a long document has a tiny Jaccard similarity, so items are
partitioned by their number of shingles, and each partition compares its items
with document windows of a matching size: twice the partition's largest item,
moved on by that size. An item that a document contains in one place then has a
similarity of at least 0.19 to one window, and shares one of ``HASHES`` minimum
hashes with it but for a chance of 0.81 ** 64 = 0.0000014. That does not hold for
items of up to ``LEAST`` shingles, which fill too little of the least window: their
shingles are looked up, so that none is missed. Every candidate is verified by the
exact share of the item's shingles that the whole document has.

Words are runs of ASCII letters (case does not matter), digits and non-ASCII
characters; a shingle is five of them. An item of fewer words is one shingle of all its
words, and a document that has them in a row contains it. Null texts and others without
words match nothing. Items that repeat both id and text count once; repeated documents each give
their rows.

Items are sent to the tasks in blocks of ``BLOCK_SHINGLES`` shingles (a larger item is a block of
its own): 8 MB of shingles and 1 KB of minimum hashes for each item, at most 120 MB, where all
items have nine shingles. Each block reads the documents once. Documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.llm.blocks import (
    LOWER_ASCII,
    Block,
    blocks,
    find_words,
    ragged,
    rolling,
    signed,
    window_starts,
)
from brooklog.scratch import write_out

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 64
#: Windows are made of runs of this many shingles; items of no more are looked up.
LEAST = 8
#: Shingles of all items that are sent to a task at once.
BLOCK_SHINGLES = 1 << 20

#: Bytes between words: ASCII other than letters and digits.
NOT_WORDS = np.ones(256, bool)
NOT_WORDS[128:] = False
for _low, _high in (("0", "9"), ("a", "z"), ("A", "Z")):
    NOT_WORDS[ord(_low) : ord(_high) + 1] = False

_FACTORS = np.random.default_rng(9).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)


class Shingled:
    """The words of a block's texts, as sums for hashes of any run of them."""

    def __init__(self, block: Block):
        data = LOWER_ASCII[block.data]
        words = find_words(data, block.offsets, NOT_WORDS)
        r = rolling(21)
        self.first = words.first
        self.sums = r.sums(r.runs(r.of_bytes(data), words.starts, words.ends))

    def of(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words, and where each text's start."""
        starts, _ = window_starts(self.first, size)
        found = rolling(21).runs(self.sums, starts, starts + size)
        counts = np.maximum(np.diff(self.first) - size + 1, 0)
        return found, np.concatenate([[0], np.cumsum(counts)])


@dataclass(frozen=True)
class Partition:
    """Items of up to ``size`` shingles: their minimum hashes by hash function."""

    size: int
    minima: list[np.ndarray]  # for each function, sorted
    owner: list[np.ndarray]  # the item of each


@dataclass(frozen=True)
class Items:
    ids: list
    sets: list[np.ndarray]
    partitions: list[Partition]
    #: Shingles of the items of up to ``LEAST``, sorted, and the item of each.
    small: np.ndarray
    small_owner: np.ndarray
    #: The same for items of fewer words than a shingle, by number of words.
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def index_items(ids: list, sets: list[np.ndarray], words: list[int]) -> Items:
    """Index items by their shingles; ``words`` tells the length of those that are one."""
    short = {}
    words_of = np.array(words)
    for size in range(1, SHINGLE):
        own = np.flatnonzero(words_of == size)
        if len(own):
            keys = np.array([sets[i][0] for i in own], np.uint64)
            order = np.argsort(keys, kind="stable")
            short[size] = keys[order], own[order]
    sizes = np.where(words_of < SHINGLE, 0, [len(s) for s in sets])
    levels = np.maximum(np.ceil(np.log2(np.maximum(sizes, 1) / LEAST)), 0).astype(int)
    partitions = []
    few = np.flatnonzero((sizes > 0) & (sizes <= LEAST))
    small = np.concatenate([*(sets[i] for i in few), np.zeros(0, np.uint64)])
    small_owner = np.repeat(few, sizes[few])
    order = np.argsort(small, kind="stable")
    small, small_owner = small[order], small_owner[order]
    for level in np.unique(levels[sizes > LEAST]):
        own = np.flatnonzero(levels == level)
        low = [np.array([(sets[i] * f).min() for i in own]) for f in _FACTORS]
        order = [np.argsort(x, kind="stable") for x in low]
        partitions.append(
            Partition(
                LEAST << int(level),
                [x[o] for x, o in zip(low, order)],
                [own[o] for o in order],
            )
        )
    return Items(ids, sets, partitions, small, small_owner, short)


def _runs_of(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of ``size`` (the last of a text may be shorter), and each text's first."""
    per_text = -(-np.diff(first) // size)
    begin = np.concatenate([[0], np.cumsum(per_text)])
    text = np.repeat(np.arange(len(per_text)), per_text)
    return first[:-1][text] + (np.arange(begin[-1]) - begin[:-1][text]) * size, begin


def looked_up(
    found: np.ndarray, first: np.ndarray, sought: np.ndarray, owner: np.ndarray
) -> np.ndarray:
    """Pairs (text, item) that share a shingle, for sorted shingles of items."""
    texts = len(first) - 1
    if len(sought) == 0 or len(found) == 0:
        return np.zeros(0, np.int64)
    left = np.searchsorted(sought, found, "left")
    hits = np.flatnonzero(sought[np.minimum(left, len(sought) - 1)] == found)
    text = np.searchsorted(first, hits, "right") - 1
    # a shingle that a text repeats counts once
    own = np.unique(left[hits] * texts + text)
    left, text = own // texts, own % texts
    many = np.searchsorted(sought, sought[left], "right") - left
    row = np.repeat(np.arange(len(own)), many)
    entry = left[row] + np.arange(len(row)) - (np.cumsum(many) - many)[row]
    return text[row] + texts * owner[entry]


def candidates(found: np.ndarray, first: np.ndarray, items: Items) -> np.ndarray:
    """Pairs (text, item) of which a window and the item share a minimum hash, or,
    for a small item, the text and the item a shingle."""
    texts = len(first) - 1
    pairs = [looked_up(found, first, items.small, items.small_owner)]
    starts, begin = _runs_of(first, LEAST)
    if len(starts) == 0 or not items.partitions:
        return np.unique(pairs[0])
    for j, factor in enumerate(_FACTORS):
        low, own, size = np.minimum.reduceat(found * factor, starts), begin, LEAST
        for part in items.partitions:
            while size < part.size:
                merge, merged = _runs_of(own, 2)
                low, own, size = np.minimum.reduceat(low, merge), merged, 2 * size
            window = low.copy()
            window[:-1] = np.minimum(low[:-1], low[1:])
            tails = own[1:][np.diff(own) > 0] - 1
            window[tails] = low[tails]
            sought = part.minima[j]
            left = np.searchsorted(sought, window, "left")
            hits = np.flatnonzero(sought[np.minimum(left, len(sought) - 1)] == window)
            if len(hits) == 0:
                continue
            right = np.searchsorted(sought, window[hits], "right")
            text = np.searchsorted(own, hits, "right") - 1
            for t, a, b in zip(text, left[hits], right):
                pairs.append(t + texts * part.owner[j][a:b])
    return np.unique(np.concatenate(pairs))


def matches(block: Block, items: Items, threshold: float):
    """(text, item, shared) for each item that a text of the block contains."""
    shingled = Shingled(block)
    found, first = shingled.of()
    texts = len(first) - 1
    out = []
    for size, (sought, owner) in items.short.items():
        pairs = looked_up(*shingled.of(size), sought, owner)
        out += [(int(p % texts), int(p // texts), 1) for p in np.unique(pairs)]
    own, sorted_text = None, -1
    pairs = candidates(found, first, items)
    for t, i in sorted((int(p % texts), int(p // texts)) for p in pairs):
        if t != sorted_text:
            own, sorted_text = np.unique(found[first[t] : first[t + 1]]), t
        sought = items.sets[i]
        at = np.minimum(np.searchsorted(own, sought), len(own) - 1)
        shared = int((own[at] == sought).sum())
        if shared >= threshold * len(sought):
            out.append((t, i, shared))
    return out


def _item_sets(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                shingled = Shingled(block)
                words = np.diff(shingled.first)
                found, first = shingled.of()
                sets = [np.unique(found[a:b]) for a, b in zip(first[:-1], first[1:])]
                for i in np.flatnonzero((words > 0) & (words < SHINGLE)).tolist():
                    whole = shingled.first[i : i + 2]
                    sets[i] = rolling(21).runs(shingled.sums, whole[:1], whole[1:])
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").slice(block.first, len(sets)).cast(pa.int64()),
                        pa.array(words.astype(np.int64)),
                        ragged(signed(flat), [len(s) for s in sets], pa.int64()),
                    ],
                    names=["item_id", "words", "shingles"],
                )

    rows = items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sets = rows.mapInArrow(run, "item_id long, words long, shingles array<long>")
    # what counts is whether an item is shorter than a shingle
    sets = sets.withColumn("words", F.least("words", F.lit(SHINGLE)))
    return sets.where(F.size("shingles") > 0).distinct().orderBy("item_id", "words", "shingles")


def item_blocks(items: DataFrame, most: int = BLOCK_SHINGLES) -> Iterator[Items]:
    """Indexed items, ``most`` shingles at a time (a larger item is a block of its own)."""
    ids, sets, words, total = [], [], [], 0
    for row in _item_sets(items).toLocalIterator():
        if ids and total + len(row.shingles) > most:
            yield index_items(ids, sets, words)
            ids, sets, words, total = [], [], [], 0
        ids.append(row.item_id)
        sets.append(np.array(row.shingles, np.int64).view(np.uint64))
        words.append(row.words)
        total += len(row.shingles)
    if ids:
        yield index_items(ids, sets, words)


_FOUND = "doc_id long, item_id long, n_shared long, n_item long, containment double"


def _search(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for block in blocks(batch.column("text")):
                rows = matches(block, items, threshold)
                if not rows:
                    continue
                text, item, shared = (list(x) for x in zip(*rows))
                sizes = [len(items.sets[i]) for i in item]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([block.first + t for t in text])),
                        pa.array([items.ids[i] for i in item], pa.int64()),
                        pa.array(shared, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([s / n for s, n in zip(shared, sizes)], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "n_shared", "n_item", "containment"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _FOUND)


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """Each document's items of which it has a share of at least ``threshold``.

    ``docs`` has doc_id and text, ``items`` has item_id and text. Returns
    (doc_id, item_id, n_shared, n_item, containment).
    """
    parts = [_search(docs, block, threshold) for block in item_blocks(items)]
    if not parts:
        return docs.sparkSession.createDataFrame([], _FOUND)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def without_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item, with their columns as they were."""
    spark = docs.sparkSession
    clean = docs
    for k, block in enumerate(item_blocks(items)):
        if k:
            clean = write_out(clean, "clean")
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for part in blocks(batch.column("text")):
                    for t, _, _ in matches(part, sent.value, threshold):
                        keep[part.first + t] = False
                yield batch.filter(pa.array(keep))

        clean = clean.mapInArrow(run, docs.schema)
    return clean


#: The same by exact containment in DuckDB, over queries ``{docs}`` and ``{items}``.
CONTAINED_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}),
item_words AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {items})
SELECT d.doc_id, i.item_id, count(*) AS n_shared, any_value(i.n) AS n_item,
       count(*) / any_value(i.n) AS containment
FROM (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3),
             lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM doc_words) d
JOIN (SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM (
      SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3),
             lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM item_words)) i ON i.s = d.s
GROUP BY d.doc_id, i.item_id
HAVING count(*) >= {threshold} * any_value(i.n)
UNION ALL
SELECT d.doc_id, i.item_id, 1, 1, 1.0
FROM doc_words d JOIN (SELECT DISTINCT item_id, w FROM item_words WHERE len(w) BETWEEN 1 AND 4) i
  ON contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(i.w, ' ') || ' ')"""
