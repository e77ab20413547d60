"""Runs of repeated words, from a suffix automaton whose links are a link-cut tree.

A run is a stretch of consecutive words with smallest period q (words q apart are equal)
that is at least ``EXPONENT`` periods and ``LENGTH`` words long, and that no neighbouring
word extends with that period.

Every state of a text's suffix automaton stands for sequences of words that end at the same
places; its suffix links form a tree. Appending word i means accessing the path from the state of
the first i words to the root: all its states now ended last at i. Before that, the path is made of
segments of one last end each, e, the lowest state of a segment holding the longest sequence,
of m words, that ended there. If i - e <= m, the last i - e words stand twice in a row: a square,
whose period is the smallest as no shorter part ended later. The square is extended word by word
to both sides. The preferred paths of a link-cut tree are these segments, so all accesses
of n words change O(n log n) of them. The automaton of a stretch is built before its accesses,
so that the tree no longer changes meanwhile.

Most words are in no run. ``stretches`` finds, for a block of texts at once, those that may be: words
equal to the one q before them for each period under eight, and for all others windows of eight
words that also start at most a third of the stretch earlier. No run lies outside of them, and only
they are put into automata; squares are extended in the whole text. A task holds one text, and the
automaton of one stretch, at a time.

Null and empty texts have no words and no runs; rows that repeat a doc_id are separate texts.
Words are runs of bytes other than [\\x20\\x09-\\x0D], compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.llm.blocks import blocks, find_words, mix, rolling, window_starts, word_hashes

#: Least words, and least periods, of a run.
LENGTH = 6
EXPONENT = 4
#: Words of the windows that find longer periods, and the periods looked at one by one.
GRAM = 8
_SEED = 91

Run = tuple[int, int, int]  # start, length, period


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length, link) of the states of a suffix automaton, and the state of each prefix.

    State 0 stands for none, state 1 for the empty sequence.
    """
    length, link, after = [0, 0], [0, 0], [{}, {}]
    prefixes, last = [], 1
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(1)
        after.append({})
        at = last
        while at and word not in after[at]:
            after[at][word] = new
            at = link[at]
        if at:
            target = after[at][word]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(length)
                length.append(length[at] + 1)
                link.append(link[target])
                after.append(dict(after[target]))
                while at and after[at].get(word) == target:
                    after[at][word] = copy
                    at = link[at]
                link[target] = link[new] = copy
        prefixes.append(new)
        last = new
    return length, link, prefixes


class LastEnds:
    """A tree of suffix links with preferred paths, each of one last end.

    Splay trees hold the paths, upper states to the left. ``end`` is kept at their roots.
    """

    def __init__(self, link: list[int]):
        # the state of the empty sequence takes no part
        self.up = [0 if x == 1 else x for x in link]
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.end = [-1] * len(link)

    def _to_root(self, x: int) -> None:
        """Splay ``x`` to the root of its path's tree."""
        up, left, right, end = self.up, self.left, self.right, self.end
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner and (left[z] == y) == (left[y] == x):
                turns = (y, x)
            elif inner:
                turns = (x, x)
            else:
                turns = (x,)
            for node in turns:
                top = up[node]
                over = up[top]
                if left[top] == node:
                    moved = left[top] = right[node]
                    right[node] = top
                else:
                    moved = right[top] = left[node]
                    left[node] = top
                if moved:
                    up[moved] = top
                up[top], up[node] = node, over
                if over and left[over] == top:
                    left[over] = node
                elif over and right[over] == top:
                    right[over] = node
                else:
                    end[node] = end[top]

    def access(self, state: int, place: int) -> list[tuple[int, int]]:
        """(last end, lowest state) of each segment above ``state``; all end at ``place`` now."""
        up, right, end = self.up, self.right, self.end
        found, below, at = [], 0, state
        while at:
            self._to_root(at)
            if end[at] >= 0:
                found.append((end[at], at))
            if right[at]:
                end[right[at]] = end[at]
            right[at] = below
            below, at = at, up[at]
        end[below] = place
        return found


def extended(words: np.ndarray, end: int, period: int) -> tuple[int, int]:
    """(start, length) of the run of this period around the square that ends at ``end``."""
    total, start, stop = len(words), end - 2 * period + 1, end + 1
    size = 64
    while stop < total:
        part = words[stop : stop + size]
        same = part == words[stop - period : stop - period + len(part)]
        if not same.all():
            stop += int(np.argmin(same))
            break
        stop, size = stop + len(part), size * 2
    size = 64
    while start > 0:
        low = max(start - size, 0)
        same = words[low:start] == words[low + period : start + period]
        if not same.all():
            start -= int(np.argmin(same[::-1]))
            break
        start, size = low, size * 2
    return start, stop - start


def runs_in(words: np.ndarray, begin: int, end: int) -> set[Run]:
    """Runs of a text that have a square in words[begin:end]."""
    _, symbols = np.unique(words[begin:end], return_inverse=True)
    length, link, prefixes = automaton(symbols.tolist())
    tree = LastEnds(link)
    known: dict[int, int] = {}  # last word of the newest run of a period
    found = set()
    for place, state in enumerate(prefixes):
        for before, lowest in tree.access(state, place):
            period = place - before
            if period <= length[lowest] and known.get(period, -1) < begin + place:
                start, size = extended(words, begin + place, period)
                known[period] = start + size - 1
                if size >= max(LENGTH, EXPONENT * period):
                    found.add((start, size, period))
    return found


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def stretches(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, begin, end) of words that may be in runs, in order; ``first`` as in ``Words``."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found = []
    for period in range(1, GRAM):
        same = (words[period:] == words[:-period]) & (text[period:] == text[:-period])
        begin, end = _stretches(same)
        enough = end - begin >= max(LENGTH, EXPONENT * period) - period
        found.append((begin[enough], end[enough] + period))
    starts, own = window_starts(first, GRAM)
    if len(starts):
        r = rolling(_SEED + 1)
        keys = mix(r.runs(r.sums(words), starts, starts + GRAM) + own.astype(np.uint64))
        order = np.argsort(keys, kind="stable")
        again = (keys[order][1:] == keys[order][:-1]) & (own[order][1:] == own[order][:-1])
        since = np.zeros(len(starts), np.int64)  # distance to the same window before
        since[order[1:][again]] = (order[1:] - order[:-1])[again]
        flags = since > 0
        while True:
            # a run of period q has 3q - GRAM + 1 windows that are also found q earlier
            begin, end = _stretches(flags)
            enough = end - begin >= (EXPONENT - 1) * GRAM - GRAM + 1
            begin, end = begin[enough], end[enough]
            longest = (end - begin + GRAM - 1) // (EXPONENT - 1)
            kept = np.zeros(len(flags), bool)
            at = np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin)
            at = at + np.arange(len(at))
            kept[at] = since[at] <= np.repeat(longest, end - begin)
            if (kept == flags).all():
                break
            flags = kept
        low = np.maximum(starts[begin] - longest, first[own[begin]]) if len(begin) else begin
        found.append((low, starts[end - 1] + GRAM if len(end) else end))
    begins = np.concatenate([b for b, _ in found]).tolist()
    ends = np.concatenate([e for _, e in found]).tolist()
    out: list[tuple[int, int, int]] = []
    for begin, end in sorted(zip(begins, ends)):
        if out and begin < out[-1][2] and text[begin] == out[-1][0]:
            out[-1] = (out[-1][0], out[-1][1], max(out[-1][2], end))
        else:
            out.append((int(text[begin]), begin, end))
    return out


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word of a text stands at each place when every tenth text gets a periodic end."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def each_text(batch: pa.RecordBatch, places: Callable | None) -> Iterator[tuple]:
    """(row, words, runs) of each text; ``places(doc_id, n)`` may tell which word stands where."""
    ids = batch.column("doc_id").to_pylist()
    for block in blocks(batch.column("text")):
        found = find_words(block.data, block.offsets)
        hashes = word_hashes(block.data, found, _SEED)
        order: dict[int, np.ndarray] = {}
        if places:
            hashes = hashes.copy()
            for i, (begin, end) in enumerate(zip(found.first[:-1], found.first[1:])):
                own = places(ids[block.first + i], int(end - begin))
                if own is not None:
                    order[i] = own
                    hashes[begin:end] = hashes[begin:end][own]
        runs: dict[int, set[Run]] = {}
        for text, begin, end in stretches(hashes, found.first):
            low, high = found.first[text], found.first[text + 1]
            own = runs_in(hashes[low:high], begin - low, end - low)
            runs.setdefault(text, set()).update(own)
        data = block.data.tobytes()
        for i in range(len(block.offsets) - 1):
            words = data[block.offsets[i] : block.offsets[i + 1]].split()
            if i in order:
                words = [words[k] for k in order[i].tolist()]
            yield block.first + i, words, sorted(runs.get(i, ()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\x01" * (length - period)
    return [w for w, g in zip(words, gone) if not g]


def find(docs: DataFrame) -> DataFrame:
    """One row for each run: doc_id, start (number of its first word), length, period."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, _, runs in each_text(batch, None):
                if runs:
                    start, length, period = zip(*runs)
                    own = ids.take(pa.array([row] * len(runs)))
                    yield pa.RecordBatch.from_arrays(
                        [own, *[pa.array(c, pa.int64()) for c in (start, length, period)]],
                        names=["doc_id", "start", "length", "period"],
                    )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, period long"
    )


_REPORT = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def report(docs: DataFrame, places: Callable | None = None) -> DataFrame:
    """One row per document: its number of runs, the longest of them, and digests.

    Of runs of one length the one that starts first, then of the smaller period, is shown.
    ``exponent_milli`` is 1000 * length / period, rounded down. The digests are of every run's
    ``start,length,period`` and line feed, by start and period, and of the words that are left
    without repeats, joined by one space.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for _, words, runs in each_text(batch, places):
                start, size, period = (
                    min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
                )
                told = "".join("%d,%d,%d\n" % r for r in runs).encode()
                left = b" ".join(collapsed(words, runs))
                row = (
                    len(runs),
                    start,
                    size,
                    period,
                    1000 * size // period if runs else None,
                    hashlib.sha256(told).hexdigest(),
                    hashlib.sha256(left).hexdigest(),
                )
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            names = [field.split()[0] for field in _REPORT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", *names],
            )

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, {_REPORT}"
    )
