"""Interpolated modified Kneser-Ney trigram model: counted in Spark, mapped by workers.

Tokens are the words of a text, A-Z in lower case, and one end. The model is

    p(w | u v) = (c(u v w) - D) / c(u v .) + g(u v) * p(w | v)

and likewise for p(w | v) and p(w), whose counts are numbers of different words before;
p(w) is mixed with 1 / (V + 1), V different training tokens and one for all others. ``D`` is
one of three discounts for counts of 1, 2, and 3 or more, from the counts of counts of the
order, and ``g`` what they free. The first token of a text is seen from the start alone,
in raw counts, as in other implementations. All n-grams are kept, also those seen once.

Counting never brings an n-gram's occurrences together before they are summed: each
block of texts sends one entry for a distinct trigram, as packed arrays by shard of the
trigram's hash; the shards' sums go on by shard of the shorter n-gram. So a frequent word, pair
or copied text weighs as much as any other in a task. Shards are stored as sorted hash
arrays (``hash_arrays``). What the shards of pairs hold of each word is summed by range of ids,
more ranges the more shards there are, one batch of rows after the other. The trigram level, the
largest, is built, used to score and dropped in ``PARTS`` slices of contexts; the levels below
stay until the scores are written.

Null texts and empty ones have one token, the end. Rows that repeat a doc_id are separate
texts, in training and in the result. A null doc_id has no remainder and is learnt from.
Without any training text every token has probability 1. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.llm import hash_arrays as arrays
from brooklog.llm.blocks import LOWER_ASCII, blocks, find_words, mix, word_hashes
from brooklog.llm.repeats import shuffles_dropped
from brooklog.scratch import drop_path, fresh_path, write_out

#: Slices of the trigram level, a power of two.
PART_BITS = 2
PARTS = 1 << PART_BITS
#: Bytes of text whose n-grams make about one shard.
SHARD_BYTES = 1 << 23
#: Ids of one file of word statistics, at most and at least, and shards of pairs for a file.
ID_BITS = 20
LEAST_ID_BITS = 8
FILE_BITS = 3
#: Tokens handled at once; a longer text is handled alone.
TOKENS = 1 << 20
#: Texts sent to a Python process at once.
_TEXTS_AT_ONCE = 2000
#: Ids that are no words.
START, END, UNKNOWN, WORDS = 0, 1, 2, 3
_SEED = 71
_PARTIAL = "shard int, keys binary, a binary, b binary, c binary, d binary, tally array<long>"


def held_out_row(doc_id: Column) -> Column:
    """Whether a document is kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _planes(values: np.ndarray) -> bytes:
    size = values.itemsize
    planes, data = np.empty((size, len(values)), np.uint8), values.view(np.uint8)
    for i in range(size):
        planes[i] = data[i::size]
    return planes.tobytes()


def _row(shard: int, keys, *values, tally=()) -> dict:
    """A row of ``_PARTIAL``; arrays as byte planes, which compress where they are sorted."""
    packed = [_planes(np.ascontiguousarray(v)) for v in (keys, *values)]
    packed += [None] * (5 - len(packed))
    return dict(zip(("keys", "a", "b", "c", "d"), packed), shard=shard, tally=list(tally))


def _batch(rows: list[dict]) -> pa.Table:
    kinds = [("shard", pa.int32()), *[(k, pa.binary()) for k in ("keys", "a", "b", "c", "d")]]
    return pa.Table.from_pylist(rows, pa.schema([*kinds, ("tally", pa.list_(pa.int64()))]))


def _plain(packed: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(packed, np.uint8).reshape(size, -1)
    data = np.empty(planes.shape[::-1], np.uint8)
    for i in range(size):
        data[:, i] = planes[i]
    return data.view(kind).ravel()


def _all(table: pa.Table, name: str, kind=np.uint64) -> np.ndarray:
    """A packed column of all rows of a group, one array after the other."""
    return np.concatenate([_plain(x, kind) for x in table.column(name).to_pylist()])


def _tally(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


@dataclass(frozen=True)
class Discounts:
    one: float = 0.5
    two: float = 1.0
    more: float = 1.5

    @classmethod
    def of(cls, tally: list[int]) -> Discounts:
        """By the counts of counts; fixed ones where these don't give sound values."""
        n1, n2, n3, n4 = tally
        if not (n1 and n2 and n3):
            return cls()
        y = n1 / (n1 + 2 * n2)
        found = cls(1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        sound = 0 < found.one <= 1 and 0 < found.two <= 2 and 0 < found.more <= 3
        return found if sound else cls()

    def less(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts; a count of 0 stays 0."""
        steps = np.array([0.0, self.one, self.two, self.more])
        return counts - steps[np.minimum(counts, 3).astype(np.int64)]

    def freed(self, n1, n2, n3):
        return self.one * n1 + self.two * n2 + self.more * n3


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that all workers need."""

    folder: str
    bits: int
    bases: tuple[int, ...]  # id of the first word of each shard, counted from 0
    texts: int
    tokens: int
    kinds: int  # distinct tokens
    id_bits: int = ID_BITS  # of an id, its place in a file of word statistics
    discounts: tuple[Discounts, Discounts, Discounts] = (Discounts(),) * 3
    pairs: int = 0  # different pairs: the sum of all words' counts
    rest: float = 1.0  # what words leave to the uniform part

    def at(self, table: str) -> str:
        return f"{self.folder}/{table}"


def _bits(docs: DataFrame) -> int:
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(PART_BITS + 1, int(np.ceil(np.log2(max(size / SHARD_BYTES, 1)))))


def _id_bits(ids: int, bits: int) -> int:
    """Each shard of pairs sends rows to all files; with a file for every few shards, none gets more.

    Only small vocabularies of large corpora meet in files of the least size.
    """
    files = 1 << max(bits - FILE_BITS, 0)
    return min(ID_BITS, max(LEAST_ID_BITS, ((ids - 1) // files).bit_length()))


def _vocabulary(docs: DataFrame, folder: str, bits: int) -> Model:
    """Count the words of the training texts."""

    def counted(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        words = np.sort(np.concatenate(hashes))
        heads = arrays.heads_of(words)
        keys, counts = words[heads], np.diff(heads, append=len(words)).astype(np.uint64)
        rows = [_row(shard, keys[cut], counts[cut]) for shard, cut in arrays.by_shard(keys, bits)]
        yield from _batch(rows).to_batches()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [np.zeros(0, np.uint64)], 0
        for batch in batches:
            for block in blocks(batch.column("text")):
                data = LOWER_ASCII[block.data]
                held.append(word_hashes(data, find_words(data, block.offsets), _SEED))
                total += len(held[-1])
                if total >= 2 * TOKENS:
                    yield from counted(held)
                    held, total = held[:1], 0
        yield from counted(held)

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = arrays.summed(_all(table, "keys"), _all(table, "a"))
        arrays.put(f"{folder}/words", f"key-{shard}", keys)
        arrays.put(f"{folder}/words", f"count-{shard}", counts.astype(np.float64))
        return pa.table(
            {"shard": pa.array([shard], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())]}
        )

    learnt = docs.where("NOT held_out")
    found = learnt.select("text").mapInArrow(count, _PARTIAL)
    sizes = found.groupBy("shard").applyInArrow(merge, "shard int, n long, tokens long")
    sizes = {r.shard: r for r in write_out(sizes, "words").collect()}
    texts = learnt.count()
    n = [sizes[s].n if s in sizes else 0 for s in range(1 << bits)]
    if sum(n) >= (1 << 32) - WORDS:
        raise ValueError("more than 2**32 different words: their ids don't fit")
    bases = tuple(np.cumsum([0, *n[:-1]]).tolist())
    tokens = sum(r.tokens for r in sizes.values()) + texts
    id_bits = _id_bits(sum(n) + WORDS, bits)
    return Model(folder, bits, bases, texts, tokens, sum(n) + (texts > 0), id_bits)


_TEXTS = "n_tokens long, n_known long, base_score double, ids binary"


def _encoded(docs: DataFrame, model: Model) -> DataFrame:
    """Texts as word ids with an end, and their score by words alone."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = arrays.Maps(model.at("words"))
        whole = model.tokens + 0.5 * (model.kinds + 1)
        for batch in batches:
            for block in blocks(batch.column("text"), 1 << 21):
                data = LOWER_ASCII[block.data]
                found = find_words(data, block.offsets)
                keys, _, back = arrays.distinct(word_hashes(data, found, _SEED))
                ids, counts = np.full(len(keys), UNKNOWN, np.uint32), np.zeros(len(keys))
                for shard, part in arrays.by_shard(keys, model.bits):
                    at, there = words.places(shard, keys[part])
                    ids[part] = np.where(there, at + (model.bases[shard] + WORDS), UNKNOWN)
                    own = words.array(f"count-{shard}", np.float64)
                    if len(own):
                        counts[part] = np.where(there, own[at], 0.0)
                n = len(block.offsets) - 1
                sizes = np.diff(found.first) + 1
                word = np.ones(len(back) + n, bool)
                word[found.first[1:] + np.arange(n)] = False  # each text's end
                tokens = np.full(len(word), END, np.uint32)
                tokens[word] = ids[back]
                each = np.full(len(word), model.texts, np.float64)
                each[word] = counts[back]
                text = np.repeat(np.arange(n), sizes)
                bases = np.bincount(text, np.log10((each + 0.5) / whole), n)
                ends = np.concatenate([[0], np.cumsum(sizes * 4)]).astype(np.int64)
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(tokens)]
                )
                rows = slice(block.first, block.first + n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row")[rows],
                        batch.column("doc_id")[rows],
                        batch.column("held_out")[rows],
                        pa.array(sizes.astype(np.int64)),
                        pa.array(np.bincount(text, each > 0, n).astype(np.int64)),
                        pa.array(bases),
                        packed.cast(pa.binary()),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "ids"],
                )

    return docs.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, {_TEXTS}")


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, ids, offsets) for some texts of a batch at a time."""
    for block in blocks(batch.column("ids").cast(pa.large_binary()), 4 * TOKENS):
        yield (
            slice(block.first, block.first + len(block.offsets) - 1),
            np.ascontiguousarray(block.data).view(np.uint32),
            block.offsets // 4,
        )


class Triples:
    """Every token of some texts with the two before it; the first ones stand behind START."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray):
        self.last, self.starts = ids, offsets[:-1]
        self.before = self._shifted(ids)

    def _shifted(self, ids: np.ndarray) -> np.ndarray:
        out = np.empty_like(ids)
        out[1:] = ids[:-1]
        out[self.starts] = START
        return out

    def pairs(self, by: str) -> np.ndarray:
        if by == "suffix":
            return arrays.pair_key(self.before, self.last)
        return arrays.pair_key(self._shifted(self.before), self.before)

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """Keys of the two tokens before each of these."""
        before = self.before[at]
        return arrays.pair_key(np.where(before == START, before, self.before[at - 1]), before)


def triple_key(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(context + (last.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _part_of(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - PART_BITS)


def _distinct(texts: DataFrame, by: str, part: int, bits: int) -> DataFrame:
    """Distinct trigrams of each block of training texts whose ``by`` pair is in a slice.

    Rows of ``_PARTIAL``: the trigrams' keys, their pairs, and how often they occur. First
    tokens have no context, but a suffix that begins with START.
    """
    shards = bits - PART_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, offsets in _tokens(batch):
                found = Triples(ids, offsets)
                pairs = found.pairs(by)
                own = _part_of(pairs) == part
                if by == "context":
                    own &= found.before != START
                own = np.flatnonzero(own)
                pairs, last = pairs[own], found.last[own]
                context = pairs
                if by == "suffix":
                    context = found.contexts(own)
                keys = triple_key(context, last)
                order = arrays.order_of(keys)
                keys = keys[order]
                heads = arrays.heads_of(keys)
                counts = np.diff(heads, append=len(keys)).astype(np.uint32)
                keys, pairs = keys[heads], pairs[order[heads]]
                yield from _batch(
                    [
                        _row(shard, keys[cut], pairs[cut], counts[cut])
                        for shard, cut in arrays.by_shard(keys, shards)
                    ]
                ).to_batches()

    return texts.where("NOT held_out").select("ids").mapInArrow(run, _PARTIAL)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of a shard: (keys, pairs, counts)."""
    keys, pairs = _all(table, "keys"), _all(table, "a")
    counts = _all(table, "b", np.uint32).astype(np.uint64)
    order = arrays.order_of(keys)
    keys = keys[order]
    heads = arrays.heads_of(keys)
    return keys[heads], pairs[order[heads]], np.add.reduceat(counts[order], heads)


_TALLY = -1  # shard of rows that carry counts of counts
_CONTEXT, _ENDED = 0, 1  # rows for words as contexts, and for words that end pairs


def _groups(sorted_values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, slice) of each run of equal values."""
    heads = np.flatnonzero(np.diff(sorted_values.astype(np.int64), prepend=-1))
    for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), len(sorted_values)]):
        yield int(sorted_values[begin]), slice(begin, end)


def _lower(texts: DataFrame, model: Model, part: int) -> DataFrame:
    """Write a slice of the pairs' counts; rows with sums for the words in them.

    A pair counts the different words before it, or its occurrences at the start of a text.
    """
    bits, folder, id_bits = model.bits, model.at("pairs"), np.uint64(model.id_bits)

    def by_suffix(table: pa.Table) -> pa.Table:
        _, pairs, counts = _merged(table)
        opening = (arrays.unmix(pairs) >> np.uint64(32)) == START
        rows = [_row(_TALLY, pairs[:0], tally=_tally(counts[~opening]))]
        pairs, counts = arrays.summed(pairs, np.where(opening, counts, np.uint64(1)))
        rows += [
            _row(shard, pairs[cut], counts[cut]) for shard, cut in arrays.by_shard(pairs, bits)
        ]
        return _batch(rows)

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard == _TALLY:
            tally = np.sum(table.column("tally").to_pylist(), axis=0)
            return _batch([_row(_TALLY, np.zeros(0, np.uint64), tally=[3, *tally.tolist()])])
        pairs, counts = arrays.summed(_all(table, "keys"), _all(table, "a"))
        arrays.put_counts(folder, shard, pairs, counts)
        rows = [_row(_TALLY, pairs[:0], tally=[2, *_tally(counts)])]
        both = arrays.unmix(pairs)
        steps = [(counts == 1), (counts == 2), (counts > 2)]
        sums = arrays.summed(both >> np.uint64(32), counts, *[s.astype(np.uint64) for s in steps])
        words, times = np.unique(both & np.uint64(0xFFFFFFFF), return_counts=True)
        for side, (ids, *values) in ((_CONTEXT, sums), (_ENDED, (words, times.astype(np.uint64)))):
            # ids and numbers of pairs fit in 32 bits, occurrences need not
            small = [ids.astype(np.uint32), values[0], *[v.astype(np.uint32) for v in values[1:]]]
            for group, cut in _groups(ids >> id_bits):
                rows.append(_row(group, *[v[cut] for v in small], tally=[side]))
        return _batch(rows)

    found = _distinct(texts, "suffix", part, bits).groupBy("shard").applyInArrow(by_suffix, _PARTIAL)
    return found.groupBy("shard").applyInArrow(merge, _PARTIAL)


def _words(sums: DataFrame, model: Model, pairs: Discounts) -> DataFrame:
    """Write the statistics of words by id: as a context, and as the end of pairs."""
    folder, id_bits = model.at("ids"), model.id_bits

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((5, 1 << id_bits), np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                at = _plain(row["keys"], np.uint32) & np.uint32((1 << id_bits) - 1)
                sums = out[4:] if row["tally"] == [_ENDED] else out[:4]
                for own, name in zip(sums, ("a", "b", "c", "d")):
                    own[at] += _plain(row[name], np.uint64 if name == "a" else np.uint32)
        total, n1, n2, n3, ended = out
        arrays.put(folder, f"total-{shard}", total.astype(np.float64))
        freed = pairs.freed(n1, n2, n3) / np.maximum(total, 1)
        arrays.put(folder, f"freed-{shard}", freed)
        arrays.put(folder, f"ended-{shard}", ended.astype(np.float64))
        counts = [int((ended == 1).sum()), int((ended == 2).sum()), int((ended > 2).sum())]
        found = [int(ended.sum()), *counts, *_tally(ended)]
        yield pa.RecordBatch.from_pydict({"n": pa.array([found], pa.list_(pa.int64()))})

    return sums.where(f"shard <> {_TALLY}").groupBy("shard").applyInArrow(dense, "n array<long>")


def _upper(texts: DataFrame, model: Model, part: int, folder: str) -> DataFrame:
    """Write the trigrams of a slice of contexts, and the contexts."""
    bits = model.bits - PART_BITS
    discounts = model.discounts[2]

    def by_context(table: pa.Table) -> pa.Table:
        keys, pairs, counts = _merged(table)
        arrays.put_counts(f"{folder}/triples", table.column("shard")[0].as_py(), keys, counts)
        steps = [(counts == 1), (counts == 2), (counts > 2)]
        found = arrays.summed(pairs, counts, *[s.astype(np.uint64) for s in steps])
        # the slice's top bits are the same in all pairs
        inner = (found[0] << np.uint64(PART_BITS)) >> np.uint64(64 - bits)
        return _batch([_row(shard, *[v[cut] for v in found]) for shard, cut in _groups(inner)])

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        found = [_all(table, n) for n in ("keys", "a", "b", "c", "d")]
        keys, total, n1, n2, n3 = arrays.summed(*found)
        arrays.put(f"{folder}/contexts", f"key-{shard}", keys)
        arrays.put(f"{folder}/contexts", f"total-{shard}", total.astype(np.float64))
        arrays.put(f"{folder}/contexts", f"freed-{shard}", discounts.freed(n1, n2, n3) / total)
        return pa.table({"n": [len(keys)]})

    found = _distinct(texts, "context", part, model.bits).groupBy("shard")
    return found.applyInArrow(by_context, _PARTIAL).groupBy("shard").applyInArrow(merge, "n long")


class Lookup:
    """Probabilities of the levels below the trigrams, from mapped arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.pairs, self.ids = arrays.Maps(model.at("pairs")), arrays.Maps(model.at("ids"))

    def by_id(self, ids: np.ndarray, *names: str) -> list[np.ndarray]:
        out = [np.zeros(len(ids)) for _ in names]
        shards, places = ids >> self.model.id_bits, ids & ((1 << self.model.id_bits) - 1)
        # numbers of files mostly fit in 16 bits, which numpy sorts in linear time
        order = np.argsort(shards.astype(np.min_scalar_type(shards.max(initial=0))), kind="stable")
        for shard, cut in _groups(shards[order]):
            mine = order[cut]
            at = places[mine]
            for values, name in zip(out, names):
                own = self.ids.array(f"{name}-{shard}", np.float64)
                if len(own):
                    values[mine] = own[at]
        return out

    def of_pairs(self, keys: np.ndarray) -> np.ndarray:
        """p(w | v) for sorted keys of (v, w)."""
        model = self.model
        both = arrays.unmix(keys)
        v, w = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        (ended,) = self.by_id(w, "ended")
        total, freed = self.by_id(v, "total", "freed")
        below = model.discounts[0].less(ended) / max(model.pairs, 1) + model.rest / (model.kinds + 1)
        own = model.discounts[1].less(self.pairs.counts(keys, model.bits))
        return np.where(total > 0, own / np.maximum(total, 1) + freed * below, below)


def _scores(texts: DataFrame, model: Model, part: int, folder: str) -> DataFrame:
    """(row, part, score): the tokens of each text whose context is in the slice."""
    bits = model.bits - PART_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = Lookup(model)
        triples, contexts = arrays.Maps(f"{folder}/triples"), arrays.Maps(f"{folder}/contexts")
        for batch in batches:
            for rows, ids, offsets in _tokens(batch):
                found = Triples(ids, offsets)
                own = found.pairs("context")
                at = np.flatnonzero(_part_of(own) == part)
                own = own[at]
                keys, some, back = arrays.distinct(triple_key(own, found.last[at]))
                counts = model.discounts[2].less(triples.counts(keys, bits))
                pairs, _, pair = arrays.distinct(own[some])
                # the slice's bits are the same in all of them
                inner = pairs << np.uint64(PART_BITS)
                total, freed = contexts.fields(pairs, inner, bits, "total", "freed")
                at_some = at[some]
                ends = arrays.pair_key(found.before[at_some], found.last[at_some])
                ends, _, end = arrays.distinct(ends)
                lower = below.of_pairs(ends)[end]
                total, freed = total[pair], freed[pair]
                # first tokens have no context, so what is left is their pair with START
                p = np.where(total > 0, counts / np.maximum(total, 1) + freed * lower, lower)
                text = np.searchsorted(offsets, at, "right") - 1
                sums = np.bincount(text, np.log10(p)[back], len(offsets) - 1).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row")[rows],
                        pa.array(np.full(len(sums), part, np.int32)),
                        pa.array(sums),
                    ],
                    names=["row", "part", "score"],
                )

    return texts.select("row", "ids").mapInArrow(run, "row long, part int, score double")


def score(docs: DataFrame) -> DataFrame:
    """Learn from the texts that are not held out, and score all.

    Returns doc_id, held_out, n_tokens, n_known (tokens of the training texts),
    train_tokens, base_score (by words alone, 0.5 added to each count) and score, the
    model's log10 probability of the text. One row for each of ``docs``.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        held_out_row(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    with shuffles_dropped(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(_TEXTS_AT_ONCE)}):
        folder = fresh_path(spark, "language-model")
        model = _vocabulary(rows.drop("row", "doc_id"), folder, _bits(rows))
        at = fresh_path(spark, "encoded")
        _encoded(rows, model).write.option("compression", "zstd").parquet(at)
        texts = spark.read.parquet(at)

        sums = [write_out(_lower(texts, model, part), "words") for part in range(PARTS)]
        every = sums[0]
        for more in sums[1:]:
            every = every.unionByName(more)
        tallies = {2: np.zeros(4, np.int64), 3: np.zeros(4, np.int64)}
        for r in every.where(f"shard = {_TALLY}").select("tally").collect():
            tallies[r.tally[0]] += r.tally[1:]  # a row for each shard of pairs
        pairs, triples = Discounts.of(tallies[2].tolist()), Discounts.of(tallies[3].tolist())
        found = [r.n for r in _words(every, model, pairs).collect()]  # a row for each file
        total, n1, n2, n3, *tally = np.sum([[0] * 8, *found], axis=0).tolist()
        words = Discounts.of(tally)
        rest = words.freed(n1, n2, n3) / total if total else 1.0
        model = replace(model, discounts=(words, pairs, triples), pairs=total, rest=rest)

        scores = []
        for part in range(PARTS):
            own = f"{folder}/slice-{part}"
            _upper(texts, model, part, own).write.format("noop").mode("overwrite").save()
            scores.append(write_out(_scores(texts, model, part, own), "scores"))
            drop_path(spark, own)
    parts = scores[0]
    for more in scores[1:]:
        parts = parts.unionByName(more)
    # a row for each slice and text, added up in the order of the slices
    total = F.aggregate(
        F.array_sort(F.collect_list(F.struct("part", "score"))), F.lit(0.0), lambda a, x: a + x["score"]
    )
    whole = parts.groupBy("row").agg(total.alias("score"))
    return texts.drop("ids").join(whole, "row").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
