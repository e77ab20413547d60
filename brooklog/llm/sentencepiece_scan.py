"""SentencePiece encoding as a max-plus scan, and decoding.

A text is split into the pieces of a vocabulary so that the sum of their scores is
largest (the unigram model's Viterbi segmentation, in exact integers); of equal
sums the one whose last differing piece is longer wins. Characters without a
piece cost the least score less ``UNKNOWN`` and become byte pieces.

Sums over paths are products in the max-plus semiring. Where no piece can cross,
as before the space that starts a word, a text falls apart into *units*, which
are scored once per block and distinct unit, many at a time. A long document is
split into chunks that any tasks may hold. For each border a *state* says how far the
piece that crosses it reaches; a chunk's transfer matrix holds the best sum from
each state at its start to each at its end. The matrices of a document are
combined associatively into the best sums at all borders. Given those, every chunk
is traced back by itself, for each end state it can have, and the document's
true end states are picked from right to left. The result does not depend on
where a text is cut.

As in the model files this reads, a text starts with an added space, spaces become
U+2581, and all else stays. Decoding gives the text back, except that U+2581 in a
text becomes a space. Null and empty texts have no pieces. Repeated rows are encoded
each. Extra columns are not read by ``encode``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklog.llm.blocks import Block, blocks, mix, ragged, rolling
from brooklog.llm.repeats import shuffles_dropped
from brooklog.scratch import write_out

SPACE = 0x2581
UNKNOWN = 10
#: Characters of a chunk; longer documents are scanned in several.
CHUNK = 1 << 16
_NONE = np.int64(-(1 << 60))
#: Units up to this many characters are worked on many at a time.
_WIDE = 48


class Pieces:
    """A piece vocabulary with whole-number scores, ready for look-ups by hash."""

    def __init__(self, texts: list[str], scores: list[int], ids: list[int], byte_ids: list[int]):
        self.byte_ids = np.array(byte_ids, np.int32)
        known = dict(zip(texts, zip(scores, ids)))
        low = min(scores) - UNKNOWN
        single = {c for t in texts for c in t}
        self.unknown = np.int64(low)
        for c in sorted(single - set(known)):
            known[c] = (low, -1)  # a character that only longer pieces have
        self.longest = max(map(len, known))
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for c in single]] = True
        #: Whether a space is only ever found at a piece's start.
        self.parts = not any(chr(SPACE) in t.lstrip(chr(SPACE)) for t in known)
        by_length: dict[int, list[str]] = {}
        for t in known:
            by_length.setdefault(len(t), []).append(t)
        keys, values, names, lengths = [], [], [], []
        r = rolling(41)
        for size, own in by_length.items():
            codes = np.array([[ord(c) for c in t] for t in own], np.uint64)
            flat = mix(codes.reshape(-1))
            sums = r.sums(flat)
            starts = np.arange(len(own)) * size
            keys.append(r.runs(sums, starts, starts + size))
            values += [known[t][0] for t in own]
            names += [known[t][1] for t in own]
            lengths += [size] * len(own)
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array(values, np.int64)[order]
        self.ids = np.array(names, np.int32)[order]
        self.lengths = np.array(lengths, np.int64)[order]
        if np.any(self.keys[1:] == self.keys[:-1]):
            raise ValueError("two pieces have one hash")
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def spells(self, spelled: list[bytes]) -> Pieces:
        """Remember the bytes that each id stands for."""
        self.letter_counts = np.array([len(b) for b in spelled], np.int64)
        self.letter_starts = np.cumsum(self.letter_counts) - self.letter_counts
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        return self

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of several texts, whose ids stand in a row."""
        lengths = self.letter_counts[ids]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.letter_starts[ids] - upto[:-1], lengths)
        raw = self.letters[at + np.arange(len(at))].tobytes()
        edges = upto[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [raw[a:b].removeprefix(b" ") for a, b in zip(edges[:-1], edges[1:])]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        may = np.flatnonzero(self.filter[(hashes >> np.uint64(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[may]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[may]
        out[may[hit]] = at[hit]
        return out


def read_model(raw: bytes) -> Pieces:
    """The vocabulary of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=raw)
    texts, scores, ids, byte_ids = [], [], [], [0] * 256
    spelled = [b""] * model.get_piece_size()
    for i in range(model.get_piece_size()):
        if not model.is_control(i):
            spelled[i] = model.id_to_piece(i).replace(chr(SPACE), " ").encode()
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:5], 16)
            byte_ids[value], spelled[i] = i, bytes([value])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            texts.append(model.id_to_piece(i))
            scores.append(model.get_score(i))
            ids.append(i)
    whole = np.rint(scores).astype(np.int64)
    if not np.array_equal(whole, np.array(scores, np.float64)):
        whole = np.rint(np.array(scores, np.float64) * (1 << 20)).astype(np.int64)
    return Pieces(texts, whole.tolist(), ids, byte_ids).spells(spelled)


_models: dict[int, Pieces] = {}


def _model(raw: bytes) -> Pieces:
    """One per Python worker and file."""
    key = hash(raw)
    if key not in _models:
        _models[key] = read_model(raw)
    return _models[key]


def characters(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)


def borders(codes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Which characters no piece can run into from the one before."""
    known = pieces.known[codes]
    out = ~known
    out[1:] |= ~known[:-1]
    if pieces.parts:
        space = codes == SPACE
        out[1:] |= space[1:] & ~space[:-1]
    return out


class Lattice:
    """Scores of all pieces that occur in a run of characters."""

    def __init__(self, codes: np.ndarray, pieces: Pieces):
        self.codes, self.pieces = codes, pieces
        self.r = rolling(41)
        self.sums = self.r.sums(mix(codes.astype(np.uint64)))

    def find(self, starts: np.ndarray, size: int) -> np.ndarray:
        return self.pieces.find(self.r.runs(self.sums, starts, starts + size))


def segment_units(lattice: Lattice, starts: np.ndarray, sizes: np.ndarray):
    """Best pieces of many units: (scores, pieces of all in a row, how many of each).

    A piece is its number in the vocabulary; unknown characters, always units of
    their own, are -1.
    """
    pieces = lattice.pieces
    total = np.zeros(len(starts), np.int64)
    counts = np.zeros(len(starts), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        if size > _WIDE:
            for i in own:
                score, path = _segment_long(lattice, int(starts[i]), int(size))
                total[i], counts[i] = score, len(path)
                found.append((np.full(len(path), i), np.arange(len(path)), path))
            continue
        begin = starts[own]
        best = np.full((size + 1, len(own)), _NONE)
        best[0] = 0
        step = np.zeros((size + 1, len(own)), np.int64)
        which = np.full((size + 1, len(own)), -1, np.int32)
        for end in range(1, size + 1):
            for length in range(min(end, pieces.longest), 0, -1):
                piece = lattice.find(begin + end - length, length)
                if length == 1:
                    score = np.where(piece >= 0, pieces.scores[piece], pieces.unknown)
                    score = best[end - 1] + score
                    better = np.flatnonzero(score > best[end])
                    best[end, better], step[end, better] = score[better], 1
                    which[end, better] = piece[better]
                    continue
                hit = np.flatnonzero(piece >= 0)
                score = best[end - length, hit] + pieces.scores[piece[hit]]
                better = score > best[end, hit]
                hit, score = hit[better], score[better]
                best[end, hit], step[end, hit], which[end, hit] = score, length, piece[hit]
        total[own] = best[size]
        place = np.full(len(own), size)
        lanes = np.arange(len(own))
        nth = np.zeros(len(own), np.int64)
        while len(lanes):
            found.append((own[lanes], -1 - nth[lanes], which[place[lanes], lanes]))
            place[lanes] -= step[place[lanes], lanes]
            nth[lanes] += 1
            lanes = lanes[place[lanes] > 0]
        counts[own] = nth
    if not found:
        return total, np.zeros(0, np.int32), counts
    whose, nth, path = (np.concatenate(x) for x in zip(*found))
    heads = np.cumsum(counts) - counts
    # negative places count from the end
    at = np.where(nth < 0, heads[whose] + counts[whose] + nth, heads[whose] + nth)
    out = np.empty(len(path), np.int32)
    out[at] = path
    return total, out, counts


def _moves(lattice: Lattice, start: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and score of every (end, length), as arrays of size + 1 rows."""
    pieces = lattice.pieces
    wide = pieces.longest
    piece = np.full((size + 1, wide + 1), -1, np.int32)
    score = np.full((size + 1, wide + 1), _NONE)
    for length in range(1, min(wide, size) + 1):
        ends = np.arange(length, size + 1)
        found = lattice.find(start + ends - length, length)
        hit = found >= 0
        piece[ends[hit], length] = found[hit]
        score[ends[hit], length] = pieces.scores[found[hit]]
        if length == 1:
            score[ends[~hit], 1] = pieces.unknown
    return piece, score


def forward(score: np.ndarray, initial: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best sums at every place from initial sums at the first places, and their last steps.

    ``initial`` is (places, lanes); lanes are independent. A step of 0 is the
    initial sum itself, which stands for a piece that began earlier.
    """
    size, wide = len(score) - 1, score.shape[1] - 1
    first, lanes = initial.shape
    best = np.full((size + 1 + wide, lanes), _NONE)  # place p is row p + wide
    step = np.zeros((size + 1, lanes), np.int64)
    # lengths from the longest to 1, so that the first of equals is the longest
    descending = score[:, :0:-1]
    for p in range(size + 1):
        from_here = best[p : p + wide] + descending[p][:, None]
        pick = np.argmax(from_here, axis=0)
        value = from_here[pick, np.arange(lanes)]
        own = initial[p] if p < first else np.full(lanes, _NONE)
        stay = own >= value
        best[p + wide] = np.maximum(np.where(stay, own, value), _NONE)
        step[p] = np.where(stay, 0, wide - pick)
    return best[wide:], step


def _segment_long(lattice: Lattice, start: int, size: int) -> tuple[int, np.ndarray]:
    piece, score = _moves(lattice, start, size)
    best, step = forward(score, np.zeros((1, 1), np.int64))
    return int(best[size, 0]), _trace(piece, step[:, 0], size)[1]


def _trace(piece: np.ndarray, step: np.ndarray, place: int) -> tuple[int, np.ndarray]:
    """Where the path to ``place`` begins, and its pieces."""
    path = []
    while step[place]:
        path.append(piece[place, step[place]])
        place -= int(step[place])
    return place, np.array(path[::-1], np.int32)


def expand(path: np.ndarray, at: np.ndarray, lattice: Lattice):
    """Ids of pieces, with characters that have none as their bytes.

    ``at`` is the character each piece starts at. Returns ids and how many for each.
    """
    codes, pieces = lattice.codes, lattice.pieces
    ids = np.where(path >= 0, pieces.ids[path], -1)
    odd = np.flatnonzero((path < 0) | (ids < 0))
    counts = np.ones(len(path), np.int64)
    if len(odd) == 0:
        return ids.astype(np.int32), counts
    kinds, kind = np.unique(codes[at[odd]], return_inverse=True)
    spelled = [chr(c).encode() for c in kinds]
    counts[odd] = np.array([len(b) for b in spelled])[kind]
    out = np.repeat(ids, counts).astype(np.int32)
    heads = np.cumsum(counts) - counts
    lengths = counts[odd]
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    table = np.zeros((len(kinds), 4), np.int32)
    for i, b in enumerate(spelled):
        table[i, : len(b)] = pieces.byte_ids[list(b)]
    out[np.repeat(heads[odd], lengths) + inside] = table[np.repeat(kind, lengths), inside]
    return out, counts


def prepared(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each with its added space, and where texts start."""
    lead = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    first = lead[block.offsets]
    codes = characters(block.data.tobytes()).copy()
    codes[codes == 0x20] = SPACE
    filled = np.diff(first) > 0
    codes = np.insert(codes, first[:-1][filled], SPACE)
    return codes, first + np.concatenate([[0], np.cumsum(filled)])


def encode_units(lattice: Lattice, starts: np.ndarray, sizes: np.ndarray):
    """Ids of units in a row, how many of each, and each unit's score.

    Equal units are worked on once.
    """
    keys = lattice.r.runs(lattice.sums, starts, starts + sizes)
    _, one, kind = np.unique(keys, return_index=True, return_inverse=True)
    total, path, counts = segment_units(lattice, starts[one], sizes[one])
    # each piece's first character, to spell out those that need it
    unit = np.repeat(np.arange(len(one)), counts)
    ids, spread = expand(path, _places(path, starts[one], counts, lattice), lattice)
    per_unit = np.bincount(unit, spread, len(one)).astype(np.int64)
    begin = np.cumsum(per_unit) - per_unit
    own = per_unit[kind]
    flat = np.repeat(begin[kind] - (np.cumsum(own) - own), own)
    return ids[flat + np.arange(len(flat))], own, total[kind]


def _places(path: np.ndarray, starts: np.ndarray, counts: np.ndarray, lattice: Lattice):
    """The character each piece starts at, of paths that begin at ``starts``."""
    lengths = np.where(path >= 0, lattice.pieces.lengths[path], 1)
    upto = np.cumsum(lengths) - lengths
    heads = np.cumsum(counts) - counts
    filled = counts > 0
    return np.repeat(starts[filled] - upto[heads[filled]], counts[filled]) + upto


def encode_block(codes: np.ndarray, first: np.ndarray, pieces: Pieces):
    """Ids of all texts of a block in a row, and how many of each text."""
    n = len(first) - 1
    if len(codes) == 0:
        return np.zeros(0, np.int32), np.zeros(n, np.int64)
    cut = borders(codes, pieces)
    cut[first[:-1][first[:-1] < len(codes)]] = True
    starts = np.flatnonzero(cut)
    ids, counts, _ = encode_units(
        Lattice(codes, pieces), starts, np.diff(starts, append=len(codes))
    )
    text = np.searchsorted(first, starts, "right") - 1
    return ids, np.bincount(text, counts, n).astype(np.int64)


# --- chunks of long documents -----------------------------------------------


class Chunk:
    """A chunk's characters and those behind it that a crossing piece can reach."""

    def __init__(self, codes: np.ndarray, size: int, pieces: Pieces):
        self.lattice, self.size = Lattice(codes, pieces), size
        self.pieces = pieces
        states = pieces.longest
        cut = borders(codes, pieces)
        if len(codes) == size:
            cut = np.append(cut, True)
        # between these places the chunk is units, whatever crosses its borders
        inner = np.flatnonzero(cut[: size + 1])
        inner = inner[inner >= states - 1]
        self.split = (int(inner[0]), int(inner[-1])) if len(inner) else None
        self.units = inner
        if self.split and self.split[0] == self.split[1]:
            self.units = inner[:0]
        head = self.split[0] if self.split else None
        tail = self.split[1] if self.split else 0
        self.tail = tail
        reach = min(len(codes), size + states - 1)
        self.tail_piece, self.tail_score = _moves(self.lattice, tail, reach - tail)
        # pieces that start behind the border belong to the next chunk
        end, length = np.indices(self.tail_score.shape)
        late = (end > size - tail) & (end - length >= size - tail)
        self.tail_score[late] = _NONE
        if head is not None:
            self.head_piece, self.head_score = _moves(self.lattice, 0, head)
            ids, _, total = encode_units(
                self.lattice, self.units[:-1], np.diff(self.units)
            ) if len(self.units) else (np.zeros(0, np.int32), None, np.zeros(1, np.int64))
            self.middle, self.middle_score = ids, int(total.sum())

    def run(self, initial: np.ndarray):
        """Best sums by end state from sums by start state, for several lanes."""
        if self.split:
            best, self.head_step = forward(self.head_score, initial)
            initial = np.maximum(best[self.split[0]] + self.middle_score, _NONE)[None]
        best, self.tail_step = forward(self.tail_score, initial)
        ends = best[self.size - self.tail :][: self.pieces.longest]
        out = np.full((self.pieces.longest, initial.shape[1]), _NONE)
        out[: len(ends)] = ends
        return out

    def matrix(self) -> np.ndarray:
        """Best sum from each start state (row) to each end state (column)."""
        states = self.pieces.longest
        initial = np.full((states, states), _NONE)
        np.fill_diagonal(initial, 0)
        return self.run(initial).T

    def _ids(self, path: np.ndarray, start: int) -> np.ndarray:
        counts = np.array([len(path)])
        at = _places(path, np.array([start]), counts, self.lattice)
        return expand(path, at, self.lattice)[0]

    def trace(self, initial: np.ndarray):
        """For each end state the start state its path comes from (-1: none) and its ids."""
        ends = self.run(initial[:, None])[:, 0]
        came, ids = [], []
        for state, best in enumerate(ends):
            if best <= _NONE // 2:
                came.append(-1)
                ids.append(np.zeros(0, np.int32))
                continue
            place = self.size - self.tail + state
            start, path = _trace(self.tail_piece, self.tail_step[:, 0], place)
            found = self._ids(path, self.tail + start)
            if self.split:
                start, path = _trace(self.head_piece, self.head_step[:, 0], self.split[0])
                found = np.concatenate([self._ids(path, start), self.middle, found])
            came.append(start)
            ids.append(found)
        return came, ids


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of matrices, pair by pair."""
    out = np.full(a.shape, _NONE)
    for j in range(a.shape[2]):
        np.maximum(out, a[:, :, j, None] + b[:, j, None, :], out=out)
    return out


def scan(matrices: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... matrices, by doubling."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out[step:] = product(out[:-step], out[step:])
        step *= 2
    return out


def _split(docs: DataFrame, raw, chunk: int) -> DataFrame:
    """Rows (rid, doc_id, crc, k, size, body): chunks of documents, spread over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(raw.value)
        least = pieces.longest
        for batch in batches:
            for block in blocks(batch.column("text")):
                codes, first = prepared(block)
                for t in range(len(first) - 1):
                    own = codes[first[t] : first[t + 1]]
                    cuts = list(range(0, len(own), max(chunk, least))) + [len(own)]
                    if len(cuts) > 2 and cuts[-1] - cuts[-2] < least:
                        del cuts[-2]
                    row = batch.slice(block.first + t, 1)
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                        body = own[a : b + least - 1].tobytes().decode("utf-32-le")
                        yield pa.RecordBatch.from_arrays(
                            [
                                row.column("rid"), row.column("doc_id"), row.column("crc"),
                                pa.array([k], pa.int32()), pa.array([b - a], pa.int32()),
                                pa.array([body]),
                            ],
                            names=["rid", "doc_id", "crc", "k", "size", "body"],
                        )

    schema = "rid long, doc_id long, crc long, k int, size int, body string"
    chunks = docs.select(F.sum(F.ceil(F.length("text") / chunk))).first()[0] or 0
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.withColumn("rid", F.monotonically_increasing_id())
    rows = rows.select("rid", "doc_id", "crc", "text").mapInArrow(run, schema)
    # a number, as few bytes would be joined into one task, whatever work they are
    tasks = max(1, min(chunks, max(spread, chunks // _CHUNKS_OF_TASK)))
    return write_out(rows.repartition(tasks, "rid", "k"), "chunks")


#: Chunks that one task works on, where there are more than tasks.
_CHUNKS_OF_TASK = 64


def _codes(body) -> np.ndarray:
    return characters(body.as_py().encode())


def _in_chunks(docs: DataFrame, raw, chunk: int) -> DataFrame:
    parts = _split(docs, raw, chunk)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(raw.value)
        for batch in batches:
            found = [
                Chunk(_codes(body), size, pieces).matrix().reshape(-1)
                for body, size in zip(batch.column("body"), batch.column("size").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("k"), pa.array(found, pa.list_(pa.int64()))],
                names=["rid", "k", "matrix"],
            )

    def at_borders(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        flat = table.column("matrix").combine_chunks().flatten().to_numpy()
        states = int(np.sqrt(len(flat) // table.num_rows))
        upto = scan(flat.reshape(-1, states, states))[:, 0]
        start = np.full((1, states), _NONE)
        start[0, 0] = 0
        sums = np.concatenate([start, upto[:-1]])
        return pa.table(
            {"rid": table.column("rid"), "k": table.column("k"), "sums": pa.array(list(sums))}
        )

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(raw.value)
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(_codes(batch.column("body")[i]), batch.column("size")[i].as_py(), pieces)
                came, ids = chunk.trace(np.array(batch.column("sums")[i].as_py()))
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("rid"), row.column("doc_id"), row.column("crc"), row.column("k"),
                        pa.array([came], pa.list_(pa.int32())),
                        pa.array([ids], pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["rid", "doc_id", "crc", "k", "came", "ids"],
                )

    def pick(table: pa.Table) -> pa.Table:
        """The end state of each chunk on the best path, from the last chunk back."""
        table = table.sort_by("k")
        came = table.column("came").combine_chunks()
        came = came.flatten().to_numpy().reshape(table.num_rows, -1)
        states = np.zeros(table.num_rows, np.int32)
        for i in range(table.num_rows - 1, 0, -1):
            states[i - 1] = came[i, states[i]]
        return pa.table(
            {"rid": table.column("rid"), "k": table.column("k"), "state": pa.array(states)}
        )

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(raw.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = row.column("ids").flatten().to_numpy()
                text = pieces.texts(ids, np.array([len(ids)]))[0]
                same = zlib.crc32(text) == row.column("crc")[0].as_py()
                names = ["doc_id", "crc", "ids"]
                columns = [*[row.column(n) for n in names], pa.array([same])]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "round_trip"])

    sums = (
        parts.mapInArrow(matrices, "rid long, k int, matrix array<long>")
        .groupBy("rid")
        .applyInArrow(at_borders, "rid long, k int, sums array<long>")
    )
    sums = write_out(sums, "sums")
    traced = parts.join(sums, ["rid", "k"]).mapInArrow(
        traces, "rid long, doc_id long, crc long, k int, came array<int>, ids array<array<int>>"
    )
    traced = write_out(traced, "traced")
    # a few numbers a chunk tell the path; the ids of other end states go no further
    states = traced.select("rid", "k", "came").groupBy("rid").applyInArrow(
        pick, "rid long, k int, state int"
    )
    chosen = traced.join(write_out(states, "states"), ["rid", "k"]).select(
        "rid", "doc_id", "crc", "k", F.get("ids", F.col("state")).alias("ids")
    )
    in_order = F.array_sort(F.collect_list(F.struct("k", "ids")))
    whole = chosen.groupBy("rid", "doc_id", "crc").agg(
        F.flatten(in_order.getField("ids")).alias("ids")
    )
    return whole.select("doc_id", "crc", "ids").mapInArrow(checked, _ENCODED)


_ENCODED = "doc_id long, crc long, ids array<int>, round_trip boolean"


def encode(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, crc, ids, round_trip): piece ids of each text, and the text's CRC32.

    ``round_trip`` says that the ids decode to the text.

    ``model`` is a SentencePiece model file, read by the driver. Texts of more than
    ``chunk`` characters are scanned in chunks.
    """
    with open(model, "rb") as file:
        # a vocabulary is some hundred kilobytes, whatever the corpus
        raw = docs.sparkSession.sparkContext.broadcast(file.read())
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.crc32(text.cast("binary")).alias("crc"),
        text.alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(raw.value)
        for batch in batches:
            for block in blocks(batch.column("text"), _BLOCK):
                ids, counts = encode_block(*prepared(block), pieces)
                rows = slice(block.first, block.first + len(counts))
                back = pieces.texts(ids, counts)
                ends = block.offsets.tolist()
                same = [
                    block.data[a:b].tobytes() == own
                    for a, b, own in zip(ends[:-1], ends[1:], back)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        batch.column("crc")[rows],
                        ragged(ids, counts, pa.int32()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "crc", "ids", "round_trip"],
                )

    short = rows.where(F.length("text") <= chunk).mapInArrow(run, _ENCODED)
    with shuffles_dropped(docs.sparkSession):
        long_ = _in_chunks(rows.where(F.length("text") > chunk), raw, chunk)
    return short.unionByName(long_)


#: Bytes of text of which equal units are worked on once.
_BLOCK = 1 << 21


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of its ``ids`` (null for null).

    Bytes that are not UTF-8 become U+FFFD.
    """
    with open(model, "rb") as file:
        raw = encoded.sparkSession.sparkContext.broadcast(file.read())
    columns = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(raw.value)
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                ids = part.column("ids")
                counts = np.array([len(x) if x.is_valid else 0 for x in ids], np.int64)
                texts = [
                    own.decode(errors="replace") if x.is_valid else None
                    for x, own in zip(ids, pieces.texts(ids.flatten().to_numpy(), counts))
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*columns, "decoded"]
                )

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(run, schema)


#: Rows that are decoded at once.
_ROWS = 512


def report(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip): round_trip says that decoding gives the text."""
    return encode(docs, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip"
    )
