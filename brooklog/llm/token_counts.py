"""Token counts of the sections of documents that are encoded once, as a whole.

Encoding sections by themselves would count other tokens than the document has, as
tokens run over section borders. Here each whole text is encoded once, every
token keeps the range of the text it stands for, and the ranges are
interval-joined with the sections by sorted search. A token that crosses borders
is allocated by one of these rules:

* ``first``: to the section that holds its first byte,
* ``last``: to the section that holds its last byte,
* ``most``: to the section that holds most of its bytes, the earlier of equals,
* ``share``: to all of them, each by its share of the token's bytes.

Sections are character ranges [start, end) of the text, in order and without
overlap; empty ones get no tokens. Gaps between them form section -1, so that the
counts of a document always add up to its tokens. Without given sections a text's
lines are its sections, each with the ``\\n`` at its end. Null and empty texts
have no tokens, and no sections but those given, at 0. Rows are worked on by
themselves, so repeated rows give repeated results. Columns other than those
named are not read.

The vocabulary file is a parameter, read by the driver; special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.llm.blocks import blocks

RULES = ("first", "last", "most", "share")


class Encoder:
    """A byte-level BPE from a file's lines of tokens and ranks, with each token's bytes."""

    def __init__(self, raw: bytes, pattern: str):
        pairs = [line.split() for line in raw.splitlines() if line]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.own = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """The byte after each token of the text."""
        ids = np.array(self.own.encode_ordinary(text), np.int64)
        return np.cumsum(self.sizes[ids])


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(raw: bytes, pattern: str) -> Encoder:
    """One per Python worker and vocabulary."""
    key = (hash(raw), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(raw, pattern)
    return _encoders[key]


def allocate(
    ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int, rule: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Tokens, tokens that cross a border, and bytes, by section; and tokens outside.

    ``ends`` are tokens' last byte plus one, ``starts`` and ``stops`` the sections'
    byte ranges, all sorted; ``size`` is the text's.
    """
    k = len(starts)
    # cut the text into sections and gaps: piece j is [cuts[j], cuts[j + 1])
    cuts = np.unique(np.concatenate([[0, size], starts, stops]))
    if len(cuts) < 2 or len(ends) == 0:
        return np.zeros(k), np.zeros(k, np.int64), np.zeros(k, np.int64), 0.0
    section = np.full(len(cuts) - 1, k)
    at = np.searchsorted(cuts, starts)
    filled = stops > starts
    # sections hold whole pieces, as nothing else begins inside them
    section[at[filled]] = np.flatnonzero(filled)
    begin = np.concatenate([[0], ends[:-1]])
    a = np.searchsorted(cuts, begin, "right") - 1
    b = np.searchsorted(cuts, ends, "left") - 1
    spread = b - a + 1
    token = np.repeat(np.arange(len(ends)), spread)
    piece = np.arange(len(token)) - (np.cumsum(spread) - spread)[token] + a[token]
    part = np.minimum(ends[token], cuts[piece + 1]) - np.maximum(begin[token], cuts[piece])
    crossing = np.bincount(section[piece], (spread > 1)[token], k + 1).astype(np.int64)
    size_of = np.bincount(section[piece], part, k + 1).astype(np.int64)
    if rule == "share":
        counts = np.bincount(section[piece], part / (ends - begin)[token], k + 1)
    else:
        heads = np.cumsum(spread) - spread
        if rule == "first":
            chosen = heads
        elif rule == "last":
            chosen = heads + spread - 1
        else:
            # the largest part of each token, the first of equals
            rank = part * (int(spread.max()) + 1) - (np.arange(len(token)) - heads[token])
            best = np.maximum.reduceat(rank, heads)
            chosen = np.flatnonzero(rank == best[token])
        counts = np.bincount(section[piece[chosen]], minlength=k + 1).astype(float)
    return counts[:k], crossing[:k], size_of[:k], float(counts[k])


_SCHEMA = (
    "doc_id long, section int, start int, end int, n_bytes long, n_tokens {}, n_crossing long"
)


def _line_sections(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the lines of a text, each with its line end."""
    stops = np.flatnonzero(data == 0x0A) + 1
    if len(data) and (len(stops) == 0 or stops[-1] < len(data)):
        stops = np.append(stops, len(data))
    return np.concatenate([[0], stops[:-1]]).astype(np.int64)[: len(stops)], stops


def count_tokens(
    docs: DataFrame, vocabulary: str, pattern: str, rule: str = "most", sections: bool = False
) -> DataFrame:
    """Tokens by document and section: (doc_id, section, start, end, n_bytes, n_tokens, n_crossing).

    ``docs`` has doc_id and text and, if ``sections`` is set, a column ``sections``
    of arrays of structs (start, end) in characters (``gather_sections`` makes it from
    a table). ``n_crossing`` counts tokens that also lie in another section or gap.
    ``n_tokens`` is a double for the rule ``share``, else a long. Section -1, with
    null ends, is listed where tokens are allocated to no section.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = "double" if rule == "share" else "long"
    # a vocabulary is about a megabyte, whatever the corpus; tasks need no file
    with open(vocabulary, "rb") as file:
        raw = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(raw.value, pattern)
        for batch in batches:
            ids, column = batch.column("doc_id").cast(pa.int64()), batch.column("text")
            given = batch.column("sections") if sections else None
            for block in blocks(column):
                out: dict[str, list] = {c: [] for c in ("row", "section", "start", "end", "bytes", "n", "x")}
                for t in range(len(block.offsets) - 1):
                    data = block.data[block.offsets[t] : block.offsets[t + 1]]
                    # characters before each byte
                    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    if given is None:
                        starts, stops = _line_sections(data)
                    else:
                        pairs = given[block.first + t].as_py() or []
                        edges = np.array([(p["start"], p["end"]) for p in pairs], np.int64)
                        edges = np.clip(edges.reshape(-1, 2), 0, chars[-1])
                        leads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                        starts, stops = leads[edges[:, 0]], leads[edges[:, 1]]
                        if np.any(stops < starts) or np.any(starts[1:] < stops[:-1]):
                            raise ValueError("sections must be in order and not overlap")
                    ends = own.ends(data.tobytes().decode()) if len(data) else stops[:0]
                    counts, crossing, sizes, outside = allocate(
                        ends, starts, stops, len(data), rule
                    )
                    k = len(starts)
                    extra = 1 if outside else 0
                    out["row"].append(np.full(k + extra, block.first + t))
                    out["section"].append(np.append(np.arange(k), [-1] * extra))
                    out["start"].append(np.append(chars[starts], [-1] * extra))
                    out["end"].append(np.append(chars[stops], [-1] * extra))
                    out["bytes"].append(np.append(sizes, [len(data) - sizes.sum()] * extra))
                    out["n"].append(np.append(counts, [outside] * extra))
                    out["x"].append(np.append(crossing, [0] * extra))
                flat = {c: np.concatenate(v) for c, v in out.items()}
                none = flat["section"] < 0
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(flat["row"].astype(np.int64))),
                        pa.array(flat["section"].astype(np.int32)),
                        pa.array(flat["start"].astype(np.int32), mask=none),
                        pa.array(flat["end"].astype(np.int32), mask=none),
                        pa.array(flat["bytes"].astype(np.int64)),
                        pa.array(flat["n"].astype(np.float64 if kind == "double" else np.int64)),
                        pa.array(flat["x"].astype(np.int64)),
                    ],
                    names=["doc_id", "section", "start", "end", "n_bytes", "n_tokens", "n_crossing"],
                )

    columns = ["doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")]
    rows = docs.select(*columns, *(["sections"] if sections else []))
    return rows.mapInArrow(run, _SCHEMA.format(kind))


def gather_sections(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the rows (doc_id, start, end) of a table as ``sections``.

    A document has as many sections as its text has borders, so a group is no larger
    than a text. Documents without any have none.
    """
    own = sections.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("sections")
    )
    rows = docs.select("doc_id", "text")
    own = own.withColumnRenamed("doc_id", "_id")
    return rows.join(own, rows["doc_id"] == own["_id"], "left").drop("_id")
