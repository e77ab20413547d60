"""Hard negatives from exact integer scores, several of them from one multiplication.

Vectors become whole numbers, floor(256 * x), and a row's score is its inner product with the
anchor. Scores come from Kronecker-packed products: the components of several candidates are
biased to be positive and put into separate fields of one 64-bit integer, each as wide as the
largest sum of products. One multiplication by a biased component of the anchor then adds
to the sums of all of them, and no field runs into the next. The sums are unpacked, and what
the two biases added is taken off again, from the sums of the components.

Every anchor is compared with every row, a block of ``ANCHORS`` anchors at a time, so what is sent
to the workers is bounded; each block takes two scans of the rows. Tasks keep the best few rows
of each anchor and pass on no others, so neither a frequent label nor a vector that many rows
share makes more of them.

A row takes no part if its id, label, vector or any component is null, or a component isn't a
finite number or reaches ``LIMIT`` in magnitude, whose sums wouldn't fit a long. Shorter vectors
are continued by zeros, and empty ones are all zeros. Rows that repeat an id are separate rows, as
anchors too, but never each other's positive or negative.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklog.operators.ordered import number_rows
from brooklog.scratch import write_out

POSITIVES = 5
NEGATIVES = 10
#: A negative's score, in hundredths of the positive's, lies between these.
LEAST, MOST = 30, 90
SCALE = 256
#: Components from here on have no part.
LIMIT = 1 << 24
#: Anchors compared in one scan, and rows whose components are packed together.
ANCHORS = 4096
ROWS = 2048
#: Anchors whose scores with so many rows are in memory together.
AT_ONCE = 256
#: Stands for no row.
_NONE = -(1 << 62)


def whole_vectors(vectors: DataFrame, label: Column) -> DataFrame:
    """(id, label, parts): the rows that take part, with whole components."""
    scaled = lambda x: F.lit(float(SCALE)) * x.cast("double")
    fits = lambda x: F.coalesce(F.abs(scaled(x)) < LIMIT, F.lit(False))  # noqa: E731  NaN is larger
    parts = F.transform("embedding", lambda x: F.when(fits(x), F.floor(scaled(x))).cast("int"))
    sound = F.forall("embedding", fits)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        label.cast("long").alias("label"),
        parts.alias("parts"),
        sound.alias("sound"),
    )
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND sound").drop("sound")


@dataclass(frozen=True)
class Fields:
    """How components are packed: by their bounds and number."""

    least: int
    most: int
    size: int

    @property
    def width(self) -> int:
        """Bits that hold the largest sum of products of biased components."""
        return max(((self.most - self.least) ** 2 * self.size).bit_length(), 1)

    @property
    def each(self) -> int:
        """Candidates in one integer."""
        return max(64 // self.width, 1)

    def matrix(self, column: pa.ListArray) -> np.ndarray:
        """Rows of whole components, continued by zeros."""
        lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
        out = np.zeros((len(lengths), self.size), np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        before = np.cumsum(lengths) - lengths
        out[row, np.arange(len(row)) - before[row]] = column.flatten().to_numpy()
        return out

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """(component, integer): ``each`` rows in a row share an integer."""
        biased = (rows - self.least).astype(np.uint64)
        full = np.zeros((-(-len(rows) // self.each) * self.each, self.size), np.uint64)
        full[: len(rows)] = biased
        fields = full.reshape(-1, self.each, self.size)
        shifts = (np.arange(self.each) * self.width).astype(np.uint64)
        return np.ascontiguousarray((fields << shifts[None, :, None]).sum(axis=1, dtype=np.uint64).T)

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products of all anchors with all rows."""
        packed = self.pack(rows)
        biased = (anchors - self.least).astype(np.uint64)
        sums = np.zeros((len(anchors), packed.shape[1]), np.uint64)
        product = np.empty_like(sums)
        for part in range(self.size):
            np.multiply(biased[:, part, None], packed[part], out=product)
            sums += product
        # a single field may fill the integer: sums then hold modulo 2**64, as scores do
        mask = np.uint64((1 << min(self.width, 64)) - 1)
        fields = [(sums >> np.uint64(k * self.width)) & mask for k in range(self.each)]
        found = np.stack(fields, axis=2).reshape(len(anchors), -1)[:, : len(rows)].astype(np.int64)
        # (a - l)(c - l) = ac - l(a + c) + ll
        found += self.least * (anchors.sum(axis=1)[:, None] + rows.sum(axis=1)[None, :])
        return found - self.size * self.least**2


def bounds(rows: DataFrame) -> Fields:
    """The least and largest component, and the longest vector."""
    found = rows.select(
        F.min(F.array_min("parts")), F.max(F.array_max("parts")), F.max(F.size("parts"))
    ).first()
    least, most, size = (x or 0 for x in found)
    return Fields(min(least, 0), max(most, 0), max(size, 1))


class Best:
    """The best rows of each of many lists: by score, then by smaller id."""

    def __init__(self, lists: int, size: int):
        self.scores = np.full((lists, size), _NONE, np.int64)
        self.ids = np.zeros((lists, size), np.int64)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows for the lists ``at``; a score of ``_NONE`` is no row."""
        scores = np.concatenate([self.scores[at], scores], axis=1)
        ids = np.concatenate([self.ids[at], ids], axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, : self.scores.shape[1]]
        self.scores[at] = np.take_along_axis(scores, order, axis=1)
        self.ids[at] = np.take_along_axis(ids, order, axis=1)

    def rows(self) -> pa.RecordBatch:
        at, place = np.nonzero(self.scores != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (at, self.ids[at, place], self.scores[at, place])],
            names=["list", "id", "score"],
        )


_BEST = "list long, id long, score long"


def _tiles(batch: pa.RecordBatch, fields: Fields) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, labels, components) of some rows of a batch, in order of their ids."""
    for begin in range(0, batch.num_rows, ROWS):
        tile = batch.slice(begin, ROWS)
        ids = tile.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        own = fields.matrix(tile.column("parts"))
        yield ids[order], tile.column("label").to_numpy()[order], own[order]


def _best_positives(rows: DataFrame, anchors: tuple, fields: Fields, count: int) -> DataFrame:
    ids, labels, parts = anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), count)
        for batch in batches:
            for row_ids, row_labels, rows in _tiles(batch, fields):
                for label in np.intersect1d(row_labels, labels).tolist():
                    like, own = np.flatnonzero(labels == label), row_labels == label
                    for begin in range(0, len(like), AT_ONCE):
                        some = like[begin : begin + AT_ONCE]
                        scores = fields.scores(parts[some], rows[own])
                        scores[ids[some][:, None] == row_ids[own][None, :]] = _NONE
                        order = np.argsort(-scores, axis=1, kind="stable")[:, :count]
                        found = np.take_along_axis(scores, order, axis=1)
                        best.add(some, found, row_ids[own][order])
        yield best.rows()

    return rows.mapInArrow(run, _BEST)


def _best_negatives(
    rows: DataFrame, anchors: tuple, positives: np.ndarray, fields: Fields, count: int
) -> DataFrame:
    """Lists are numbered by anchor and place of the positive, whose scores ``positives`` has."""
    ids, labels, parts = anchors
    places = positives.shape[1]
    low = -(-LEAST * positives // 100)
    high = MOST * positives // 100
    known = positives != _NONE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids) * places, count)
        for batch in batches:
            for row_ids, row_labels, rows in _tiles(batch, fields):
                for begin in range(0, len(ids), AT_ONCE):
                    cut = slice(begin, begin + AT_ONCE)
                    scores = fields.scores(parts[cut], rows)
                    other = labels[cut, None] != row_labels[None, :]
                    other &= ids[cut, None] != row_ids[None, :]
                    scores = np.where(other, scores, _NONE)
                    order = np.argsort(-scores, axis=1, kind="stable")
                    ranked = np.take_along_axis(scores, order, axis=1)
                    for place in range(places):
                        # the first rows that aren't over the window
                        first = (ranked > high[cut, place, None]).sum(axis=1)
                        at = first[:, None] + np.arange(count)
                        inside = at < len(row_ids)
                        at = np.minimum(at, len(row_ids) - 1)
                        found = np.take_along_axis(ranked, at, axis=1)
                        inside &= (found >= low[cut, place, None]) & known[cut, place, None]
                        found = np.where(inside & (found != _NONE), found, _NONE)
                        some = np.flatnonzero((found != _NONE).any(axis=1))
                        lists = (begin + some) * places + place
                        own = row_ids[np.take_along_axis(order, at, axis=1)]
                        best.add(lists, found[some], own[some])
        yield best.rows()

    return rows.mapInArrow(run, _BEST)


def _first(found: DataFrame, count: int) -> DataFrame:
    """The first rows of each list, numbered by ``rank``; each task sends no more than that."""
    ranked = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= count)


def mine(
    vectors: DataFrame,
    label: Column | None = None,
    anchors: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels within the window.

    ``vectors`` has vec_id, embedding and, unless ``label`` tells how to work it out, label;
    ``anchors`` picks the anchors by vec_id, all rows if it is null. The positives of an
    anchor are the best rows of its label. Returns anchor_id, positive_id, rank (from 1),
    negative_id, positive_score and negative_score; ties go to the smaller id.
    """
    rows = whole_vectors(vectors, F.col("label") if label is None else label)
    fields = bounds(rows)
    chosen = vectors.where(anchors) if anchors is not None else vectors
    chosen = whole_vectors(chosen, F.col("label") if label is None else label)
    chosen = write_out(chosen.withColumn("n", F.monotonically_increasing_id()), "anchors")
    chosen = write_out(number_rows(chosen, [], ["id", "n"], "number"), "anchors")
    total = chosen.count()
    result = None
    for begin in range(0, max(total, 1), ANCHORS):
        block = chosen.where(F.col("number").between(begin, begin + ANCHORS - 1)).orderBy("number")
        block = block.select("id", "label", "parts").toArrow().combine_chunks()
        ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
        parts = block.column("parts").combine_chunks()
        own = (ids, labels, fields.matrix(parts) if len(ids) else np.zeros((0, fields.size), int))
        best = _first(_best_positives(rows, own, fields, positives), positives)
        best = write_out(best, "positives")
        found = best.toArrow()  # bounded: the anchors of a block, times the positives
        scores = np.full((len(ids), positives), _NONE, np.int64)
        at, place = found.column("list").to_numpy(), found.column("rank").to_numpy() - 1
        scores[at, place] = found.column("score").to_numpy()
        hard = _first(_best_negatives(rows, own, scores, fields, negatives), negatives)
        hard = hard.select(
            F.expr(f"list DIV {positives}").alias("anchor"),
            F.expr(f"CAST(list % {positives} + 1 AS int)").alias("place"),
            "rank",
            F.col("id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        named = best.select(
            F.col("list").alias("anchor"),
            F.col("rank").alias("place"),
            F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        numbers = chosen.select((F.col("number") - begin).alias("anchor"), F.col("id").alias("anchor_id"))
        hard = hard.join(named, ["anchor", "place"]).join(numbers, "anchor").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
        hard = write_out(hard, "negatives")
        result = hard if result is None else result.unionByName(hard)
    return result


#: The query's result in SQL, for tables where all pairs can be looked at.
MINE_SQL = """
WITH rows_ AS (
    SELECT vec_id AS id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.id AS anchor_id, c.id AS id, a.label = c.label AS same,
        CAST(list_sum(list_transform(range(1, len(a.parts) + 1), lambda i: a.parts[i] * c.parts[i])) AS BIGINT) AS score
    FROM rows_ a JOIN rows_ c ON a.id <> c.id
    WHERE a.id % 100 = 0
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
    n.id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN pairs n USING (anchor_id)
WHERE NOT n.same AND 100 * n.score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id) <= 10
"""
