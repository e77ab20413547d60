"""Exact join of documents by the Jaccard similarity of their word shingles.

A metric-space join, in four steps over the distinct sets of shingles:

1. *Regions.* Almost all documents are at distance 1 of each other, so documents
   as pivots tell nothing apart. The first pivots are therefore parts of the
   shingle space: sets of one size class are cut into so many parts by hash
   that two sets within the radius differ in fewer parts than there are, and
   agree in at least one that is not empty. All sets with the same part form a
   region, the part's cell at distance 0. The window of sizes that the radius
   allows replicates a set to the next smaller class. Sets whose regions with others are
   fewer than the parts in which linked sets agree are done (``_agreeing``).
2. *Pivots.* In each region one set is the pivot; the distance of all others to
   it is worked out exactly, and those within the radius are linked. Regions
   whose sets are by now connected are done, which are nearly all: a group of
   copies costs one comparison a member and region, not one a pair.
3. *Recursion.* What is left are regions with sets of several components. Large ones get
   a second pivot and are divided into the two pivots' Voronoi cells; sets whose distances
   to the pivots are within the triangle inequality's window go to both, and cells are divided
   again (``_voronoi``).
4. *Leaves.* Sets of one cell are joined by how they differ from its pivot: two are compared if
   they share one of the rarest shingles that the pivot lacks (``_late_pairs``), or if the
   numbers of shingles by which they differ from the pivot are within the window that the
   triangle inequality leaves for sets without such a shingle. Pairs that are connected
   already are not compared.

Distances come from whole sets of 64-bit shingle hashes. Words are runs of bytes
other than [\\x20\\x09-\\x0D], with A-Z in lower case; a text of fewer than four
words is one shingle, and null and empty texts have none and join nothing.
Equal sets are one set. Rows that repeat a doc_id are separate documents; a null
doc_id comes last and is named as the smallest only where there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.llm.blocks import (
    LOWER_ASCII,
    Block,
    blocks,
    find_words,
    mix,
    ragged,
    rolling,
    signed,
    window_starts,
)
from brooklog.llm.graph import components
from brooklog.llm.repeats import LAST, identity, keyed, shuffles_dropped
from brooklog.llm.rows import packed, unpacked
from brooklog.scratch import drop_path, fresh_path, write_out

SHINGLE = 4
#: Least similarity, in hundredths.
PERCENT = 85
#: Size classes by number; a set is in the regions of one of each.
KINDS = ("even", "odd")


def shingle_sets(block: Block, size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's shingles as sorted distinct hashes."""
    data = LOWER_ASCII[block.data]
    words = find_words(data, block.offsets)
    r = rolling(31)
    sums = r.sums(r.runs(r.of_bytes(data), words.starts, words.ends))
    starts, _ = window_starts(words.first, size)
    found = r.runs(sums, starts, starts + size)
    counts = np.diff(words.first)
    upto = np.concatenate([[0], np.cumsum(np.maximum(counts - size + 1, 0))])
    out = []
    for i, n in enumerate(counts.tolist()):
        if n == 0:
            out.append(found[:0])
        elif n < size:
            out.append(r.runs(sums, words.first[i : i + 1], words.first[i + 1 : i + 2]))
        else:
            own = np.sort(found[upto[i] : upto[i + 1]])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
    return out


class Classes:
    """Size classes, and the parts that sets are cut into when the smaller is in a class."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = [1]

    def of(self, n: int) -> int:
        """Class ``i`` holds sizes over ``tops[i - 1]`` up to ``tops[i]``; no set can be
        linked with one more than a class away."""
        while self.tops[-1] < n:
            top = self.tops[-1]
            self.tops.append(max(100 * top // self.percent, top + 1))
        return int(np.searchsorted(self.tops, n))

    @lru_cache(maxsize=None)
    def parts(self, i: int) -> tuple[int, int]:
        """(parts, most shingles in which two linked sets differ)."""
        differ = (100 - self.percent) * self.tops[i] // self.percent
        spare = 0
        if differ >= 4:
            low = self.tops[i - 1] + 1
            empty = (differ + 1) * np.exp(-low / (differ + 1))
            spare = 1 + int(np.ceil(empty + 3 * np.sqrt(empty)))
        return differ + 1 + spare, differ

    def signatures(self, own: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """By ``KINDS``: one hash for each part that can show a link of this set, and how many of
        them a linked set has at least."""
        n = len(own)
        out = [(own[:0], 1) for _ in KINDS]
        if n == 0:
            return out
        i = self.of(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own))])
        for scheme in (i, i - 1):
            if scheme < 0 or n * self.percent > 100 * self.tops[scheme]:
                continue
            parts, differ = self.parts(scheme)
            step = np.uint64((1 << 64) // max(parts, 2) + 1)
            edges = np.arange(1, parts, dtype=np.uint64) * step
            cut = np.concatenate([[0], np.searchsorted(own, edges), [n]])
            number = np.arange(parts, dtype=np.uint64) + np.uint64(scheme << 32)
            found = mix(mix(number) ^ (sums[cut[1:]] - sums[cut[:-1]]))
            filled = cut[1:] > cut[:-1]
            empty, agree = parts - int(filled.sum()), parts - differ
            # with few empty parts, some part that agrees is not empty
            out[scheme % 2] = (found[filled], agree - empty) if empty < agree else (found, 1)
        return out


_SETS = "doc long, tag long, n long, id long"
_SETS += "".join(f", needs_{kind} int, signatures_{kind} array<long>" for kind in KINDS)


def sets_of(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Per document: size and hash of its set, and its signatures of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(percent)
        for batch in batches:
            for block in blocks(batch.column("text")):
                sets = shingle_sets(block, size)
                rows = slice(block.first, block.first + len(sets))
                sizes = np.array([len(s) for s in sets], np.int64)
                whole = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                ids = mix(whole ^ (sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                columns = {
                    "doc": batch.column("doc")[rows],
                    "tag": batch.column("tag")[rows],
                    "n": pa.array(sizes),
                    "id": pa.array(signed(ids)),
                }
                for kind, found in zip(KINDS, zip(*[classes.signatures(s) for s in sets])):
                    columns[f"needs_{kind}"] = pa.array([need for _, need in found], pa.int32())
                    columns[f"signatures_{kind}"] = ragged(
                        signed(np.concatenate([f for f, _ in found])),
                        [len(f) for f, _ in found],
                        pa.int64(),
                    )
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return keyed(docs).mapInArrow(run, _SETS)


def _shingles(texts: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of texts that carry the id of their set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                sets = shingle_sets(block, size)
                rows = slice(block.first, block.first + len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id")[rows],
                        ragged(
                            signed(np.concatenate([*sets, np.zeros(0, np.uint64)])),
                            [len(s) for s in sets],
                            pa.int64(),
                        ),
                    ],
                    names=["id", "shingles"],
                )

    return texts.mapInArrow(run, "id long, shingles array<long>")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``shared`` and ``joint``, the sizes of intersection and union."""
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    found = _both(pairs, sets).select("a", "b", shared.alias("shared"), F.expr("size(x) + size(y)").alias("n"))
    return found.select("a", "b", "shared", (F.col("n") - F.col("shared")).alias("joint"))


def _both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their sets x and y."""
    left = sets.selectExpr("id AS a", "shingles AS x")
    right = sets.selectExpr("id AS b", "shingles AS y")
    return pairs.join(left, "a").join(right, "b")


#: Sets of several components that a region may hold undivided.
LEAF = 64


def _voronoi(rest: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """``rest`` with large regions divided, and the pairs that were compared on the way.

    A region gets a second pivot, the set farthest from the first, whose distances to all
    others are worked out. Each set then goes to the nearer pivot's cell, and also to the other's
    if its distances differ by no more than twice the radius: of two sets within the radius, the
    second is in the cell that is the first one's own. Cells are divided again
    until they are small, or until pivots no longer tell their sets apart: a
    region whose cells are hardly smaller stays whole.
    """
    window = 2 * (100 - percent) / 100 + 1e-9
    columns = ["region", "id", "pivot", "root", "home", "n", "size", "added", "missing"]
    rest, compared = rest.select(*columns, F.lit(False).alias("whole")), []
    to_first = F.expr("1 - (n - added) / (size + added)")
    while True:
        rest = write_out(rest, "rest")
        large = rest.where("NOT whole").groupBy("region").agg(
            F.count(F.lit(1)).alias("m"),
            F.max(F.struct(to_first.alias("d"), F.col("id"), F.col("root"), F.col("n")))
            .alias("second"),
        )
        large = write_out(large.where(F.col("m") > LEAF), "large")
        if large.isEmpty():
            return rest.drop("whole"), compared
        members = rest.join(large, "region").where("id <> second.id")
        pairs = members.select(F.col("second.id").alias("a"), F.col("id").alias("b")).distinct()
        # the second pivot and the first were compared before
        pairs = write_out(_distances(pairs, sets), "compared")
        compared.append(pairs)
        told = members.withColumn("q", F.col("second.id")).join(
            pairs.withColumnsRenamed({"a": "q", "b": "id"}), ["q", "id"]
        )
        told = told.withColumns({"d1": to_first, "d2": F.expr("1 - shared / joint")})
        told = told.withColumns(
            {"one": F.col("d1") - F.col("d2") <= window, "two": F.col("d2") - F.col("d1") <= window}
        )
        told = write_out(told, "told")
        good = told.groupBy("region", "m").agg(
            F.count_if("one").alias("ones"), F.count_if("two").alias("twos")
        )
        good = good.where("ones + twos <= 1.25 * m AND greatest(ones, twos) <= 0.75 * m")
        good = write_out(good.select("region"), "good")
        cells = told.join(good, "region", "left_semi")
        first = cells.where("one").withColumn("region", F.xxhash64("region", "pivot"))
        second = cells.where("two").selectExpr(
            "xxhash64(region, q) AS region", "id", "q AS pivot", "root", "second.root AS home", "n",
            "second.n AS size", "n - shared AS added", "second.n - shared AS missing", "whole",
        )
        kept = rest.join(large.join(good, "region", "left_semi"), "region", "left_anti")
        kept = kept.join(
            large.join(good, "region", "left_anti").select("region", F.lit(True).alias("stays")),
            "region",
            "left",
        ).withColumn("whole", F.col("whole") | F.coalesce("stays", F.lit(False)))
        rest = (
            kept.select(*columns, "whole")
            .unionByName(first.select(*columns, "whole"))
            .unionByName(second)
        )


def _late_pairs(
    members: DataFrame,
    spokes: DataFrame,
    roots: DataFrame,
    ends: DataFrame,
    sets: DataFrame,
    percent: int,
) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs (a, b) in regions of several components that may still be linked, and tables of
    pairs that were compared to divide the regions.

    Seen from the pivot a set has ``added`` shingles that the pivot lacks and misses
    ``missing`` of the pivot's. Two sets differ in all of their added shingles but the
    ones they share, and in at least as many missing ones as their numbers differ. So
    a linked pair either shares added shingles, so many that what is left is allowed, or
    has sums that the radius allows. How many it shares at least follows from either set alone,
    so that only their rarest have to meet: passages that many hold make no pairs.
    At least one of the two is outside the pivot's component.
    """
    near, far = 100 - percent, 100 + percent  # linked: far * differing <= near * (sizes)
    named = members.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "region", "id", "pivot", F.coalesce("root", "id").alias("root")
    )
    # pairs with the pivot have been compared; what else there is has to be of several components
    open_ = (
        named.where("id <> pivot")
        .groupBy("region")
        .agg(F.min("root").alias("r"), F.max("root").alias("s"))
        .where("r <> s")
        .select("region")
    )
    open_ = write_out(open_, "open")
    # all others are done
    named = write_out(named.join(open_, "region", "left_semi"), "named")
    homes = named.where("id = pivot").select("region", F.col("root").alias("home"))
    away = spokes.selectExpr("a AS pivot", "b AS id", "shared").join(ends, "id")
    away = away.join(ends.selectExpr("id AS pivot", "n AS size"), "pivot").selectExpr(
        "pivot", "id", "n", "size", "n - shared AS added", "size - shared AS missing"
    )
    rest = named.where("id <> pivot").join(homes, "region").join(away, ["pivot", "id"])
    rest, compared = _voronoi(rest, sets, percent)

    # first kind: the sums allow it; the least sums of a region rule out most sets
    bounds = rest.groupBy("region").agg(
        F.min(F.expr("added - missing")).alias("fewer"),
        F.min(F.expr(f"{far - near} * added + {far + near} * missing")).alias("more"),
    )
    bounds = write_out(bounds, "bounds")
    apart = rest.where("root <> home").join(bounds, "region")
    # with missing (m) and added (d) of both: far * (d + d' + |m - m'|) <= near * (n + n'),
    # where n' is size - m' + d'
    apart = apart.where(
        f"({far - near} * fewer + {far} * (missing + added) <= {near} * (n + size))"
        f" OR (more + {far} * (added - missing) <= {near} * (n + size))"
    )
    one = apart.selectExpr("region", "id AS a", "root AS p", "added AS d", "missing AS m", "n")
    two = rest.selectExpr("region", "id AS b", "root AS q", "added AS e", "missing AS o", "n AS k")
    by_sums = one.join(two, "region").where(
        f"p <> q AND {far} * (d + e + abs(m - o)) <= {near} * (n + k)"
    )

    # second kind: they share a shingle that the pivot lacks
    seen = rest.select("pivot", "id", "root", "home", "added", "missing", "size").distinct()
    seen = write_out(seen, "seen")
    pairs = seen.select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    extra = F.array_except("y", "x").alias("extra")
    extra_at = fresh_path(rest.sparkSession, "extra")
    extras = _both(pairs, sets).select(F.col("a").alias("pivot"), F.col("b").alias("id"), extra)
    extras = write_out(extras, "extra", extra_at)
    # most are of one set only, and many of no set that is still apart
    parted = seen.select("pivot", "id", (F.col("root") != F.col("home")).alias("far"))
    shared = (
        extras.join(parted, ["pivot", "id"])
        .select("pivot", "far", F.explode("extra").alias("shingle"))
        .groupBy("pivot", "shingle")
        .agg(F.count(F.lit(1)).alias("c"), F.max("far").alias("far"))
        .where("c > 1 AND far")
        .select("pivot", "shingle", "c")
    )
    shared = write_out(shared, "shared")
    held = extras.select("pivot", "id", F.explode("extra").alias("shingle"))
    held = held.join(shared, ["pivot", "shingle"]).groupBy("pivot", "id").agg(
        F.sort_array(F.collect_list(F.struct("c", "shingle")))["shingle"].alias("held")
    )
    # sets are linked if, besides the pivot's, they share ``least`` of the held shingles: among
    # the rarest of either, of which there are so many less one that it need not share, is one
    held = held.join(seen, ["pivot", "id"]).withColumns(
        {
            "h": F.size("held"),
            "least": F.expr(
                f"greatest(1, ({percent} * added - {near} * (size - missing) + 99) div 100)"
            ),
        }
    )
    held = held.where("least <= h").select(
        "pivot", "id", "root", "home", "added", "missing", "size", "h",
        F.posexplode(F.expr("slice(held, 1, CAST(h - least + 1 AS INT))")).alias("i", "shingle"),
    )
    held = write_out(held, "held")
    drop_path(rest.sparkSession, extra_at)
    one = held.where("root <> home").selectExpr(
        "pivot", "shingle", "id AS a", "root AS p", "added AS d", "missing AS m", "size", "h", "i"
    )
    two = held.selectExpr(
        "pivot", "shingle", "id AS b", "root AS q", "added AS e", "missing AS o", "h AS l", "i AS j"
    )
    # they share no more than there are up to this shingle in one and after it in one
    most = "(least(i, j) + least(h - i, l - j))"
    by_shingle = one.join(two, ["pivot", "shingle"]).where(
        f"p <> q AND {far} * (d + e - 2 * {most} + abs(m - o))"
        f" <= {near} * (2 * size + d + e - m - o)"
    )
    both = by_sums.select("a", "b").unionByName(by_shingle.select("a", "b"))
    return both.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), compared


def _agreeing(rows: DataFrame, needs: DataFrame, path: str) -> None:
    """Write distinct (id, region) of the regions that sets have in common with others, of sets
    that have as many of them as linked ones have.

    Passages that documents share make them agree in a part or two; such pairs grow with the
    square of the documents, and are no links.
    """
    # dealt once, for both sides of the join (Spark would deal them anew for a semi-join)
    rows = rows.repartition("region")
    several = rows.groupBy("region").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    several = several.where("a <> b").select("region")
    at = fresh_path(rows.sparkSession, "several")
    shared = write_out(rows.join(several, "region").distinct(), "several", at)
    enough = shared.groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    enough = enough.join(needs.groupBy("id").agg(F.max("needs").alias("needs")), "id")
    found = shared.join(enough.where("c >= needs").select("id"), "id", "left_semi")
    write_out(found.select("id", "region"), "agreeing", path)
    drop_path(rows.sparkSession, at)


def linked_sets(docs: DataFrame, found: DataFrame, cells: str, percent: int, size: int) -> DataFrame:
    """(node, root): components of the sets in ``found`` that are linked with another.

    ``cells`` is the folder of their signatures. Large working tables, this one too,
    are dropped as soon as nothing later reads them.
    """
    spark = docs.sparkSession
    near = F.col("shared") * 100 >= F.col("joint") * percent
    first_at = {kind: fresh_path(spark, "agreeing") for kind in KINDS}
    for kind, path in first_at.items():
        rows = spark.read.schema(f"id long, signatures_{kind} array<long>").parquet(cells)
        rows = rows.select("id", F.explode(f"signatures_{kind}").alias("region"))
        _agreeing(rows, found.select("id", F.col(f"needs_{kind}").alias("needs")), path)
    drop_path(spark, cells)
    members = spark.read.schema("id long, region long").parquet(*first_at.values())
    # the set that shares most parts with others is the pivot: the least changed copy
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("size"))
    sizes = write_out(sizes.where("size > 1"), "sizes")
    shares = members.join(sizes, "region").groupBy("id").agg(F.sum("size").alias("shares"))
    shares = write_out(shares, "shares")
    pivots = members.join(shares, "id").groupBy("region").agg(
        F.max(F.struct("shares", "id"))["id"].alias("pivot")
    )
    pivots = write_out(pivots.join(sizes, "region", "left_semi"), "pivots")
    members = write_out(members.join(pivots, "region"), "members")
    for path in first_at.values():
        drop_path(spark, path)

    spokes = members.where("id <> pivot").selectExpr("pivot AS a", "id AS b").distinct()
    spokes = write_out(spokes, "spokes")
    one_each = found.where("n > 0").groupBy("id").agg(
        F.min(F.struct("doc", "tag")).alias("at"), F.min("n").alias("n")
    )
    ends = spokes.selectExpr("a AS id").unionByName(spokes.selectExpr("b AS id")).distinct()
    ends = one_each.join(ends, "id", "left_semi")
    ends = write_out(ends.select("id", "n", "at.doc", "at.tag"), "ends")
    # rows that repeat doc_id and text would give the same set again
    # (the test of n is always true; it lets Spark filter the texts by these keys at run time)
    few = ends.where("n > 0").drop("n")
    texts = keyed(docs).join(few, ["doc", "tag"]).dropDuplicates(["doc", "tag"])
    whole = fresh_path(spark, "sets")
    sets = write_out(_shingles(texts.select("id", "text"), size), "sets", whole)
    spokes = write_out(_distances(spokes, sets), "spokes")
    links = spokes.where(near).select("a", "b")
    roots = components(links)

    pairs, compared = _late_pairs(members, spokes, roots, ends.select("id", "n"), sets, percent)
    pairs = write_out(pairs, "pairs")
    late = write_out(_distances(pairs, sets), "late")
    drop_path(spark, whole)
    for more in compared:
        late = late.unionByName(more)
    late = late.where(near).select("a", "b")
    if late.isEmpty():
        return roots
    return components(links.unionByName(late))


def join(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(doc, tag, n, id, root, smallest): each document's set, component and least doc."""
    with shuffles_dropped(docs.sparkSession):
        cells = fresh_path(docs.sparkSession, "signatures")
        found = write_out(sets_of(docs, percent, size), "signatures", cells)
        found = write_out(found.drop(*[f"signatures_{kind}" for kind in KINDS]), "found")
        roots = linked_sets(docs, found, cells, percent, size)
        named = (
            found.join(roots.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("root", F.coalesce("root", "id"))
        )
        least = named.where("n > 0").groupBy("root").agg(F.min("doc").alias("least"))
        least = write_out(least, "least")
    smallest = F.when(F.col("n") > 0, F.coalesce("least", "doc")).otherwise(F.col("doc"))
    return named.join(least, "root", "left").select(
        "doc", "tag", "n", "id", "root", smallest.alias("smallest")
    )


def report(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id)."""
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return join(docs, percent, size).select(
        known("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        known("smallest").alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The document with the smallest doc_id of each component, and all without shingles."""
    found = join(docs, percent, size)
    first = F.min(F.struct("doc", "tag")).alias("first")
    heads = found.where("n > 0").groupBy("root").agg(first).select("first.doc", "first.tag")
    stay = heads.withColumn("empty", F.lit(False)).unionByName(
        found.where("n = 0").select("doc", "tag", F.lit(True).alias("empty")).distinct()
    )
    stay = write_out(stay, "stay")
    rows = packed(docs).select("*", *identity()).join(stay, ["doc", "tag"])
    # of rows that repeat doc_id and text one stays, unless they have no shingles
    rows = rows.withColumn(
        "row", F.when(F.col("empty"), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    )
    return unpacked(rows.dropDuplicates(["doc", "tag", "row"]), docs)
