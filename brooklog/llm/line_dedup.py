"""Line deduplication by deletion neighbourhoods, in built-in functions only.

Two lines are alike if their words are equal, or if both have at least
``MIN_EDIT_WORDS`` words and one word inserted, deleted or replaced turns one
into the other: five words, since one change then leaves a similarity of 0.8. A line is
removed if an alike line comes earlier (smaller doc_id, or same document, earlier line),
judged on the input.

Equal lines meet by hash. For the rest each line emits its deletion neighbourhood:
a key of all its words, and for each word a key of the others. Lines that share a
key meet at the key's earliest line: a full line with any, two shortened lines if
the same place is missing. That takes one minimum per key and no pairs. Found
sources are verified word by word. One edit leaves three of four equal parts of a line as
they were, as seen from its ends, so only lines that share three parts with another emit their
neighbourhood.

Lines are parts of the text between ``\\n``; words are runs of characters other than
[\\x20\\x09-\\x0D]. Lines without words always stay. Null and empty texts are one blank line.
Rows that repeat doc_id and text are one document, which does not remove its own lines. A null
doc_id comes last. Columns other than doc_id and text, whatever their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklog.llm.repeats import identity, shuffles_dropped
from brooklog.llm.rows import only, packed, unpacked
from brooklog.scratch import write_out

#: Least words of a line that may go, and of one that may go for an alike one.
MIN_WORDS = 1
MIN_EDIT_WORDS = 5


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*identity(), F.split(text, "\n").alias("lines"))


def _words(line: Column) -> Column:
    """Splits at single spaces, which takes no regular expression; the other separators are
    rare, and replaced first."""
    for other in "\t\v\f\r":
        line = F.replace(line, F.lit(other), F.lit(" "))
    return F.array_remove(F.split(line, " "), "")


def _plain(line: Column) -> Column:
    """The words of a line with one space between them; most lines are that already."""
    rare = F.contains(line, F.lit("  ")) | line.startswith(" ") | line.endswith(" ")
    for other in "\t\v\f\r":
        rare = rare | F.contains(line, F.lit(other))
    return F.when(rare, F.array_join(_words(line), " ")).otherwise(line)


def _part_size(n: str) -> str:
    """SQL: the largest of 1, 2, 3, 4, 6, 8, 12, … that is no more than a quarter of ``n``."""
    quarter = f"({n} div 4)"
    power = f"shiftleft(1, length(bin({quarter})) - 1)"
    half = f"({power} div 2)"
    return f"CAST(IF({quarter} >= {power} + {half}, {power} + {half}, {power}) AS INT)"


def hashed_lines(docs: DataFrame, min_words: int, min_edit: int) -> DataFrame:
    """A row without text for each line that may go: place, hashes of its words, part keys.

    A part has as many words as ``_part_size`` tells. Keys are of three parts each, for
    each of the four that one edit may be in. A line that is the shortest of its size has a second
    row (``size`` 1) with the keys that a line with a word less has.
    """
    lines = _keyed(docs).select("doc", "tag", F.posexplode("lines").alias("line", "text"))
    lines = lines.select("doc", "tag", "line", _plain(F.col("text")).alias("s"))
    spaces = F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit("")))
    lines = lines.withColumn("n", F.when(F.col("s") != "", spaces + 1).otherwise(0))
    lines = only(lines, F.col("n") >= max(min_words, 1))
    sizes = F.expr(
        f"""CASE WHEN n < {max(min_edit, 4)} THEN array(0)
                 WHEN n > {max(min_edit, 4)} AND {_part_size('n')} <> {_part_size('(n - 1)')}
                 THEN array({_part_size('n')}, {_part_size('(n - 1)')})
                 ELSE array({_part_size('n')}) END"""
    )
    lines = lines.select("*", F.posexplode(sizes).alias("size", "p"))
    keys = ", ".join(
        f"xxhash64(p, {j}, substring_index(s, ' ', {j} * p), substring_index(s, ' ', {j - 3} * p))"
        for j in range(4)
    )
    return lines.select(
        "doc", "tag", "line", "n", "size",
        F.xxhash64("s").alias("h1"),
        F.xxhash64(F.lit("second"), "s").alias("h2"),
        F.expr(f"IF(p > 0, array({keys}), cast(array() AS array<bigint>))").alias("parts"),
    )


def _at(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in ("doc", "tag", "line")])


def _neighbourhood(words: DataFrame, min_edit: int) -> DataFrame:
    """(k1, k2, size, gone, at): a line's own key (gone -1) and one for each missing word.

    A key is the exclusive or of hashes of (word, place) with the places that the
    words have when one is missing, so that each takes a running sum and no copy.
    """
    each = words.select("at", "n", F.posexplode("w").alias("i", "word"))
    each = each.select(
        "at", "n", "i",
        F.xxhash64("word", "i").alias("a1"),
        F.xxhash64("word", F.col("i") - 1).alias("b1"),
        F.xxhash64(F.lit("second"), "word", "i").alias("a2"),
        F.xxhash64(F.lit("second"), "word", F.col("i") - 1).alias("b2"),
    )
    line = Window.partitionBy("at")
    so_far = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    sums = each.select(
        "at", "n", "i",
        *[F.bit_xor(c).over(so_far).alias(f"s{c}") for c in ("a1", "a2", "b1", "b2")],
        *[F.bit_xor(c).over(line).alias(f"t{c}") for c in ("b1", "b2")],
        "a1", "a2",
    )
    missing = sums.selectExpr(
        # words before i at their own places, words after it one place earlier
        "sa1 ^ a1 ^ tb1 ^ sb1 AS k1",
        "sa2 ^ a2 ^ tb2 ^ sb2 AS k2",
        "n - 1 AS size", "i AS gone", "at",
    )
    full = sums.where("i = n - 1").selectExpr("sa1 AS k1", "sa2 AS k2", "n AS size", "-1 AS gone", "at")
    return missing.unionByName(full)


def _one_edit(x: str, y: str) -> str:
    """SQL: arrays ``x`` and ``y`` differ by one word inserted, deleted or replaced."""
    p = f"cast(array_position(zip_with({x}, {y}, (u, v) -> u <=> v), false) AS int)"
    long_, short = f"if(size({x}) >= size({y}), {x}, {y})", f"if(size({x}) >= size({y}), {y}, {x})"
    rest = f"slice({long_}, {p} + 1, size({long_}))"
    return (
        f"abs(size({x}) - size({y})) <= 1 AND {p} > 0 AND {rest} = "
        f"slice({short}, if(size({x}) = size({y}), {p} + 1, {p}), size({short}) + 1)"
    )


def _near(docs: DataFrame, distinct: DataFrame, min_edit: int) -> DataFrame:
    """(h1, h2) of distinct lines that an earlier line differs from by one edit."""
    keys = distinct.select("h1", "h2", F.explode("parts").alias("part"))
    shared = keys.groupBy("part").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("part")
    shared = write_out(shared, "parts")
    chosen = keys.join(shared, "part", "left_semi").select("h1", "h2").distinct()
    chosen = distinct.join(chosen, ["h1", "h2"], "left_semi").select("h1", "h2", "at")
    places = chosen.groupBy("at.doc", "at.tag").agg(
        F.collect_list(F.struct("h1", "h2", F.col("at.line").alias("line"))).alias("chosen")
    )
    # (the test is always true; it lets Spark filter the texts by these keys at run time)
    places = write_out(places, "places").where(F.size("chosen") > 0)
    # rows that repeat a document give the same lines again
    texts = _keyed(docs).join(places, ["doc", "tag"]).dropDuplicates(["doc", "tag"])
    words = texts.select("doc", "tag", "lines", F.explode("chosen").alias("c")).select(
        F.struct("doc", "tag", "c.line").alias("at"),
        "c.h1", "c.h2",
        _words(F.get("lines", F.col("c.line"))).alias("w"),
    )
    words = only(words.withColumn("n", F.size("w")), F.col("n") >= min_edit)
    words = write_out(words, "words")
    variants = write_out(_neighbourhood(words, min_edit), "variants")
    variants = variants.where(F.col("size") >= min_edit - 1)
    # nearly all keys are of one line; the others are few enough to filter by
    key = ["k1", "k2", "size"]
    shared = write_out(variants.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "shared")
    variants = variants.join(shared.where("c > 1").drop("c"), key, "left_semi")
    variants = write_out(variants, "variants")
    by_place = variants.groupBy("k1", "k2", "size", "gone").agg(F.min("at").alias("first"))
    by_place = write_out(by_place, "places")
    by_key = by_place.groupBy("k1", "k2", "size").agg(
        F.min("first").alias("any"),
        F.min(F.when(F.col("gone") < 0, F.col("first"))).alias("full"),
        F.count(F.lit(1)).alias("c"),
    )
    by_key = write_out(by_key, "keys")
    sources = by_place.join(by_key, ["k1", "k2", "size"]).select(
        "k1", "k2", "size", "gone",
        F.when(F.col("gone") < 0, F.col("any")).otherwise(F.least("full", "first")).alias("source"),
    )
    sources = write_out(sources.where("source IS NOT NULL"), "sources")
    found = (
        variants.join(sources, ["k1", "k2", "size", "gone"])
        .where("source < at")
        .groupBy("at")
        .agg(F.min("source").alias("source"))
    )
    found = write_out(found, "found")
    mine = words.select("at", "h1", "h2", F.col("w").alias("x"))
    theirs = words.select(F.col("at").alias("source"), F.col("w").alias("y"))
    verified = found.join(mine, "at").join(theirs, "source").where(_one_edit("x", "y"))
    return verified.select("h1", "h2")


def removed_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, min_edit: int = MIN_EDIT_WORDS
) -> DataFrame:
    """(doc, tag, removed): the numbers of each text's removed lines."""
    lines = write_out(hashed_lines(docs, min_words, min_edit), "lines")
    parts = [F.first(F.when(F.col("size") == k, F.col("parts")), ignorenulls=True) for k in (0, 1)]
    distinct = lines.groupBy("h1", "h2").agg(
        F.min(_at()).alias("at"),
        F.count_if(F.col("size") == 0).alias("c"),
        F.concat(parts[0], F.coalesce(parts[1], F.array().cast("array<bigint>"))).alias("parts"),
    )
    distinct = write_out(distinct, "distinct")
    lines = lines.where("size = 0")
    near = _near(docs, distinct, min_edit).withColumn("near", F.lit(True))
    marked = distinct.select("h1", "h2", "at", "c").join(near, ["h1", "h2"], "left")
    marked = marked.withColumn("near", F.coalesce("near", F.lit(False)))
    marked = write_out(marked.where("near OR c > 1").drop("c"), "marked")
    gone = lines.select("doc", "tag", "line", "h1", "h2").join(marked, ["h1", "h2"])
    gone = gone.where(F.col("near") | (_at() > F.col("at")))
    return write_out(
        gone.groupBy("doc", "tag").agg(F.collect_set("line").alias("removed")), "removed"
    )


def _left(lines: Column, removed: Column) -> Column:
    """The lines whose numbers are not in ``removed``.

    Numbers are looked up in a map, so that long texts don't take quadratic time.
    """
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    return F.transform(kept, lambda i: F.get(lines, i))


def _with_left(docs: DataFrame, min_words: int, min_edit: int) -> DataFrame:
    """``packed`` documents with ``left`` (the text), ``n_lines`` and ``n_removed``."""
    with shuffles_dropped(docs.sparkSession):
        removed = removed_lines(docs, min_words, min_edit)
    rows = packed(docs).select("*", *identity())
    # the struct holds the text already; it is shuffled once
    # the removed numbers of a partition's texts fit in memory, and the texts need no order
    rows = rows.drop("text").join(removed.hint("shuffle_hash"), ["doc", "tag"], "left")
    text = F.col("_all").getField("text")
    rows = rows.withColumn("lines", F.split(F.coalesce(text, F.lit("")), "\n"))
    some = F.col("removed").isNotNull()
    return rows.select(
        "_all",
        "doc_id",
        F.when(some, F.array_join(_left(F.col("lines"), F.col("removed")), "\n"))
        .otherwise(text)
        .alias("left"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(some, F.size("removed")).otherwise(0).cast("long").alias("n_removed"),
    )


def without_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, min_edit: int = MIN_EDIT_WORDS
) -> DataFrame:
    """``docs`` with the text that is left, without documents that lost all their words.

    A text without removed lines stays as it is, null too. A column ``n_chars`` is
    set to the characters of a changed text.
    """
    rows = _with_left(docs, min_words, min_edit)
    some = (F.col("n_removed") == 0) | F.col("left").rlike(r"[^\x20\x09-\x0D]")
    rows = only(rows, some)
    new = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        own = F.col("_all").getField("n_chars")
        new["n_chars"] = F.when(
            F.col("n_removed") > 0, F.length("left").cast(docs.schema["n_chars"].dataType)
        ).otherwise(own)
    return unpacked(rows, docs, **new)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_lines, n_removed, kept_sha256)."""
    return _with_left(docs.select("doc_id", "text"), MIN_WORDS, MIN_EDIT_WORDS).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce(F.col("left"), F.lit("")), 256).alias("kept_sha256"),
    )


#: The same in DuckDB, over a query ``{docs}`` with distinct doc_id. Of alike lines with
#: different words, either the first words are equal or the last.
KEPT_SQL = r"""
split AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls
          FROM {docs}),
numbered AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
                                                   FROM split)),
worded AS (SELECT doc_id, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM numbered),
usable AS (SELECT * FROM worded WHERE len(w) >= {min_words}),
equal AS (SELECT w, min(struct_pack(d := doc_id, i := i)) AS first FROM usable GROUP BY w),
pairs AS (
  SELECT a.w AS x, b.w AS y FROM equal a JOIN equal b
    ON a.w[1] = b.w[1] AND abs(len(a.w) - len(b.w)) <= 1 AND b.first < a.first
  WHERE least(len(a.w), len(b.w)) >= {min_edit}
  UNION
  SELECT a.w, b.w FROM equal a JOIN equal b
    ON a.w[-1] = b.w[-1] AND abs(len(a.w) - len(b.w)) <= 1 AND b.first < a.first
  WHERE least(len(a.w), len(b.w)) >= {min_edit}),
placed AS (
  SELECT x, y, list_position(list_transform(list_zip(x, y),
                lambda z: z[1] IS NOT DISTINCT FROM z[2]), false) AS p FROM pairs),
near AS (
  SELECT DISTINCT x AS w FROM placed
  WHERE CASE WHEN len(x) = len(y) THEN x[p + 1:] = y[p + 1:]
             WHEN len(x) > len(y) THEN x[p + 1:] = y[p:]
             ELSE y[p + 1:] = x[p:] END),
gone AS (
  SELECT u.doc_id, u.i FROM usable u JOIN equal e ON e.w = u.w LEFT JOIN near n ON n.w = u.w
  WHERE n.w IS NOT NULL OR struct_pack(d := u.doc_id, i := u.i) > e.first),
kept AS (
  SELECT b.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(b.line, chr(10) ORDER BY b.i) FILTER (g.i IS NULL), '') AS kept
  FROM numbered b LEFT JOIN gone g ON g.doc_id = b.doc_id AND g.i = b.i
  GROUP BY b.doc_id)"""

REPORT_SQL = (
    "WITH "
    + KEPT_SQL.format(docs="documents", min_words=1, min_edit=5)
    + " SELECT doc_id, n_lines, n_removed, sha256(kept) AS kept_sha256 FROM kept"
)
