"""Quality rules: a threshold table compiled into one projection of built-in functions.

Each rule bounds one ratio of a text's length, symbols, stop words or lines.
``compile_rules`` turns a table of rules into Spark columns, ``keep`` filters
documents by them, and ``report`` lists counts and verdicts. A row is judged by its own text
alone, so there is no shuffle, and repeated rows get equal verdicts. Null and
empty texts count 0 everywhere and fail the least number of words. Other columns
of the input are not touched, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.llm.rows import only, packed, unpacked

#: Words are runs of other characters than these.
SEPARATOR = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Words of a window that counts as repeated when the text has it again.
GRAM = 5

# Frequent function words of the corpus' languages.
STOP_WORDS = (
    "a and as at be by for from had he in is it of on or that the this to was with "
    "das dem den der des die ein eine ist mit nicht und von zu "
    "al con de del el en es la las los no para por que se su un una y "
    "au ce dans des du elle est et la le les ne pas pour qui une"
).split()


class Rule(NamedTuple):
    """``top / over`` must lie in [low, high]; texts of under ``from_words`` words pass.

    ``top`` and ``over`` name measures; an ``over`` of 0 counts as 1, none as 1.
    """

    name: str
    top: str
    over: str | None
    low: float | None
    high: float | None
    from_words: int = 0


#: The two rules every document must pass.
BASE = (
    Rule("few_words", "n_words", None, 10.0, None),
    Rule("repeats", "n_repeat_words", "n_words", None, 0.2),
)

#: Further rules. They are wide: in the labelled sample no good document fails one.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations", "n_exclamations", "n_words", None, 0.2),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None, 100),
    Rule("dup_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once although it is used often."""
    return F.transform(F.array(value), body)[0]


def repeated_words(grams: Column) -> Column:
    """Words in windows found twice or more, from each window's hash in order."""

    def covered(pairs: Column) -> Column:
        alike = lambda x, i: (
            (i > 0) & (F.get(pairs, i - 1)["g"] == x["g"])
        ) | F.coalesce(F.get(pairs, i + 1)["g"] == x["g"], F.lit(False))
        places = F.array_sort(F.transform(F.filter(pairs, alike), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("last"))
        step = lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(GRAM), i - a["last"])).alias("n"), i.alias("last")
        )
        return F.aggregate(places, start, step, lambda a: a["n"])

    pairs = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(
        _let(F.array_sort(pairs), covered)
    )


def _measures(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``_m`` of counts, each a long.

    Windows are compared within a text by 64-bit hashes.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(whole, SEPARATOR + "+"), lambda w: w != "")
    lines = F.filter(
        F.split(whole, "\n"), lambda x: x.rlike(SEPARATOR.replace("[", "[^", 1))
    )
    steps = docs.withColumn("_words", words).withColumn("_lines", lines)
    n = F.size("_words")
    gram = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(GRAM)])
    steps = steps.withColumn(
        "_grams",
        F.when(n >= GRAM, F.transform(F.sequence(F.lit(0), n - GRAM), gram)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    stop = F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))
    counted = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, "")),
        "n_exclamations": F.length(whole) - F.length(F.regexp_replace(whole, "!", "")),
        "n_stop_words": F.size(stop),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_grams")),
    }
    return steps.withColumn(
        "_m", F.struct(*[v.cast("long").alias(k) for k, v in counted.items()])
    ).drop("_words", "_lines", "_grams")


def compile_rules(rules: tuple[Rule, ...], struct: str = "_m") -> Column:
    """The names of the rules that a row fails, as an array.

    Bounds are compared without division, so that they hold exactly.
    """

    def fails(rule: Rule) -> Column:
        over = F.greatest(F.col(f"{struct}.{rule.over}"), F.lit(1)) if rule.over else F.lit(1)
        top = F.col(f"{struct}.{rule.top}") * 100
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (top < over * round(100 * rule.low))
        if rule.high is not None:
            bad = bad | (top > over * round(100 * rule.high))
        return bad & (F.col(f"{struct}.n_words") >= rule.from_words)

    names = [F.when(fails(rule), F.lit(rule.name)) for rule in rules]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def _assess(
    docs: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` with ``_m`` (all counts) and ``_failed`` / ``_base_failed`` (rule names)."""
    counted = _measures(docs)
    return counted.withColumn("_base_failed", compile_rules(base)).withColumn(
        "_failed", F.concat("_base_failed", compile_rules(rules))
    )


def keep(docs: DataFrame, **tables) -> DataFrame:
    """The documents that pass all rules, with their columns as they were."""
    return unpacked(only(_assess(packed(docs), **tables), F.size("_failed") == 0), docs)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its id, counts and verdict."""
    found = _assess(docs.select("doc_id", "text"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(f"_m.{c}").alias(c) for c in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (F.size("_base_failed") > 0).alias("base_failed"),
        (F.size("_failed") == 0).alias("kept"),
    )


def _sql_fails(rule: Rule) -> str:
    over = f"greatest({rule.over}, 1)" if rule.over else "1"
    bounds = []
    if rule.low is not None:
        bounds.append(f"100 * {rule.top} < {over} * {round(100 * rule.low)}")
    if rule.high is not None:
        bounds.append(f"100 * {rule.top} > {over} * {round(100 * rule.high)}")
    return f"((n_words >= {rule.from_words}) AND ({' OR '.join(bounds)}))"


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

#: The measures in DuckDB, from a table or query ``{docs}`` with doc_id and text.
MEASURES_SQL = (
    r"""
t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM {docs}),
w AS (SELECT *, regexp_extract_all(text, '[^ 	-
]+') AS words,
             list_filter(string_split(text, chr(10)),
                         lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM t),
grams AS (SELECT rid, i, words[i:i + 4] AS gram
          FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams),
repeated AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(5) AS s(k)
             WHERE again.n > 1 GROUP BY rid),
m AS (SELECT w.rid, doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations,
             CAST(len(list_filter(words, lambda x: lower(x) IN ("""
    + _STOP
    + r"""))) AS BIGINT) AS n_stop_words,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN repeated r ON r.rid = w.rid)"""
)

BASE_FAILED_SQL = "(" + " OR ".join(map(_sql_fails, BASE)) + ")"
FAILED_SQL = "(" + " OR ".join(map(_sql_fails, (*BASE, *RULES))) + ")"

REPORT_SQL = (
    "WITH "
    + MEASURES_SQL.format(docs="documents")
    + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {BASE_FAILED_SQL} AS base_failed, NOT {FAILED_SQL} AS kept
FROM m"""
)
