"""Operators 1, 2, 4, 5, 9 and 10."""

from __future__ import annotations

import itertools
import math
import random

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from oracle import difference

from brooklog.llm import (
    decontaminate,
    licenses,
    quality,
    sentencepiece_scan,
    sharding,
    token_counts,
)
from brooklog.llm.queries import PATTERN, TOKENIZERS

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


# --- licenses ------------------------------------------------------------------


def test_notices_are_found_whole_and_changed(spark):
    text = dict(licenses.NOTICES)["MIT text"]
    changed = text.replace("free of charge", "at no charge").replace("a copy", "one copy")
    rows = [
        (1, f"Ünïcode first. {text}\nand more"),
        (2, f"some words {changed} some words"),
        (3, "Released under the MIT License. released under the mit license!"),
        (4, "Released under another License than that one"),
        (5, " ".join(text.split()[:20])),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(df, licenses.notices(spark)).collect()
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start : r.end] == r.span for r in found)
    assert sorted((r.doc_id, r.license, r.coverage == 1.0) for r in found) == [
        (1, "MIT text", True), (2, "MIT text", False), (3, "MIT", True), (3, "MIT", True),
    ]
    assert next(r for r in found if r.doc_id == 1).span == text


def test_whole_texts_and_reserved_rights_are_found(spark):
    rows = [(i, name, f"before {text} after") for i, (name, text) in enumerate(licenses.NOTICES)]
    whole = dict(licenses.NOTICES)["GPL-2.0 text"].split()
    rows.append((len(rows), "half of it", " ".join(whole[: len(whole) // 2])))
    df = spark.createDataFrame(rows, "doc_id long, name string, text string")
    found = {(r.doc_id, r.license) for r in licenses.scan(df, licenses.notices(spark)).collect() if r.coverage == 1}
    own = {(i, name) for i, name, _ in rows[:-1]}
    assert own <= found and {name for _, name in own} >= {
        "All rights reserved", "MIT text", "ISC text", "BSD-2-Clause text", "BSD-3-Clause text",
        "Apache-2.0 text", "CC0-1.0 text", "GPL-2.0 text", "GPL-3.0 text", "LGPL-2.1 text",
        "LGPL-3.0 text", "MPL-2.0 text", "Unlicense text", "AGPL-3.0 header", "CC-BY-SA-4.0",
    }
    assert (len(rows) - 1, "GPL-2.0 text") not in found


def test_alignment_against_all_paths():
    """The band is wide, so the number of matches is that of the plain recurrence."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        template = rng.integers(0, 6, rng.integers(3, 9)).astype(np.uint64)
        words = rng.integers(0, 6, rng.integers(3, 14)).astype(np.uint64)
        m, n = len(template), len(words)
        best = np.zeros((m + 1, n + 1))
        best[1:, 0] = -np.arange(1, m + 1)
        for i in range(1, m + 1):
            for j in range(1, n + 1):
                same = 2 if template[i - 1] == words[j - 1] else -1
                best[i, j] = max(best[i - 1, j - 1] + same, best[i - 1, j] - 1, best[i, j - 1] - 1)
        found = licenses.align(template, words, -m, m + n + m)
        assert found == sorted(found) and all(0 <= j < n for j in found)
        # the matches alone can't score less than the best path
        assert 2 * len(found) >= best[m].max()
        assert len(found) <= m


def test_short_templates_lose_none_of_their_changes(spark):
    """A match is found wherever the words are that coverage lets be replaced."""
    rows, templates = [], []
    for size in (1, 2, 3, 5, 6, 7, 10, 11, 15):
        own = [f"t{size}w{k}" for k in range(size)]
        templates.append((str(size), " ".join(own)))
        changes = size - math.ceil(licenses.COVERAGE * size)
        for places in itertools.combinations(range(size), changes):
            text = [f"other{len(rows)}x{k}" if k in places else w for k, w in enumerate(own)]
            rows.append((size, f"words before {' '.join(text)} and after"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(docs, spark.createDataFrame(templates, "name string, text string"))
    assert sorted(r.license for r in found.collect()) == sorted(str(d) for d, _ in rows)


def test_license_templates_of_odd_kinds(spark, odd, none):
    templates = spark.createDataFrame(
        [("a", None), ("b", "two words"), ("c", "these eight short words"), ("c", "these eight short words")],
        "name string, text string",
    )
    found = licenses.scan(odd, templates).collect()
    assert [(r.doc_id, r.license, r.n_matched) for r in found] == [(9, "c", 4), (9, "c", 4)]
    assert licenses.scan(odd, templates.limit(0)).count() == 0
    assert licenses.scan(none, templates).count() == 0


# --- tokens ------------------------------------------------------------------


def tokens_by_line(text: str, ends, rule: str):
    lines, at = [], 0
    raw = text.encode()
    while at < len(raw):
        end = raw.find(b"\n", at) + 1 or len(raw)
        lines += [len(set(lines))] * (end - at)
        at = end
    counts: dict[int, float] = {}
    for a, b in zip([0, *ends], ends):
        held = lines[a:b]
        share = {k: held.count(k) / len(held) for k in held}
        if rule != "share":
            key = {
                "first": held[0], "last": held[-1],
                "most": max(share, key=lambda k: (share[k], -k)),
            }[rule]
            share = {key: 1}
        for k, v in share.items():
            counts[k] = counts.get(k, 0) + v
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_tokens_of_lines(spark, rule):
    rows = [(1, "one line\n\n\n  next line\n"), (2, "a\n" * 30 + "é€\n日本"), (3, "no end"), (4, "\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    with open(VOCABULARY, "rb") as file:
        own = token_counts.Encoder(file.read(), PATTERN)
    found = token_counts.count_tokens(df, VOCABULARY, PATTERN, rule).collect()
    for doc, text in rows:
        got = {r.section: r.n_tokens for r in found if r.doc_id == doc}
        want = tokens_by_line(text, own.ends(text).tolist(), rule)
        assert set(want) <= set(got)
        assert all(math.isclose(got[k], want.get(k, 0)) for k in got)
        lines = [text[r.start : r.end] for r in sorted(found, key=lambda r: r.section) if r.doc_id == doc]
        assert "".join(lines) == text


def test_given_sections_and_gaps_add_up(spark, odd):
    df = spark.createDataFrame(
        [(1, "title of it\nbody body body\nend"), (2, "no sections"), (3, None)], "doc_id long, text string"
    )
    sections = spark.createDataFrame(
        [(1, 0, 11), (1, 12, 20), (1, 20, 20), (3, 0, 5)], "doc_id long, start int, `end` int"
    )
    rows = token_counts.gather_sections(df, sections)
    found = token_counts.count_tokens(rows, VOCABULARY, PATTERN, "first", sections=True).collect()
    with open(VOCABULARY, "rb") as file:
        own = token_counts.Encoder(file.read(), PATTERN)
    total = {d: sum(r.n_tokens for r in found if r.doc_id == d) for d in (1, 2, 3)}
    assert total == {
        1: len(own.ends("title of it\nbody body body\nend")), 2: len(own.ends("no sections")), 3: 0,
    }
    assert {(r.section, r.start, r.end) for r in found if r.doc_id == 1} == {
        (0, 0, 11), (1, 12, 20), (2, 20, 20), (-1, None, None),
    }
    assert [r.n_tokens for r in found if r.doc_id == 1 and r.section == 2] == [0]


def test_tokens_of_odd_rows(spark, odd, none):
    found = token_counts.count_tokens(odd, VOCABULARY, PATTERN).collect()
    per_doc = {}
    for r in found:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.n_tokens
    assert 3 not in per_doc and 4 not in per_doc and per_doc[7] > 30_000
    assert token_counts.count_tokens(none, VOCABULARY, PATTERN).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(odd, VOCABULARY, PATTERN, "other")


# --- shards ------------------------------------------------------------------


def test_a_new_shard_only_takes_rows(spark):
    df = spark.range(4000).withColumnRenamed("id", "key")
    five = {r.key: r.shard for r in sharding.assign(df, "key", [1.0] * 5).collect()}
    six = {r.key: r.shard for r in sharding.assign(df, "key", [1.0] * 6).collect()}
    moved = [k for k in five if five[k] != six[k]]
    assert all(six[k] == 5 for k in moved) and 500 < len(moved) < 850


def test_weights_are_shares(spark):
    df = spark.range(6000).withColumnRenamed("id", "key")
    rows = sharding.assign(df, "key", [1.0, 2.0, 3.0]).groupBy("shard").count().collect()
    counts = {r.shard: r["count"] for r in rows}
    assert all(abs(counts[i] - 1000 * (i + 1)) < 150 for i in range(3))
    assert sharding.assign(df, "key", [2.0]).where("shard <> 0").count() == 0
    for weights in ([], [1.0, 0.0]):
        with pytest.raises(ValueError):
            sharding.assign(df, "key", weights)


def test_shards_of_odd_rows(spark, odd, none):
    rows = sharding.plan(odd, 3).collect()
    assert len(rows) == odd.count()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 3)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r.size for r in rows if r.doc_id in (3, 4)} == {8}
    assert len({r.shard for r in rows if r.doc_id == 9}) == 1
    assert sharding.plan(none, 3).count() == 0


def test_slots_beside_columns_of_any_name(spark):
    names = ["key", "shard", "slot", "all", "row", "by0", "_row", "_slice", "_place", "_base", "_first", "_b_shard"]
    rows = [(i, *[f"{n}{i}" for n in names[1:]]) for i in range(50)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'key' else 'string'}" for n in names))
    assigned = sharding.assign(df, "key", [1.0] * 3)
    found = sharding.with_slots(assigned, ["key"])
    assert sorted(found.columns) == sorted(names)
    shards = {}
    for r in sorted(found.collect(), key=lambda r: r.key):
        assert r.slot == len(shards.setdefault(r.shard, []))
        shards[r.shard].append(r.key)
        assert all(r[n] == f"{n}{r.key}" for n in names[3:])


# --- quality -----------------------------------------------------------------


def test_counts_by_hand(spark):
    text = "a b c d e f g a b c d e\nDup line here\n \nDup line here\n#$ | <x>"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = quality.report(df).first()
    own = text.split()
    assert r.n_words == len(own) and r.word_chars == sum(map(len, own))
    assert r.n_symbols == 5 and r.n_dup_lines == 1
    assert r.n_repeat_words == 10  # the five words before and after "f g"
    assert r.base_failed and not r.kept


def test_a_table_of_rules_is_compiled(spark):
    df = spark.createDataFrame(
        [(1, "x " * 30), (2, " ".join(f"w{i}" for i in range(30)))], "doc_id long, text string"
    )
    few = (quality.Rule("many", "n_words", None, None, 5.0),)
    assert quality.keep(df, base=few, rules=()).count() == 0
    assert [r.doc_id for r in quality.keep(df, rules=()).collect()] == [2]


def test_rules_on_odd_rows(spark, odd, none):
    rows = quality.report(odd).collect()
    assert len(rows) == odd.count()
    assert {r.n_words for r in rows if r.doc_id in (3, 4, 5)} == {0}
    kept = quality.keep(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(
        r.doc_id or 0 for r in rows if r.kept
    )
    assert quality.keep(none).count() == 0 and quality.report(none).count() == 0


# --- decontamination -----------------------------------------------------------


def grams(text: str, size: int = 5):
    own = [bytes(w) for w in _words(text)]
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def contains(body: str, item: str) -> bool:
    """An item of fewer than five words is one shingle."""
    n = min(len(_words(item)), 5)
    sought = grams(item, n) if n else set()
    return bool(sought) and 10 * len(sought & grams(body, n)) >= 8 * len(sought)


def _words(text: str):
    import re

    return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))


def test_items_inside_documents(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [
        (i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 4, 5, 8, 20, 60, 200]))))
        for i in range(40)
    ] + [(40, ""), (41, "W5")]
    rows = []
    for d in range(120):
        own = [rng.choice(vocabulary) for _ in range(rng.choice([3, 50, 400, 6000]))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            passage = rng.choice(items)[1].upper().split()
            if passage and rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = "other"
            at = rng.randrange(len(own))
            own[at:at] = passage
        rows.append((d, ", ".join(own)))
    want = set()
    for i, text in items:
        want |= {(d, i) for d, body in rows if contains(body, text)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, bench).collect()}
    assert got == want and len(want) > 30
    clean = decontaminate.without_items(docs, bench)
    assert {r.doc_id for r in clean.collect()} == set(range(120)) - {d for d, _ in want}


def test_items_in_several_blocks(spark):
    items = spark.createDataFrame(
        [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(5)], "item_id long, text string"
    )
    blocks = list(decontaminate.item_blocks(items, 20))
    assert [b.ids for b in blocks] == [[0, 1], [2, 3], [4]]


@pytest.mark.parametrize("size", [5, 6, 8, 12])
def test_no_small_item_is_missed(size):
    """Each item stands once in one long text, where one window or two hold it."""
    texts = [" ".join(f"s{i}x{k}" for k in range(size)) for i in range(4000)]
    whole = " filler of seven words that stays equal ".join(texts)
    block = next(decontaminate.blocks(pa.array([whole]), 1 << 30))
    sets = []
    for text in texts:
        own, _ = decontaminate.Shingled(next(decontaminate.blocks(pa.array([text])))).of()
        sets.append(np.unique(own))
    items = decontaminate.index_items(list(range(len(texts))), sets, [size] * len(texts))
    found = decontaminate.matches(block, items, decontaminate.THRESHOLD)
    assert [i for _, i, _ in found] == list(range(len(texts)))


def test_short_items_agree_with_sql(spark):
    docs = [(1, "Yes, it is."), (2, "it was; yes it IS so"), (3, "it is not"), (4, None), (5, "is it")]
    items = [(1, "It is"), (2, "yes"), (3, "is not"), (4, "it is it is it"), (5, ""), (6, None), (1, "is it")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("docs", docs.toArrow())
    con.register("items", items.toArrow())
    sql = decontaminate.CONTAINED_SQL.format(docs="docs", items="items", threshold=0.8)
    got = decontaminate.contained_items(docs, items)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 3), (5, 1)]
    assert difference(got, con, sql) is None


def test_items_and_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, None), (2, "four words are few"), (4, "ONE"), (5, " ... "), (3, "repeated row of exactly these eight"), (3, "repeated row of exactly these eight")],
        "item_id long, text string",
    )
    found = decontaminate.contained_items(odd, items).collect()
    assert sorted((r.doc_id, r.item_id, r.containment) for r in found) == [(6, 4, 1.0)] + [(9, 3, 1.0)] * 2
    clean = decontaminate.without_items(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 3
    assert decontaminate.contained_items(odd, items.limit(0)).count() == 0
    assert decontaminate.without_items(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.contained_items(none, items).count() == 0


# --- pieces ------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    with open(MODEL, "rb") as file:
        return sentencepiece_scan.read_model(file.read())


TEXTS = [
    "", "a", " ", "  hello   world ", "日本語 text €\n\nx", "\U0001F600 emoji\x00", "x" * 130,
    "ab" * 80 + " c" * 30, "日本" * 50, "the" * 60 + "\n" + "e" * 70, "tab\tand\r\nline",
]


@pytest.mark.parametrize("chunk", [16, 37, 1 << 16])
def test_pieces_are_best_wherever_the_text_is_cut(spark, pieces, chunk):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    scores = {
        own.id_to_piece(i): (round(own.get_score(i)), i) for i in range(3 + 256, own.get_piece_size())
    }
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in sentencepiece_scan.encode(df, MODEL, chunk).collect()}
    for i, text in enumerate(TEXTS):
        want = brute.segment(text, scores, int(pieces.unknown), 16, pieces.byte_ids.tolist())
        assert got[i] == want, (i, text[:20])


def test_max_plus_products_are_associative():
    rng = np.random.default_rng(2)
    a, b, c = (rng.integers(-50, 0, (3, 4, 4)) for _ in range(3))
    left = sentencepiece_scan.product(sentencepiece_scan.product(a, b), c)
    assert (left == sentencepiece_scan.product(a, sentencepiece_scan.product(b, c))).all()
    upto = sentencepiece_scan.scan(a)
    assert (upto[2] == sentencepiece_scan.product(
        sentencepiece_scan.product(a[:1], a[1:2]), a[2:3])[0]).all()


def test_round_trip(spark, odd, none):
    rows = {r.doc_id: r for r in sentencepiece_scan.report(odd, MODEL).collect() if r.doc_id != 9}
    assert all(r.round_trip for r in rows.values()) and rows[3].n_pieces == rows[4].n_pieces == 0
    marked = spark.createDataFrame([(1, "a▁b"), (2, None)], "doc_id long, text string")
    assert [r.round_trip for r in sentencepiece_scan.report(marked, MODEL).orderBy("doc_id").collect()] == [False, True]
    assert sentencepiece_scan.report(none, MODEL).count() == 0
