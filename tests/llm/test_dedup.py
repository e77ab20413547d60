"""Operators 3, 6, 7 and 8, and what they share."""

from __future__ import annotations

import itertools
import random
import zlib

import brute
import numpy as np
import pytest
from conftest import ODD_ROWS  # noqa: F401

from brooklog.llm import graph, jaccard_join, line_dedup, substring_dedup, suffix_dedup


def passages(seed: int, documents: int = 60):
    """Texts that share passages, whole or changed, also within themselves."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(8)]
    rows = []
    for d in range(documents):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.6:
                part = list(rng.choice(shared))
                if rng.random() < 0.4:
                    part[rng.randrange(len(part))] = "changed"
            else:
                part = [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))]
            parts.append(" ".join(part))
        rows.append((d * 3, rng.choice([" ", "\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("length, gram", [(20, 6), (5, 2)])
def test_words_that_repeat_go(spark, length, gram):
    rows = passages(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.drop_repeats(rows, length, "words")
    got = substring_dedup.drop_repeats(df, length, gram).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        d: (n, gone, sha) for d, (n, gone, _, sha) in want.items()
    }


@pytest.mark.parametrize("limits", [{}, {"collection": 3}, {"core_limit": 0}])
def test_bytes_that_repeat_go(spark, limits):
    rows = passages(2, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.drop_repeats(df, **limits).collect()
    assert {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got
    } == brute.drop_repeats(rows, suffix_dedup.LENGTH, "bytes")


@pytest.mark.parametrize("length", [100, 300])
def test_longer_strings_than_a_byte_can_count(spark, length):
    rng = random.Random(9)
    shared = "".join(rng.choice("abcd ") for _ in range(900))
    rows = [(d, f"{d}" * 5 + shared[40 * d : 40 * d + 520] + f"{d}" * 5) for d in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.drop_repeats(df, length).collect()
    assert {r.doc_id: tuple(r[1:5]) for r in got} == brute.drop_repeats(rows, length, "bytes")
    members = [t[k : k + 400].encode() for _, t in rows for k in (0, 60)]
    offsets = np.cumsum([0, *map(len, members)])
    who, start, cls = suffix_dedup.equal_strings(np.frombuffer(b"".join(members), np.uint8), offsets, 300)
    strings = {}
    for m, at, c in zip(who.tolist(), start.tolist(), cls.tolist()):
        strings.setdefault(c, set()).add(members[m][at : at + 300])
    assert all(len(x) == 1 for x in strings.values())
    assert len(strings) == len(set().union(*strings.values()))


@pytest.mark.parametrize("leaf", [1, 3, 1 << 20])
def test_regions_are_divided_and_lose_no_link(spark, monkeypatch, leaf):
    """Families of near copies that share their first half with all others."""
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    rng = random.Random(7)
    common = [f"c{i}" for i in range(30)]
    rows = []
    for family in range(6):
        own = [f"f{family}w{i}" for i in range(30)]
        for _ in range(8):
            words = common + own
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                words[rng.randrange(30, 60)] = f"x{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(words)))
    divided = []
    whole = jaccard_join._voronoi
    monkeypatch.setattr(
        jaccard_join, "_voronoi", lambda *a: divided.append(whole(*a)) or divided[-1]
    )
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.report(df, 80, 2).collect()}
    assert got == brute.components(rows, 80, 2)
    assert bool(divided[0][1]) == (leaf < 1 << 20)


def test_maximal_repeats_name_their_source(spark):
    one = " ".join(f"a{i}" for i in range(50))
    two = " ".join(["b"] + [f"a{i}" for i in range(10, 40)] + ["c"])
    df = spark.createDataFrame([(5, one), (6, two)], "doc_id long, text string")
    found = [tuple(r) for r in substring_dedup.maximal_repeats(df).collect()]
    assert found == [(6, 1, 31, 5, 10)]


def test_collection_transform_sorts_all_suffixes():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, rng.integers(0, 25)).astype(np.uint8)) for _ in range(30)]
    offsets = np.cumsum([0, *map(len, texts)])
    before, common = suffix_dedup.collection_bwt(np.frombuffer(b"".join(texts), np.uint8), offsets)
    suffixes = sorted(
        (t[i:], k, t[i - 1] + 1 if i else 0) for k, t in enumerate(texts) if t for i in range(len(t) + 1)
    )
    filled = [t for t in texts if t]
    # empty strings have a suffix too
    extra = len(texts) - len(filled)
    assert sorted(before.tolist()) == sorted([x[2] for x in suffixes] + [0] * extra)
    want = [0]
    for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        want.append(n)
    assert sorted(common.tolist()) == sorted(want + [0] * extra)


def near_copies(seed: int):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(2000)]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 5, 8, 12, 20, 40, 80, 200]))]
        for _ in range(rng.choice([1, 2, 3, 8, 25])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 15))):
                k = rng.randrange(len(own))
                own[k : k + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(9000, None), (9001, ""), (9002, " \n")]


@pytest.mark.parametrize("percent, size", [(85, 4), (80, 5)])
def test_components_are_exact(spark, percent, size):
    rows = near_copies(percent)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.report(df, percent, size).collect()
    want = brute.components(rows, percent, size)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    stay = {r.doc_id for r in jaccard_join.one_of_each(df, percent, size).collect()}
    assert stay == {root for _, root in want.values()}


def test_unlike_sets_with_common_parts_are_compared_in_bands(spark):
    """A pivot's region also holds sets that are linked with each other only."""
    rng = random.Random(8)
    base = [f"z{i}" for i in range(120)]
    rows = []
    for k in range(60):
        own = list(base)
        for i in rng.sample(range(120), k % 12):
            own[i] = f"n{k % 7}{i}"
        rows.append((k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.report(df).collect()}
    assert got == {d: root for d, (_, root) in brute.components(rows, 85, 4).items()}


def test_sets_that_only_share_passages_are_not_compared(spark, monkeypatch):
    shared = [f"s{i}" for i in range(50)]
    rows = [(d, " ".join([*(f"d{d}x{i}" for i in range(130)), *shared])) for d in range(40)]
    rows += [(100, rows[0][1]), (101, rows[1][1] + " end")]
    written = {}

    def noted(df, label, *path):
        out = write_out(df, label, *path)
        written[label] = out.count()
        return out

    write_out = jaccard_join.write_out
    monkeypatch.setattr(jaccard_join, "write_out", noted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.report(df).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: {100: 0, 101: 1}.get(d, d) for d, _ in rows}
    # the two that are linked, and hardly any of the others
    assert 2 <= written["sets"] <= 5


def test_apart_sets_are_not_compared_by_each_common_shingle(spark, monkeypatch):
    """Sets near one pivot share a passage that it lacks, which is too little for a link."""
    rng = random.Random(5)
    common, passages = [f"c{i}" for i in range(60)], [[f"{p}{i}" for i in range(18)] for p in "pq"]
    rows = []
    for d in range(40):
        own = [f"d{d}x{i}" for i in range(22)]
        rows.append((d, " ".join(common + passages[d % 2] + own)))
    for d in range(0, 40, 5):
        words = rows[d][1].split()
        for _ in range(3):
            words[rng.randrange(60, 100)] = f"e{rng.randrange(1000)}"
        rows.append((100 + d, " ".join(words)))
    written = {}

    def noted(df, label, *path):
        out = write_out(df, label, *path)
        written[label] = out.count()
        return out

    write_out = jaccard_join.write_out
    monkeypatch.setattr(jaccard_join, "write_out", noted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.report(df, 80, 2).collect()}
    assert got == brute.components(rows, 80, 2)
    # they share far more shingles with each other, each with all that hold the passage
    assert written["shared"] > 15 and written["held"] < 3 * written["shared"]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 80)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 80: 80, 90: 80}


def edited_lines(seed: int):
    rng = random.Random(seed)
    vocabulary = [f"u{i}" for i in range(30)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 16))] for _ in range(12)]
    rows = []
    for d in range(50):
        lines = []
        for _ in range(rng.randint(0, 6)):
            own = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(own) + 1)
                own[k : k + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
                own = own or ["u0"]
            lines.append("  ".join(own) if rng.random() < 0.2 else " ".join(own))
        rows.append((d * 2, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed, least", [(1, (1, 5)), (2, (1, 5)), (3, (5, 10))])
def test_alike_lines_go(spark, seed, least):
    rows = edited_lines(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: set(r.removed) for r in line_dedup.removed_lines(df, *least).collect()}
    want = {d: gone for d, gone in brute.removed_lines(rows, *least).items() if gone}
    assert got == want and sum(map(len, want.values())) > 20


@pytest.mark.parametrize("size", [*range(5, 26), 31, 32, 33, 47, 48, 49, 64, 96])
def test_any_one_edit_is_found(spark, size):
    """One word replaced, missing or more, at every place of a line of any size."""
    own = [f"x{i}" for i in range(size)]
    lines = [" ".join(own)]
    for i in range(size):
        lines += [" ".join(own[:i] + ["y"] + own[i + 1 :]), " ".join(own[:i] + ["z"] + own[i:])]
        lines += [" ".join(own[:i] + own[i + 1 :])] if size > 5 else []
    df = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "doc_id long, text string")
    gone = {r.doc for r in line_dedup.removed_lines(df).collect()}
    assert gone == set(range(1, len(lines)))


def test_short_equal_lines_go(spark):
    rows = [(1, "Yes.\n\none two\nYes."), (2, "Yes.\n\none  two \none two three"), (3, "one two four")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: sorted(r.removed) for r in line_dedup.removed_lines(df).collect()}
    assert got == {1: [3], 2: [0, 2]}


def test_texts_without_ids_are_told_apart(spark):
    """Two texts of one 32-bit checksum, and no id, are two texts."""
    seen, pair = {}, None
    for i in itertools.count():
        text = f"b{i} first words b{i} of it\nown b{i} and b{i} line here now"
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text:
            pair = [other, text]
            break
    df = spark.createDataFrame([(None, t) for t in pair], "doc_id long, text string")
    assert sorted(r.text for r in jaccard_join.one_of_each(df).collect()) == sorted(pair)
    assert sorted(r.text for r in line_dedup.without_repeats(df).collect()) == sorted(pair)
    for run in (substring_dedup.drop_repeats, suffix_dedup.drop_repeats):
        assert [r.n_removed for r in run(df).collect()] == [0, 0]


def test_text_without_the_lines(spark, odd):
    got = line_dedup.without_repeats(odd).collect()
    assert got[0].asDict().keys() == odd.first().asDict().keys()
    texts = {}
    for r in got:
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[1] == ["The first of all lines has these ten words in it.\nAnother line."]
    assert 2 not in texts  # all of its words are in lines of the first
    assert texts[3] == [None] and texts[4] == [""] and texts[5] == [" \n\t\n "]
    # equal rows of one id do not remove each other; the null id comes last
    assert len(texts[9]) == 3 and texts[None] == [None]
    # the longer text is one edit from the shorter, and all of its one line
    assert 8 not in texts and 7 in texts


def test_odd_rows(spark, odd):
    n = odd.count()
    for run in (substring_dedup.drop_repeats, suffix_dedup.drop_repeats):
        rows = run(odd).collect()
        assert len(rows) == n
        by_id = {r.doc_id: r for r in rows if r.doc_id not in (9, None)}
        assert by_id[3].n_removed == by_id[4].n_removed == by_id[7].n_removed == 0
        assert by_id[3].kept_sha256 == by_id[4].kept_sha256
        assert by_id[8].n_removed > 0
        assert all(r.n_removed == 0 for r in rows if r.doc_id == 9)
    components = jaccard_join.report(odd).collect()
    assert len(components) == n
    roots = {r.doc_id: r.component_id for r in components if r.doc_id not in (9, None)}
    assert roots == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 10: 10}
    stay = jaccard_join.one_of_each(odd)
    assert stay.columns == odd.columns
    # of the equal rows of id 9 one stays, and all rows without shingles
    assert sorted((r.doc_id or 0) for r in stay.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 9, 9, 10]


def test_empty_table(none):
    assert substring_dedup.drop_repeats(none).count() == 0
    assert substring_dedup.maximal_repeats(none).count() == 0
    assert suffix_dedup.drop_repeats(none).count() == 0
    assert jaccard_join.report(none).count() == 0
    assert jaccard_join.one_of_each(none).count() == 0
    assert line_dedup.without_repeats(none).count() == 0
