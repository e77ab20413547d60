"""Operators 11 to 13: language model scores, runs of words, hard negatives."""

from __future__ import annotations

import os
import random

import brute
import numpy as np
import pytest
from oracle import difference, duck
from pyspark.sql import functions as F
from test_dedup import passages

from brooklog.llm import hard_negatives, hash_arrays, kneser_ney, queries, runs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rounded(rows):
    order = lambda r: (r[0] is None, *[str(x) for x in r])
    return sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows], key=order)


@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_scores_are_those_of_the_model(spark, monkeypatch, chunk):
    monkeypatch.setattr(kneser_ney, "TOKENS", chunk)
    rows = [(d, t.upper() if d % 7 == 0 else t) for d, t in passages(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rounded(kneser_ney.score(df).collect()) == rounded(brute.kneser_ney(rows))


def test_scores_of_the_table(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    got = queries.QUERIES["op11_lm_scoring"](spark, SF_DIR).collect()
    assert rounded(got) == rounded(brute.kneser_ney([tuple(r) for r in documents.collect()]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rounded(kneser_ney.score(odd).collect()) == rounded(brute.kneser_ney(rows))
    assert kneser_ney.score(none).collect() == []
    # nothing to learn from: doc 3 is held out
    alone = spark.createDataFrame([(3, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in kneser_ney.score(alone).collect()] == [(3, True, 3, 0, 0, 0.0, 0.0)]


def test_sums_of_words_are_spread_over_files(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows = [(d, " ".join(rng.choices(words, k=60))) for d in range(300)]
    sizes, plain = [], kneser_ney._words

    def seen(sums, model, pairs):
        sent = sums.where("shard >= 0").groupBy("shard").agg(F.sum(F.octet_length("keys")).alias("n"))
        sizes.extend(r.n for r in sent.collect())
        return plain(sums, model, pairs)

    monkeypatch.setattr(kneser_ney, "_words", seen)
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 1 << 11)  # 64 shards
    monkeypatch.setattr(kneser_ney, "_TEXTS_AT_ONCE", 7)  # a file's rows come in many batches
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rounded(kneser_ney.score(df).collect()) == rounded(brute.kneser_ney(rows))
    assert max(sizes) <= sum(sizes) / 4
    for ids, bits in ((3_600_000, 7), (17_000_000, 11), (50_000_000, 14)):
        assert (1 << bits) / -(-ids // (1 << kneser_ney._id_bits(ids, bits))) <= 16


def test_orders_and_planes_of_keys():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    for own in (
        keys,
        keys % np.uint64(50),
        (keys >> np.uint64(40)) + np.uint64(3 << 62),  # differ in the bits left out
        np.concatenate([keys, keys, keys ^ np.uint64(1)]),
        keys[:1],
        keys[:0],
    ):
        order = hash_arrays.order_of(own)
        assert sorted(order.tolist()) == list(range(len(own)))
        assert (own[order] == np.sort(own)).all()
        for kind in (np.uint64, np.uint32):
            values = own.astype(kind)
            packed = kneser_ney._planes(values)
            assert packed[: len(own)] == (values & kind(255)).astype(np.uint8).tobytes()
            assert (kneser_ney._plain(packed, kind) == values).all()


def periodic(seed: int, documents: int):
    """Texts of few or many words with periodic stretches, some of them twice."""
    rng = random.Random(seed)
    rows = []
    for d in range(documents):
        kinds = rng.choice([1, 2, 3, 20, 500])
        own = [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(0, 160))]
        if own and rng.random() < 0.7:
            a = rng.randrange(len(own))
            p = rng.randint(1, max(1, (len(own) - a) // 4))
            own = [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]
            if rng.random() < 0.5:
                own += [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(0, 30))] + own[-60:]
        rows.append((d, " ".join(own)))
    return rows


def test_runs_are_all_found(spark):
    rows = periodic(3, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.start, r.length, r.period) for r in runs.find(df).collect()}
    assert got == {(d, *r) for d, t in rows for r in brute.runs(brute.words(t))}
    # the automaton finds them without the search for stretches, too
    for d, text in rows[:60]:
        own = np.array([hash(w) & (2**60 - 1) for w in text.split()], np.uint64)
        assert runs.runs_in(own, 0, len(own)) == set(brute.runs(brute.words(text))) if text else True


def test_long_runs(spark):
    text = " ".join(["a b c"] * 40_000 + [f"x{i % 700}" for i in range(2_900)])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(r) for r in runs.find(df).collect()] == [(1, 0, 120_000, 3), (1, 120_000, 2_900, 700)]


def test_runs_of_the_table(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    got = queries.QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()
    want = [brute.runs_report(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r.n_runs for r in got)


def test_runs_of_odd_rows(spark, odd, none):
    got = [tuple(r) for r in runs.report(odd, runs.planted).collect()]
    want = [brute.runs_report(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert runs.report(none).collect() == [] and runs.find(none).collect() == []


def test_hard_negatives_agree_with_sql(spark):
    got = queries.QUERIES["op13_hard_negatives"](spark, SF_DIR)
    assert difference(got, duck(SF_DIR), hard_negatives.MINE_SQL) is None


@pytest.mark.parametrize("scale, anchors, at_once", [(1, 4096, 256), (1, 7, 2), (40_000, 4096, 3)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, scale, anchors, at_once):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "AT_ONCE", at_once)
    rng = random.Random(8)
    # few values, so that scores tie; half of all rows have one vector and one label
    rows = [
        (i, [scale * rng.choice([-0.5, 0.25, 0.26, 1.0]) for _ in range(6)], rng.randrange(3))
        for i in range(150)
    ] + [(1000 + i, [scale * 0.5] * 6, 1) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = hard_negatives.mine(df, anchors=F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute.hard_negatives(
        [(i, v, x) for i, v, x in df.collect()], lambda i: i % 10 == 0
    )


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1),
        (1, [1.0, None], 1),
        (2, [1.0, nan], 1),
        (3, [1.0, -inf], 2),
        (4, None, 1),
        (5, [1.0, 2.0], None),
        (None, [1.0, 2.0], 1),
        (6, [], 2),
        (7, [0.5], 2),
        (8, [1.0, 2.0, 9.0], 1),
        (9, [1.0, 1.0], 2),
        (9, [1.0, 1.0], 2),
        (10, [3e38, 1.0], 2),
        (0, [1.0, 2.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({c: F.lit(1) for c in ("id", "n", "number", "parts", "sound", "list", "rank")})
    got = hard_negatives.mine(df, anchors=F.col("vec_id") == 0).collect()
    # 0 and 8 score 327680; of label 2 row 9 is in the window, twice, for either row 0
    one = [(0, 8, 1, 9, 327680, 196608), (0, 8, 2, 9, 327680, 196608)]
    assert sorted(map(tuple, got)) == sorted(one * 2)
    assert hard_negatives.mine(df.limit(0)).collect() == []
