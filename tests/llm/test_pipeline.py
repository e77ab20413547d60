"""The pipeline against a plain version, and the registered queries against SQL."""

from __future__ import annotations

import os

import brute
import pytest
from oracle import difference, duck
from test_scan import MODEL, VOCABULARY, contains

import corpus_pipeline
from brooklog.llm import licenses, quality, queries, sentencepiece_scan, token_counts
from brooklog.llm.queries import PATTERN

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), con, queries.ORACLES[name]) is None


def test_queries_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op3_suffix_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == brute.drop_repeats(rows, 100, "bytes")
    got = queries.QUERIES["op8_substring_dedup"](spark, SF_DIR).collect()
    want = brute.drop_repeats(rows, 20, "words")
    assert {r.doc_id: tuple(r[1:]) for r in got} == {d: (n, k, s) for d, (n, k, _, s) in want.items()}
    got = queries.QUERIES["op6_ngram_jaccard_join"](spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == brute.components(rows, 85, 4)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def test_licenses_of_the_table(spark, documents):
    """Against alignments of every text with every template, found by no index."""
    got = queries.QUERIES["op1_license_scan"](spark, SF_DIR).collect()
    want = brute.licenses_of(documents, licenses.NOTICES, licenses.COVERAGE)
    assert {(r.doc_id, r.license) for r in got} == want and len(want) > 5
    texts = dict(documents)
    assert all(texts[r.doc_id][r.start : r.end] == r.span for r in got)
    exact = sum(t.count("Released under the MIT License.") for t in texts.values() if t)
    assert sum(r.license == "MIT" and r.coverage == 1 for r in got) >= exact > 0


def test_tokens_of_the_table(spark, documents):
    """Against each token's bytes, one by one."""
    with open(VOCABULARY, "rb") as file:
        own = token_counts.Encoder(file.read(), PATTERN)
    want = {}
    for doc, text in documents:
        raw = (text or "").encode()
        line = [0]
        for byte in raw[:-1]:
            line.append(line[-1] + (byte == 10))
        if raw:
            want |= {(doc, k): 0 for k in range(line[-1] + 1)}
        begin = 0
        for end in own.ends(text or "").tolist():
            held = line[begin:end]
            best = max(set(held), key=lambda k: (held.count(k), -k))
            want[doc, best] += 1
            begin = end
    got = queries.QUERIES["op2_token_counts"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.section): r.n_tokens for r in got} == want


def test_pieces_of_the_table(spark, documents):
    """Against plain segmentation of every text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    with open(MODEL, "rb") as file:
        pieces = sentencepiece_scan.read_model(file.read())
    scores = {
        model.id_to_piece(i): (round(model.get_score(i)), i) for i in range(3 + 256, model.get_piece_size())
    }
    bytes_ = pieces.byte_ids.tolist()
    got = {r.doc_id: r for r in queries.QUERIES["op10_sentencepiece"](spark, SF_DIR).collect()}
    assert len(got) == len(documents) and all(r.round_trip for r in got.values())
    for doc, text in documents:
        assert got[doc].ids == brute.segment(text, scores, int(pieces.unknown), 16, bytes_), doc
        assert got[doc].n_pieces == len(got[doc].ids)


def brute_pipeline(documents, items, con):
    """{doc_id: text} after the first four stages; quality counts come from SQL."""
    verdicts = con.execute(quality.REPORT_SQL).fetchdf()
    kept = set(verdicts[verdicts["kept"]]["doc_id"])
    rows = {d: t for d, t in documents if d in kept}
    gone = brute.removed_lines(rows.items(), 1, 5)
    for d, lines in gone.items():
        if lines:
            rows[d] = "\n".join(x for i, x in enumerate(rows[d].split("\n")) if i not in lines)
            if not brute.words(rows[d]):
                del rows[d]
    roots = brute.components(rows.items(), corpus_pipeline.PERCENT, corpus_pipeline.SHINGLE)
    rows = {d: t for d, t in rows.items() if roots[d][1] == d}
    return {d: t for d, t in rows.items() if not any(contains(t, item) for item in items)}


def test_pipeline_against_brute_force(spark, con):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = brute_pipeline([tuple(r) for r in documents.collect()], items, con)
    found = corpus_pipeline.run(spark, SF_DIR)
    decoded = sentencepiece_scan.decode(found, MODEL).collect()
    assert {r.doc_id: r.decoded for r in decoded} == want
    assert all(r.round_trip for r in decoded)


def test_copies_go_with_their_short_lines(spark):
    whole = "Title.\nthe first line has these eight words here\n\nEnd."
    docs = spark.createDataFrame(
        [(1, whole), (2, whole), (3, "Title.\nother words than those\nEnd.")], "doc_id long, text string"
    )
    left = corpus_pipeline.deduplicate_lines(spark, docs, SF_DIR)
    assert sorted(tuple(r) for r in left.collect()) == [(1, whole), (3, "other words than those")]


def test_each_stage_on_odd_rows(spark, odd, none, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns."""
    items = [(1, "Naïve café"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    whole = texts(odd)

    def after(name):
        found = stages[name](spark, odd, str(tmp_path))
        assert found.columns == odd.columns and stages[name](spark, none, str(tmp_path)).count() == 0
        # all other columns are as they were
        others = [c for c in odd.columns if c not in ("doc_id", "text")]
        assert {tuple(r) for r in found.select(others).collect()} <= {tuple(r) for r in odd.select(others).collect()}
        return texts(found)

    kept = after("quality_rules")
    assert set(kept) <= set(whole) and not [d for d, _ in kept if d in (3, 4, 5, 6)]
    told = [r.doc_id for r in quality.report(odd).collect() if r.kept]
    assert sorted(str(d) for d, _ in kept) == sorted(map(str, told))
    left = after("line_dedup")
    # 2 and 8 are copies of 1 and 7, and the text without an id differs from 1 by a word
    assert [d for d, _ in left] == [1, 10, 3, 4, 5, 6, 7, 9, 9, 9, None]
    assert (None, None) in left and (3, None) in left and (5, " \n\t\n ") in left
    one = after("ngram_jaccard_join")
    assert sorted(d or 0 for d, _ in one) == [0, 0, 1, 3, 4, 5, 6, 7, 9, 9, 10]
    clean = after("benchmark_decontamination")
    assert clean == [x for x in whole if x[0] != 10]
    pieces = stages["sentencepiece"](spark, odd, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in pieces) == sorted(str(d) for d, _ in whole)
    assert all(r.round_trip for r in pieces) and {r.n_pieces for r in pieces if r.doc_id in (3, 4)} == {0}
    assert stages["sentencepiece"](spark, none, str(tmp_path)).count() == 0
