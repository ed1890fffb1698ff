"""NULLs, empty and long texts, ties, repeated rows, empty tables and extra
columns for every operator and pipeline stage."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spindle.llm import ann, jaccard, katz, langid, mixing, pii, sentencepiece, sharding, topk, toxicity
from spindle.llm.queries import QUERIES

LONG = "word " * 30_000 + "x" * 70_000
ROWS = [(1, "The quick brown fox jumps over it", "en", "a", 1, 9.0), (2, None, "en", "a", 2, 9.0), (3, "", None, None, 3, 9.0),
        (4, "The quick brown fox jumps over it", "en", "a", 1, 9.0), (4, "The quick brown fox jumps over it", "en", "a", 1, 9.0),
        (5, LONG, "de", "b", 5, None), (None, "nul\0 byte 漢字 ñ", None, "b", None, None), (7, " \t\n", "fr", "c", 7, 1.0)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 0, None), (None, 1, 1), (4, 1, 0)],
                                 "doc_id long, quality int, toxic int")


TEXT_OPS = {"katz": (lambda d, _: katz.katz_scores(d), 8), "pii": (lambda d, _: pii.pseudonymise(d), 8),
            "shards": (lambda d, _: sharding.shard_documents(d), 8), "toxicity": (toxicity.score_toxicity, 8),
            "pieces": (lambda d, _: sentencepiece.encode(d), 8), "langid": (lambda d, _: langid.predict_languages(d), 8),
            "mixing": (mixing.mix, 8), "rates": (mixing.document_rates, 8), "jaccard": (lambda d, _: jaccard.jaccard_components(d), 6)}


@pytest.mark.parametrize("name", TEXT_OPS)
def test_odd_rows_and_empty_tables(name, docs, none, labels):
    run, rows = TEXT_OPS[name]
    out = run(docs, labels)
    assert out.count() == rows
    empty = run(none, labels)
    assert empty.columns == out.columns and empty.count() == 0


def test_defined_results(docs, labels):
    same = {r.doc_id: r for r in jaccard.jaccard_components(docs).collect()}
    assert same[4].component_id == 1 and same[2].n_shingles == same[3].n_shingles == same[7].n_shingles == 0
    lang = {r.doc_id: r.lang_pred for r in langid.predict_languages(docs).collect()}
    assert lang[2] == lang[3] == lang[7] == "und"
    tokens = {r.doc_id: r.n_tokens for r in katz.katz_scores(docs).collect()}
    assert tokens[2] == tokens[3] == tokens[7] == 1 and tokens[1] == 8 and tokens[5] == 30_002
    pieces = {r.doc_id: r.ids for r in sentencepiece.encode(docs).collect()}
    assert pieces[2] == pieces[3] == []
    back = {r.doc_id: r.text for r in sentencepiece.decode(sentencepiece.encode(docs)).collect()}
    assert back[5] == LONG and back[None] == ROWS[6][1]
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(docs, labels).collect())


def test_the_pieces_query_decodes_every_row(spark, docs, tmp_path):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(
        ["  two  spaces ", " ", "😀😀 \u200d end", "tab\tline\n\n", "ñ" * 5000, LONG, "x" * 70_000, "ends with space "])],
        "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(more)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or 0, r.text_crc32, r.text_bytes) for r in QUERIES["op7_sentencepiece"][0](spark, str(tmp_path)).collect())
    want = [(r.doc_id or 0, (r.text or "").encode()) for r in table.collect()]
    assert got == sorted((i, zlib.crc32(t), len(t)) for i, t in want)


def test_stages_keep_columns_and_take_odd_rows(spark, docs, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, none):
            out = stage(spark, table, str(tmp_path))
            if name != "pieces":
                assert out.columns == docs.columns
            if table is none:
                assert out.count() == 0
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 5, 7]


def test_vectors_with_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (3, [0.5, 0.5], 1), (3, [0.5, 0.5], 1), (4, None, 1), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (None, [1.0, 1.0], 1), (8, [0.0, 0.0], 1), (9, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = topk.top_inner_products(table).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [
        (0, 20, 4096), (0, 3, 2048), (0, 8, 0), (20, 0, 4096), (20, 3, 2048), (20, 8, 0)]
    got = ann.nearest_vectors(table).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 20, 1.0), (0, 3, 0.5), (20, 0, 1.0), (20, 3, 0.5)]
    empty = table.filter("false")
    assert topk.top_inner_products(empty).count() == ann.nearest_vectors(empty).count() == 0
