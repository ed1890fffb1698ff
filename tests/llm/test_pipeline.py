"""The corpus pipeline against a plain rebuild, repeated ids and clashing columns."""

import collections

from pyspark.sql import functions as F

import corpus_pipeline
from spindle.llm import mixing, pii, sentencepiece, toxicity
from spindle.llm.base import written
from tests.conftest import SMALL
from tests.llm.test_brute_force import _components


def _pseudonym(text):
    out, last = [], 0
    for start, end, kind in pii.find_entities(text or ""):
        out += [text[last:start], pii.dressed(kind, pii.surrogate(kind, pii.canonical(kind, text[start:end]), pii.KEY), text[start:end])]
        last = end
    return "".join(out) + text[last:] if out else text


def test_run_against_a_plain_rebuild(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs.filter("length(text) > 300").orderBy("doc_id").first()
    more = [first.asDict() | {"doc_id": 900_001}, first.asDict() | {"doc_id": 900_002, "text": first.text + " more"},
            first.asDict() | {"doc_id": 900_003, "text": "Write to jane.roe@mail.example.org about the meadow and the mill"},
            first.asDict() | {"doc_id": 900_004, "text": None}]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    bad = {r.doc_id for r in toxicity.score_toxicity(given, labels).filter("predicted = 1").collect()}
    rows = {r.doc_id: r for r in given.collect() if r.doc_id not in bad}
    parts = _components([(i, r.text) for i, r in rows.items()], 5, 80)
    rows = {i: r for i, r in rows.items() if parts[i][1] == i}
    assert 900_001 not in rows and 900_002 not in rows and 900_004 in rows
    texts = {i: _pseudonym(r.text) for i, r in rows.items()}
    assert "jane.roe" not in texts[900_003]
    left = spark.createDataFrame([r.asDict() | {"text": texts[i]} for i, r in rows.items()], docs.schema)
    times = {r.doc_id: r.copies for r in mixing.document_rates(written(left, "test-left"), labels).collect()}
    got = sentencepiece.decode(corpus_pipeline.run(spark, str(tmp_path))).select("doc_id", "text").collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(
        {(i, t or ""): times[i] for i, t in texts.items() if times[i]})


def test_repeated_ids_keep_texts_that_do_not_link(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, b), (5, c), (5, c), (9, c + " end"), (7, a), (None, a), (None, None), (4, b + " end"), (6, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert collections.Counter(got) == collections.Counter(
        [(4, b + " end"), (5, c), (7, a), (None, a), (None, None), (6, None), (6, "")])


def test_columns_of_the_caller_come_back_as_they_were(spark, tmp_path):
    names = ["n_entities", "tokens", "rate", "copies", "_m0", "f_word", "p_poor", "_score", "row_number", "component_id", "count", "Copy"]
    docs = spark.createDataFrame([(i, f"text number {i} of a few words", "en") for i in range(12)] * 2, "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.concat(F.lit(c), "doc_id") for c in names})
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.collect() for c in names), name
