"""The corpus pipeline: five stages over ``documents``, each written and read again.

1. toxicity      documents whose calibrated toxicity reaches 0.7 go
2. near_copies   one document (the smallest doc_id) of each near-copy component stays
3. pii           personal data is replaced by surrogates, in place
4. mixing        documents appear as often as the fitted rates say
5. pieces        texts become the ids of the fixed public vocabulary

All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import jaccard, mixing, pii, sentencepiece, toxicity
from spindle.llm.base import written

#: Near copies: five-word shingles, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; every row is
    judged by its own text, NULL and empty ones by the rate of such texts."""
    return toxicity.without_toxic(docs, _labels(spark, sf_dir))


def _aside(docs: DataFrame) -> dict[str, str]:
    """Names under which columns that no stage reads pass an operator, so
    that none meets a column that the operator adds."""
    return {c: c if c.lower() in ("doc_id", "text", "lang") else f"passed_{i}" for i, c in enumerate(docs.columns)}


def _back(out: DataFrame, names: dict[str, str]) -> DataFrame:
    return out.select(*names.values()).toDF(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-copy component: the one of smallest doc_id.

    NULL and empty texts and rows with a NULL doc_id belong to no component
    and stay.  Rows with the same doc_id and text are one row; with different
    texts they are documents of their own, told apart by a written row number.
    """
    found = written(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
                    .filter("rows > 1").select("doc_id"), "pipeline-twice")
    if not found.limit(1).count():
        same = jaccard.jaccard_components(docs, words=SHINGLE_WORDS, threshold=SIMILARITY)
        gone = written(same.filter("component_id <> doc_id").select("doc_id"), "pipeline-copies")
        return jaccard.rows_without(docs, gone)
    names = _aside(docs)
    rows = docs.toDF(*names.values())
    rows = jaccard.rows_without(rows, found).unionByName(
        jaccard.kept_rows(rows, found).dropDuplicates(["doc_id", "text"]))
    rows = written(rows.withColumn("row_number", F.monotonically_increasing_id()), "pipeline-rows")
    same = jaccard.jaccard_components(rows.filter("doc_id is not null").select(F.col("row_number").alias("doc_id"), "text"),
                                      words=SHINGLE_WORDS, threshold=SIMILARITY)
    member = rows.select("doc_id", "row_number").join(same.select(F.col("doc_id").alias("row_number"), "component_id"), "row_number")
    member = written(member, "pipeline-members")
    first = member.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_number"))["row_number"].alias("row_number"))
    gone = written(member.select("row_number").join(first, "row_number", "left_anti"), "pipeline-copies")
    kept = rows.join(gone, "row_number", "left_anti")
    return _back(kept, names)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, the entities of their texts replaced; NULL and empty texts
    stay, repeated rows are rewritten alike, other columns pass through."""
    names = _aside(docs)
    out = pii.pseudonymise(docs.toDF(*names.values()))
    return _back(out, names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as its rate says (perhaps not at all).  NULL
    and empty texts have a rate like any other, repeated rows draw alike,
    other columns pass through."""
    names = _aside(docs)
    out = mixing.mix(docs.toDF(*names.values()), _labels(spark, sf_dir))
    times = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return _back(out.filter("copies > 0").select("*", times), names)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids)`` of every row; NULL and empty texts have no ids."""
    return sentencepiece.encode(docs)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("pii", replace_personal_data),
          ("mixing", mix_sources), ("pieces", to_pieces)]

#: SQL can express neither the fitted models nor the surrogates; tests/llm holds run() against a plain rebuild.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}
