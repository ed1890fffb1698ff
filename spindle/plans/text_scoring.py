"""Multi-label text scoring.

Every document is read and hashed once: the term counts of all documents are
written with their labels joined on, IDF is learnt on the labelled rows, and
one L2-penalised logistic model per label is fitted by shared passes.
Unlabelled documents get one probability per label in a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import clean_text
from spindle.operators.common import ensure_parallelism, materialized
from spindle.operators.multilabel import MultilabelModel, fit_labels, vector_certificate
from spindle.operators.text import NUM_HASH_FEATURES, estimator_tokens, hashing_tf, stop_words_remover
from spindle.sources import load_table

LABELS = ["quality", "toxic"]
REG_PARAM = 0.1


def featurize(docs: DataFrame, text_col: str = "text"):
    """clean → tokens (Tokenizer's rule) → stop words → hashed TF; returns the
    frame with ``tf``.  (IDF is fitted separately, on training rows.)"""
    words = docs.withColumn("tokens", estimator_tokens(clean_text(text_col)))
    words = stop_words_remover("tokens", "words").transform(words)
    return hashing_tf("words", "tf").transform(words)


def fitted_features(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(training rows, unlabelled rows) with ``features``; documents are read
    once, into a written table of term counts."""
    from pyspark.ml.feature import IDF
    docs = ensure_parallelism(load_table(spark, sf_dir, "documents", ["doc_id", "text"]), keys=["doc_id"])
    labels = load_table(spark, sf_dir, "labels").select("doc_id", *LABELS, F.lit(True).alias("labelled"))
    tf = materialized(featurize(docs).select("doc_id", "tf").join(labels, "doc_id", "left"), "text-features")
    train = tf.filter("labelled").na.drop(subset=LABELS).select("doc_id", *LABELS, "tf")
    idf = IDF(inputCol="tf", outputCol="features").fit(train)
    train_x = materialized(idf.transform(train).select("doc_id", *LABELS, "features"), "text-train")
    return train_x, idf.transform(tf.filter("labelled is null")).select("doc_id", "features")


def fit_text_models(train_x: DataFrame, labels: list[str]) -> MultilabelModel:
    return fit_labels(train_x, "features", labels, NUM_HASH_FEATURES, reg_param=REG_PARAM)


def run_multilabel(spark, sf_dir) -> DataFrame:
    train_x, test_x = fitted_features(spark, sf_dir)
    return fit_text_models(train_x, LABELS).transform(test_x, "features", ["doc_id"])


def run_single(spark, sf_dir, label: str = "toxic") -> DataFrame:
    """One penalised fit on all labelled rows, scored on those rows."""
    train_x, _ = fitted_features(spark, sf_dir)
    out = fit_text_models(train_x, [label]).transform(train_x, "features", ["doc_id", label])
    p = F.col(f"p_{label}")
    return out.select("doc_id", label, F.round(p, 6).alias("probability"), (p > 0.5).cast("double").alias("prediction"))


def run_certificate(spark, sf_dir) -> DataFrame:
    """``(label, n_rows, largest_gradient)`` of the text models: how far they are from their minimum."""
    train_x, _ = fitted_features(spark, sf_dir)
    return vector_certificate(train_x, "features", fit_text_models(train_x, LABELS), REG_PARAM)
