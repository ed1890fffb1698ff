"""Driver queries of this package: name -> (callable(spark, sf_dir), oracle SQL or None)."""

from __future__ import annotations

from spindle.llm import (ann, fim, jaccard, katz, langid, merkle, mixing, oracles, pii, secret_scan, sentencepiece,
                         sharding, topk, toxicity)
from spindle.llm.base import documents


def op10_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(documents(spark, sf_dir, "doc_id", "text"))


def op1_katz(spark, sf_dir):
    return katz.katz_scores(documents(spark, sf_dir, "doc_id", "text"))


def op6_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(documents(spark, sf_dir, "doc_id", "text"),
                                   spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_langid(spark, sf_dir):
    return langid.predict_languages(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op4_hash_tree(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir, "doc_id", "text"), 8)


def op9_soft_mixing(spark, sf_dir):
    return mixing.document_rates(documents(spark, sf_dir, "doc_id", "text", "lang"),
                                 spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_pii_surrogates(spark, sf_dir):
    return pii.pseudonymise(documents(spark, sf_dir, "doc_id", "text"))


def op3_threshold_topk(spark, sf_dir):
    return topk.top_inner_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_posting_lists(spark, sf_dir):
    return ann.nearest_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_sentencepiece(spark, sf_dir):
    return sentencepiece.digest(sentencepiece.encode(documents(spark, sf_dir, "doc_id", "text")))


def op11_merkle(spark, sf_dir):
    return merkle.verified_documents(documents(spark, sf_dir, *merkle.FIELDS))


def op12_fill_in_middle(spark, sf_dir):
    return fim.digest(fim.fill_in_middle(documents(spark, sf_dir, "doc_id", "text")))


def op13_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.find_secrets(documents(spark, sf_dir, "doc_id", "text"), ["doc_id"]))


QUERIES = {
    "op1_katz": (op1_katz, None),
    "op2_pii_surrogates": (op2_pii_surrogates, None),
    "op3_threshold_topk": (op3_threshold_topk, oracles.TOP_K),
    "op5_posting_lists": (op5_posting_lists, None),
    "op4_hash_tree": (op4_hash_tree, None),
    "op9_soft_mixing": (op9_soft_mixing, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_sentencepiece": (op7_sentencepiece, None),
    "op8_langid": (op8_langid, None),
    "op10_ngram_jaccard": (op10_ngram_jaccard, oracles.JACCARD),
    "op11_merkle": (op11_merkle, oracles.MERKLE),
    "op12_fill_in_middle": (op12_fill_in_middle, oracles.FIM),
    "op13_secret_scan": (op13_secret_scan, None),
}
