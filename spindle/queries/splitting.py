"""Split, sample and preview queries."""

from __future__ import annotations

from spindle.operators import split
from spindle.sources import load_table


def q_hash_split(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey"])
    return split.hash_split(cust, ["c_custkey"], 80)


def q_hash_sample(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    return split.hash_sample(docs, ["doc_id"], 200)


def q_preview_stable(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    return split.preview(orders, ["o_orderkey"], 20)


def md5_bucket_sql(expr: str, buckets: int = 100) -> str:
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT) % {buckets}"


QUERIES = {
    "hash_split": (q_hash_split, f"""
SELECT c_custkey, CASE WHEN {md5_bucket_sql('c_custkey')} < 80 THEN 'train' ELSE 'test' END AS split
FROM customer"""),
    "hash_sample": (q_hash_sample, """
SELECT doc_id, n_chars, md5(CAST(doc_id AS VARCHAR)) AS sample_hash FROM documents
ORDER BY sample_hash, doc_id LIMIT 200"""),
    "preview_stable": (q_preview_stable, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20"),
}
