"""CSV source/sink queries (S2–S5): write a driver table as CSV into the
shared folder, read it back with the workload's options, compare to the
table.  ``sf_dir`` is read-only, so the CSV goes under the folder named by
``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.operators import split
from spindle.session import shared_path
from spindle.sources import load_table, read_csv, read_pair, write_csv


def q_csv_roundtrip_trim(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer")
    padded = cust.select(F.concat(F.lit("  "), F.col("c_custkey").cast("string")).alias("c_custkey"),
                         F.concat(F.lit(" "), "c_name", F.lit("   ")).alias("c_name"),
                         F.concat(F.lit(" "), F.col("c_nationkey").cast("string")).alias("c_nationkey"),
                         F.col("c_acctbal").cast("string").alias("c_acctbal"),
                         F.concat("c_mktsegment", F.lit("  ")).alias("c_mktsegment"))
    path = write_csv(padded, shared_path(spark, "csv-customer"))
    # header + inference + blank trimming, as the reference reads its files;
    # inference gives small keys an int type, so the key is cast back to the table's type
    back = read_csv(spark, path, infer_schema=True, trim=True)
    return back.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def q_csv_multiline_roundtrip(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    base = shared_path(spark, "csv-docs")
    flagged = split.hash_split(docs, ["doc_id"], 80)
    for part in ("train", "test"):
        write_csv(flagged.filter(F.col("split") == part).drop("split"), f"{base}/{part}",
                  multiline_safe=True)
    schema = "doc_id BIGINT, text STRING"
    train, test = read_pair(spark, base, schema=schema, multiline=True)
    both = train.unionByName(test).na.fill({"text": ""})
    return both.select("doc_id", F.length("text").alias("text_len"), F.md5("text").alias("text_md5"))


QUERIES = {
    "csv_roundtrip_trim": (q_csv_roundtrip_trim,
                           "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"),
    "csv_multiline_roundtrip": (q_csv_multiline_roundtrip, """
SELECT doc_id, CAST(length(coalesce(text, '')) AS INTEGER) AS text_len, md5(coalesce(text, '')) AS text_md5
FROM documents"""),
}
