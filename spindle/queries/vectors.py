"""Vector / array conversions (F4–F6, U1–U4, S10) — all JVM-side."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.functions.vectors import (array_sum, densify, numeric_array, to_array,
                                       to_dense_vector, vector_element)
from spindle.sources import load_table


def q_vector_roundtrip(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    vec = emb.select("vec_id", to_dense_vector(F.col("embedding").cast("array<double>")).alias("v"))
    back = vec.select("vec_id", "v", to_array(densify("v")).alias("arr"))
    return back.select("vec_id", F.round(vector_element("v", 1), 6).alias("elem1"),
                       F.round(array_sum("arr"), 6).alias("vsum"),
                       F.size("arr").alias("dim"))


def q_array_cast(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity",
                                                "l_discount", "l_tax"])
    arr = li.select("l_orderkey", "l_linenumber",
                    numeric_array("l_quantity", "l_discount", "l_tax").alias("pt"))
    return arr.select("l_orderkey", "l_linenumber", F.round(array_sum("pt"), 6).alias("pt_sum"),
                      F.col("pt")[0].alias("pt0"))


QUERIES = {
    "vector_roundtrip": (q_vector_roundtrip, """
SELECT vec_id, round(CAST(embedding[2] AS DOUBLE), 6) AS elem1,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vsum, CAST(len(embedding) AS INTEGER) AS dim
FROM embeddings"""),
    "array_cast": (q_array_cast, """
SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 6) AS pt_sum, l_quantity AS pt0
FROM lineitem"""),
}
