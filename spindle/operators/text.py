"""Text features (E1–E4): tokens, stop words, term frequency, IDF.

Two forms:

* exact and relational — tokens are exploded to ``(doc, term)`` rows and
  counted; IDF is a ``(term, doc_freq, idf)`` table.  It is SQL-checkable and
  keeps the vocabulary explicit.  Document frequency is a partial aggregate,
  so a term present in every document costs one partial row per task; the
  TF ⋈ IDF join is broadcast when the vocabulary is proven small, otherwise
  a shuffle join whose hot terms AQE's skew handling splits.
* hashed — MLlib's HashingTF / IDF on vectors, which the classifiers consume.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.stopwords import ENGLISH_STOP_WORDS
from spindle.operators.common import materialized, skew_split_join

NUM_HASH_FEATURES = 1 << 18       # HashingTF's default


def tokens(c: Column | str, drop_empty: bool = True) -> Column:
    """Lower-case and split on single white-space characters.
    ``drop_empty`` removes the empty strings a run of blanks produces."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(F.lower(col), "\\s")
    return F.filter(parts, lambda t: t != "") if drop_empty else parts


def estimator_tokens(c: Column | str) -> Column:
    """Tokens by MLlib's Tokenizer (E1): lower-cased, split at every
    white-space character; empty strings stay except at the end, and a text
    without any other token gives one empty string if it is empty, none if it
    is blank."""
    col = F.col(c) if isinstance(c, str) else c
    # the last non-blank character ends the last token that is kept
    kept = F.regexp_replace(F.lower(col), "\\s+$", "")
    return F.when(F.length(col) == 0, F.array(F.lit(""))).when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, "\\s"))


def without_stop_words(c: Column | str, words: list[str] | None = None) -> Column:
    """Drop stop words from a token array (E2), case-insensitively, as a JVM
    expression.  The literal list is planned as a hash set (``InSet``), so a
    token costs one lookup; no join or shuffle is involved."""
    col = F.col(c) if isinstance(c, str) else c
    stop = list(words or ENGLISH_STOP_WORDS)
    return F.filter(col, lambda t: ~F.lower(t).isin(*stop))


def stop_words_remover(input_col: str, output_col: str):
    """MLlib's remover with the default English list (parity path)."""
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover(inputCol=input_col, outputCol=output_col)


def explode_terms(df: DataFrame, tokens: Column | str, keep: list[str] | None = None) -> DataFrame:
    """One row per token.  ``explode_outer`` + a NULL filter instead of
    ``explode``: for a plain explode the optimiser infers a ``size(tokens) >
    0`` filter below the generator, which re-evaluates the whole cleaning
    expression a second time per document."""
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    return (df.select(*(keep or []), F.explode_outer(col).alias("term"))
            .filter(F.col("term").isNotNull()))


def run_lengths(words: Column) -> Column:
    """``(term, tf)`` of every distinct token of an array, in linear steps from
    the sorted array: a run's length is the next run's start less its own.  Each
    step binds its array, so that nothing is sorted twice."""
    def starts(s: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(s) - 1)
        return F.struct(s.alias("s"), F.filter(at, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))).alias("at"))

    def lengths(r: Column) -> Column:
        s, at = r["s"], r["at"]
        return F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("tf")))
    bound = F.transform(F.transform(F.array(F.array_sort(words)), starts), lengths)
    return F.when(F.size(words) > 0, F.get(bound, F.lit(0)))


def term_frequency(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """Exact term counts ``(id, term, tf)`` (E3, exact form) of rows with
    their own id.  Tokens are counted inside the row: no exchange, however
    the input is partitioned."""
    rows = df.select(id_col, F.explode_outer(run_lengths(F.col(tokens_col))).alias("_r"))
    return rows.select(id_col, "_r.term", "_r.tf").filter(F.col("term").isNotNull())


def hashing_tf(input_col: str, output_col: str, num_features: int = NUM_HASH_FEATURES):
    from pyspark.ml.feature import HashingTF
    return HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=num_features)


@dataclass
class IdfTable:
    """Fitted IDF: ``table(term, doc_freq, idf)`` and the training doc count."""
    table: DataFrame
    n_docs: int
    min_doc_freq: int = 0

    def transform(self, tf: DataFrame, id_col: str) -> DataFrame:
        """``(id, term, tf, idf, tfidf)``; a term unseen at fit time has
        doc_freq 0, i.e. idf = ln((N+1)/1), or 0 where a least document
        frequency is set, as the vector IDF gives."""
        unseen = 0.0 if self.min_doc_freq > 0 else float(_idf(self.n_docs, 0))
        out = skew_split_join(tf, self.table.select("term", "idf"), ["term"], "left")
        out = out.withColumn("idf", F.coalesce(F.col("idf"), F.lit(unseen)))
        return out.withColumn("tfidf", F.col("tf") * F.col("idf"))


def _idf(n_docs: int, doc_freq) -> float:
    import math
    return math.log((n_docs + 1.0) / (doc_freq + 1.0))


def fit_idf(docs: DataFrame, tokens_col: str, min_doc_freq: int = 0) -> IdfTable:
    """IDF = ln((N + 1) / (df + 1)) over the training documents.

    N counts every training document, also those without a term; document
    frequency counts distinct terms per document (a partial aggregate per
    term).  The table is materialised in the shared folder: it is model
    state reused by every later transform.
    """
    n_docs = docs.count()          # column-pruned: no tokenising needed
    table = (explode_terms(docs, F.array_distinct(tokens_col))
             .groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
             .withColumn("idf", F.when(F.col("doc_freq") >= min_doc_freq, F.log(
                 (F.lit(n_docs) + 1.0) / (F.col("doc_freq") + 1.0))).otherwise(0.0)))
    return IdfTable(materialized(table, "idf"), n_docs, min_doc_freq)
