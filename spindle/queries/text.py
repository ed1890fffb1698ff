"""Text queries (F1–F3, E1–E4) over the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.functions.stopwords import ENGLISH_STOP_WORDS
from spindle.functions.text import clean_text
from spindle.operators.text import (fit_idf, hashing_tf, term_frequency, tokens,
                                    without_stop_words)
from spindle.operators.common import ensure_parallelism
from spindle.sources import load_table


def cleaned_docs(spark, sf_dir, extra: list[str] | None = None):
    docs = ensure_parallelism(load_table(spark, sf_dir, "documents", ["doc_id", "text", *(extra or [])]),
                              keys=["doc_id"])
    return docs.select("doc_id", *(extra or []), clean_text("text").alias("clean"))


def word_docs(spark, sf_dir, extra: list[str] | None = None):
    """doc_id, words (stop words removed)."""
    docs = cleaned_docs(spark, sf_dir, extra)
    return docs.select("doc_id", *(extra or []), without_stop_words(tokens("clean")).alias("words"))


def q_text_clean(spark, sf_dir):
    return cleaned_docs(spark, sf_dir).withColumnRenamed("clean", "clean_text")


def q_tokenize(spark, sf_dir):
    docs = cleaned_docs(spark, sf_dir).select("doc_id", tokens("clean").alias("t"))
    return docs.select("doc_id", F.size("t").alias("n_tokens"),
                       F.size(F.array_distinct("t")).alias("n_distinct"))


def q_stopwords(spark, sf_dir):
    docs = word_docs(spark, sf_dir)
    return docs.select("doc_id", F.size("words").alias("n_kept"),
                       F.array_join("words", " ").alias("kept_text"))


def q_term_frequency(spark, sf_dir):
    return term_frequency(word_docs(spark, sf_dir), "doc_id", "words")


def q_hashed_tf(spark, sf_dir):
    docs = word_docs(spark, sf_dir)
    return hashing_tf("words", "features").transform(docs).select("doc_id", "features")


def _labelled_split(spark, sf_dir):
    docs = word_docs(spark, sf_dir)
    labels = load_table(spark, sf_dir, "labels", ["doc_id"])
    return (docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti"))


def q_idf_fit(spark, sf_dir):
    train, _ = _labelled_split(spark, sf_dir)
    model = fit_idf(train, "words")
    return model.table.select("term", "doc_freq", F.round("idf", 6).alias("idf"))


def q_tfidf(spark, sf_dir):
    train, test = _labelled_split(spark, sf_dir)
    model = fit_idf(train, "words")
    out = model.transform(term_frequency(test, "doc_id", "words"), "doc_id")
    return out.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


CLEAN_SQL = r"regexp_replace(lower(regexp_replace(text, '[^a-zA-Z\s]', '', 'g')), '[\r\n]+', '', 'g')"
TOKENS_SQL = r"list_filter(string_split_regex(clean, '\s'), lambda x: x <> '')"
WORDS_SQL = f"list_filter({TOKENS_SQL}, lambda w: NOT list_contains({_sql_list(ENGLISH_STOP_WORDS)}, w))"

_DOCS = f"docs AS (SELECT doc_id, lang, {WORDS_SQL} AS words FROM (SELECT doc_id, lang, {CLEAN_SQL} AS clean FROM documents))"
_IDF = f"""WITH {_DOCS},
train AS (SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)),
test AS (SELECT * FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
n AS (SELECT count(*) AS n FROM train),
dfreq AS (SELECT term, count(*) AS doc_freq FROM (SELECT DISTINCT doc_id, unnest(words) AS term FROM train) GROUP BY term),
idf AS (SELECT term, doc_freq, ln((n + 1.0) / (doc_freq + 1.0)) AS idf FROM dfreq, n)"""

QUERIES = {
    "text_clean": (q_text_clean, f"SELECT doc_id, {CLEAN_SQL} AS clean_text FROM documents"),
    "tokenize": (q_tokenize, f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, CAST(len(list_distinct(t)) AS INTEGER) AS n_distinct
FROM (SELECT doc_id, {TOKENS_SQL} AS t FROM (SELECT doc_id, {CLEAN_SQL} AS clean FROM documents))"""),
    "stopwords": (q_stopwords, f"""WITH {_DOCS}
SELECT doc_id, CAST(len(words) AS INTEGER) AS n_kept, array_to_string(words, ' ') AS kept_text FROM docs"""),
    "term_frequency": (q_term_frequency, f"""WITH {_DOCS}
SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM docs)
GROUP BY doc_id, term"""),
    "hashed_tf": (q_hashed_tf, None),
    "idf_fit": (q_idf_fit, _IDF + "\nSELECT term, doc_freq, round(idf, 6) AS idf FROM idf"),
    "tfidf": (q_tfidf, _IDF + """,
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM test) GROUP BY doc_id, term)
SELECT tf.doc_id, tf.term, tf.tf, round(tf.tf * coalesce(idf.idf, ln(((SELECT n FROM n) + 1.0) / 1.0)), 6) AS tfidf
FROM tf LEFT JOIN idf ON tf.term = idf.term"""),
}
