"""Soft-membership mixing of sources to target token weights.

1.  Every row gets cheap text features, by DataFrame functions.
2.  A multinomial logistic model of the labelled rows' domains (Spark ML, on
    a bounded sample) predicts posteriors p_dk; they are applied to all rows
    as column expressions.
3.  Rates r_d >= 0 solve a least-squares problem: the expected domain totals
    sum_d r_d t_d p_dk (t_d: tokens) shall meet the targets T_k.  Projected
    gradient steps start at r = 1: r <- max(0, r - step . p_d), the step being
    the residual times the inverse of the totals' Gram matrix (K x K), halved
    when the residual doesn't fall.  Each step is one aggregate over the
    written (tokens, posterior) table; only K sums return.  A row's rate is
    refolded from the steps so far, so no state is kept by row.
4.  A row appears floor(r) times, and once more if a hash of its id falls
    below the rest of r.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import written

#: Domains and their target shares of all tokens: rows of good quality by language, and rows of poor quality.
TARGETS = {"good-en": 0.505, "good-de": 0.159, "good-fr": 0.159, "good-es": 0.121, "poor": 0.056}
#: All targets together, as a multiple of the tokens there are.
TOTAL = 1.12
#: Labelled rows that the classifier is fitted on, at most.
FIT_ROWS = 20_000
#: Largest number of gradient steps, and relative residual that ends them.
STEPS, TOLERANCE = 40, 1e-4
#: Characters whose shares are features.
SHARES = {"f_upper": "[A-Z]", "f_digit": "[0-9]", "f_symbol": r"[%$&*#!|<>{}]", "f_line": r"\n",
          "f_german": "[äöüßÄÖÜ]", "f_french": "[èêàçÈÊÀÇ]", "f_accent": "[éÉ]", "f_spanish": "[áíóúñÁÍÓÚÑ]"}
FEATURES = ["f_length", "f_word", *SHARES]


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are worked out once for a row, however often they are
    used: a generator of one row, which the optimiser does not merge into
    the expressions above it."""
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def domain_of(quality: Column, lang: Column) -> Column:
    return F.when(quality == 0, "poor").when(quality == 1, F.concat(F.lit("good-"), lang))


def with_features(docs: DataFrame) -> DataFrame:
    """Add tokens (runs of non-space) and bounded features of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.length(text)
    tokens = F.regexp_count(text, F.lit(r"\S+")).cast("long")
    size = F.greatest(n, F.lit(1))
    return once(docs, {
        "tokens": tokens, "f_length": F.log1p(n.cast("double")) / 10,
        "f_word": F.least(n / F.greatest(tokens, F.lit(1)), F.lit(50.0)) / 10}
        | {f: F.regexp_count(text, F.lit(chars)) / size * 10 for f, chars in SHARES.items()})


def posteriors(rows: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """Add ``p_<domain>``; ``labelled`` has the features and ``domain``.  With
    fewer than two domains among the labelled rows, the posterior is the
    labelled share (all equal without any)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    share = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = [d for d in domains if share.get(d)]
    if len(seen) < 2:
        total = sum(share.values())
        return rows.withColumns({f"p_{d}": F.lit(share.get(d, 0) / total if total else 1 / len(domains)) for d in domains})
    number = F.coalesce(*[F.when(F.col("domain") == d, float(i)) for i, d in enumerate(seen)])
    ready = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(labelled.withColumn("y", number))
    model = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=1e-3, maxIter=50).fit(ready)
    weight, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    margins = [sum((F.col(f) * float(w) for f, w in zip(FEATURES, weight[i])), F.lit(float(bias[i]))) for i in range(len(seen))]
    rows = once(rows, {f"_m{i}": m for i, m in enumerate(margins)})
    top = F.greatest(*[F.col(f"_m{i}") for i in range(len(seen))])
    rows = once(rows, {f"_e{i}": F.exp(F.col(f"_m{i}") - top) for i in range(len(seen))})
    parts = [F.col(f"_e{i}") for i in range(len(seen))]
    whole = sum(parts[1:], parts[0])
    rows = once(rows, {f"p_{d}": parts[seen.index(d)] / whole if d in seen else F.lit(0.0) for d in domains})
    return rows.drop(*[f"_{x}{i}" for x in "me" for i in range(len(seen))])


def rate_column(steps: list[np.ndarray], domains: list[str]) -> Column:
    """The rate after all steps, folded within the row."""
    if not steps:
        return F.lit(1.0)
    history = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    return F.aggregate(history, F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r - sum(
        (F.element_at(s, k + 1) * F.col(f"p_{d}") for k, d in enumerate(domains)), F.lit(0.0))))


def fit_rates(rows: DataFrame, targets: dict[str, float], whole: float = TOTAL) -> list[np.ndarray]:
    """Steps that lead to the rates; targets are shares of ``whole`` times all tokens."""
    domains = list(targets)
    p = [F.col(f"p_{d}") for d in domains]
    t = F.col("tokens").cast("double")
    first = rows.agg(F.sum(t), *[F.sum(t * a * b) for a in p for b in p]).first()
    total = first[0] or 0.0
    if not total:
        return []
    gram = np.array([x or 0.0 for x in first[1:]]).reshape(len(p), len(p)) / total
    goal = np.array([targets[d] for d in domains], float)
    goal *= whole / goal.sum()
    inverse = np.linalg.pinv(gram, rcond=1e-6)

    def residual(steps):
        got = rows.select("tokens", *p, rate_column(steps, domains).alias("_r")).agg(
            *[F.sum(t * x * F.col("_r")) for x in p]).first()
        return np.array([x or 0.0 for x in got]) / total - goal

    steps: list[np.ndarray] = []
    rest, damp = residual(steps), 1.0
    for _ in range(STEPS):
        if np.abs(rest).max() < TOLERANCE or damp < 1e-3:
            break
        trial = [*steps, damp * (inverse @ rest)]
        left = residual(trial)
        if (left ** 2).sum() < (rest ** 2).sum():
            steps, rest, damp = trial, left, min(1.0, 2 * damp)
        else:
            damp /= 2
    return steps


def _copies(rows: DataFrame, steps: list[np.ndarray], domains: list[str]) -> DataFrame:
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    rows = once(rows, {"rate": rate_column(steps, domains)})
    whole = F.floor("rate")
    return rows.withColumn("copies", (whole + (u < F.col("rate") - whole).cast("int")).cast("int"))


def _fit(docs: DataFrame, labels: DataFrame, domains: list[str], targets: dict[str, float], fit_rows: int):
    rows = written(with_features(docs.select("doc_id", "text", "lang")).drop("text"), "mixing-features")
    sample = written(labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
                     .agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows),
                     "mixing-sample")
    labelled = rows.join(F.broadcast(sample), "doc_id")                                  # fit_rows ids at most
    labelled = written(labelled.withColumn("domain", domain_of(F.col("quality"), F.col("lang")))
                       .filter(F.col("domain").isin(domains)), "mixing-labelled")
    scored = written(posteriors(rows, labelled, domains).drop("lang", *FEATURES), "mixing-posteriors")
    return scored, labelled, fit_rates(scored, targets)


def document_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
                   fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, tokens, p_<domain>, rate, copies)`` of every row of ``docs
    (doc_id, text, lang)``.

    NULL and empty texts have no tokens and a rate like any other row; rows
    with a NULL doc_id draw alike, as do repeated rows, each of which is
    returned.  Labels count as for ``mix``.  Other columns are ignored; an
    empty table gives no rows.
    """
    targets = targets or TARGETS
    scored, _, steps = _fit(docs, labels, list(targets), targets, fit_rows)
    return _copies(scored, steps, list(targets))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
        fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` with ``tokens``, ``p_<domain>``, ``rate`` and ``copies``;
    ``labels (doc_id, quality)`` and the labelled rows' ``lang`` give the domains.

    NULL and empty texts have no tokens and a rate like any other row.  Labels
    of a repeated doc_id: the largest; NULL labels, and labelled rows of a
    domain without a target, are left out of the fit.  Repeated rows draw alike.  Extra columns pass through; an
    empty table gives no rows.  Added columns replace any of the same name.
    """
    targets = targets or TARGETS
    domains = list(targets)
    added = ["tokens", "rate", "copies", *FEATURES, *[f"p_{d}" for d in domains]]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    _, labelled, steps = _fit(docs, labels, domains, targets, fit_rows)
    return _copies(posteriors(with_features(docs), labelled, domains), steps, domains).drop(*FEATURES)
