"""Secrets in texts: fixed patterns, and a battery of randomness tests.

Patterns (assignments of passwords and tokens, access keys, long hex runs)
give the base spans.  Beyond them every long run of key-like characters is
tested.  Its encoding is the smallest alphabet that holds it, and under the
hypothesis of independent uniform symbols of that alphabet three tests are
made: chi-squared uniformity, runs above and below the middle of the
alphabet, and serial correlation.  A run that any of them rejects (level
``alpha``, Bonferroni) isn't random.

Short runs of ordinary language pass such tests for want of power, so the
rest must also be told from language: the frequencies of symbols in the short
words of all texts give mean and variance of chi-squared for a run of ordinary
text of the same length and alphabet, and the lower tail is the p-value of
"ordinary text".  False discoveries are held to the share ``fdr`` by a
weighted Benjamini-Hochberg rule over all runs of all texts; a run's weight is
the power of its test, which grows with its length, divided by the mean power.
The rule needs only a histogram of p-values.

Everything is a DataFrame expression; texts are read twice, and what is kept
of them (spans, test statistics) is a written table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import written

# Kinds in their order, patterns and least lengths.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS = "AKIA[A-Z0-9]{12,}"        # AKIA[A-Z0-9]+ of 16 characters or more: a shorter match holds no longer one
HEX = "[0-9a-f]{32,}"               # likewise [0-9a-f]+ of 32 or more

#: Characters and least length of the runs that are tested.
SYMBOLS, LEAST = "A-Za-z0-9+/_-", 20
RUN = f"(?<![{SYMBOLS}])[{SYMBOLS}]{{{LEAST},}}+=*"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, smallest alphabet first.
ENCODINGS = {
    "decimal": _DIGITS, "hex": _DIGITS + "abcdef", "upper hex": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER,
    "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER, "upper base36": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS, "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_", "mixed": _UPPER + _LOWER + _DIGITS + "+/-_"}

#: -10 log10 p is cut to whole numbers up to this one for the histogram.
BINS = 3000

_SPANS = "array<struct<start:int,end:int,token:string,value:string>>"


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches as ``(start, end, token, value)``,
    in code points; ``value`` is the given group.  Matches alternate with the pieces
    that ``split`` leaves, so the lengths add up to positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"),
                          found.alias("token"), values.alias("value"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["token"])
        span = F.struct(start.alias("start"), end.alias("end"), x["token"].alias("token"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))
    empty = F.array().cast(_SPANS)
    listed = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("spans")), add, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), listed).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the three patterns as ``(start, rank, end)``, sorted; the rank is the kind's."""
    kinds = [F.filter(_spans(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_VALUE), _spans(text, ACCESS),
             _spans(text, HEX)]

    def ranked(rank: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))
    return F.array_sort(F.concat(*[F.transform(k, ranked(rank)) for rank, k in enumerate(kinds)]))


def _choose(of: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), of + 1)


def _encoding(body: Column) -> Column:
    """Place in ``ENCODINGS`` of the first alphabet that holds the run."""
    value = None
    for i, alphabet in enumerate(ENCODINGS.values()):
        held = body.rlike("^[" + alphabet.replace("-", "\\-") + "]+$")
        value = F.when(held, i) if value is None else value.when(held, i)
    return value


def run_statistics(runs: Column) -> Column:
    """For every tested run ``(start, end, encoding, n, squares, sums, edges)``:
    symbols, sum of squared symbol counts, sums of a walk over the symbols'
    places in the alphabet (symbols in its upper half, runs of halves, moments and lagged products), and
    first plus last place.  Steps bind what the next one needs, so that
    nothing about a run is worked out again for each of its symbols."""
    runs = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"),
                                                F.rtrim(r["token"], F.lit("=")).alias("body")))
    runs = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["body"].alias("body"),
                                                _encoding(r["body"]).alias("encoding")))
    runs = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"),
                                                _choose(r["encoding"], [len(a) for a in ENCODINGS.values()]).alias("k"),
                                                F.split(r["body"], "").alias("symbols"),
                                                _choose(r["encoding"], list(ENCODINGS.values())).alias("alphabet")))
    runs = F.transform(runs, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["k"].alias("k"),
        F.transform(r["symbols"], lambda c: F.instr(r["alphabet"], c) - 1).alias("values")))
    return F.transform(runs, _sums)


def _sums(r: Column) -> Column:
    k, values = r["k"], r["values"]

    def same(acc: Column, v: Column) -> Column:
        again = F.when(acc["last"] == v, acc["run"]).otherwise(F.lit(0).cast("long"))
        return F.struct(v.alias("last"), (again + 1).alias("run"), (acc["squares"] + 2 * again + 1).alias("squares"))
    zero = F.lit(0).cast("long")
    squares = F.aggregate(F.array_sort(values), F.struct(F.lit(-1).alias("last"), zero.alias("run"), zero.alias("squares")),
                          same, lambda acc: acc["squares"])

    def walk(acc: Column, v: Column) -> Column:
        high = (2 * v >= k).cast("int")
        x = v.cast("double")
        first = acc["last"] < 0
        return F.struct(
            v.alias("last"), high.alias("high"), (acc["ones"] + high).alias("ones"),
            (acc["runs"] + F.when(first | (acc["high"] != high), 1).otherwise(0)).alias("runs"), (acc["sx"] + x).alias("sx"),
            (acc["sxx"] + x * x).alias("sxx"), (acc["sxy"] + F.when(first, 0.0).otherwise(x * acc["last"])).alias("sxy"))
    real = F.lit(0.0)
    sums = F.aggregate(values, F.struct(F.lit(-1).alias("last"), F.lit(0).alias("high"), zero.alias("ones"), zero.alias("runs"),
                                        real.alias("sx"), real.alias("sxx"), real.alias("sxy")), walk)
    return F.struct(r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"),
                    F.size(values).cast("double").alias("n"), squares.alias("squares"), sums.alias("sums"),
                    (F.element_at(values, 1) + F.element_at(values, -1)).cast("double").alias("edges"))


def _log10_lower_tail(z: Column) -> Column:
    """log10 of the normal lower tail: a continued fraction below -1, a
    logistic curve (never a discovery) above."""
    a = -z
    tail = (-(a * a) / 2 / math.log(10) - F.lit(0.5 * math.log10(2 * math.pi))
            - F.log10(a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))))
    return F.when(z < -1, tail).otherwise(-F.log10(1 + F.exp(-1.702 * z)))


def battery(s: Column) -> dict[str, Column]:
    """log10 p-values of the three tests of uniform, independent symbols."""
    k, n, sums = _choose(s["encoding"], [float(len(a)) for a in ENCODINGS.values()]), s["n"], s["sums"]
    df = k - 1
    chi = k * s["squares"] / n - n
    uniform = -(F.pow(F.greatest(chi, F.lit(0.0)) / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    ones = sums["ones"].cast("double")
    mean = 2 * ones * (n - ones) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    run = F.when(spread > 0, -F.abs(sums["runs"] - mean) / F.sqrt(F.abs(spread))).otherwise(-10.0)
    centre = sums["sx"] / n
    spare = sums["sxx"] - n * centre * centre
    lagged = sums["sxy"] - centre * (2 * sums["sx"] - s["edges"]) + (n - 1) * centre * centre
    serial = F.when(spare > 0, -F.abs(lagged / F.when(spare > 0, spare) + 1 / n) * F.sqrt(n)).otherwise(-10.0)
    two = math.log10(2)
    return {"uniform": _log10_lower_tail(uniform), "runs": F.least(_log10_lower_tail(run) + two, F.lit(0.0)),
            "serial": F.least(_log10_lower_tail(serial) + two, F.lit(0.0))}


def symbol_counts(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How often each symbol stands in the words of all texts that are shorter than a tested run."""
    words = (docs.select(F.explode(F.split(F.col(text), f"[^{SYMBOLS}]+", -1)).alias("word"))
             .filter(f"length(word) between 1 and {LEAST - 1}").groupBy("word").count())
    symbols = (words.select(F.explode(F.split("word", "")).alias("symbol"), "count").groupBy("symbol")
               .agg(F.sum("count").alias("n")))
    return {r.symbol: r.n for r in symbols.collect()}           # one row for each of the symbols at most


def ordinary_text(counts: dict[str, int]) -> list[tuple[float, float]]:
    """For every encoding the sums of squares and cubes of its symbols' shares in ordinary words."""
    moments = []
    for alphabet in ENCODINGS.values():
        shares = [counts.get(c, 0) + 0.5 for c in alphabet]
        total = sum(shares)
        moments.append((sum((s / total) ** 2 for s in shares), sum((s / total) ** 3 for s in shares)))
    return moments


def language_test(s: Column, moments: list[tuple[float, float]]) -> tuple[Column, Column]:
    """log10 p of "as uneven as ordinary text" and the test's power against
    uniform symbols at level 0.01; both from the moments of a multinomial."""
    k, n = _choose(s["encoding"], [float(len(a)) for a in ENCODINGS.values()]), s["n"]
    two, three = (_choose(s["encoding"], [m[i] for m in moments]) for i in range(2))
    mean = k * (1 - two) + n * (k * two - 1)
    spread = k / n * F.sqrt(F.greatest(2 * n * (n - 1) * (2 * (n - 2) * three + two - (2 * n - 3) * two * two), F.lit(1e-9)))
    chi = k * s["squares"] / n - n
    power = F.pow(F.lit(10.0), _log10_lower_tail((mean - (k - 1)) / spread - 2.326))
    return _log10_lower_tail((chi - mean) / spread), power


def threshold(histogram: list[tuple[int, int]], fdr: float) -> int | None:
    """The smallest bin of ``-10 log10 p`` that Benjamini and Hochberg's rule
    rejects, from ``(bin, runs)``; None if there is none."""
    total, above, best = sum(n for _, n in histogram), 0, None
    for at, n in sorted(histogram, reverse=True):
        above += n
        if total * 10 ** (-at / 10) <= fdr * above:
            best = at
    return best


def find_secrets(docs: DataFrame, keep: list[str], text: str = "text", alpha: float = 0.01, fdr: float = 0.01) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with ``secrets``, an array of
    ``(start, rank, end, encoding)`` by start and kind: the base spans (their
    encoding is NULL) and the random runs that overlap none of them.

    Positions are code points, ends exclusive.  NULL and empty texts have no
    spans; repeated rows have the same; every row's runs count in the
    false-discovery rule.  An empty table gives no rows.  Columns not in
    ``keep`` are ignored, and one of ``keep`` called ``secrets`` gives way.
    """
    names = [c for c in keep if c != "secrets"]
    rows = docs.select(*[F.col(c).alias(f"_keep_{c}") for c in names], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    free = F.filter(_spans(F.col("_text"), RUN),
                    lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    found = written(rows.withColumn("_base", base_spans(F.col("_text"))).withColumn("_runs", run_statistics(free))
                    .drop("_text"), "secrets")
    each = found.select(F.explode("_runs").alias("s"))
    moments = ordinary_text(symbol_counts(docs, text))
    mean_power = each.agg(F.avg(language_test(F.col("s"), moments)[1])).first()[0] or 1.0

    def evidence(s: Column) -> Column:
        log_p, power = language_test(s, moments)
        weighted = log_p - F.log10(F.greatest(power / mean_power, F.lit(1e-6)))
        return F.least(F.greatest(F.floor(-10 * weighted), F.lit(0)), F.lit(BINS)).cast("int")
    histogram = each.groupBy(evidence(F.col("s")).alias("bin")).count().collect()     # BINS + 1 rows at most
    least = threshold([(r["bin"], r["count"]) for r in histogram], fdr)
    base = F.transform("_base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end"),
                                                   F.lit(None).cast("string").alias("encoding")))
    columns = [F.col(f"_keep_{c}").alias(c) for c in names]
    if least is None:
        return found.select(*columns, base.alias("secrets"))
    level = math.log10(alpha / 3)

    def random(s: Column) -> Column:
        return (evidence(s) >= least) & (F.least(*battery(s).values()) >= level)
    added = F.transform(F.filter("_runs", random), lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), s["end"].alias("end"),
        _choose(s["encoding"], list(ENCODINGS)).alias("encoding")))
    return found.select(*columns, F.array_sort(F.concat(base, added)).alias("secrets"))


def digest(found: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of found secrets."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _choose(s["rank"], KINDS), s["start"], s["end"])), ",")
    random = KINDS.index("random")
    counts = [F.expr(f"size(filter(secrets, s -> s.rank = {i}))").cast("long").alias(f"n_{KINDS[i]}") for i in range(random)]
    return found.select("doc_id", *counts, F.sha2(listed(F.filter("secrets", lambda s: s["rank"] < random)), 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))
