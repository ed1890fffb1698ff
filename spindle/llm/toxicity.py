"""Toxicity by the nearest labelled examples.

Terms are runs of letters (A-Z and Latin-1 capitals read as small) and their
beginnings of 4, 5 and 6 bytes.  The vocabulary holds every term of the
labelled examples; a term that no example holds adds to no product of a text
with an example and is left out of its length, which changes neither the
order of a text's neighbours nor its vote.
Weights are (1 + ln tf) * ln((1 + N) / (1 + df)), with df over all documents,
times the term's relevance: how far the toxic examples that hold it exceed
their expected number, in standard deviations, on top of a floor that
every term has.  Vectors have unit length, so scores are exact cosines.

The examples (a bounded, documented sample of the labelled rows, by class)
form a block-max inverted index.  Examples are ordered so that similar ones
share a block of ``BLOCK``; for every term and block the index holds the
postings and the largest weight.  A text adds up the block maxima of its
terms: an upper bound of the cosine with any example of a block.  The most
promising blocks are scored first, and only blocks whose bound reaches the k-th cosine
so far follow; the others are skipped, which is exact.  Votes of the k nearest are weighted by
cosine; a vote is calibrated by the rate of label 1 among examples (each
against the others, weighted back to their class's share) with a vote in the same
tenth, made monotone.  Evidence is the list of nearest examples with label and cosine.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import bounded_batches, hash_mod, mix64, received, runs, shared, span_hasher, text_slices, written

#: Examples of label 1 and of label 0 at most (smallest hashes of the doc_id), and examples that vote.
TOXIC_ROWS, CLEAN_ROWS, NEAREST = 800, 1000, 15
#: Examples of a block of the index, and blocks that are scored first.
BLOCK, FIRST = 128, 4
#: Relevance that every term has, in standard deviations.
FLOOR = 3.0
#: Answers that a task keeps for texts with the same terms.
KEPT = 10_000
STEMS = (4, 5, 6)
#: Bytes of text whose terms are hashed at once.
TERM_BYTES = 512 << 10
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _terms(column: pa.Array):
    """``(first row, row of each term, term hash)`` by slices."""
    for row, data, starts, ends in text_slices(column, TERM_BYTES):
        low = _FOLD[data]
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        low[latin] += 32
        letter = _LETTER[low]
        edge = np.zeros(len(low) + 1, bool)
        edge[starts] = True
        edge[len(low)] = True
        begin, finish = letter.copy(), letter.copy()
        begin[1:] &= ~letter[:-1] | edge[1:len(low)]
        finish[:-1] &= ~letter[1:] | edge[1:len(low)]
        begin, finish = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        n = np.searchsorted(begin, ends) - np.searchsorted(begin, starts)
        of = np.repeat(np.arange(len(n)), n)
        span_hashes = span_hasher(low)
        rows, hashes = [of], [span_hashes(begin, finish)]
        for k in STEMS:
            long = finish - begin > k
            rows.append(of[long])
            hashes.append(mix64(span_hashes(begin[long], begin[long] + k) + np.uint64(k)))
        yield row, len(n), np.concatenate(rows), np.concatenate(hashes)


def _distinct(batches):
    """Texts -> their terms, each once for a slice."""
    for batch in batches:
        for _, _, _, h in _terms(batch.column("text")):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).view(np.int64))], names=["term"])


def _lists(flat: list[np.ndarray], size: np.ndarray) -> pa.Array:
    values = np.concatenate([np.zeros(0, np.int32), *flat]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(values))


def _vectors(vocabulary, keep: list[str]):
    """Texts -> vocabulary terms and their numbers, beside the kept columns."""
    def run(batches):
        terms = received(vocabulary)                    # sorted hashes
        for batch in batches:
            out_t, out_n, size = [], [], np.zeros(batch.num_rows, np.int64)
            for first, rows, of, h in _terms(batch.column("text")) if len(terms) else ():
                at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
                hit = terms[at] == h
                key, times = np.unique(of[hit] * len(terms) + at[hit], return_counts=True)
                out_t.append(key % len(terms))
                out_n.append(times)
                size[first:first + rows] = np.bincount(key // len(terms), minlength=rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), _lists(out_t, size), _lists(out_n, size)],
                                             names=[*keep, "_terms", "_times"])
        pa.default_memory_pool().release_unused()
    return run


def _holders(vocabulary, size: int):
    """Texts -> documents of a task that hold a term."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in _vectors(vocabulary, [])(batches):
            df += np.bincount(np.asarray(batch.column("_terms").flatten()), minlength=size)
        held = np.flatnonzero(df)
        for at in range(0, len(held), 100_000):
            some = held[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["t", "n"])
    return run


def _rows_of(terms, times):
    """``(terms, times)`` of each row of two list columns, as arrays."""
    size = np.asarray(terms.value_lengths().fill_null(0)).astype(np.int64)
    end, t, n = np.cumsum(size), np.asarray(terms.flatten()), np.asarray(times.flatten())
    for e, k in zip(end.tolist(), size.tolist()):
        yield t[e - k:e], n[e - k:e]


def _packed(batches):
    """Examples -> a row for each batch: terms as differences, compressed."""
    for batch in batches:
        size = np.asarray(batch.column("_terms").value_lengths()).astype(np.int32)
        press = zstandard.ZstdCompressor(level=1).compress
        step = np.diff(np.asarray(batch.column("_terms").flatten()), prepend=0).astype(np.int32)
        yield pa.RecordBatch.from_pylist([{
            "ids": batch.column("doc_id").cast(pa.int64()).to_pylist(), "toxic": batch.column("toxic").to_pylist(),
            "size": size.tobytes(), "terms": press(step.tobytes()),
            "times": press(np.asarray(batch.column("_times").flatten()).astype(np.int32).tobytes())}], schema=pa.schema(
                [("ids", pa.list_(pa.int64())), ("toxic", pa.list_(pa.int32()))] + [(c, pa.binary()) for c in ("size", "terms", "times")]))


def _flat(lists, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(np.asarray(x, dtype) for x in lists)])


def _unpacked(rows):
    """What ``Index`` takes, from the rows of ``_packed``."""
    plain = zstandard.ZstdDecompressor().decompress
    size = _flat([np.frombuffer(r["size"], np.int32) for r in rows], np.int32)
    terms = _flat([np.cumsum(np.frombuffer(plain(r["terms"]), np.int32), dtype=np.int32) for r in rows], np.int32)
    times = [np.frombuffer(plain(r["times"]), np.int32) for r in rows]
    times = _flat(times, np.min_scalar_type(max((int(t.max(initial=1)) for t in times), default=1)))
    return [i for r in rows for i in r["ids"]], [x for r in rows for x in r["toxic"]], terms, times, size


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[i] .. first[i] + size[i] - 1``, one run after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def relevance(ex: np.ndarray, terms: np.ndarray, labels: np.ndarray, size: int) -> np.ndarray:
    """Excess of the toxic examples among a term's holders, in standard
    deviations, on top of ``FLOOR``."""
    share = labels.mean() if len(labels) else 0.0
    held = np.bincount(terms, minlength=size)
    excess = np.bincount(terms, weights=labels[ex], minlength=size) - held * share
    return np.maximum(excess / np.sqrt(held * share * (1 - share) + 1), 0) + FLOOR


def _similar_order(ex: np.ndarray, terms: np.ndarray, w: np.ndarray, count: int, size: int) -> np.ndarray:
    """Examples in an order where neighbours are alike: halves along the main
    direction of the vectors, halved again down to ``BLOCK``."""
    order, parts = [], [np.arange(count)]
    while parts:
        part = parts.pop()
        if len(part) <= BLOCK:
            order.append(part)
            continue
        at = np.full(count, -1)
        at[part] = np.arange(len(part))
        mine = at[ex] >= 0
        e, t, v = at[ex[mine]], terms[mine], w[mine]
        x = np.sin(1.0 + np.arange(len(part)))
        for _ in range(6):
            x = x - x.mean()
            x = np.bincount(e, weights=v * np.bincount(t, weights=v * x[e], minlength=size)[t], minlength=len(part))
            x /= max(np.abs(x).max(), 1e-300)
        half = -(-len(part) // (2 * BLOCK)) * BLOCK
        ranked = part[np.argsort(x, kind="stable")]
        parts += [ranked[half:], ranked[:half]]
    return np.concatenate([np.zeros(0, np.int64), *order])


class Index:
    """Block-max postings of the examples.  Examples are numbered by doc_id.
    Terms and times are a list for each example, or (with ``size``) all of
    them one after another; ``idf`` is the weight of every term."""

    def __init__(self, ids, labels, terms, times, idf: np.ndarray, size=None):
        if size is None:
            size = np.fromiter(map(len, terms), np.int64, len(terms))
            terms, times = _flat(terms, np.int32), _flat(times, np.int32)
        ids, count = np.asarray(ids, np.int64), len(ids)
        order = np.argsort(ids, kind="stable")
        number = np.empty(count, np.int64)
        number[order] = np.arange(count)
        self.ids, self.labels, self.idf = ids[order], np.asarray(labels, float)[order], idf
        ex, w = np.repeat(number, size), (1 + np.log(times.astype(float))) * idf[terms]
        length = np.maximum(np.sqrt(np.bincount(ex, weights=w * w, minlength=count)), 1e-12)
        w /= length[ex]
        place = np.empty(count, np.int64)
        place[_similar_order(ex, terms, w, count, len(idf))] = np.arange(count)
        block = place[ex] // BLOCK
        self.blocks = -(-count // BLOCK)
        order = np.lexsort((ex, block, terms))                           # term, then block
        self.ex, self.weight = ex[order].astype(np.int32), w[order]
        pair = terms[order].astype(np.int64) * self.blocks + block[order]
        self.pair_first, self.pair_size = runs(pair)
        held = pair[self.pair_first]
        self.pair_block = (held % max(self.blocks, 1)).astype(np.int32)
        self.pair_most = np.maximum.reduceat(self.weight, self.pair_first) if len(held) else np.zeros(0)
        self.first = np.searchsorted(held, np.arange(len(idf) + 1) * self.blocks)    # a term's pairs
        self.scored = self.passed = 0

    def __getstate__(self):
        """Packed: each broadcast is a file in every executor's folder."""
        press = zstandard.ZstdCompressor(level=3).compress
        return {k: (press(np.ascontiguousarray(v).tobytes()), v.dtype.str, v.shape) if isinstance(v, np.ndarray) else v
                for k, v in self.__dict__.items()}

    def __setstate__(self, state):
        plain = zstandard.ZstdDecompressor().decompress
        for k, v in state.items():
            self.__dict__[k] = np.frombuffer(plain(v[0]), v[1]).reshape(v[2]) if isinstance(v, tuple) else v

    def weights(self, terms, times):
        t = np.asarray(terms, np.int64)
        w = (1 + np.log(np.asarray(times, float))) * self.idf[t]
        return t, w / max(np.sqrt((w * w).sum()), 1e-12)

    def nearest(self, terms, times, k: int = NEAREST, but: int | None = None):
        """The k examples of largest positive cosine, ties to the smaller number."""
        t, q = self.weights(terms, times)
        size = self.first[t + 1] - self.first[t]
        pairs, q = _spans(self.first[t], size), np.repeat(q, size)
        block = self.pair_block[pairs]
        bound = np.bincount(block, weights=q * self.pair_most[pairs], minlength=self.blocks) + 1e-9
        other = self.ids != but if but is not None else None

        def cosines(chosen: np.ndarray) -> np.ndarray:
            some = chosen[block]
            size = self.pair_size[pairs[some]]
            spot = _spans(self.pair_first[pairs[some]], size)
            score = np.bincount(self.ex[spot], weights=self.weight[spot] * np.repeat(q[some], size), minlength=len(self.ids))
            self.scored += int(chosen.sum())
            return score if other is None else score * other
        chosen = np.zeros(self.blocks, bool)
        chosen[np.argsort(-bound, kind="stable")[:FIRST]] = True
        cos = cosines(chosen)
        least = np.partition(cos, -k)[-k] if len(cos) > k else 0.0
        rest = ~chosen & (bound >= least) & (bound > 2e-9)
        if rest.any():
            cos = cos + cosines(rest)
        self.passed += self.blocks - int(chosen.sum()) - int(rest.sum())
        who = np.flatnonzero(cos >= max(least - 1e-9, 1e-12))
        order = np.lexsort((who, -np.round(cos[who], 12)))[:k]
        return who[order], cos[who[order]]

    def vote(self, terms, times, but: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        who, cos = self.nearest(terms, times, but=but)
        return (float((cos * self.labels[who]).sum() / cos.sum()) if len(who) else -1.0), who, cos


def _votes(index):
    """Each example against the others: tenth of its vote, label."""
    def run(batches):
        ix = received(index)
        for batch in batches:
            votes = [ix.vote(t, n, but=d)[0] if len(t) else -1.0 for d, (t, n) in zip(
                batch.column("doc_id").to_pylist(), _rows_of(batch.column("_terms"), batch.column("_times")))]
            tenth = [min(9, int(10 * v)) if v >= 0 else -1 for v in votes]
            yield pa.RecordBatch.from_arrays([pa.array(tenth, pa.int32()), batch.column("toxic")], names=["tenth", "toxic"])
    return run


_HIDDEN = ["_score", "_predicted", "_evidence"]
_OUTPUTS = ["score", "predicted", "evidence"]


def _score(index, rates, keep: list[str], names: list[str]):
    def run(batches):
        ix, rate = received(index), received(rates)
        seen: dict = {}
        for batch in batches:
            score, evidence = [], []
            for t, n in _rows_of(batch.column("_terms"), batch.column("_times")):
                key = blake2b(t.tobytes() + n.tobytes(), digest_size=16).digest()
                if key not in seen:
                    if len(seen) >= KEPT:
                        seen.clear()
                    v, who, cos = ix.vote(t, n) if len(t) else (-1.0, np.zeros(0, np.int64), np.zeros(0))
                    seen[key] = rate[min(9, int(10 * v)) if v >= 0 else -1], who, cos
                score.append(seen[key][0])
                evidence.append([{"doc_id": int(ix.ids[w]), "toxic": int(ix.labels[w]), "cosine": float(c)}
                                 for w, c in zip(*seen[key][1:])])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(score, pa.float64()),
                 pa.array([int(s >= 0.7) for s in score], pa.int32()),
                 pa.array(evidence, pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))],
                names=[*keep, *names])
    return run


def _schema(df: DataFrame, keep: list[str], more: str) -> str:
    return ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [more])


_VECTOR = "_terms array<int>, _times array<int>"


def _evidence(names: list[str]) -> str:
    return (f"{names[0]} double, {names[1]} int, {names[2]} array<struct<doc_id:bigint,toxic:int,cosine:double>>")


def _monotone(rates: list[float], weights: list[float]) -> list[float]:
    """The nearest non-decreasing rates (neighbours out of order are pooled)."""
    pools: list[list[float]] = []
    for r, w in zip(rates, weights):
        pools.append([r, w, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            r2, w2, n2 = pools.pop()
            r1, w1, n1 = pools.pop()
            pools.append([(r1 * w1 + r2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return [r for r, _, n in pools for _ in range(int(n))]


def fit(rows: DataFrame, labels: DataFrame, folds: int, held: int, toxic_rows: int, clean_rows: int):
    """``(vocabulary, index, rates)``, broadcast; ``rows (doc_id, text)``."""
    spark = rows.sparkSession
    known = (labels.filter((hash_mod("doc_id", folds) != held) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for y, n in ((1, toxic_rows), (0, clean_rows))]
    sample = written(drawn[0].unionByName(drawn[1]), "toxicity-sample")
    labelled = written(rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic")      # a sample's rows at most
                       .agg(F.min("text").alias("text")), "toxicity-labelled")
    found = labelled.select("text").mapInArrow(_distinct, "term long").distinct().toPandas()    # terms of the sample's texts
    terms = np.sort(found["term"].to_numpy(np.int64).view(np.uint64))
    vocabulary = shared(spark, terms)
    df, total = np.zeros(len(terms)), rows.count()
    holders = (rows.select("text").mapInArrow(_holders(vocabulary, len(terms)), "t long, n long").groupBy("t")
               .agg(F.sum("n").alias("n")).toPandas())                                         # one row for each term
    df[holders["t"].to_numpy(np.int64)] = holders["n"]
    keep = ["doc_id", "toxic"]
    examples = labelled.repartition("doc_id").mapInArrow(_vectors(vocabulary, keep), _schema(labelled, keep, _VECTOR))
    examples = written(examples, "toxicity-examples")
    own = (examples.filter(F.size("_terms") > 0).select("doc_id", "toxic", "_terms", "_times").mapInArrow(
        _packed, "ids array<long>, toxic array<int>, size binary, terms binary, times binary").collect())
    ids, toxic, flat, times, size = _unpacked(own)
    y = np.asarray(toxic, float)
    weight = np.log((1 + total) / (1 + df)) * relevance(np.repeat(np.arange(len(ids)), size), flat, y, len(terms))
    index = shared(spark, Index(ids, toxic, flat, times, weight, size))
    votes = examples.mapInArrow(_votes(index), "tenth int, toxic int").groupBy("tenth", "toxic").count().collect()
    drawn = {c: sum(r["count"] for r in votes if r["toxic"] == c) for c in (0, 1)}
    share = {c: totals.get(c, 0) / drawn[c] if drawn[c] else 0.0 for c in (0, 1)}      # labelled rows for each drawn one
    mass = {(r["tenth"], r["toxic"]): r["count"] * share[r["toxic"]] for r in votes}
    seen = [mass.get((i, 0), 0.0) + mass.get((i, 1), 0.0) for i in range(-1, 10)]
    prior = totals.get(1, 0) / max(sum(totals.values()), 1)
    rate = [(mass.get((i, 1), 0.0) + (prior if i < 0 else (i + 0.5) / 10)) / (n + 1) for i, n in zip(range(-1, 10), seen)]
    rate = dict(zip(range(-1, 10), [rate[0] if totals else 0.0, *(_monotone(rate[1:], [n + 1 for n in seen[1:]]) if totals else [0.0] * 10)]))
    return vocabulary, index, shared(spark, rate)


def _rows(docs: DataFrame, folds: int, held: int) -> DataFrame:
    return docs.select("doc_id", "text", (hash_mod("doc_id", folds) == held).alias("held_out"))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
                   toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` for every row of
    ``docs (doc_id, text)``; ``labels (doc_id, toxic)`` count only for rows
    with ``crc32(doc_id) % folds <> held``.

    NULL and empty texts and texts without a vocabulary term get the label
    rate of such examples and no evidence; without any labelled row the score
    is 0.  A doc_id with several labels takes the largest, NULL labels none.
    Sets the session's limit of bytes of an Arrow batch.
    Repeated rows are scored one by one, other columns are ignored, an empty
    table gives no rows.
    """
    rows, keep = _rows(docs, folds, held), ["doc_id", "held_out"]
    bounded_batches(docs.sparkSession)
    vocabulary, index, rates = fit(rows, labels, folds, held, toxic_rows, clean_rows)
    vectors, scored = _vectors(vocabulary, keep), _score(index, rates, keep, _OUTPUTS)
    return rows.mapInArrow(lambda batches: scored(vectors(batches)),
                           _schema(rows, keep, _evidence(_OUTPUTS)))


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
                  toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``score_toxicity`` doesn't predict as toxic."""
    bounded_batches(docs.sparkSession)
    vocabulary, index, rates = fit(_rows(docs, folds, held), labels, folds, held, toxic_rows, clean_rows)
    keep = docs.columns
    names = [f"{c}_of_{len(keep)}" for c in _HIDDEN]
    while set(n.lower() for n in names) & set(c.lower() for c in keep):
        names = [f"{n}_" for n in names]
    vectors, scored = _vectors(vocabulary, keep), _score(index, rates, keep, names)
    found = docs.mapInArrow(lambda batches: scored(vectors(batches)), _schema(docs, keep, _evidence(names)))
    return found.filter(F.col(names[1]) == 0).select(*keep)
