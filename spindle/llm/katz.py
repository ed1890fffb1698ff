"""Katz back-off scoring of texts.

Model of order n, over every training word (no vocabulary bound).  A token's
probability after a context is found recursively:

* seen gram (h, w):  d(c) * c(h, w) / c(h), Good-Turing discounted (counts of
                     counts smoothed by a line), d fitted for each order;
* unseen gram:       alpha(h) * P(w | h without its first token), alpha
                     exactly normalised, so that the probabilities after h
                     sum to one; 1 after a context that was never seen;
* order 1:           Good-Turing discounted counts of words and the end; the
                     mass they leave is that of one unseen word.

Contexts at the beginning of a text are filled with a begin token.

Tables.  All counts are exact and cover every training token.  Parts of the
input (chunks) keep their token streams as rows of a written table.  For each
order a chunk sends its distinct grams with counts to key ranges; a range adds
them up, writes its slice of the count table (partitioned by ``kind``) and
answers each chunk with the totals of the keys it asked for.  One asking chunk
owns each seen gram: owners add its discounted count and its lower-order
probability to the sums of the gram's context, which meet in key ranges and
are answered alike.  A context that only one chunk asked about needs no
exchange.  Tokens are scored by folding the answers of the orders.  Only
histograms of counts reach the driver.  Key ranges are cut by tokens, so that
a range stays small at any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import buckets, hash_mod, hashed_words, key_bucket, mix64, written
from spindle.session import shared_path

#: Counts up to this are discounted by Good-Turing.
GT_MAX = 5
#: Tokens of a part of the input that is handled at once (a longer text is a part of its own).
CHUNK_TOKENS = 2_000_000
#: Tokens whose grams share a key range; never fewer ranges than shuffle partitions.
RANGE_TOKENS = 4_000_000
#: Bits of a gram's key beyond order 1 (words have 64): at 5e8 distinct grams about a hundred share a key.
GRAM_BITS = 50

_END, _BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def _zip(x: np.ndarray) -> bytes:
    """Byte planes, compressed: the high bytes of small numbers cost nothing."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unzip(b: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _zip_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, as differences."""
    return _zip(np.diff(keys, prepend=np.uint64(0)))


def _unzip_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unzip(b, np.uint64), dtype=np.uint64)


def discounts(times, most: int = GT_MAX, at=None) -> np.ndarray:
    """Katz's Good-Turing factors for counts 0..most, from the numbers of
    kinds: ``times[i]`` kinds occur ``at[i]`` times (1, 2, ... by default).

    The numbers are smoothed as in simple Good-Turing: each is spread over
    the gap to its neighbours and a line is fitted to its logarithm over the
    logarithm of the count.  Any slope below -1 gives factors in (0, 1).
    Only without such a line (less than two different counts, or kinds that
    don't grow rarer) absolute discounting takes their place."""
    n = np.asarray(times, float)
    r = np.arange(1, len(n) + 1) if at is None else np.asarray(at)
    order = np.argsort(r)
    r, n = r[order][n[order] > 0].astype(float), n[order][n[order] > 0]
    d, low = np.ones(most + 1), np.arange(1, most + 1)
    if len(r) > 1:
        before = np.concatenate([[0], r[:-1]])
        after = np.append(r[1:], 2 * r[-1] - r[-2])
        x, y = np.log(r), np.log(n / (0.5 * (after - before)))
        x, y = x - x.mean(), y - y.mean()
        slope = (x @ y) / (x @ x)
        if slope < -1 - 1e-6:
            tail = (most + 1.0) ** (slope + 1)               # (most + 1) n(most + 1) / n(1) on the line
            d[1:] = ((1 + 1 / low) ** (slope + 1) - tail) / (1 - tail)
            return d
    few = dict(zip(r.tolist(), n.tolist()))
    off = few[1.0] / (few[1.0] + 2 * few[2.0]) if 1.0 in few and 2.0 in few else 0.5
    d[1:] = 1 - off / low
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return c * np.where(c < len(d), d[np.minimum(c, len(d) - 1).astype(np.int64)], 1.0)


def _streams(batches):
    """Batches of (doc_id, text, fold) -> chunks: distinct word hashes and
    the tokens as numbers of those."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        h, counts = hashed_words(batch.column("text"))
        end, row = np.concatenate([[0], np.cumsum(counts)]), 0
        while row < len(counts):
            last = max(row + 1, int(np.searchsorted(end, end[row] + CHUNK_TOKENS, "right")) - 1)
            words, stream = np.unique(h[end[row]:end[last]], return_inverse=True)
            n = counts[row:last]
            train = np.asarray(batch.column("fold"))[row:last] != 0
            yield pa.RecordBatch.from_pylist([{
                "chunk": (part << 32) | seq, "tokens": int(n.sum()) + len(n), "ends": int(train.sum()),
                "doc_id": batch.column("doc_id").cast(pa.int64())[row:last].to_pylist(),
                "train": train.astype(np.uint8).tobytes(), "n": n.astype(np.int32).tobytes(),
                "keys": _zip_keys(words), "stream": _zip(stream.astype(np.uint32))}], schema=pa.schema(
                    [(c, pa.int64()) for c in ("chunk", "tokens", "ends")] + [("doc_id", pa.list_(pa.int64()))]
                    + [(c, pa.binary()) for c in ("train", "n", "keys", "stream")]))
            seq, row = seq + 1, last


_STREAM_SCHEMA = ("chunk long, tokens long, ends long, doc_id array<long>, train binary, n binary, keys binary, "
                  "stream binary")


class Grams:
    """Distinct grams of one order in a chunk: ascending ``keys``, ``at`` the
    gram that ends at each token, ``context`` and ``suffix`` the grams of the
    order below that it extends and ends with (the begin context has the
    number after the last)."""

    def __init__(self, keys, bits, at, context=None, suffix=None):
        self.keys, self.bits, self.at, self.context, self.suffix = keys, bits, at, context, suffix


def chunk_grams(row: dict, order: int) -> list[Grams]:
    """Grams of the orders 1 to ``order``.  The end is the last gram of order 1, without a key."""
    words, counts = _unzip_keys(row["keys"]), np.frombuffer(row["n"], np.int32)
    last = np.cumsum(counts + 1) - 1
    at = np.full(len(last) + int(counts.sum()), len(words), np.int64)
    inner = np.ones(len(at), bool)
    inner[last] = False
    at[inner] = _unzip(row["stream"], np.uint32)
    begins = np.zeros(len(at), bool)
    begins[last - counts] = True
    token = np.append(words, _END)[at]
    out, h, below = [Grams(words, 64, at)], token, len(words) + 1
    for _ in range(1, order):
        h = mix64(np.where(begins, _BEGIN, np.roll(h, 1)) * np.uint64(0x9E3779B97F4A7C15) + token)
        keys, one, now = np.unique(h >> np.uint64(64 - GRAM_BITS), return_index=True, return_inverse=True)
        out.append(Grams(keys, GRAM_BITS, now, np.where(begins[one], below, at[one - 1]), at[one]))
        at, below = now, len(keys)
    return out


def _by_range(keys: np.ndarray, bits: int, parts: int):
    """``(range, slice of its keys)`` of ascending keys."""
    of = key_bucket(keys << np.uint64(64 - bits), parts)
    for b in np.unique(of).tolist():
        yield b, slice(int(np.searchsorted(of, b)), int(np.searchsorted(of, b, "right")))


def _answered(table: pa.Table, order: int, kind: str) -> dict:
    """``{range: (first, second)}`` of a chunk's answers."""
    if not table.num_rows:
        return {}
    cols = [table.column(c).to_pylist() for c in ("order", "kind", "bucket", "first", "second")]
    return {b: (x, y) for o, k, b, x, y in zip(*cols) if o == order and k == kind}


_ANSWER = "order int, kind string, bucket int, chunk long, first binary, second binary"
_ASK = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("first", pa.binary()),
                  ("second", pa.binary())])
_ASKED = "bucket int, chunk long, keys binary, first binary, second binary"


def _asks(order: int, parts: int):
    """Chunks -> their distinct grams of an order with training counts, by key range."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                g = chunk_grams(row, order)[-1]
                train = np.repeat(np.frombuffer(row["train"], np.uint8), np.frombuffer(row["n"], np.int32) + 1)
                times = np.bincount(g.at, weights=train, minlength=len(g.keys)).astype(np.int64)
                for b, cut in _by_range(g.keys, g.bits, parts):
                    yield pa.RecordBatch.from_pylist([{"bucket": b, "chunk": row["chunk"], "second": None, "keys":
                                                       _zip_keys(g.keys[cut]), "first": _zip(times[cut])}], schema=_ASK)
    return run


def _asked(table: pa.Table):
    """A key range's rows by chunk, their distinct keys, each ask's first
    place among all asks and the key that it is for."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    keys = [_unzip_keys(r["keys"]) for r in rows]
    return rows, np.cumsum([0, *map(len, keys)]), *np.unique(np.concatenate(keys), return_index=True, return_inverse=True)


_OUT = pa.schema([("order", pa.int32()), ("kind", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int64()),
                  ("first", pa.binary()), ("second", pa.binary())])


def _totals(order: int):
    """A key range: counts of its grams (kind ``count``: keys, counts), and
    what each chunk asked for, in the order of its keys (kind ``answer``):
    4 * count + 2 if nobody else asked + 1 if the chunk owns the seen gram."""
    def run(table: pa.Table) -> pa.Table:
        rows, end, keys, one, which = _asked(table)
        times = np.concatenate([_unzip(r["first"], np.int64) for r in rows])
        total = np.bincount(which, weights=times, minlength=len(keys)).astype(np.int64)
        reply = total[which] * 4 + (np.bincount(which, minlength=len(keys)) == 1)[which] * 2
        reply[one] += total > 0
        b, some = rows[0]["bucket"], total > 0
        out = [{"kind": "answer", "chunk": r["chunk"], "first": _zip(reply[i:j]), "second": None}
               for r, i, j in zip(rows, end, end[1:])]
        out.append({"kind": "count", "chunk": -1, "first": _zip_keys(keys[some]), "second": _zip(total[some])})
        return pa.Table.from_pylist([{"order": order, "bucket": b, **r} for r in out], schema=_OUT)
    return run


def _table(rows: DataFrame, name: str) -> DataFrame:
    path = shared_path(rows.sparkSession, name)
    rows.write.partitionBy("kind").parquet(path)
    out = rows.sparkSession.read.schema(_ANSWER.replace("kind string, ", "") + ", kind string").parquet(path)
    out.written_path = path
    return out


def count_table(streams: DataFrame, order: int, parts: int) -> DataFrame:
    """Counts of the grams of an order and the answers to all chunks, written."""
    return _table(streams.mapInArrow(_asks(order, parts), _ASKED).groupBy("bucket")
                  .applyInArrow(_totals(order), _ANSWER), f"katz-counts-{order}")


def _shape(batches):
    """Slices of a count table -> how many grams occur so many times."""
    for batch in batches:
        for b in batch.column("second").to_pylist():
            at, kinds = np.unique(_unzip(b, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(kinds.astype(np.int64))], names=["at", "kinds"])


def shape(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The whole histogram: different counts, ascending, and the number of
    grams of each (different counts grow with the root of the tokens at most)."""
    rows = (counts.filter("kind = 'count'").select("second").mapInArrow(_shape, "at long, kinds long")
            .groupBy("at").agg(F.sum("kinds").alias("kinds")).orderBy("at").toPandas())
    return rows["at"].to_numpy(np.int64), rows["kinds"].to_numpy(np.int64)


class Model:
    """What every task needs: totals, and discount factors by order."""

    def __init__(self, at, kinds, ends: int):
        self.n, self.v, self.ends = int(at @ kinds) + ends, int(kinds.sum()) + (ends > 0), ends
        self.base = self.n + 0.1 * (self.v + 1)
        by = dict(zip(at.tolist(), kinds.tolist()))
        if ends:
            by[ends] = by.get(ends, 0) + 1
        self.d = [discounts(list(by.values()), at=list(by))]
        self.unseen, self.scale = 0.5, 0.0
        if self.n:
            self.unseen = min(max(by.get(1, 0) / self.n, 0.1 / self.base), 0.5)
            r = np.arange(1, GT_MAX + 1)
            lost = (np.array([by.get(int(i), 0) for i in r]) * r * (1 - self.d[0][1:])).sum()
            self.scale = (1 - self.unseen) / (self.n - lost)

    def words(self, c: np.ndarray) -> np.ndarray:
        """Probabilities of words by count; the last entry is the end's."""
        p = np.where(c > 0, discounted(c, self.d[0]) * self.scale, self.unseen)
        return p if self.n else np.append(p[:-1], 0.5)

    def step(self, order: int, c, total, seen, below, lower) -> np.ndarray:
        """Probabilities of grams from their counts, their context's count and
        sums, and the probability of their last token one order lower."""
        safe = np.where(total > 0, total, 1.0)
        keep = np.minimum(seen / safe, 1 - 0.5 / (safe + 1))
        room = 1 - below
        full = room <= 1e-12                     # every token has been seen after this context
        keep = np.where(full, 1.0, keep)
        alpha = np.where(total > 0, (1 - keep) / np.where(full, 1.0, room), 1.0)
        return np.where(c > 0, discounted(c, self.d[order - 1]) * keep / np.where(seen > 0, seen, 1.0), alpha * lower)


class Chunk:
    """A chunk with the answers of some orders: counts, context sums and
    probabilities ``p`` of its grams, up to the last order whose sums are known."""

    def __init__(self, row: dict, answers: pa.Table, model: Model, parts: int, order: int, summed: int):
        self.model, self.parts, self.grams = model, parts, chunk_grams(row, order)
        self.reply = []
        for k, g in enumerate(self.grams, 1):
            got, reply = _answered(answers, k, "answer"), np.zeros(len(g.keys), np.int64)
            for b, cut in _by_range(g.keys, g.bits, parts):
                reply[cut] = _unzip(got[b][0], np.int64)
            self.reply.append(np.append(reply, model.ends * 4) if k == 1 else reply)
        self.p = model.words(self.reply[0] >> 2)
        for k in range(2, summed + 1):
            self.p = self._raise(k, _answered(answers, k, "sum"))

    def sums(self, order: int):
        """Sums of the owned grams by context, and the contexts that other
        chunks know too: ``(seen, below, numbers, keys)``, keys ascending."""
        g, low, reply = self.grams[order - 1], self.grams[order - 2], self.reply[order - 1]
        own, many = (reply & 1) == 1, len(self.reply[order - 2]) + 1
        seen, below = (np.bincount(g.context[own], weights=x, minlength=many).astype(float) for x in
                       (discounted(reply[own] >> 2, self.model.d[order - 1]), self.p[g.suffix[own]]))
        apart = np.append((self.reply[order - 2] & 2) == 2, False)
        known = np.flatnonzero((np.bincount(g.context, minlength=many) > 0) & ~apart)
        keys = np.append(low.keys, np.zeros(many - len(low.keys), np.uint64))
        keys[-1] = _BEGIN >> np.uint64(64 - low.bits)
        order_of = np.argsort(keys[known], kind="stable")
        return seen, below, known[order_of], keys[known][order_of]

    def _raise(self, order: int, got: dict) -> np.ndarray:
        seen, below, known, keys = self.sums(order)
        for b, cut in _by_range(keys, self.grams[order - 2].bits, self.parts):
            seen[known[cut]], below[known[cut]] = (_unzip(x, float) for x in got[b])
        g = self.grams[order - 1]
        total = np.append(self.reply[order - 2] >> 2, self.model.ends)
        return self.model.step(order, self.reply[order - 1] >> 2, *(x[g.context] for x in (total, seen, below)),
                               self.p[g.suffix])


def _sum_asks(model: Model, parts: int, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            chunk = Chunk(row, right, model, parts, order, order - 1)
            seen, below, known, keys = chunk.sums(order)
            for b, cut in _by_range(keys, chunk.grams[order - 2].bits, parts):
                out.append({"bucket": b, "chunk": row["chunk"], "keys": _zip_keys(keys[cut]),
                            "first": _zip(seen[known[cut]]), "second": _zip(below[known[cut]])})
        return pa.Table.from_pylist(out, schema=_ASK)
    return run


def _sum_totals(order: int):
    """A key range: sums of its contexts over all chunks, answered to each chunk."""
    def run(table: pa.Table) -> pa.Table:
        rows, end, keys, _, which = _asked(table)
        seen, below = (np.bincount(which, weights=np.concatenate([_unzip(r[c], float) for r in rows]),
                                   minlength=len(keys))[which] for c in ("first", "second"))
        return pa.Table.from_pylist([{"order": order, "kind": "sum", "bucket": r["bucket"], "chunk": r["chunk"],
                                      "first": _zip(seen[i:j]), "second": _zip(below[i:j])}
                                     for r, i, j in zip(rows, end, end[1:])], schema=_OUT)
    return run


def _by_text(counts: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(counts)), counts), weights=x, minlength=len(counts))


def _scored(model: Model, parts: int, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            chunk, n = Chunk(row, right, model, parts, order, order), np.frombuffer(row["n"], np.int32).astype(np.int64) + 1
            c, at = chunk.reply[0] >> 2, chunk.grams[0].at
            out.append(pa.table({
                "doc_id": pa.array(row["doc_id"], pa.int64()),
                "held_out": pa.array(np.frombuffer(row["train"], np.uint8) == 0),
                "n_tokens": pa.array(n), "n_known": pa.array(_by_text(n, c[at] > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(n), model.n, np.int64)),
                "base_score": pa.array(_by_text(n, np.log10((c + 0.1) / model.base)[at])),
                "score": pa.array(_by_text(n, np.log10(chunk.p)[chunk.grams[-1].at]))}))
        return pa.concat_tables(out)
    return run


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double")


def katz_scores(docs: DataFrame, folds: int = 10, order: int = 2) -> DataFrame:
    """Score every text of ``docs (doc_id, text)`` by a model of the given
    order learnt from the rows with ``crc32(doc_id) % folds <> 0``.

    NULL texts are empty: one token, the end.  Rows with the same or a NULL
    doc_id are scored one by one.  Other columns are ignored.  Without
    training rows every word is unseen.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", hash_mod("doc_id", folds).alias("fold"))
    streams = written(rows.mapInArrow(_streams, _STREAM_SCHEMA), "katz-streams")
    size = streams.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                       F.coalesce(F.sum("ends"), F.lit(0)).alias("ends")).first()
    parts = max(buckets(spark), -(-size["tokens"] // RANGE_TOKENS))
    chunks = streams.drop("tokens", "ends").groupBy("chunk")
    model, answers = None, None
    for k in range(1, order + 1):
        counts = count_table(streams, k, parts)
        at, kinds = shape(counts)
        if k == 1:
            model = Model(at, kinds, size["ends"])
        else:
            model.d.append(discounts(kinds, at=at))
        own = counts.filter("kind = 'answer'")
        answers = own if answers is None else answers.unionByName(own)
        if k > 1:
            asks = chunks.cogroup(answers.groupBy("chunk")).applyInArrow(_sum_asks(model, parts, k), _ASKED)
            answers = answers.unionByName(_table(asks.groupBy("bucket").applyInArrow(_sum_totals(k), _ANSWER),
                                                 f"katz-sums-{k}"))
    return chunks.cogroup(answers.groupBy("chunk")).applyInArrow(_scored(model, parts, order), _SCORES)
