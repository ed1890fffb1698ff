"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces
(forward algorithm), that of a text the product over its words; a character
that is no piece counts as one unknown piece.  The distributions are fitted by
EM (forward-backward over the same lattices) on the words of a bounded sample
of labelled rows; each EM step is one Spark job over the (language, word)
counts, and only one number for each language and piece returns.

Every text is scored whole: the distinct words of a part of the input are
walked through the lattice at once for all languages, and the words' log
probabilities are summed by text.  A word of more than RUN characters is
walked alone, over its whole length: its forward values are rescaled every
STEP characters, so that no sum leaves the doubles and none is cut.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.base import hash_mod, received, shared, span_hashes, text_slices, words_of, written
from spindle.llm.pieces import MODEL_FILE, SPACE_MARK, Trie, code_matrix, edges, read_pieces

#: Rows of each language that the distributions are fitted on, and EM steps.
FIT_ROWS, EM_STEPS = 800, 4
#: Longest word (with its mark) that is walked together with others, and
#: characters between two rescalings of a longer one.  Neither changes a result.
RUN, STEP = 48, 16
#: Hash classes that each language's rows are ranked in before they are ranked together.
RANKS = 64
#: Weight of an unknown character and of pieces never seen in a language.
UNKNOWN, SMOOTH = 1e-9, 1e-8
_LETTER = re.compile(r"[^\W\d_]")
#: Forward sums are scaled by this for each character, so that they stay within doubles.
SCALE = 1024.0


def distinct_words(column: pa.Array):
    """``(rows of a slice, words of each row, word numbers, words)`` by slices."""
    for row, data, starts, ends in text_slices(column):
        begin, finish, counts = words_of(data, starts, ends)
        _, at, number = np.unique(span_hashes(data, begin, finish), return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[b:e].decode("utf-8", "replace").lower() for b, e in zip(begin[at].tolist(), finish[at].tolist())]
        yield row, counts, number, words


class Pieces(Trie):
    """The trie, and the piece numbers by text for words that are walked alone."""

    def __init__(self, pieces: list[tuple[int, str]]):
        Trie.__init__(self, pieces)
        self.number = {p: i for i, p in pieces}

    def walk(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, ends, pieces)`` of the edges of one word, starts ascending."""
        starts, ends, found, get, n = array("q"), array("q"), array("q"), self.number.get, len(word)
        for s in range(n):
            for e in range(s + 1, min(s + self.longest, n) + 1):
                piece = get(word[s:e], -1)
                if piece >= 0 or e == s + 1:
                    starts.append(s)
                    ends.append(e)
                    found.append(piece)
        return tuple(np.frombuffer(x, np.int64) for x in (starts, ends, found))


def _marked(words: list[str]) -> tuple[list[str], np.ndarray]:
    words = [SPACE_MARK + w for w in words]
    return words, np.fromiter((len(w) for w in words), np.int64, len(words))


def _lattices(words: list[str]):
    """Batches of ``(numbers, codes, lengths)`` of the words up to ``RUN``."""
    words, size = _marked(words)
    for low, high in ((0, 12), (12, 18), (18, RUN)):
        pick = np.flatnonzero((size > low) & (size <= high))
        for k in range(0, len(pick), 20_000):
            some = pick[k:k + 20_000]
            yield (some, *code_matrix([words[i] for i in some]))


def _long(words: list[str]):
    """``(number, word)`` of the words beyond ``RUN``."""
    words, size = _marked(words)
    return [(i, words[i]) for i in np.flatnonzero(size > RUN).tolist()]


def _forward(trie: Pieces, p: np.ndarray, word: str):
    """Edges of one word and its rescaled forward values ``[position,
    language]``; the logarithms taken out up to each position."""
    starts, ends, piece = trie.walk(word)
    n, at = len(word), 0
    total, out = np.zeros((n + 1, p.shape[1])), np.zeros((n + 1, p.shape[1]))
    total[0] = 1.0
    for s in range(n):
        if s and s % STEP == 0:
            top = total[s:s + trie.longest].max(axis=0)
            total[s:s + trie.longest] /= top
            out[s] = np.log(top)
        while at < len(starts) and starts[at] == s:
            total[ends[at]] += total[s] * p[piece[at]]
            at += 1
    return starts, ends, piece, total, np.cumsum(out, axis=0)


def word_logs(trie: Pieces, p: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language; ``p[piece, language]``
    has the unknown piece last (so that index -1 is it)."""
    out = np.zeros((len(words), p.shape[1]))
    for owner, codes, n in _lattices(words):
        total = np.zeros((codes.shape[1] + 1, len(owner), p.shape[1]))
        total[0] = 1.0
        for start, end, at, piece in edges(trie, codes, n):
            total[end, at] += total[start, at] * p[piece] * SCALE ** (end - start)
        last = total[n, np.arange(len(owner))]
        out[owner] = np.log(last) - n[:, None] * np.log(SCALE)
    for i, word in _long(words):
        *_, total, taken = _forward(trie, p, word)
        out[i] = np.log(total[-1]) + taken[-1]
    return out


def long_uses(trie: Pieces, p: np.ndarray, word: str):
    """``(pieces, expected uses)`` of one word in the one language of ``p``,
    by edge: forward values times backward ones, both rescaled alike."""
    starts, ends, piece, total, taken = _forward(trie, p[:, None], word)
    q = p[piece] * np.exp(taken[starts, 0] - taken[ends, 0])
    back = np.zeros(len(word) + 1)
    back[-1] = 1.0
    for k in range(len(starts) - 1, -1, -1):
        back[starts[k]] += back[ends[k]] * q[k]
    return piece, total[starts, 0] * q * back[ends] / back[0]


def _word_counts(batches):
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        rows: dict[tuple[str, str], int] = {}
        for first, counts, number, words in distinct_words(batch.column("text")):
            at = 0
            for r, c in enumerate(counts.tolist()):
                k, times = np.unique(number[at:at + c], return_counts=True)
                at += c
                for i, t in zip(k.tolist(), times.tolist()):
                    key = (langs[first + r], words[i])
                    rows[key] = rows.get(key, 0) + t
        yield pa.RecordBatch.from_pylist([{"lang": a, "word": w, "n": c} for (a, w), c in rows.items()],
                                         schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))


def _expected(model):
    """One EM step over (lang, word, n): expected uses of each piece."""
    def run(batches):
        trie, p, langs = received(model)
        spot = {a: i for i, a in enumerate(langs)}
        uses = np.zeros_like(p)
        for batch in batches:
            lang = np.array([spot[a] for a in batch.column("lang").to_pylist()], np.int64)
            times = np.asarray(batch.column("n"), np.float64)
            words = batch.column("word").to_pylist()
            for i, word in _long(words):
                used, share = long_uses(trie, p[:, lang[i]], word)
                np.add.at(uses, (used, lang[i]), times[i] * share)
            for owner, codes, n in _lattices(words):
                which, weight = lang[owner], times[owner]
                steps = [(s, e, at, piece, p[piece, which[at]] * SCALE ** (e - s))
                         for s, e, at, piece in edges(trie, codes, n)]
                ahead = np.zeros((codes.shape[1] + 1, len(owner)))
                back = np.zeros_like(ahead)
                ahead[0] = 1.0
                back[n, np.arange(len(owner))] = 1.0
                for s, e, at, _, q in steps:
                    ahead[e, at] += ahead[s, at] * q
                for s, e, at, _, q in reversed(steps):
                    back[s, at] += back[e, at] * q
                for s, e, at, piece, q in steps:
                    np.add.at(uses, (piece, which[at]), weight[at] * ahead[s, at] * q * back[e, at] / back[0, at])
        piece, which = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int64)), pa.array(which.astype(np.int64)),
                                          pa.array(uses[piece, which])], names=["piece", "lang", "uses"])
    return run


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, steps: int = EM_STEPS, model_file: str = MODEL_FILE):
    """Fit on ``rows (doc_id, text, lang)``; returns ``(trie, p, langs, prior)``.

    Of each language the ``fit_rows`` rows with the smallest hash of doc_id
    take part; the prior is the share of all rows.
    """
    spark = rows.sparkSession
    pieces, _ = read_pieces(model_file)
    trie = Pieces([(k, piece) for k, (_, piece, _) in enumerate(pieces)])
    share = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(share)
    if not langs:
        return trie, np.zeros((len(pieces) + 1, 0)), [], np.zeros(0)
    ids = rows.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(RANKS)).alias("part"))
    for group in (["lang", "part"], ["lang"]):              # no language's rows are ranked in one task
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id"))
        ids = ids.withColumn("r", rank).filter(F.col("r") <= fit_rows).drop("r")
    ids = ids.select("doc_id").distinct()
    some = rows.join(F.broadcast(ids), "doc_id", "left_semi")          # fit_rows ids of each language
    counts = written(some.select("text", "lang").mapInArrow(_word_counts, "lang string, word string, n long")
                     .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    spread = counts.repartition("lang", "word")
    p = np.full((len(pieces) + 1, len(langs)), 1 / len(pieces))
    p[-1] = UNKNOWN
    for _ in range(steps):
        got = (spread.mapInArrow(_expected(shared(spark, (trie, p, langs))), "piece long, lang long, uses double")
               .groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas())   # pieces x languages at most
        p = np.zeros_like(p)
        p[got["piece"], got["lang"]] = got["uses"]
        p[-1] = 0
        p = p / np.maximum(p.sum(axis=0), 1e-300) + SMOOTH
        p[-1] = UNKNOWN
        p /= p.sum(axis=0)
    prior = np.array([share[a] for a in langs], float)
    return trie, p, langs, prior / prior.sum()


def _predict(model):
    def run(batches):
        trie, p, langs, prior = received(model)
        for batch in batches:
            n = batch.num_rows
            logs, letters = np.zeros((n, len(langs))), np.zeros(n, bool)
            for first, counts, number, words in distinct_words(batch.column("text")):
                of = np.repeat(np.arange(len(counts)), counts)
                letter = np.fromiter((_LETTER.search(w) is not None for w in words), bool, len(words))
                letters[first:first + len(counts)] |= np.bincount(of, weights=letter[number], minlength=len(counts)) > 0
                if langs:
                    each = word_logs(trie, p, words)
                    for k in range(len(langs)):
                        logs[first:first + len(counts), k] = np.bincount(of, weights=each[number, k], minlength=len(counts))
            known = letters & bool(langs)
            if langs:
                logs += np.log(prior)
                post = np.exp(logs - logs.max(axis=1, keepdims=True))
                post /= post.sum(axis=1, keepdims=True)
                best = post.argmax(axis=1)
                pred = [langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, post[np.arange(n), best], 0.0)
            else:
                pred, score = ["und"] * n, np.zeros(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                                              pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict_languages(docs: DataFrame, folds: int = 3, held: int = 1, fit_rows: int = FIT_ROWS,
                      model_file: str = MODEL_FILE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs
    (doc_id, text, lang)``, learnt from rows with a language and
    ``crc32(doc_id) % folds <> held``.

    NULL and empty texts and texts without a letter get ``und`` and score 0,
    as does every text if no row can be learnt from.  Ties go to the language
    that sorts first.  Repeated rows are predicted one by one; other columns
    are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", "lang", (hash_mod("doc_id", folds) == held).alias("held_out"))
    model = fit(rows.filter("not held_out and lang is not null and text is not null").select("doc_id", "text", "lang"),
                fit_rows, model_file=model_file)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return rows.select("doc_id", "text", "held_out").mapInArrow(_predict(shared(docs.sparkSession, model)), schema)
