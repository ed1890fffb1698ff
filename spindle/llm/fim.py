"""Fill-in-middle transformation by word-parallel selection.

A text's units are runs of ASCII letters and single other code points.  To
cut behind the k-th unit, no unit is ever listed: the UTF-8 bytes of a batch
are viewed as 64-bit words, and plain integer arithmetic marks the last byte of every
unit in the high bit of its lane, eight bytes at a time.  ``bitwise_count``
gives the marks of each word, their running sum is searched for the word
that holds the k-th mark, and the mark is found inside the word by the same
arithmetic.  Code points are counted from marks of starting bytes.

Texts are cut at two places drawn from a hash of the document's id, and
written as prefix, suffix, middle (psm) or suffix, prefix, middle (spm) with
a sentinel before each part; some stay as they are (plain).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.base import bounded_batches, small_batches, text_slices

#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

OUTPUTS = "n long, form string, prefix_chars long, middle_chars long, output string"


def _lanes(byte: int) -> np.uint64:
    """The byte in all eight lanes."""
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW7, _ONE = _lanes(0x80), _lanes(0x7F), _lanes(1)


class Marks:
    """Marked bytes of a buffer: rank and select over 64-bit words."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        below = (np.uint64(1) << (8 * (at & 7)).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 3] + np.bitwise_count(self.words[at >> 3] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte that bears the ``k``-th mark (from 1)."""
        word = np.searchsorted(self.before, k, "left") - 1
        rest = (k - self.before[word]).astype(np.uint64)
        running = (self.words[word] >> np.uint64(7)) * _ONE              # lane i: marks in lanes 0..i
        reached = ((running | _HIGH) - rest * _ONE) & _HIGH              # lanes whose count is at least the rest
        return 8 * word + 8 - np.bitwise_count(reached)


def unit_marks(data: np.ndarray, ends: np.ndarray) -> tuple[Marks, Marks]:
    """Marks of the last byte of every unit and of the first byte of every
    code point; ``ends`` are the ends of the non-empty texts in ``data``."""
    words = np.zeros(len(data) // 8 + 2, dtype="<u8")
    words.view(np.uint8)[:len(data)] = data
    lower = (words & _LOW7) | _lanes(0x20)
    letter = (lower + _lanes(0x80 - 0x61)) & ~(lower + _lanes(0x80 - 0x7B)) & ~words & _HIGH
    first = ~(words & ~(words << np.uint64(1))) & _HIGH                  # all but 10xxxxxx

    def following(marks):
        out = marks >> np.uint64(8)
        out[:-1] |= marks[1:] << np.uint64(56)
        return out
    last = following(first) & ~(letter & following(letter)) & _HIGH
    last.view(np.uint8)[ends - 1] = 0x80                                 # a text's end ends its last unit
    return Marks(last), Marks(first)


def cuts(column: pa.Array, draws: np.ndarray):
    """For every row: units, the two cut bytes, and code points of prefix and
    middle.  ``draws`` holds two draws a row; a draw modulo (units + 1) is the
    number of units before a cut."""
    rows = len(column)
    n, at, chars = np.zeros(rows, np.int64), np.zeros((rows, 2), np.int64), np.zeros((rows, 2), np.int64)
    for row, data, starts, ends in text_slices(column):
        here = slice(row, row + len(starts))
        last, first = unit_marks(data, ends[ends > starts])
        base = last.rank(starts)
        n[here] = last.rank(ends) - base
        units = np.sort(draws[here] % (n[here] + 1)[:, None], axis=1)
        point = np.repeat(starts, 2).reshape(-1, 2)
        some = units > 0
        point[some] = last.select((units + base[:, None])[some]) + 1
        at[here] = point - starts[:, None]
        seen = first.rank(point.ravel()).reshape(-1, 2)
        chars[here, 0] = seen[:, 0] - first.rank(starts)
        chars[here, 1] = seen[:, 1] - seen[:, 0]
    return n, at, chars


def _draws(key: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"_draw{i}") for i in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1,
                   rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """Columns of ``docs`` with ``n`` (units), ``form`` (``plain``, ``psm`` or
    ``spm``), ``prefix_chars``, ``middle_chars`` (code points; NULL if plain)
    and ``output``.

    ``rate`` % of the texts are transformed, ``spm_rate`` % of those as spm,
    decided by the hash of the key (a NULL key hashes as no digits).  Empty and
    NULL texts and texts that hold a sentinel are plain; the output of a NULL
    text is empty.  Rows are independent: repeated rows give the same output,
    an empty table gives no rows.  A column of ``docs`` named like an output
    gives way to it; all others are kept.
    """
    bounded_batches(docs.sparkSession)
    outputs = T._parse_datatype_string(OUTPUTS)
    kept = [f for f in docs.schema if f.name not in outputs.names]
    names, sentinels = [f.name for f in kept], (PREFIX, SUFFIX, MIDDLE)
    cut, source = cuts, f"_source_{text}"
    rows = docs.select(*[F.col(c) for c in names], F.col(text).alias(source), *_draws(F.col(key), seed))

    def transform(batches):
        for batch in small_batches(batches, source):
            texts = pc.fill_null(batch.column(source), "")
            draw = np.stack([np.asarray(batch.column(f"_draw{i}")) for i in range(4)], axis=1)
            n, at, chars = cut(texts, draw[:, :2])
            plain = (draw[:, 2] % 100 >= rate) | (n == 0)
            for s in sentinels:
                plain |= np.asarray(pc.match_substring(texts, s))
            form = np.where(plain, "plain", np.where(draw[:, 3] % 100 < spm_rate, "spm", "psm"))
            first, second, third = (s.encode() for s in sentinels)
            output = []
            for t, f, (a, b) in zip(texts.cast(pa.binary()), form.tolist(), at.tolist()):
                t = t.as_py()
                if f == "psm":
                    t = b"".join((first, t[:a], second, t[b:], third, t[a:b]))
                elif f == "spm":
                    t = b"".join((second, t[b:], first, t[:a], third, t[a:b]))
                output.append(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [
                    pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(chars[:, 0], pa.int64(), mask=plain),
                    pa.array(chars[:, 1], pa.int64(), mask=plain), pa.array(output, pa.binary()).cast(pa.string())],
                names + outputs.names)

    return rows.mapInArrow(transform, T.StructType([*kept, *outputs]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made of."""
    def parts(o: Column, sentinel: str) -> tuple[Column, Column, Column]:
        body = F.substr(o, F.lit(len(PREFIX) + 1))
        rest = F.substring_index(body, sentinel, -1)
        return F.substring_index(body, sentinel, 1), F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)
    prefix, suffix, middle = parts(output, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(output, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(made: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256)``: the second checksum is of the text rebuilt from output and form."""
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
