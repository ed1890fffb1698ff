"""Helpers shared by the operators of this package: table access, written
intermediate tables, vectorised word hashing and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.session import shared_path

#: Bytes of text that are tokenised at once (a single longer text is taken whole).
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch that carries texts to Python.
BATCH_BYTES = 8 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1                                     # so that a NUL byte counts
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ["*"]))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared checkpoint folder."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove written tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hash_mod(column: str, n: int):
    """crc32 of the column's text, modulo ``n`` (NULL counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def buckets(spark) -> int:
    """Key ranges that an exchange is cut into: one for each shuffle partition."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = []
        for base in (_BASE, _BASE_INV):
            p = np.full(1 << (n - 1).bit_length(), np.uint64(base))
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def bounded_batches(spark) -> None:
    """Hold the session's Arrow batches to ``BATCH_BYTES`` (rows alone don't
    bound a batch of long texts).  Batches never change a result."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_slices(column: pa.Array, size: int = SLICE_BYTES):
    """``(first row, bytes, starts, ends)`` for runs of rows of a string
    column; NULL is an empty text.  Starts and ends index the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        cut = offsets[row:last + 1]
        yield row, data[cut[0]:cut[-1]], cut[:-1] - cut[0], cut[1:] - cut[0]
        row = last


def small_batches(batches, column: str = "text", size: int = 4 * SLICE_BYTES):
    """The same rows in batches of about ``size`` bytes of text at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        end = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
        row = 0
        while row < batch.num_rows:
            before = end[row - 1] if row else 0
            last = max(row + 1, int(np.searchsorted(end, before + size, "right")))
            yield batch.slice(row, last - row)
            row = last


def words_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """``(word start, word end, words of each row)``: runs of bytes other
    than space and \\t..\\r, never across rows."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts] = True
    edge[n] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:n]
    finish = word.copy()
    finish[:-1] &= ~word[1:] | edge[1:n]
    begin = np.flatnonzero(begin)
    finish = np.flatnonzero(finish) + 1
    return begin, finish, np.searchsorted(begin, ends) - np.searchsorted(begin, starts)


def span_hasher(data: np.ndarray):
    """``(begin, finish) -> 64-bit hashes`` of byte spans with A-Z read as a-z."""
    n = len(data)
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * power[:n], out=total[1:])

    def hashes(begin: np.ndarray, finish: np.ndarray) -> np.ndarray:
        h = (total[finish] - total[begin]) * inverse[begin]
        return mix64(h + (finish - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes


def span_hashes(data: np.ndarray, begin: np.ndarray, finish: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans with A-Z read as a-z."""
    return span_hasher(data)(begin, finish)


def code_hashes(codes: np.ndarray, begin: np.ndarray, finish: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of code points, as they are."""
    n = len(codes)
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    h = (total[finish] - total[begin]) * inverse[begin]
    return mix64(h + (finish - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a column in row order and the word count of each row."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, data, starts, ends in text_slices(column):
        begin, finish, each = words_of(data, starts, ends)
        hashes.append(span_hashes(data, begin, finish))
        counts.append(each)
    return np.concatenate(hashes), np.concatenate(counts)


def shared(spark, value):
    """Broadcast ``value`` pickled by value (tasks need not import this package)."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast):
    return cloudpickle.loads(broadcast.value)


def key_bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Range of a 64-bit key among ``n`` equal ranges (ascending with the key)."""
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in a sorted array."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, np.diff(np.append(first, len(values)))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, label)`` for the ids of ``edges (a, b)``: the smallest id that
    is reachable.  Minimum labels travel along edges and labels are followed
    one step further in each round, so the rounds grow with the logarithm of
    the longest path; each round's labels are a written table."""
    pairs = edges.select(F.col("a"), F.col("b")).unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = written(pairs, f"{name}-pairs")
    labels = written(pairs.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.col("id")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = (pairs.join(labels, pairs.b == labels.id).groupBy(F.col("a").alias("id"))
                .agg(F.min("label").alias("near")))
        moved = labels.join(near, "id").select("id", F.col("label").alias("old"),
                                               F.least("label", "near").alias("label"))
        parent = labels.select(F.col("id").alias("label"), F.col("label").alias("up"))
        moved = moved.join(parent, "label", "left").select(
            "id", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        moved = written(moved, f"{name}-{step}")
        if not moved.filter("label <> old").limit(1).count():
            return moved.select("id", "label")
        labels = moved.select("id", "label")
