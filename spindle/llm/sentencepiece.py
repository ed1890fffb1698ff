"""SentencePiece encoding and decoding on a relational lattice.

Spaces become the piece mark, one goes before the text, and the best path is
the segmentation into pieces of the fixed public vocabulary with the largest
sum of scores; a character that is no piece costs the lowest score less ten
and is written as its UTF-8 bytes.

1.  Texts are cut where no piece can cross; the best path of a text is that
    of its units one after another.  Parts of the input keep their unit
    streams; their distinct units become rows.
2.  The distinct units of the whole table are encoded relationally: substrings of
    bounded length are exploded and equi-joined to the (broadcast, fixed-size)
    piece table, the edges grouped by unit, and a Viterbi pass folds them with
    the higher-order function ``aggregate``; a second fold walks back.
    Rows stay partitioned by unit from the first exchange on.
3.  The units' ids return to the parts that asked and are strung together.

Units longer than ``LONG`` characters (none of real words) take the same
Viterbi in a Python function, as the fold copies its state at each step.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import buckets, code_hashes, received, runs, shared, small_batches
from spindle.llm.pieces import MODEL_FILE, SPACE_MARK, Cutter, read_pieces
from spindle.session import shared_path

#: Longest unit that is encoded by the fold.
LONG = 64
#: Units of a partition whose edges are grouped in memory (above, Spark sorts them).
GROUPED_UNITS = 10_000
#: What an unknown character costs below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Bits of a unit's number within a part (a part has no more units than bytes, one long text aside).
PLACE_BITS = 32
#: Rows that reach a Python worker at once while streams are made.
BATCH_ROWS = 1000
#: Bytes of text that are cut into units at once.
BATCH_BYTES = 1 << 20
#: Answers that are packed together.
PACKED = 500_000
#: Bytes of text of a part of the input (a longer text is a part of its own).
PART_BYTES = 16 << 20
_MARK = SPACE_MARK.encode("utf-8")


def _units_of(cutter: Cutter, texts: list[str]):
    """``(units of each text, number of each unit, distinct units)``."""
    marked = [SPACE_MARK + t.replace(" ", SPACE_MARK) if t else "" for t in texts]
    size = np.fromiter((len(m) for m in marked), np.int64, len(marked))
    whole = "".join(marked)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum(size) - size
    start = cutter.units(codes, first[size > 0])
    counts = np.searchsorted(start, first + size) - np.searchsorted(start, first)
    end = np.append(start[1:], len(codes))
    _, at, number = np.unique(code_hashes(codes, start, end), return_index=True, return_inverse=True)
    return counts, number, [whole[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]


def _pack_numbers(x: np.ndarray) -> bytes:
    """Numbers as bytes; 255 stands for one of the rest, four bytes each."""
    low = np.minimum(x, 255).astype(np.uint8)
    rest = np.ascontiguousarray(x[x >= 255].astype("<u4").view(np.uint8).reshape(-1, 4).T)
    press = zstandard.ZstdCompressor(level=3).compress
    first = press(low.tobytes())
    return len(first).to_bytes(8, "little") + first + press(rest.tobytes())


def _unpack_numbers(b: bytes) -> np.ndarray:
    size, plain = int.from_bytes(b[:8], "little"), zstandard.ZstdDecompressor().decompress
    out = np.frombuffer(plain(b[8:8 + size]), np.uint8).astype(np.int64)
    raw = np.frombuffer(plain(b[8 + size:]), np.uint8).reshape(4, -1)
    rest = np.zeros((raw.shape[1], 4), np.uint8)
    rest[:] = raw.T
    out[out == 255] = rest.reshape(-1).view("<u4")
    return out


def _streams(cutter):
    def run(batches):
        cut, part, seq = received(cutter), TaskContext.get().partitionId(), 0
        held: list = []
        known: dict[str, int] = {}
        bytes_held = 0

        def row():
            times = np.zeros(len(known), np.int64)
            for h in held:
                times += np.bincount(h[2], minlength=len(known))
            rank = np.empty(len(known), np.uint32)
            order = np.argsort(-times, kind="stable")           # frequent units get small numbers
            rank[order] = np.arange(len(known), dtype=np.uint32)
            units = list(known)
            return pa.RecordBatch.from_pylist([{
                "chunk": (part << 15) | seq, "doc_id": [i for h in held for i in h[0]],
                "n": np.concatenate([h[1] for h in held]).astype(np.int32).tobytes(),
                "stream": _pack_numbers(np.concatenate([rank[h[2]] for h in held])), "units": [units[i] for i in order]}],
                schema=pa.schema([("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n", pa.binary()),
                                  ("stream", pa.binary()), ("units", pa.list_(pa.string()))]))

        for batch in small_batches(batches, size=BATCH_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts, number, units = _units_of(cut, texts)
            at = np.fromiter((known.setdefault(u, len(known)) for u in units), np.int64, len(units))
            held.append((batch.column("doc_id").cast(pa.int64()).to_pylist(), counts,
                         at[number].astype(np.int32) if len(number) else np.zeros(0, np.int32)))
            bytes_held += sum(map(len, texts))
            if bytes_held >= PART_BYTES:
                yield row()
                pa.default_memory_pool().release_unused()
                seq, held, known, bytes_held = seq + 1, [], {}, 0
        if held:
            yield row()
        held, known = [], {}
        pa.default_memory_pool().release_unused()
    return run, "chunk long, doc_id array<long>, n binary, stream binary, units array<string>"


def encode_units(units: DataFrame, pieces: DataFrame, longest: int, lowest: float) -> DataFrame:
    """``(unit, ids)`` of distinct units by explode, equi-join, grouping and
    folds; ``pieces (piece, id, score)``.  Id -1 marks an unknown character."""
    n = F.length("unit")
    start = units.select("unit", F.explode(F.sequence(F.lit(1), n)).alias("s"))
    subs = start.select("unit", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("s") + 1))).alias("k"))
    subs = subs.withColumn("piece", F.substring("unit", F.col("s"), F.col("k")))
    found = subs.join(F.broadcast(pieces), "piece", "left").filter("id is not null or k = 1")
    edge = F.struct((F.col("s") + F.col("k") - 1).alias("e"), (F.col("s") - 1).alias("s"), F.coalesce("id", F.lit(-1)).alias("id"),
                    F.coalesce("score", F.lit(lowest - UNKNOWN_PENALTY)).alias("w"))
    grouped = found.groupBy("unit").agg(F.collect_list(edge).alias("edges"))

    def reach(best, e):
        ways = F.transform(F.filter("edges", lambda x: x["e"] == e), lambda x: F.struct(
            (F.element_at(best, x["s"] + 1)["w"] + x["w"]).alias("w"), (-x["s"]).alias("s"), x["id"].alias("id")))
        return F.concat(best, F.array(F.array_max(ways)))

    origin = F.array(F.struct(F.lit(0.0).alias("w"), F.lit(0).alias("s"), F.lit(-2).alias("id")))
    best = grouped.select("unit", F.aggregate(F.sequence(F.lit(1), n), origin, reach).alias("best"))
    back = F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("at"), F.array().cast("array<int>").alias("ids")),
                       lambda a, _: F.when(a["at"] == 0, a).otherwise(F.struct(
                           (-F.element_at("best", a["at"] + 1)["s"]).alias("at"),
                           F.concat(F.array(F.element_at("best", a["at"] + 1)["id"]), a["ids"]).alias("ids"))))
    return best.select("unit", back["ids"].alias("ids"))


def viterbi(unit: str, pieces: dict[str, tuple[int, float]], longest: int, lowest: float) -> list[int]:
    """The fold's result for one unit; ties, as there, to the longer last piece."""
    best: list[tuple[float, int, int]] = [(0.0, 0, -2)]
    for e in range(1, len(unit) + 1):
        ways = []
        for s in range(max(0, e - longest), e):
            hit = pieces.get(unit[s:e])
            if hit or s == e - 1:
                i, w = hit or (-1, lowest - UNKNOWN_PENALTY)
                ways.append((best[s][0] + w, -s, i))
        best.append(max(ways))
    ids, at = [], len(unit)
    while at:
        _, s, i = best[at]
        ids.append(i)
        at = -s
    return ids[::-1]


def _with_bytes(unit: str, ids: list[int], names: dict[int, str], byte: dict[int, int]) -> list[int]:
    """Unknown characters as their UTF-8 bytes."""
    out, at = [], 0
    for i in ids:
        if i < 0:
            out += [byte[b] for b in unit[at].encode("utf-8", "surrogatepass")]
            at += 1
        else:
            out.append(i)
            at += len(names[i])
    return out


_ANSWERS = "chunk long, pos binary, size binary, flat binary, rare_at binary, rare array<string>"


def _packed_answers(batches):
    """(ids, rare, place) -> one row for each part among every ``PACKED`` rows."""
    def rows():
        place = np.concatenate([np.asarray(b.column("place")) for b in held])
        lists = pa.concat_arrays([b.column("ids") for b in held])
        rare = pa.concat_arrays([b.column("rare") for b in held])
        order = np.argsort(place, kind="stable")
        place, lists, rare = place[order], lists.take(pa.array(order)), rare.take(pa.array(order))
        size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        flat, end, odd = np.asarray(lists.flatten()).astype(np.int64), np.cumsum(size), np.asarray(rare.is_valid())
        at, n = runs(place >> PLACE_BITS)
        out = []
        for a, k in zip(at.tolist(), n.tolist()):
            strange = np.flatnonzero(odd[a:a + k])
            out.append({"chunk": int(place[a]) >> PLACE_BITS,
                        "pos": _pack_numbers(np.diff(place[a:a + k] & ((1 << PLACE_BITS) - 1), prepend=0)),
                        "size": _pack_numbers(size[a:a + k]),
                        "flat": _pack_numbers(flat[end[a] - size[a]:end[a + k - 1]] + 1),
                        "rare_at": _pack_numbers(strange), "rare": rare.take(pa.array(a + strange)).to_pylist()})
        return pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("chunk", pa.int64()), *((c, pa.binary()) for c in ("pos", "size", "flat", "rare_at")), ("rare", pa.list_(pa.string()))]))

    held: list = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= PACKED:
            yield rows()
            held = []
    if held:
        yield rows()


def _assembled(table):
    """A part's stream + the packed ids of its units -> ids of each text;
    ``rare`` units are long or have unknown characters."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces, longest, lowest, byte = received(table)
        names = {i: p for p, (i, _) in pieces.items()}
        spots, sizes, flats, fixes, at = [], [], [], [], 0
        for row in right.to_pylist():
            spots.append(np.cumsum(_unpack_numbers(row["pos"])))
            sizes.append(_unpack_numbers(row["size"]))
            flats.append((_unpack_numbers(row["flat"]) - 1).astype(np.int32))
            fixes += [(at + k, unit) for k, unit in zip(_unpack_numbers(row["rare_at"]).tolist(), row["rare"])]
            at += len(spots[-1])
        none = [np.zeros(0, np.int64)]
        spot, size = np.concatenate(spots or none), np.concatenate(sizes or none)
        flat = np.concatenate(flats or [np.zeros(0, np.int32)])
        begin, more, at, out = np.cumsum(size) - size, [flat], len(flat), []
        for k, unit in fixes:
            ids = flat[begin[k]:begin[k] + size[k]].tolist()
            ids = _with_bytes(unit, ids or viterbi(unit, pieces, longest, lowest), names, byte)
            more.append(np.asarray(ids, np.int32))
            begin[k], size[k], at = at, len(ids), at + len(ids)
        flat = np.concatenate(more)
        by_spot = np.argsort(spot, kind="stable")
        begin, size = begin[by_spot], size[by_spot]
        for row in left.to_pylist():
            stream, n = _unpack_numbers(row["stream"]), np.frombuffer(row["n"], np.int32).astype(np.int64)
            end, first = np.cumsum(n), 0
            while first < len(n):                        # some texts at a time, so that memory stays bounded
                done = end[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(end, done + 200_000, "right")))
                units = stream[done:end[last - 1]]
                k = size[units]
                where = np.repeat(begin[units] - (np.cumsum(k) - k), k) + np.arange(k.sum())
                text = np.repeat(np.arange(last - first), n[first:last])
                total = np.bincount(text, weights=k, minlength=last - first).astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(total)]).astype(np.int32)
                out.append(pa.table({"doc_id": pa.array(row["doc_id"][first:last], pa.int64()),
                                     "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[where].astype(np.int32)))}))
                first = last
        return pa.concat_tables(out)
    return run


def _bucketed(df: DataFrame, key: str, parts: int) -> DataFrame:
    """``df`` as a table in the shared folder, cut by ``key`` as a shuffle
    would, so that later groupings by it need none."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, "pieces-streams")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.option("compression", "zstd").bucketBy(parts, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def encode(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs (doc_id, text)``.

    Sets the session's limit of keys that collect_list groups without a sort.
    NULL and empty texts have no ids.  Of equal sums the one
    with the longer last piece wins, from the end of each unit backwards.  Repeated rows are encoded one by one; other columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(GROUPED_UNITS))
    normal, byte = read_pieces(model_file)
    longest, lowest = max(len(p) for _, p, _ in normal), min(s for _, _, s in normal)
    pieces = spark.createDataFrame([(p, i, s) for i, p, s in normal], "piece string, id int, score double")
    run, schema = _streams(shared(spark, Cutter([p for _, p, _ in normal])))
    rows, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(rows, str(BATCH_ROWS))
    try:
        streams = _bucketed(docs.select("doc_id", "text").mapInArrow(run, schema), "chunk", buckets(spark))
    finally:
        spark.conf.set(rows, before)
    asked = streams.select("chunk", F.posexplode("units").alias("pos", "unit")).filter("unit is not null")
    # one exchange by unit: the lattice and the list of who asked both start from it
    place = F.shiftleft("chunk", PLACE_BITS) + F.col("pos")
    asked = asked.select("unit", place.alias("place")).repartition(8 * buckets(spark), "unit")
    asked = asked.groupBy("unit").agg(F.collect_list("place").alias("at"))
    # (conditions on "at", so that they stay above the exchange, which is then reused)
    size = F.when(F.size("at") > 0, F.length("unit"))
    short = encode_units(asked.filter(size <= LONG).select("unit"), pieces, longest, lowest)
    answers = (asked.filter(size > 0).join(short.withColumnRenamed("unit", "_unit"), F.col("unit") == F.col("_unit"), "left")
               .select("ids", F.when(F.col("ids").isNull() | F.array_contains("ids", -1), F.col("unit")).alias("rare"),
                       F.explode("at").alias("place")).mapInArrow(_packed_answers, _ANSWERS))
    table = shared(spark, ({p: (i, s) for i, p, s in normal}, longest, lowest, byte))
    streams = streams.select(F.col("chunk").alias("part"), "doc_id", "n", "stream")
    return streams.groupBy("part").cogroup(answers.groupBy("chunk")).applyInArrow(
        _assembled(table), "doc_id long, ids array<int>")


def _byte_table(model_file: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all pieces one after another; first byte and length of each id (-1: no such id)."""
    normal, byte = read_pieces(model_file)
    names = {i: p.encode("utf-8") for i, p, _ in normal} | {i: bytes([b]) for b, i in byte.items()}
    size = np.full(max(names) + 1, -1, np.int64)
    size[list(names)] = [len(x) for x in names.values()]
    order = sorted(names)
    first = np.zeros(len(size), np.int64)
    first[order] = np.cumsum(size[order]) - size[order]
    return np.frombuffer(b"".join(names[i] for i in order), np.uint8), first, size


def _decoded(table, lists: pa.Array):
    """The UTF-8 bytes of the text that each list of ids stands for."""
    data, first, size = table
    counts = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    ids, end, row = np.asarray(lists.flatten()), np.cumsum(counts), 0
    while row < len(counts):                             # some texts at a time, so that memory stays bounded
        done = end[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(end, done + 200_000, "right")))
        some = ids[done:end[last - 1]]
        k = size[some]
        if len(k) and k.min() < 0:
            raise ValueError("an id that is not in the vocabulary")
        raw = data[np.repeat(first[some] - (np.cumsum(k) - k), k) + np.arange(k.sum())].tobytes()
        cut = np.concatenate([[0], np.cumsum(k)])[np.concatenate([[done], end[row:last]]) - done].tolist()
        for a, b in zip(cut, cut[1:]):
            text = raw[a:b].replace(_MARK, b" ")
            yield text[1:] if text.startswith(b" ") else text
        row = last


def decode(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """``(doc_id, text)`` of ``encoded (doc_id, ids)``; NULL and no ids give
    an empty text, so that a NULL text comes back empty.  The vocabulary's
    space mark U+2581 stands for a space: where a text holds it itself, a
    space comes back.  Every other text comes back as it was.  Repeated rows
    are decoded one by one, other columns ignored; an empty table gives no rows."""
    share = shared(encoded.sparkSession, _byte_table(model_file))

    def run(batches):
        table = received(share)
        for batch in batches:
            texts = pa.array(list(_decoded(table, batch.column("ids"))), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts.cast(pa.string())], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """``(doc_id, n_pieces, ids_hash, text_crc32, text_bytes)``: the hash is
    over the ids in order; CRC-32 and length are those of the UTF-8 bytes of
    the text that the ids are decoded to, by the same pass as ``decode``."""
    share = shared(encoded.sparkSession, _byte_table(model_file))

    def run(batches):
        table = received(share)
        for batch in batches:
            sums = [(zlib.crc32(t), len(t)) for t in _decoded(table, batch.column("ids"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_pieces", "ids_hash")),
                 *(pa.array([x[k] for x in sums], pa.int64()) for k in (0, 1))],
                names=["doc_id", "n_pieces", "ids_hash", "text_crc32", "text_bytes"])
    hashed = encoded.select("doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "ids")
    return hashed.mapInArrow(run, "doc_id long, n_pieces int, ids_hash long, text_crc32 long, text_bytes long")
