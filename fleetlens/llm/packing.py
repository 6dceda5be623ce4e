"""Best-fit packing with certified bounds.

Documents' ids are cut into pieces of at most ``capacity``; pieces are packed
into sequences by best-fit decreasing, in groups of bounded size. For each
group dual feasible functions give a lower bound of its number of sequences: a
group that meets its bound is certified optimal and done. Of the others, all
sequences with room dissolve: neighbouring groups exchange their pieces (four
groups become one) and pack them again, keeping the result if it takes fewer
sequences. This repeats up to ``rounds`` times, so a task never holds more than
``group_size * 4**rounds`` pieces, however large the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import text_of, texts_of, vocabulary_path, written
from fleetlens.llm.encoding import ByteLevel, encoder

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END = 0
GROUP_SIZE = 8192
ROUNDS = 3
MERGED = 4


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the
    end id, cut so that all pieces but the first are full."""
    path = vocabulary or vocabulary_path(VOCABULARY)
    src = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ByteLevel, path)
        tail = np.array([end], dtype="<u4").tobytes()
        for b in batches:
            row, piece, starts, lengths, crcs = [], [], [], [], []
            all_ids = encode.encode(texts_of(b.column(1)))
            for r, ids in enumerate(all_ids):
                ids += tail
                n, start = len(ids) // 4, 0
                length = n if n <= capacity else n % capacity or capacity
                while start < n:
                    row.append(r)
                    piece.append(0 if start == 0 else piece[-1] + 1)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(ids[4 * start:4 * (start + length)]))
                    start, length = start + length, capacity
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs)]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, at least: the best of two families of
    dual feasible functions, rounded up.

    For e up to half the capacity: longer than capacity - e count whole,
    shorter than e not, others by length. For k: x (k + 1) / capacity rounded
    down, over k, where that is not whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    number = np.concatenate([[0], np.cumsum(count)])  # of lengths below i
    total = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    e = np.arange(capacity // 2 + 1)
    whole = number[-1] - number[capacity - e + 1]
    some = total[capacity - e + 1] - total[e]
    best = int((whole + -(-some // capacity)).max())
    x = np.arange(capacity + 1)
    for k in range(1, 64):
        scaled, rest = np.divmod(x * (k + 1), capacity)
        weight = np.where(rest == 0, x * k, scaled * capacity)  # over k * capacity
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins. Longest first, each
    into the fullest bin that it fits; a bit set tells which rooms exist."""
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            stack = with_room[room]
            b = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room, b, bins = capacity, bins, bins + 1
        place[i], offset[i] = b, capacity - room
        left = room - n
        if left:
            if not with_room[left]:
                rooms |= 1 << left
            with_room[left].append(b)
    return place, offset, bins


def _pack_round(state: DataFrame, number: int, capacity: int) -> DataFrame:
    """Packs each group anew; ``open`` marks what goes into another round."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")  # the same packing in a repeated task
        lengths = table["length"].to_numpy()
        group = table["group"][0].as_py()
        place, offset, bins = best_fit_decreasing(lengths, capacity)
        old = table["sequence_id"].to_numpy()
        if number and bins >= len(np.unique(old)):
            sequence, offset = old, table["offset"].to_numpy()
            _, place = np.unique(old, return_inverse=True)
            bins = int(place.max()) + 1
        else:
            sequence = (number << 58) + (group << 26) + place
        full = np.bincount(place, weights=lengths, minlength=bins) == capacity
        more = np.zeros(len(table), bool) if bins == lower_bound(lengths, capacity) else ~full[place]
        for name, values in (("sequence_id", sequence), ("offset", offset), ("open", more)):
            table = table.set_column(table.column_names.index(name), name, pa.array(values))
        return table

    return state.groupBy("group").applyInArrow(run, state.schema)


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           capacity: int = CAPACITY, end: int = END, group_size: int = GROUP_SIZE,
           rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (its place in the sequence, without gaps from 0).

    A null text is empty, one piece of the end id; repeated rows and rows
    without doc_id are documents of their own; an empty table packs to nothing.
    """
    cut = written(pieces(docs, doc_id, text, vocabulary, capacity, end)
                  .withColumn("item", F.monotonically_increasing_id()), "pieces")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = cut.filter(F.col("length") == capacity).select(
        *out[:5], (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_size))
    state = short.select(
        *out[:5], "item", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("group"),
        F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("open"))
    done = [whole]
    for number in range(rounds + 1):
        state = written(_pack_round(state, number, capacity), f"packed-{number}")
        if groups == 1 or number == rounds:
            done.append(state.select(*out))
            break
        done.append(state.filter("not open").select(*out))
        groups = -(-groups // MERGED)
        state = state.filter("open").withColumn("group", F.expr(f"group div {MERGED}"))
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    return result
