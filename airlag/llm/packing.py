"""Packing token pieces into sequences of one length.

Shortest pack first over the histogram of lengths: lengths are placed from the
longest down, each into the packs that have the most room, and what is kept is
not packs but patterns (which lengths share a sequence) with the number of
sequences that have them. Pieces then find their pattern by their rank among
the pieces of their length.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airlag.llm.common import join_grown, materialize, strings, text_bytes
from airlag.llm.encode import SPLIT_BYTES, encoder
from airlag.session import arrow_batch_bytes

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, nth long"
#: Ids that one Arrow batch of pieces holds at most (a single piece may exceed it).
BATCH_IDS = 1 << 20


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    id_bytes: int = 4,
) -> DataFrame:
    """Tokenised documents, cut into pieces of at most ``capacity`` ids.

    A longer document becomes full pieces and one remainder. ``ids`` holds
    little-endian unsigned integers of ``id_bytes`` bytes. ``part`` and ``nth`` number the
    pieces of one length within the task that made them: with them a piece's
    rank among all pieces of its length needs only counts per task and length.
    Null text is empty and makes one piece, the end id; repeated rows are kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = strings(batch.column(1))
            ids, sizes = encode.encode(texts)
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype(f"<u{id_bytes}")
            sizes = sizes + 1
            pieces = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), pieces)
            order = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = order * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            nth = np.empty(len(owner), np.int64)
            by_length = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=capacity + 1)
            firsts = np.cumsum(counts) - counts
            nth[by_length] = np.arange(len(owner)) - firsts[length[by_length]] + seen[length[by_length]]
            seen += counts
            bounds = np.concatenate([[0], np.cumsum(length)]) * id_bytes
            spelled = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(owner), [None, pa.py_buffer(bounds), pa.py_buffer(ids.tobytes())]
            )
            columns = [
                batch.column(0).take(pa.array(owner)), pa.array(start), pa.array(length),
                pa.array(sizes[owner]), spelled, pa.array(np.full(len(owner), part, np.int32)),
                pa.array(nth),
            ]
            begin = 0
            while begin < len(owner):
                end = int(np.searchsorted(bounds, bounds[begin] + id_bytes * BATCH_IDS, "right")) - 1
                end = max(end, begin + 1)
                slices = [c.slice(begin, end - begin) for c in columns]
                slices[4] = slices[4].cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    slices, names=["doc_id", "start", "length", "doc_tokens", "ids", "part", "nth"]
                )
                begin = end

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, {length: times in each}) per pattern.

    The work and the result depend on the number of distinct lengths, at most
    ``capacity``, and not on the number of pieces.
    """
    # Room, a running number that keeps the order defined, count, pattern.
    open_packs: list[tuple[int, int, int, tuple[tuple[int, int], ...]]] = []
    done: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    made = 0

    def put(room: int, count: int, pattern: tuple[tuple[int, int], ...]) -> None:
        nonlocal made
        made += 1
        if room:
            heapq.heappush(open_packs, (-room, made, count, pattern))
        else:
            done.append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not open_packs or -open_packs[0][0] < length:
                each = capacity // length if not open_packs else 1
                # Without any open pack, as many to a pack as would follow anyway.
                packs, rest = divmod(left, each)
                if packs:
                    put(capacity - each * length, packs, ((length, each),))
                if rest:
                    put(capacity - rest * length, 1, ((length, rest),))
                break
            room, _, count, pattern = heapq.heappop(open_packs)
            room = -room
            used = min(count, left)
            if count > used:
                put(room, count - used, pattern)
            if pattern[-1][0] == length:
                longer = (*pattern[:-1], (length, pattern[-1][1] + 1))
            else:
                longer = (*pattern, (length, 1))
            put(room - length, used, longer)
            left -= used
    merged: Counter = Counter()
    for count, pattern in [*done, *((p[2], p[3]) for p in open_packs)]:
        merged[pattern] += count
    return [(count, dict(pattern)) for pattern, count in sorted(merged.items(), reverse=True)]


class Slots:
    """Where the r-th piece of a length goes. Of the size of the patterns."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]], spread: int = 1 << 40):
        self.spread = spread
        taken: Counter = Counter()
        rows, sequence = [], 0
        for count, pattern in patterns:
            offset = 0
            for length, times in pattern.items():
                rows.append((length * spread + taken[length], times, sequence, offset, length))
                taken[length] += count * times
                offset += times * length
            sequence += count
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.begin, self.times, self.sequence, self.offset, self.length = table.T

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of pieces given by length and rank."""
        key = length * self.spread + rank
        at = np.searchsorted(self.begin, key, "right") - 1
        nth, slot = np.divmod(key - self.begin[at], self.times[at])
        return self.sequence[at] + nth, self.offset[at] + slot * self.length[at]


def place_pieces(pieces: DataFrame, capacity: int = 4096, id_bytes: int = 4) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces.

    The table is read twice: once for counts per (task, length), which give
    the histogram and each piece's rank, once to place the pieces. Counts are
    summed before they move, and a length that a third of all pieces share is
    at most one row per task. Only the histogram, one row per length up to
    ``capacity``, reaches the driver. The counts per task grow with the input,
    so they are joined, not broadcast. An empty table stays empty. ``ids`` of
    two bytes come out as four.
    """
    spark = pieces.sparkSession
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = Slots(shortest_pack_first(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part")
    firsts = counts.withColumn(
        "first", F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    ).select("part", "length", F.coalesce("first", F.lit(0)).alias("first"))
    ranked = join_grown(pieces, firsts, ["part", "length"]).withColumn("rank", F.col("first") + F.col("nth"))
    shared = spark.sparkContext.broadcast(slots)
    kept = [c for c in pieces.columns if c not in ("part", "nth")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c) for c in kept}
            at = shared.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            if id_bytes == 2:
                columns["ids"] = _widened(columns["ids"])
            columns |= {"sequence_id": pa.array(at[0]), "offset": pa.array(at[1])}
            yield pa.RecordBatch.from_pydict(columns)

    schema = StructType([f for f in pieces.schema if f.name in kept])
    schema = schema.add("sequence_id", "long").add("offset", "long")
    return ranked.select(*kept, "rank").mapInArrow(place, schema)


def _widened(held: pa.Array) -> pa.Array:
    """Two-byte ids as four-byte ids."""
    held = held.cast(pa.large_binary())
    bounds, data = text_bytes(held)
    ids = np.frombuffer(data.tobytes(), "<u2").astype("<u4")
    buffers = [None, pa.py_buffer((2 * bounds).astype(np.int64)), pa.py_buffer(ids.tobytes())]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(held), buffers).cast(pa.binary())


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all documents, with their ids, sequence and offset.

    On the way, ids are stored and moved in two bytes where those of the
    tokenizer fit.
    """
    width = 2 if max(encoder(tokenizer).most(), end_id) < 1 << 16 else 4
    pieces = cut_pieces(docs, tokenizer, capacity, end_id, id_bytes=width)
    # Each task holds a batch of texts in the JVM and twice in Python.
    with arrow_batch_bytes(docs.sparkSession, SPLIT_BYTES):
        stored = materialize(pieces)
    return place_pieces(stored, capacity, width)
