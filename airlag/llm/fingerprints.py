"""One-permutation MinHash fingerprints of documents.

Every five-word shingle of a text is hashed once; the top bits of the hash name
one of ``BINS`` bins, and each bin keeps its smallest hash. An empty bin copies
the value of the first non-empty bin in its own random order of bins (optimal
densification). A fingerprint packs the low ``BITS`` bits of every bin; equal
bits of two fingerprints estimate their Jaccard similarity once the chance of
equal bits by accident is taken out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import balanced, partitions, strings, text_bytes

BINS, BITS, WORDS = 512, 4, 5
#: Bytes of text, and texts, that are hashed at once.
CHUNK_BYTES, CHUNK_ROWS = 2 << 20, 512
#: Bytes, and shingles, of one long text that are worked on at once.
BLOCK_BYTES, BLOCK_SHINGLES = 4 << 20, 1 << 20
#: Characters of a text that order rows of one id before their hash does.
HEAD = 16

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BLANK = np.isin(np.arange(256), [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20])
_SPREAD = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(256)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text); words are parted by ASCII white
    space. Texts are hashed in blocks of bytes; a word that a block cuts goes on
    in the next with its sum and place, so 8 bytes a word are held, not what
    hashing takes for each byte."""
    bounds, data = text_bytes(texts)
    sums, heads = [], []
    open_length = 0
    for begin in range(0, len(data), BLOCK_BYTES):
        part = data[begin : begin + BLOCK_BYTES]
        fresh = np.zeros(len(part), bool)
        low, high = np.searchsorted(bounds, [begin, begin + len(part)])
        fresh[bounds[low:high] - begin] = True
        solid = ~_BLANK[part]
        at = solid.copy()
        at[1:] &= ~solid[:-1] | fresh[1:]
        at = np.flatnonzero(at)
        goes_on = bool(open_length and solid[0] and not fresh[0])
        if len(at):
            spans = np.diff(at, append=len(part))
            place = np.arange(len(part)) - np.concatenate([np.arange(at[0]), np.repeat(at, spans)])
            if goes_on:
                place[: spans[0]] += open_length
            # Stretches of a long word differ by their number, so no place is used twice.
            spread = _SPREAD[place & 255] + (place >> 8).astype(np.uint64) * _M2
            mixed = np.where(solid, mix(part.astype(np.uint64) + spread), np.uint64(0))
            found = np.add.reduceat(mixed, at)
            open_length = int(place[-1]) + 1 if solid[-1] else 0
            if goes_on:
                sums[-1][-1:] += found[:1]
                found, at = found[1:], at[1:]
            if len(at):
                sums.append(found)
                heads.append(at + begin)
        else:
            open_length = 0
    hashes = mix(np.concatenate(sums)) if sums else np.empty(0, np.uint64)
    starts = np.concatenate(heads) if heads else np.empty(0, np.int64)
    return hashes, np.diff(np.searchsorted(starts, bounds))


def shingle_hashes(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, shingles per text). A text with fewer words than
    a shingle, but not none, is one shingle."""
    hashes, counts = word_hashes(texts)
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    ends, shift = np.cumsum(sizes), np.cumsum(counts) - counts - (np.cumsum(sizes) - sizes)
    stops = np.cumsum(counts)
    total = np.zeros(int(sizes.sum()), np.uint64)
    for low in range(0, len(total), BLOCK_SHINGLES):
        place = np.arange(low, min(low + BLOCK_SHINGLES, len(total)))
        owner = np.searchsorted(ends, place, "right")
        at, last = place + shift[owner], stops[owner]
        for k in range(words):
            value = hashes[np.minimum(at + k, len(hashes) - 1)]
            total[place] += np.where(at + k < last, mix(value + _SPREAD[k]), np.uint64(0))
        total[place] = mix(total[place])
    return total, sizes


def _probe_orders(bins: int) -> np.ndarray:
    """For each bin its own random order of all bins, the same everywhere."""
    return np.random.default_rng(20170807).permuted(
        np.tile(np.arange(bins, dtype=np.int32), (bins, 1)), axis=1
    )


_ORDERS: dict[int, np.ndarray] = {}


def densify(least: np.ndarray) -> np.ndarray:
    """Fills empty bins (all ones) of rows that have any bin."""
    bins = least.shape[1]
    if bins not in _ORDERS:
        _ORDERS[bins] = _probe_orders(bins)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    filled = least.copy()
    row, column = np.nonzero((least == empty) & (least != empty).any(axis=1, keepdims=True))
    for step in range(bins):
        if not len(row):
            break
        found = least[row, _ORDERS[bins][column, step]]
        hit = found != empty
        filled[row[hit], column[hit]] = found[hit]
        row, column = row[~hit], column[~hit]
    return filled


def pack_bits(least: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Low bits of every bin, packed into bytes."""
    low = (least & np.uint64((1 << bits) - 1)).astype(np.uint8)
    planes = (low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    return np.packbits(planes.reshape(len(low), -1), axis=1)


def sketch(texts: pa.Array, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Packed fingerprints of a large-string column; a row of bytes per text.
    Texts without words have all bits set."""
    out = []
    for part in balanced(texts, CHUNK_BYTES):
        for begin in range(part.start, part.stop, CHUNK_ROWS):
            some = texts[begin : min(begin + CHUNK_ROWS, part.stop)]
            hashes, sizes = shingle_hashes(some)
            least = np.full(len(some) * bins, 0xFFFFFFFFFFFFFFFF, np.uint64)
            shift = np.uint64(64 - (bins.bit_length() - 1))
            ends = np.cumsum(sizes)
            for low in range(0, len(hashes), BLOCK_SHINGLES):
                block = hashes[low : low + BLOCK_SHINGLES]
                owner = np.searchsorted(ends, np.arange(low, low + len(block)), "right")
                np.minimum.at(least, owner * bins + (block >> shift).astype(np.int64), block)
            out.append(pack_bits(densify(least.reshape(len(some), bins)), bits))
    return np.concatenate(out) if out else np.empty((0, bins * bits // 8), np.uint8)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of packed fingerprints, row by row.

    Two bins agree by chance with probability 2^-bits; that is taken out, and
    what is left is kept within 0 and 1.
    """
    planes = np.unpackbits(a ^ b, axis=1).reshape(len(a), -1, bits)
    share = 1 - planes.any(axis=2).mean(axis=1) if len(a) else np.empty(0)
    chance = 2.0**-bits
    return np.clip((share - chance) / (1 - chance), 0.0, 1.0)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``doc_id, fingerprint`` (binary) per row; a map without a shuffle. Null
    text is empty; texts without words share one fingerprint."""
    kept = keep or []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *kept)
    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    names = ["doc_id", "fingerprint", *kept]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [x.tobytes() for x in sketch(strings(batch.column(1)))]
            columns = [batch.column(0), pa.array(made, pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [kinds[0], "binary", *kinds[2:]]
    return rows.mapInArrow(make, ", ".join(f"`{n}` {t}" for n, t in zip(names, fields, strict=True)))


def with_follower(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in ranges of ascending id, each range closed by its follower.

    Returns ``doc_id, text, range_no, follower``: every document in its range,
    and once more, marked ``follower``, the first document of the next range
    (after the last range: the first of all). Within a range rows are ordered
    as ``in_order`` says. So a task that walks a range sees every document's
    next one. Ranges come from a pass over ids, heads and hashes of texts; texts
    are shuffled once. Ranges end between rows of one id, too, so an id that
    very many texts share is cut; only rows that repeat id and text stay in one
    range. Rows with a null id come before all others.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    keys = rows.select("doc_id", F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("hash"))
    dealt = keys.repartitionByRange(partitions(spark), "doc_id", "head", "hash")
    low = F.min(F.struct("doc_id", "head", "hash")).alias("low")
    # One short row per range.
    lows = dealt.groupBy(F.spark_partition_id().alias("p")).agg(low).select("low.*").orderBy("doc_id", "head", "hash")
    found = [tuple(r) for r in lows.collect()]
    schema = "array<struct<doc_id: bigint, head: string, hash: bigint>>"
    listed = json.dumps([dict(zip(("doc_id", "head", "hash"), r, strict=True)) for r in found])
    begins_at = F.from_json(F.lit(listed), schema)
    key = F.struct("doc_id", F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("hash"))
    # How many ranges begin at or before a row, by halving.
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(max(len(found), 1).bit_length()))])
    passed = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(begins_at, at + step - 1) <= key, step).otherwise(0)
    )
    range_no = F.greatest(passed - 1, F.lit(0)).alias("range_no")
    ranged = rows.select("doc_id", "text", range_no)
    # Only rows with an id that begins a range are looked at more closely.
    ids = [r[0] for r in found if r[0] is not None]
    maybe = rows.where(F.col("doc_id").isNull() | F.col("doc_id").isin(ids)).select("doc_id", "text", range_no)
    starts = maybe.where(key.eqNullSafe(F.get(begins_at, F.col("range_no"))))
    begins = starts.groupBy("range_no").agg(F.min(F.struct("doc_id", "text")).alias("low"))
    before = F.when(F.col("range_no") == 0, len(found) - 1).otherwise(F.col("range_no") - 1)
    closing = begins.select("low.doc_id", "low.text", before.alias("range_no"), F.lit(True).alias("follower"))
    return ranged.withColumn("follower", F.lit(False)).unionByName(closing)


def in_order() -> list[Column]:
    """Rows by ascending id; those of one id by the head of their text, then by
    its hash."""
    return [F.col("doc_id"), F.substring("text", 1, HEAD), F.xxhash64("text"), F.col("text")]


PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last half (rounded down, in code points) replaced
    by as much of the beginning of the next document. Texts are walked a batch
    at a time, one row carried over; nothing else is held.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0), strings(batch.column(1))
            follower = batch.column(3).to_numpy(zero_copy_only=False)
            if carry is not None:
                ids = pa.concat_arrays([carry[0], ids])
                texts = pa.concat_arrays([carry[1], texts])
                follower = np.concatenate([carry[2], follower])
            carry = ids[-1:], texts[-1:], follower[-1:]
            for part in balanced(texts, CHUNK_BYTES):
                # With the row after the last, the next of the last.
                some = slice(part.start, min(part.stop + 1, len(texts)))
                yield from _pairs(ids[some], texts[some], follower[some])

    ranged = with_follower(docs, id_col, text_col)
    # Ranges are numbered from 0, below the number of partitions.
    dealt = ranged.repartitionById(partitions(docs.sparkSession), F.col("range_no"))
    ordered = dealt.sortWithinPartitions("range_no", "follower", *in_order())
    return ordered.mapInArrow(walk, PAIRS)


def _pairs(ids: pa.Array, texts: pa.Array, follower: np.ndarray) -> Iterator[pa.RecordBatch]:
    own = np.flatnonzero(~follower[:-1])
    if not len(own):
        return
    spelled = texts.to_numpy(zero_copy_only=False)
    edited = []
    for i in own.tolist():
        text, half = spelled[i], len(spelled[i]) // 2
        edited.append(text[: len(text) - half] + spelled[i + 1][:half])
    marks = sketch(texts)
    changed = sketch(pa.array(edited, pa.large_string()))
    yield pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(own)),
            pa.array([len(spelled[i]) for i in own.tolist()], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array([x.tobytes() for x in marks[own]], pa.binary()),
            pa.array([x.tobytes() for x in changed], pa.binary()),
            pa.array(likeness(marks[own], changed)),
            pa.array(likeness(marks[own], marks[own + 1])),
        ],
        names=[c.split()[0] for c in PAIRS.split(", ")],
    )
