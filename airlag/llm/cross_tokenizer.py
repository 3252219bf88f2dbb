"""Aligns the tokens of two tokenizers over the same bytes.

Each side's tokens are given by the byte offsets where they end. Where the two
end arrays agree at the current shift between their indices, an exponential
probe finds how long they agree: a stretch of one-to-one groups, jumped over at
once. Where they do not, the irregular group is walked token by token until
both sides end at one place, and the shift is the new difference of indices.
Token occurrences whose byte ranges overlap are links; the corpus-wide count of
an id pair is how many links hold it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import balanced, materialize, strings, text_bytes
from airlag.llm.encode import Encoder

#: Bytes of text that are aligned at a time, parts that each encoder keeps,
#: tokens that are listed, groups that are spelled at a time, and id pairs that
#: a task sums before it passes them on.
CHUNK_BYTES, KEEP, LISTED, SPELL_GROUPS, SUM_PAIRS = 2 << 20, 600_000, 1 << 20, 1 << 18, 1 << 21
#: The id pairs of highest count, which every task has; all others are joined.
HEAD_PAIRS = 1 << 18

_ID_BITS = 32
ALIGNED = (
    "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
)


class PieceEncoder(Encoder):
    """The same table of known parts before a sentencepiece model.

    Texts come with the space that the model puts before them. No piece holds a
    space after another character, so a text may be cut before spaces, and none
    holds a line break, so before these as well; for a model that has such
    pieces, or changes texts before it splits them, whole texts are encoded. (A
    text with the mark U+2581 of its own is spelled by no ids, however it is cut.)
    """

    def __init__(self, path: str, keep: int | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = spec.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules = model.normalizer_spec
        pieces = [p.piece for p in model.pieces]
        plain = rules.add_dummy_prefix and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
        self.whole = not plain or any(re.search("[^▁]▁|\n", p) for p in pieces) or "▁" not in pieces
        if model.trainer_spec.model_type == model.trainer_spec.BPE and not self.whole:
            self.starts = np.array([p.startswith("▁") for p in pieces])
        self.space = self.library.piece_to_id("▁")
        self.keep = keep
        self._forget()

    def _call(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, each with its leading space (or line break, before
        which the model's own space is taken off again)."""
        found = self.library.encode([t.removeprefix(" ") for t in texts], num_threads=1)
        ids = [np.array(x, np.uint32) for x in found]
        for i, text in enumerate(texts):
            if text == " ":
                ids[i] = np.array([self.space], np.uint32)
            elif text.startswith("\n"):
                ids[i] = ids[i][1:]
        return ids

    def cuts(self, data: np.ndarray) -> np.ndarray:
        space, line = data == 0x20, data == 0x0A
        return np.flatnonzero(space[1:] & ~space[:-1] | line[1:]) + 1


class Side:
    """An encoder and the bytes of each of its ids."""

    def __init__(self, encoder: Encoder, spelled: dict[int, bytes]):
        self.encoder = encoder
        self.bytes = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(self.bytes), np.uint8)
        # Each id in decimal digits with a mark after it, in bytes of one width.
        self.after = {mark: np.array([f"{i}{mark}".encode() for i in range(len(self.bytes))]) for mark in ",|;"}

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, joined."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        return self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[ids] - ends + size, size)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printing characters for themselves, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@cache
def byte_side(path: str) -> Side:
    encoder = Encoder(path, plain=True, keep=KEEP)
    letters = byte_alphabet()
    spelled = {
        i: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else b""
        for entry, i in encoder.library.get_vocab().items()
    }
    return Side(encoder, spelled)


@cache
def piece_side(path: str) -> Side:
    encoder = PieceEncoder(path, keep=KEEP)
    model = encoder.library
    spelled = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = model.is_byte(i)
        spelled[i] = bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()
    return Side(encoder, spelled)


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of a per group, tokens of b per group) of two int32 arrays of end
    offsets with the same last value."""
    # Lists are read faster; of very long texts they would be large.
    ends_a, ends_b = (x.tolist() if len(x) < LISTED else memoryview(x) for x in (a, b))
    raw_a, raw_b = a.tobytes(), b.tobytes()
    n, m = len(a), len(b)
    # Where stretches and irregular groups begin, and the groups of each.
    begins: list[int] = []
    i = j = 0
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            # How many ends from here agree at this shift: at least ``low``.
            low, step = 1, 1
            most = n - i if n - i < m - j else m - j
            while low < most:
                high = low + step
                if high > most:
                    high = most
                if step == 1:
                    same = ends_a[i + low] == ends_b[j + low]
                else:
                    same = raw_a[4 * (i + low) : 4 * (i + high)] == raw_b[4 * (j + low) : 4 * (j + high)]
                if not same:
                    while high - low > 1:
                        middle = (low + high) // 2
                        if raw_a[4 * (i + low) : 4 * (i + middle)] == raw_b[4 * (j + low) : 4 * (j + middle)]:
                            low = middle
                        else:
                            high = middle
                    break
                low, step = high, step * 2
            begins += (i, j, low)
            i += low
            j += low
        else:
            begins += (i, j, 1)
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            i += 1
            j += 1
    begins += (n, m, 0)
    table = np.array(begins, np.int64).reshape(-1, 3)
    groups = table[:-1, 2]
    sizes = np.diff(table[:, :2], axis=0) // groups[:, None]
    size_a, size_b = (np.repeat(sizes[:, side], groups) for side in (0, 1))
    return size_a, size_b


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in a, index in b) of every two tokens whose ranges overlap: each
    stretch between two neighbouring ends of either side lies in one of each."""
    both = np.sort(np.concatenate([a, b]))
    both = both[np.append(True, both[1:] != both[:-1])]
    return np.searchsorted(a, both), np.searchsorted(b, both)


def spelled_groups(
    a: Side, b: Side, ids_a: np.ndarray, ids_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray
) -> Iterator[bytes]:
    """``a1,a2|b1;a3|b2,b3``, in pieces of some groups each."""
    stop_a, stop_b = np.cumsum(size_a), np.cumsum(size_b)
    for g in range(0, len(size_a), SPELL_GROUPS):
        h = min(g + SPELL_GROUPS, len(size_a))
        from_a, from_b = stop_a[g] - size_a[g], stop_b[g] - size_b[g]
        x, y = ids_a[from_a : stop_a[h - 1]], ids_b[from_b : stop_b[h - 1]]
        end_a, end_b = stop_a[g:h] - from_a, stop_b[g:h] - from_b
        words = np.empty(len(x) + len(y), max(a.after[","].dtype, b.after[","].dtype, key=lambda d: d.itemsize))
        # Tokens of the other side that stand before each token.
        at_a = np.arange(len(x)) + np.repeat(end_b - size_b[g:h], size_a[g:h])
        at_b = np.arange(len(y)) + np.repeat(end_a, size_b[g:h])
        words[at_a], words[at_b] = a.after[","][x], b.after[","][y]
        words[at_a[end_a - 1]], words[at_b[end_b - 1]] = a.after["|"][x[end_a - 1]], b.after[";"][y[end_b - 1]]
        # Shorter numbers are filled up with zero bytes.
        joined = words.tobytes().replace(b"\0", b"")
        yield joined if h < len(size_a) else joined[:-1]


def pack_pairs(pairs: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted distinct id pairs with their numbers of links, compressed."""
    steps = np.diff(pairs, prepend=np.int64(0))
    body = np.int64(len(pairs)).tobytes() + steps.tobytes() + n.astype("<i4").tobytes()
    return np.int64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def unpack_pairs(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int(np.frombuffer(held, np.int64, 1)[0])
    body = pa.decompress(held[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    return np.cumsum(np.frombuffer(body, np.int64, n, 8)), np.frombuffer(body, "<i4", n, 8 + 8 * n)


def _same_bytes(side: Side, ids: np.ndarray, sizes: np.ndarray, bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Which texts the ids of one side spell, byte by byte."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[0], np.cumsum(side.sizes[ids])])
    good = total[ends] - total[ends - sizes] == np.diff(bounds)
    if good.all() and np.array_equal(side.spell(ids), data):
        return good
    for i in np.flatnonzero(good).tolist():
        own = ids[ends[i] - sizes[i] : ends[i]]
        good[i] = np.array_equal(side.spell(own), data[bounds[i] : bounds[i + 1]])
    return good


def _aligned_rows(a: Side, b: Side, texts: pa.Array) -> Iterator[tuple]:
    """The columns of ``ALIGNED`` after ``row`` for each text."""
    led = pa.array([" " + t for t in texts.to_pylist()], pa.large_string())
    bounds, data = text_bytes(led)
    (ids_a, sizes_a), (ids_b, sizes_b) = a.encoder.encode(led), b.encoder.encode(led)
    good = (np.diff(bounds) > 1) & _same_bytes(a, ids_a, sizes_a, bounds, data)
    good &= _same_bytes(b, ids_b, sizes_b, bounds, data)
    each_a, each_b = np.split(ids_a, np.cumsum(sizes_a)[:-1]), np.split(ids_b, np.cumsum(sizes_b)[:-1])
    for fine, x, y in zip(good.tolist(), each_a, each_b, strict=True):
        if not fine:
            yield 0, 0, 0, 0, "", b""
            continue
        ends = [np.cumsum(side.sizes[ids]).astype(np.int32) for side, ids in ((a, x), (b, y))]
        size_a, size_b = align(*ends)
        link_a, link_b = links(*ends)
        digest = hashlib.sha256()
        for part in spelled_groups(a, b, x, y, size_a, size_b):
            digest.update(part)
        pairs = x[link_a].astype(np.int64) << _ID_BITS | y[link_b]
        distinct, n = np.unique(pairs, return_counts=True)
        yield len(x), len(y), len(size_a), len(pairs), digest.hexdigest(), pack_pairs(distinct, n)


def aligned(docs: DataFrame, byte_path: str, piece_path: str, id_col: str, text_col: str) -> DataFrame:
    """The columns of ``ALIGNED``, a row per input row; ``row`` numbers them."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_side(byte_path), piece_side(piece_path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = strings(batch.column(1))
            for part in balanced(texts, CHUNK_BYTES):
                found = list(zip(*_aligned_rows(a, b, texts[part]), strict=True))
                rows = np.arange(row, row + len(found[0]))
                row += len(rows)
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                columns = [pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)]
                names = [f.split()[0] for f in ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], pa.array(rows), *columns], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(make, ALIGNED)


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n, best``: links per id pair over all rows, and whether no pair
    of the same second id has more. Tasks sum before they pass rows on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        numbers: list[np.ndarray] = []
        size = 0

        def pass_on() -> pa.RecordBatch:
            summed = _summed(held, numbers)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in summed], names=["pair", "n"])

        for batch in batches:
            for packed in batch.column(0):
                if packed.as_py():
                    pairs, n = unpack_pairs(packed.as_py())
                    held.append(pairs)
                    numbers.append(n)
                    size += len(pairs)
                if size > SUM_PAIRS:
                    distinct, n = _summed(held, numbers)
                    held, numbers, size = [distinct], [n], len(distinct)
                    if size > SUM_PAIRS // 2:
                        yield pass_on()
                        held, numbers, size = [], [], 0
        if held:
            yield pass_on()

    counts = rows.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts)
    second = F.col("pair").bitwiseAND((1 << _ID_BITS) - 1)
    highest = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("second", second).join(highest, "second")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def cross_alignment(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``,
    one row per input row.

    A null or empty text, or one that either side does not spell byte by byte,
    has no tokens: zeros and an empty string. Repeated rows count as often as
    they stand there; extra columns are not read. Texts are encoded in whole,
    cut only at places that change no id.

    Texts are read once; what is kept of them is each text's id pairs. Counts of
    the ``HEAD_PAIRS`` commonest pairs go to every task (12 bytes each, whatever
    the input); the rest of each text's pairs, few as they are rare, are joined.
    """
    rows = materialize(aligned(docs, byte_path, piece_path, id_col, text_col))
    scored = materialize(pair_counts(rows))
    head = scored.orderBy(F.desc("n"), "pair").limit(HEAD_PAIRS).toArrow().sort_by("pair")
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(head.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, is_best = shared.value
        for batch in batches:
            found = []
            for packed in batch.column(1):
                held = packed.as_py()
                pairs, n = unpack_pairs(held) if held else (np.empty(0, np.int64), np.empty(0, "<i4"))
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                at, links = at[hit], n[hit].astype(np.int64)
                found.append((int(links[is_best[at]].sum()), int((links * number[at]).sum()), pairs[~hit], n[~hit]))
            best, total, rest, n = zip(*found, strict=True)
            bounds = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in rest])]), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x))) for x in (rest, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.int64()), pa.array(total, pa.int64()), *lists],
                names=["row", "best", "total", "rest", "links"],
            )

    sums = materialize(
        rows.select("row", "pairs").mapInArrow(
            score, "row long, best long, total long, rest array<long>, links array<int>"
        )
    )
    rare = sums.select("row", F.explode(F.arrays_zip("rest", "links")).alias("r"))
    joined = rare.select("row", F.col("r.rest").alias("pair"), F.col("r.links").alias("links")).join(scored, "pair")
    more = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("n")).alias("more_total"),
    )
    whole = rows.drop("pairs").join(sums.select("row", "best", "total"), "row").join(more, "row", "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more_total", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
