"""Removes text that occurs twice, found by run-length indexes.

An index is the Burrows-Wheeler transform of a set of strings, kept as runs,
with the suffix array sampled at the ends of its runs. The longest match of a
text place with its neighbour in suffix order is one less than that of the place
before it, except at a sampled place. So matching statistics are streamed over
the text: from each sample on they count down until the next. Repetitive text
has few runs, so few matches are measured on the text itself.

One index over the whole corpus would be one task. The corpus is dealt so that
equal strings of ``length`` bytes meet: the key of such a window is the smallest
hash of its grams of ``GRAM`` bytes, which equal windows share. Neighbouring
windows with one key are a region. Regions whose key occurs once are dropped;
equal regions become one; what is left goes, by key, into indexes of some
megabytes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import balanced, join_grown, materialize, strings, text_bytes
from airlag.llm.fingerprints import mix

LENGTH, GRAM = 200, 48
#: Bytes of text that are hashed at a time, windows of a region at most, bytes
#: of an index, and bytes of the regions of one key from which on the key is
#: parted into single windows.
CHUNK_BYTES, REGION, INDEX_BYTES, HOT_BYTES = 1 << 20, 4096, 4 << 20, 4 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_ROW = ["r1", "r2"]


# --- regions ----------------------------------------------------------------


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on."""
    n = len(data)
    powers = np.full((2, n), 1, np.uint64)
    powers[:, 1:] = np.array([[_BASE], [_BACK]], np.uint64)
    powers = np.cumprod(powers, axis=1, dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0], out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * powers[1][: n - gram + 1])


def sliding(values: np.ndarray, width: int, least: bool = True) -> np.ndarray:
    """Least (or largest) of the ``width`` values from each place on."""
    choose = np.minimum if least else np.maximum
    size, found = 1, values
    while 2 * size <= width:
        found = choose(found[:-size], found[size:])
        size *= 2
    rest = len(values) - width + 1
    return choose(found[:rest], found[width - size : width - size + rest])


def _repeats_inside(hashes: np.ndarray, keys: np.ndarray, valid: np.ndarray, begin, end, width: int) -> np.ndarray:
    """Which runs of windows with one key hold that key's gram more than once."""
    lows = np.where(valid, keys, 0)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), lows, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(hashes == sliding(padded, width, least=False)[: len(hashes)])
    distinct, code = np.unique(hashes[at], return_inverse=True)
    size = len(hashes) + 1
    place = np.sort(code * size + at)
    own = np.searchsorted(distinct, keys[begin]) * size
    return np.searchsorted(place, own + end + width - 1) - np.searchsorted(place, own + begin) > 1


def regions(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, first window, windows, key, repeats inside) of all regions of the
    texts that lie between ``bounds`` in ``data``."""
    width = length - gram + 1
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, np.empty(0, np.uint64), np.empty(0, bool)
    hashes = gram_hashes(data, gram)
    keys = sliding(hashes, width)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(keys)]
    valid = np.arange(len(keys)) + length <= bounds[1:][owner]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(fresh & valid)
    ends = np.flatnonzero(np.append((fresh[1:] | ~valid[1:]) & valid[:-1], valid[-1])) + 1
    inside = _repeats_inside(hashes, keys, valid, begin, ends, width)
    parts = -(-(ends - begin) // REGION)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(begin, parts) + nth * REGION
    windows = np.minimum(np.repeat(ends, parts) - first, REGION)
    text = owner[first]
    return text, first - bounds[text], windows, keys[first], np.repeat(inside, parts)


def _pieces(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, offsets in their texts, bounds, bytes) of stretches of text of
    some ``CHUNK_BYTES``. Stretches of a long text overlap by ``length`` - 1."""
    bounds, data = text_bytes(texts)
    for part in balanced(texts, CHUNK_BYTES):
        begin, end = bounds[part.start], bounds[part.stop]
        if part.stop - part.start > 1 or end - begin <= 2 * CHUNK_BYTES:
            rows = np.arange(part.start, part.stop)
            yield rows, np.zeros(len(rows), np.int64), bounds[part.start : part.stop + 1] - begin, data[begin:end]
            continue
        for at in range(0, int(end - begin) - length + 1, CHUNK_BYTES):
            piece = data[begin + at : min(begin + at + CHUNK_BYTES + length - 1, end)]
            yield np.array([part.start]), np.array([at]), np.array([0, len(piece)]), piece


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, r1, r2, text``: r1 and r2 name a row by its text and id. Rows
    that repeat both lose the same bytes, so they may share a name."""
    text, name = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    return docs.select(
        name.alias("doc_id"),
        F.xxhash64(text).alias("r1"),
        F.coalesce(name, F.lit(-(1 << 63))).alias("r2"),
        text.alias("text"),
    )


def key_counts(rows: DataFrame, length: int) -> DataFrame:
    """``key, n, inside``: regions per key, summed in each chunk before they move."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, bounds, data in _pieces(strings(batch.column(0)), length):
                *_, keys, inside = regions(data, bounds, length)
                found, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, minlength=len(found))
                twice = np.bincount(at, inside, len(found)) > 0
                columns = [found.view(np.int64), n, twice.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "n", "inside"])

    found = rows.select("text").mapInArrow(count, "key long, n long, inside int")
    return found.groupBy("key").agg(F.sum("n").alias("n"), F.max("inside").alias("inside"))


def region_rows(rows: DataFrame, length: int) -> DataFrame:
    """``key, content, r1, r2, start, windows``, a row per region."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r1, r2 = (batch.column(i).to_numpy() for i in (0, 1))
            for own, offset, bounds, data in _pieces(strings(batch.column(2)), length):
                text, first, windows, keys, _ = regions(data, bounds, length)
                whole, begin = memoryview(data), first + bounds[text]
                spans = zip(begin.tolist(), (begin + windows + length - 1).tolist(), strict=True)
                content = np.array([xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in spans], np.uint64)
                at = own[text]
                columns = [
                    keys.view(np.int64), content.view(np.int64), r1[at], r2[at],
                    first + offset[text], windows.astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["key", "content", "r1", "r2", "start", "windows"]
                )

    schema = "key long, content long, r1 long, r2 long, start long, windows int"
    return rows.select("r1", "r2", "text").mapInArrow(make, schema)


# --- the index --------------------------------------------------------------


class RunIndex:
    """Strings, joined, with a run-length transform of them.

    ``heads`` and ``tails`` are the places in the text of the first and last
    suffix of each run, ``matches`` how far the last suffix of a run agrees with
    the first of the next. Every string ends in an end mark of its own, so no
    match crosses strings.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray):
        ends = np.cumsum(sizes + 1) - 1
        self.begins = ends - sizes
        self.symbols = np.zeros(len(data) + len(sizes), np.uint16)
        inner = np.ones(len(self.symbols), bool)
        inner[ends] = False
        self.symbols[inner] = data.astype(np.uint16) + 1
        self.end_of = np.repeat(ends, sizes + 1)
        self._sample(self._suffixes(ends))

    def _suffixes(self, ends: np.ndarray) -> np.ndarray:
        """All suffixes in order, by prefix doubling on those not yet apart."""
        n = len(self.symbols)
        places = np.arange(n)
        first = np.zeros(n, np.uint64)
        for step in range(7):
            first = first * np.uint64(257) + self.symbols[np.minimum(places + step, self.end_of)]
        first[ends] = np.arange(len(ends))
        order = np.argsort(first, kind="stable")
        rank = np.empty(n, np.int64)
        known, open_at = first[order], places
        depth = 7
        while len(open_at):
            new = np.ones(len(open_at), bool)
            new[1:] = known[1:] != known[:-1]
            head = open_at[np.flatnonzero(new)][np.cumsum(new) - 1]
            rank[order[open_at]] = head
            alone = new & np.append(new[1:], True)
            open_at = open_at[~alone]
            here = order[open_at]
            known = rank[here] * n + rank[np.minimum(here + depth, self.end_of[here])]
            again = np.argsort(known, kind="stable")
            order[open_at], known = here[again], known[again]
            depth *= 2
        return order

    def _sample(self, order: np.ndarray) -> None:
        before = self.symbols[order - 1].astype(np.int32)
        before[order == 0] = 0
        # An end mark before a suffix is a run of its own.
        new = (before[1:] != before[:-1]) | (before[1:] == 0)
        starts = np.flatnonzero(np.concatenate([[True], new]))
        self.heads, self.tails = order[starts], order[np.append(starts[1:], len(order)) - 1]
        self.matches = self._agree(self.tails[:-1], self.heads[1:])

    def _agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from the places ``a`` and ``b`` on agree."""
        padded = np.concatenate([self.symbols, np.zeros(8, np.uint16)])
        four = np.ndarray(len(padded) - 3, "<u8", padded, strides=(2,))
        most = np.minimum(self.end_of[a] - a, self.end_of[b] - b)
        agreed = np.zeros(len(a), np.int64)
        active = np.flatnonzero(most > 0)
        while len(active):
            done = agreed[active]
            apart = four[a[active] + done] ^ four[b[active] + done]
            lowest = apart & (~apart + np.uint64(1))
            # Place of the lowest bit that differs, in symbols of 16 bits.
            same = np.where(apart == 0, 4, np.frexp(lowest.astype(np.float64))[1] - 1 >> 4)
            agreed[active] = np.minimum(done + same, most[active])
            active = active[(apart == 0) & (agreed[active] < most[active])]
        return agreed

    def statistics(self) -> np.ndarray:
        """The longest match of every place with any other place."""
        places = np.arange(len(self.symbols))
        best = np.zeros(len(places), np.int64)
        none = np.zeros(1, np.int64)
        for samples, values in (
            (self.heads, np.concatenate([none, self.matches])), (self.tails, np.concatenate([self.matches, none])),
        ):
            value = np.full(len(places), -1, np.int64)
            value[samples] = values
            last = np.maximum.accumulate(np.where(value >= 0, places, 0))
            np.maximum(best, value[last] - (places - last), out=best)
        return best


def long_matches(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, end) of every maximal stretch of windows of ``length``
    bytes that occur anywhere else in the strings."""
    index = RunIndex(data, sizes)
    marked = index.statistics() >= length
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    string = np.searchsorted(index.begins, start, "right") - 1
    return string, start - index.begins[string], stop - index.begins[string] + length - 1


# --- the corpus -------------------------------------------------------------


def _bodies(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` regions (r1, r2, start, windows, key, n) with their bytes."""
    place = F.struct("start", "windows", "key", "n")
    lists = wanted.groupBy(*_ROW).agg(F.collect_list(place).alias("at"))
    held = join_grown(rows.select(*_ROW, "text"), lists, _ROW)
    size = F.col("a.windows") + length - 1
    cut = held.select(*_ROW, F.col("text").cast("binary").alias("text"), F.explode("at").alias("a"))
    body = F.substring("text", F.col("a.start").cast("int") + 1, size)
    return cut.select(*_ROW, "a.start", "a.windows", "a.key", "a.n", body.alias("body"))


def _span(start: Column | str, size: Column) -> list[Column]:
    start = F.col(start) if isinstance(start, str) else start
    return [*map(F.col, _ROW), start.alias("start"), (start + size).cast("long").alias("stop")]


def _indexed(bodies: DataFrame, shards: int, length: int) -> DataFrame:
    """Repeated stretches of the regions that stand for one place each."""

    def search(table: pa.Table) -> pa.Table:
        body = table.column("body").combine_chunks().cast(pa.large_binary())
        bounds = np.frombuffer(body.buffers()[1], np.int64, len(body) + 1, 8 * body.offset)
        data = np.frombuffer(body.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        string, start, stop = long_matches(data, np.diff(bounds), length)
        once = table.column("n").to_numpy()[string] == 1
        string, start, stop = string[once], start[once], stop[once]
        first = table.column("start").to_numpy()[string]
        names = [table.column(c).to_numpy()[string] for c in _ROW]
        return pa.table([*map(pa.array, [*names, first + start, first + stop])], names=[*_ROW, "start", "stop"])

    dealt = bodies.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(search, "r1 long, r2 long, start long, stop long")


def _by_window(bodies: DataFrame, length: int) -> DataFrame:
    """The same for regions of very frequent keys: a window's own hash, 128
    bits, is its key, so that equal windows meet and no others do."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r1, r2, start, windows, n, body = (batch.column(i) for i in range(6))
            times = windows.to_numpy()
            at = np.repeat(np.arange(len(times)), times)
            along = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            digests = b"".join(
                xxhash.xxh3_128_digest(own[i : i + length])
                for own, count in zip(body.to_pylist(), times.tolist(), strict=True)
                for i in range(count)
            )
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            columns = [r1.to_numpy()[at], r2.to_numpy()[at], start.to_numpy()[at] + along, n.to_numpy()[at]]
            columns += [halves[:, 0].copy(), halves[:, 1].copy()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*_ROW, "start", "n", "w1", "w2"])

    each = bodies.select(*_ROW, "start", "windows", "n", "body").mapInArrow(
        part, "r1 long, r2 long, start long, n long, w1 long, w2 long"
    )
    each = materialize(each)
    found = each.groupBy("w1", "w2").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("w1", "w2")
    return join_grown(each.where("n = 1"), found, ["w1", "w2"]).select(*_span("start", F.lit(length)))


def repeated_spans(rows: DataFrame, length: int) -> DataFrame:
    """``r1, r2, start, stop`` of bytes that lie in windows which occur twice."""
    counts = key_counts(rows, length)
    keys = counts.where((F.col("n") > 1) | (F.col("inside") > 0)).select("key", "inside")
    found = materialize(join_grown(region_rows(rows, length), keys, ["key"]))

    place = F.min(F.struct(*_ROW, "start", "windows")).alias("at")
    contents = found.groupBy("key", "content").agg(F.count("*").alias("n"), place, F.max("inside").alias("inside"))
    contents = materialize(contents)
    copies = join_grown(found, contents.where("n > 1").select("key", "content"), ["key", "content"])
    spans = [copies.select(*_span("start", F.col("windows") + length - 1))]

    size = (F.col("at.windows") + length - 1).cast("long")
    of_key = contents.groupBy("key").agg(
        F.count("*").alias("contents"), F.sum(size).alias("bytes"), F.max("inside").alias("repeats")
    )
    mixed = of_key.where("contents > 1 or repeats > 0").select("key", "bytes")
    wanted = materialize(
        join_grown(contents, mixed, ["key"]).select("at.*", "key", "n", (F.col("bytes") > HOT_BYTES).alias("hot"))
    )
    sizes = {
        r.hot: r.bytes
        for r in wanted.groupBy("hot").agg(F.sum(F.col("windows") + length - 1).alias("bytes")).collect()
    }
    if False in sizes:
        bodies = _bodies(rows, wanted.where("not hot"), length)
        spans.append(_indexed(bodies, -(-sizes[False] // INDEX_BYTES), length))
    if True in sizes:
        spans.append(_by_window(_bodies(rows, wanted.where("hot"), length), length))
    every = spans[0]
    for more in spans[1:]:
        every = every.unionAll(more)
    return every


def dedup_substrings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``, one row per input row.

    ``spans`` are the maximal stretches of UTF-8 bytes, ends excluded, that are
    covered by strings of ``length`` bytes which also start anywhere else in the
    table, the same text included; ``kept`` are the other bytes, which may end
    inside a character. All copies go, judged on the input. Matches do not cross
    texts. Null and empty texts, and texts shorter than ``length``, keep all;
    rows that repeat lose all of ``length`` bytes or more; null ids and ties
    change nothing; extra columns are not read. Texts of any length are read
    whole, in overlapping stretches.
    """
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    rows = _keyed(docs, id_col, text_col)
    lists = repeated_spans(rows, length).groupBy(*_ROW).agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    held = join_grown(rows, lists, _ROW, "left").select("doc_id", "text", "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, data = text_bytes(strings(batch.column(1)))
            spans, kept = [], []
            for row, cuts in enumerate(batch.column(2)):
                own = data[bounds[row] : bounds[row + 1]]
                merged: list[dict[str, int]] = []
                if cuts.is_valid:
                    fields = cuts.values.flatten()
                    start, stop = (f.to_numpy() for f in fields)
                    order = np.argsort(start, kind="stable")
                    start, reach = start[order], np.maximum.accumulate(stop[order])
                    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
                    ends = reach[np.append(new[1:], len(reach)) - 1]
                    merged = [{"start": a, "stop": b} for a, b in zip(start[new].tolist(), ends.tolist(), strict=True)]
                    stay = np.ones(len(own), bool)
                    for span in merged:
                        stay[span["start"] : span["stop"]] = False
                    own = own[stay]
                spans.append(merged)
                kept.append(own.tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            sizes = pa.array(np.diff(bounds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
    return held.mapInArrow(cut, schema)
