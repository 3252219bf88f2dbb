"""Finds passages of benchmark items in documents with one automaton.

Words are runs of ASCII digits, lower-cased ASCII letters and all other
non-ASCII characters. Every window of ``width`` consecutive words of an item
(all its words, if it has fewer) goes into an Aho-Corasick automaton; each
document's words are scanned once, and hits are mapped back to places in the
original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import keep_rows, materialize, strings, text_bytes

#: Window characters in one automaton: it takes some 60 bytes for each. Items
#: beyond this fill further blocks, and documents are scanned once per block.
BLOCK_CHARS = 4_000_000

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
#: Each byte as a word byte or a space; bytes above 0x7F only occur in words.
TABLE = bytes(
    lower if lower in _KEEP else 0x20
    for lower in (b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def windows_of(words: list[bytes], width: int) -> Iterator[bytes]:
    """Each window with one space around every word."""
    for i in range(max(1, len(words) - width + 1) if words else 0):
        yield b" " + b" ".join(words[i : i + width]) + b" "


def build(items: list[tuple[str, str | None]], width: int):
    """The automaton of some items: window -> (number of words, item ids)."""
    import ahocorasick

    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows_of(words_of(text), width):
            owners.setdefault(window, set()).add(item)
    automaton = ahocorasick.Automaton()
    for window, ids in owners.items():
        # Latin-1 gives one character per byte, so offsets stay byte offsets.
        automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(sorted(ids))))
    if owners:
        automaton.make_automaton()
    return automaton if owners else None


def item_blocks(items: DataFrame, width: int, most: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in blocks whose windows fit one automaton; streamed from Spark a
    partition at a time, never held together."""
    block: list[tuple[str, str | None]] = []
    size = 0
    for row in items.toLocalIterator():
        chars = len(row.text or "") * width
        if block and size + chars > most:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += chars
    if block:
        yield block


_SCANNED = (
    "doc_id long, n_words long, n_hit long, item_ids array<string>, "
    "spans array<struct<begin: long, end: long>>"
)
_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
     ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))]
)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def scan_text(raw: bytes, automaton):
    """(number of words, hit flags per word or None, item ids) of one text."""
    split = raw.translate(TABLE).split()
    line = b" " + b" ".join(split) + b" "
    flags, found = None, set()
    for end, (count, ids) in automaton.iter(line.decode("latin-1")) if split else ():
        if flags is None:
            # Start of every word in the normalised line, and marks to be summed.
            starts = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
            flags = np.zeros(len(split) + 1, np.int32)
        last = int(np.searchsorted(starts, end))
        flags[last - count] += 1
        flags[last] -= 1
        found.update(ids)
    if flags is not None:
        flags = np.cumsum(flags[:-1]) > 0
    return len(split), flags, found


def code_point_spans(raw: bytes, flags: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as half-open spans of code points in the original."""
    data = np.frombuffer(raw, np.uint8)
    begins, ends = _runs(np.frombuffer(raw.translate(TABLE), np.uint8) != 0x20)
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    first, last = _runs(flags)
    return [
        {"begin": int(point[begins[a]]), "end": int(point[ends[b - 1]])}
        for a, b in zip(first, last, strict=True)
    ]


def _scan(docs: DataFrame, block: list[tuple[str, str | None]], width: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    made: dict[str, object] = {}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "automaton" not in made:
            made["automaton"] = build(shared.value, width)
        automaton = made["automaton"]
        for batch in batches:
            texts = strings(batch.column(1))
            bounds, data = text_bytes(texts)
            rows: list[list] = [[], [], [], []]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                raw = data[a:b].tobytes()
                if automaton is None:
                    n, flags, found = len(raw.translate(TABLE).split()), None, set()
                else:
                    n, flags, found = scan_text(raw, automaton)
                rows[0].append(n)
                rows[1].append(0 if flags is None else int(flags.sum()))
                rows[2].append(sorted(found))
                rows[3].append([] if flags is None else code_point_spans(raw, flags))
            columns = [batch.column(0)]
            columns += [pa.array(r, f.type) for r, f in zip(rows, list(_SCHEMA)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    return docs.mapInArrow(scan, _SCANNED)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, spans``, one row per input row.

    ``n_hit`` counts document words inside any occurrence of any window,
    ``item_ids`` are the items with occurring windows, sorted as strings, and
    ``spans`` the hit places as half-open code point ranges of the original
    text. Items of one block (the usual case) give one automaton and a plain
    map without a shuffle. More blocks are scanned one after the other, and a
    document's spans are then united. Null texts have no words, an item without
    words has no window, a null item id is the text ``null``; repeated rows of
    a document are each reported, and repeated items count once.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    blocks = item_blocks(keyed, width, block_chars)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _scan(rows, first, width)
    # Repeated rows need an identity before their blocks are united.
    numbered = materialize(rows.withColumn("row", F.monotonically_increasing_id()))
    # A block is drawn from Spark once the one before it was scanned and stored.
    parts = chain([first, second], blocks)
    del first, second
    by_row = numbered.select(F.col("row").alias("doc_id"), "text")
    scanned = None
    for block in parts:
        one = materialize(_scan(by_row, block, width))
        scanned = one if scanned is None else scanned.unionAll(one)
        del block
    return _unite(numbered, scanned)


def _unite(numbered: DataFrame, scanned: DataFrame) -> DataFrame:
    """One row per numbered row out of one per row and block."""
    hits = scanned.groupBy(F.col("doc_id").alias("row")).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, spans = [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True):
                merged: list[dict[str, int]] = []
                for span in found:
                    # A run of hit words may continue another block's run.
                    joint = merged and not words_of((text or "")[merged[-1]["end"] : span["begin"]])
                    if merged and (span["begin"] <= merged[-1]["end"] or joint):
                        merged[-1]["end"] = max(merged[-1]["end"], span["end"])
                    else:
                        merged.append(dict(span))
                spans.append(merged)
                n_hit.append(sum(len(words_of(text[s["begin"] : s["end"]])) for s in merged))
            columns = [batch.column(0), batch.column(2), pa.array(n_hit, pa.int64())]
            columns += [batch.column(3).cast(pa.list_(pa.string())), pa.array(spans, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    joined = numbered.join(hits, "row").select("doc_id", "text", "n_words", "item_ids", "spans")
    return joined.mapInArrow(unite, _SCANNED)


def remove_contaminated(
    docs: DataFrame, items: DataFrame, width: int = 10, block_chars: int = BLOCK_CHARS, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, as they are, without any window of an item. Each
    block of items is one automaton that the rows pass; what passed is stored
    before the next, so a task holds one automaton at a time."""
    keyed = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    for number, block in enumerate(item_blocks(keyed, width, block_chars)):
        passed = materialize(docs) if number else docs
        docs = keep_rows(passed, _Clean(docs.sparkSession.sparkContext.broadcast(block), width), text_col)
    return docs


class _Clean:
    """Marks texts without a hit; builds its automaton once per task."""

    def __init__(self, block, width: int):
        self.block, self.width, self.automaton = block, width, None

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if self.automaton is None:
            self.automaton = (build(self.block.value, self.width),)
        (automaton,) = self.automaton
        bounds, data = text_bytes(texts)
        clean = np.ones(len(texts), bool)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if automaton is not None:
                clean[i] = scan_text(data[a:b].tobytes(), automaton)[1] is None
        return clean
