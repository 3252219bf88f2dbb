"""Token ids in Arrow stream files with fixed-size-list batches.

A file is an Arrow IPC stream. Its batches hold ``rows`` sequences each (the
last one fewer): ``ids`` is a fixed-size list of ``length`` unsigned integers,
``mask`` one of booleans, false where a sequence is padded. All full batches
take the same number of bytes, so a reader that maps the file finds sequence i
by arithmetic and sees it without a copy. Beside it lies a second stream file
with one row per document: its id, its place among the file's ids, its length.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlag.llm.common import materialize, partitions, scratch_dir, strings
from airlag.llm.encode import encoder
from airlag.llm.fingerprints import in_order

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, ids_file string, index_file string, n_docs long, n_tokens long, id_bits int"


def sequence_schema(length: int, bits: int) -> pa.Schema:
    kind = {16: pa.uint16(), 32: pa.uint32()}[bits]
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a run of ids into equal sequences and writes them in equal batches."""

    def __init__(self, sink, length: int, rows: int, bits: int):
        self.schema = sequence_schema(length, bits)
        self.kind = np.uint16 if bits == 16 else np.uint32
        self.length, self.rows = length, rows
        self.left = np.empty(0, self.kind)
        self.out = ipc.new_stream(sink, self.schema)

    def write(self, ids: np.ndarray) -> None:
        ids = np.concatenate([self.left, ids.astype(self.kind)])
        size = self.length * self.rows
        full = len(ids) // size * size
        for begin in range(0, full, size):
            self._batch(ids[begin : begin + size], size)
        self.left = ids[full:]

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:real] = True
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (ids, mask)
        ]
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if len(self.left):
            padded = np.zeros(-(-len(self.left) // self.length) * self.length, self.kind)
            padded[: len(self.left)] = self.left
            self._batch(padded, len(self.left))
        self.out.close()


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 2,
    length: int = 2048,
    rows: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode all texts in ascending document order; returns the manifest.

    Rows are dealt by ranges of the id, and of the text's head and hash within
    an id that many texts share, so file after file holds the global order; each task streams its texts into one pair of files and keeps one
    batch in memory. A task that is run again writes under a new name, and only
    the names in the manifest (written once, by committed tasks) count, so a
    lost executor leaves unnamed files behind but no wrong ones. Null text is
    empty: only the end id. Equal ids follow one another, ordered
    by the head of the text, then by its hash; null ids come first. An empty table gives an empty manifest. ``folder`` must
    be one that all executors can write to.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        bits = 16 if max(encode.library.get_vocab_size() - 1, end_id) < 1 << 16 else 32
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        target, path = fs.FileSystem.from_uri(folder)
        target.create_dir(path, recursive=True)
        names = [f"{path}/{name}.ids.arrow", f"{path}/{name}.docs.arrow"]
        n_docs = n_tokens = 0
        with ExitStack() as opened:
            out = index = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    sinks = [opened.enter_context(target.open_output_stream(n)) for n in names]
                    out = SequenceWriter(sinks[0], length, rows, bits)
                    index = ipc.new_stream(sinks[1], INDEX)
                ids, sizes = encode.encode(strings(batch.column(1)))
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
                out.write(ids)
                starts = n_tokens + np.cumsum(sizes) - sizes
                columns = [batch.column(0), pa.array(starts), pa.array(sizes)]
                index.write_batch(pa.record_batch(columns, schema=INDEX))
                n_docs, n_tokens = n_docs + len(sizes), n_tokens + len(ids)
            if out is not None:
                out.close()
                index.close()
        if n_docs:
            row = {
                "part": part, "ids_file": f"{folder}/{name}.ids.arrow",
                "index_file": f"{folder}/{name}.docs.arrow",
                "n_docs": n_docs, "n_tokens": n_tokens, "id_bits": bits,
            }
            schema = pa.schema(
                [("part", pa.int32()), ("ids_file", pa.string()), ("index_file", pa.string()),
                 ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("id_bits", pa.int32())]
            )
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    spark = docs.sparkSession
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(partitions(spark), *in_order()[:-1])
        .sortWithinPartitions(*in_order())
    )
    return materialize(ordered.mapInArrow(write, MANIFEST))


def open_mapped(path: str) -> ipc.RecordBatchStreamReader:
    """A stream file: mapped into memory if it is local, else read as it comes."""
    source, name = fs.FileSystem.from_uri(path)
    local = isinstance(source, fs.LocalFileSystem)
    return ipc.open_stream(pa.memory_map(name) if local else source.open_input_stream(name))


class TokenFile:
    """Random access to the sequences of one file. Nothing is copied: arrays
    point into the mapped file."""

    def __init__(self, path: str):
        self.batches = list(open_mapped(path))
        self.rows = self.batches[0].num_rows if self.batches else 0

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence i."""
        batch, row = self.batches[i // self.rows], i % self.rows
        ids, mask = batch.column(0), batch.column(1)
        width = ids.type.list_size
        flat = ids.values.slice(row * width, width)
        return flat.to_numpy(), mask.values.slice(row * width, width)


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    The manifest has one row per file; it alone is ordered in one task, to give
    each file its place in the whole. The files are read in as many tasks, each
    batch by batch. ``ids_crc32`` covers the ids as little-endian unsigned
    32-bit integers.
    """
    shards, before = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r.part):
        shards.append((row.part, row.ids_file, row.index_file, before))
        before += row.n_tokens
    schema = T.StructType.fromDDL("part int, ids_file string, index_file string, before long")
    listed = spark.createDataFrame(shards, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                yield from _documents(shard["ids_file"], shard["index_file"], shard["before"])

    parts = max(1, min(len(shards), partitions(spark)))
    return listed.repartitionByRange(parts, "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _documents(ids_file: str, index_file: str, before: int) -> Iterator[pa.RecordBatch]:
    """Walks both files side by side, a batch of documents at a time."""
    stream, held = iter(open_mapped(ids_file)), np.empty(0, np.uint32)
    for docs in open_mapped(index_file):
        starts, sizes = (docs.column(i).to_numpy() for i in (1, 2))
        sums = np.empty(len(sizes), np.int64)
        for i, size in enumerate(sizes.tolist()):
            if len(held) < size:
                found = [held]
                have = len(held)
                while have < size:
                    batch = next(stream)
                    ids = batch.column(0).flatten().to_numpy()
                    mask = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                    found.append((ids if mask.all() else ids[mask]).astype("<u4"))
                    have += len(found[-1])
                held = np.concatenate(found)
            sums[i] = zlib.crc32(held[:size])
            held = held[size:]
        yield pa.RecordBatch.from_arrays(
            [docs.column(0), pa.array(starts + before), docs.column(2), pa.array(sums)],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def scratch_token_folder(spark: SparkSession) -> str:
    """A new folder for token files that all executors share, as a URI."""
    path = scratch_dir(spark)
    return path if "://" in path else f"file://{path.removeprefix('file:')}"
