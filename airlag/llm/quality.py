"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its potentials come from counts of character kinds
in it and in the lines before and after it; a 2 x 2 matrix couples neighbours.
A document's score is the mean of its lines' forward-backward marginals of
"good", weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import balanced, keep_rows, materialize, strings, text_bytes

#: Bytes of text whose lines are scored at once.
CHUNK_BYTES = 2 << 20
#: Documents used to fit, at most about so many of each label.
FIT_ROWS = 2_000

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _LOUD, _SYMBOL, _OTHER = range(8)


def _kinds() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    for byte in range(0x80):
        char = chr(byte)
        table[byte] = (
            _LOWER if char.islower()
            else _UPPER if char.isupper()
            else _DIGIT if char.isdigit()
            else _SPACE if char.isspace()
            else _STOP if char in ".,;:'\"()-"
            else _LOUD if char in "!?"
            else _SYMBOL
        )
    return table


_KINDS = _kinds()
_ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(64)], np.uint64)
N_FEATURES = 12


def repeated_words(kinds: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of each line that equal the word before them in that line."""
    solid = kinds != _SPACE
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    first = first[:-1]
    heads = solid.copy()
    heads[1:] &= ~solid[:-1] | first[1:]
    heads = np.flatnonzero(heads)
    same = np.zeros(len(data) + 1, np.int64)
    if len(heads):
        # Place of each byte in its word; what lies before the first word is 0.
        spans = np.diff(heads, append=len(data))
        place = np.arange(len(data)) - np.concatenate([np.arange(heads[0]), np.repeat(heads, spans)])
        mixed = np.where(solid, (data.astype(np.uint64) + np.uint64(1)) * _ODD[place & 63], np.uint64(0))
        word = np.add.reduceat(mixed, heads)
        line = np.cumsum(first)[heads]
        equal = np.zeros(len(heads), bool)
        equal[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
        same[1:] = np.cumsum(np.bincount(heads[equal], minlength=len(data)))
    return same[ends] - same[starts]


@dataclass
class Lines:
    """Lines of some documents: features, byte lengths, lines per document."""

    features: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray


def line_features(texts: pa.Array) -> Lines:
    """Cuts texts at line breaks; an empty text is one empty line."""
    bounds, data = text_bytes(texts)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([bounds[:-1], breaks + 1])
    owner = np.concatenate(
        [np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, "right") - 1]
    )
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    counts = np.bincount(owner, minlength=len(bounds) - 1)
    ends = np.concatenate([starts[1:] - 1, [0]])
    last = np.cumsum(counts) - 1
    ends[last] = bounds[1:]
    lengths = ends - starts
    kinds = _KINDS[data]
    sums = np.zeros((len(starts), 8), np.float64)
    for kind in range(8):
        total = np.concatenate([[0], np.cumsum(kinds == kind, dtype=np.int64)])
        sums[:, kind] = total[ends] - total[starts]
    share = sums / np.maximum(lengths, 1)[:, None]
    words = sums[:, _SPACE] + 1
    again = repeated_words(kinds, data, starts, ends) / words
    features = np.column_stack(
        [share, again, np.log1p(lengths), np.log(np.maximum(lengths, 1) / words), lengths == 0]
    )
    return Lines(features.astype(np.float32), lengths, counts)


def _line_windows(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of whole lines, without the break behind the last; a line of
    more than ``CHUNK_BYTES`` is a range of its own."""
    breaks = np.flatnonzero(data == 0x0A)
    begin = 0
    while begin <= len(data):
        end = len(data)
        if end - begin > CHUNK_BYTES:
            # The last break within reach, else the next one.
            within = np.searchsorted(breaks, begin + CHUNK_BYTES, "right") - 1
            at = max(within, np.searchsorted(breaks, begin))
            end = int(breaks[at]) if at < len(breaks) else end
        yield begin, end
        begin = end + 1


def features_of(texts: pa.Array) -> Lines:
    """``line_features``; those of one long text are made in windows of lines,
    so a few numbers a line are held, not several arrays over its bytes."""
    _, data = text_bytes(texts)
    if len(texts) != 1 or len(data) <= CHUNK_BYTES:
        return line_features(texts)
    found = [
        line_features(pa.array([data[begin:end].tobytes()], pa.large_binary()).view(pa.large_string()))
        for begin, end in _line_windows(data)
    ]
    lengths = np.concatenate([x.lengths for x in found])
    return Lines(np.concatenate([x.features for x in found]), lengths, np.array([len(lengths)]))


def with_neighbours(lines: Lines, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features of each line, of its neighbours, and a constant."""
    own = (lines.features - mean) / scale
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    ends = np.cumsum(lines.counts)
    before[ends - lines.counts] = 0
    after[ends - 1] = 0
    return np.hstack([own, before, after, np.ones((len(own), 1), own.dtype)])


def forward_backward(unary: np.ndarray, counts: np.ndarray, pair: np.ndarray):
    """(log partition per document, marginal of "good" per line, pair sums).

    ``unary`` is the potential of "good" per line ("bad" has 0); ``pair`` holds
    potentials of (state, next state). Documents advance together, a line a
    step; those that have ended drop out, so the work is the number of lines.
    """
    order = np.argsort(-counts, kind="stable")
    begins = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")  # documents with over t lines
    node = np.stack([np.zeros_like(unary), unary], axis=1)
    alpha, beta = np.empty_like(node), np.zeros_like(node)

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for t in range(steps):
        at = begins[: active[t]] + t
        alpha[at] = node[at] if t == 0 else node[at] + lse(alpha[at - 1][:, :, None] + pair, 1)
    for t in range(steps - 2, -1, -1):
        at = begins[: active[t + 1]] + t
        beta[at] = lse(pair + (node[at + 1] + beta[at + 1])[:, None, :], 2)
    ends = begins + sizes - 1
    z = np.empty(len(counts))
    z[order] = lse(alpha[ends], 1)
    each = np.repeat(z, counts)
    good = np.exp(np.clip(alpha[:, 1] + beta[:, 1] - each, None, 0))
    inner = np.ones(len(unary), bool)
    inner[(np.cumsum(counts) - counts)] = False
    at = np.flatnonzero(inner)
    pairs = np.exp(
        alpha[at - 1][:, :, None] + pair + (node[at] + beta[at])[:, None, :] - each[at][:, None, None]
    )
    return z, good, pairs, at


@dataclass
class Crf:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pair: np.ndarray

    def line_marginals(self, lines: Lines) -> np.ndarray:
        unary = with_neighbours(lines, self.mean, self.scale) @ self.weights
        return forward_backward(unary.astype(np.float64), lines.counts, self.pair)[1]

    def score(self, texts: pa.Array) -> np.ndarray:
        found = [np.empty(0)]
        for part in balanced(texts, CHUNK_BYTES):
            lines = features_of(texts[part])
            weight = lines.lengths + 1.0
            good = self.line_marginals(lines) * weight
            begins = np.cumsum(lines.counts) - lines.counts
            found.append(np.add.reduceat(good, begins) / np.add.reduceat(weight, begins))
        return np.clip(np.concatenate(found), 0.0, 1.0)


def train(lines: Lines, label: np.ndarray, weight: np.ndarray, rounds: int = 150, ridge: float = 1e-3) -> Crf:
    """Maximum likelihood by Adam. Every line carries its document's label and
    each document a weight; ``ridge`` keeps separable data finite."""
    mean = lines.features.mean(axis=0)
    scale = lines.features.std(axis=0) + 1e-6
    x = with_neighbours(lines, mean, scale).astype(np.float64)
    state = np.repeat(label, lines.counts)
    share = np.repeat(weight / (weight * lines.counts).sum(), lines.counts)
    weights, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, pair)]
    for step in range(1, rounds + 1):
        _, good, pairs, at = forward_backward(x @ weights, lines.counts, pair)
        seen = np.zeros((len(at), 2, 2))
        seen[np.arange(len(at)), state[at - 1], state[at]] = 1
        slopes = (
            ((state - good) * share) @ x - ridge * weights,
            ((seen - pairs) * share[at][:, None, None]).sum(axis=0) - ridge * pair,
        )
        for value, slope, (first, second) in zip((weights, pair), slopes, moment, strict=True):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            value += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Crf(mean, scale, weights.astype(np.float32), pair)


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Crf | None:
    """Fits on a bounded sample: of each label at most about ``rows`` labelled
    documents, those with the smallest id hashes, whole; weights give the labels
    back their shares. The sample's ids (bounded by ``rows``) are broadcast,
    line features are made by Spark, and only these reach the driver. Rows that
    repeat id and text count as one with their number as its weight. Where ids
    stand for many texts, so that a label has more than ``2 * rows``, about
    ``rows`` of them are drawn by hash, so no id decides what is held. None
    where no document is labelled, and a constant where only one label occurs.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")
    )
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    cut = F.when(F.col("label") == 1, min(1.0, rows / sizes.get(1, 1))).otherwise(
        min(1.0, rows / sizes.get(0, 1))
    )
    sample = known.where(place < cut)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "text", "label")
    joined = materialize(found.agg(F.count("*").alias("n")))
    drawn_by = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(True)
    for r in joined.groupBy("label").agg(F.count("*").alias("texts")).collect():
        if r.texts > 2 * rows:
            keep = keep & ((F.col("label") != r.label) | (drawn_by < rows / r.texts))
    joined = joined.where(keep).select("text", "label", "n")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column(0))
            for part in balanced(column, CHUNK_BYTES):
                lines = features_of(column[part])
                begins = np.cumsum(lines.counts) - lines.counts
                flat, lengths = [], []
                for a, n in zip(begins.tolist(), lines.counts.tolist(), strict=True):
                    flat.append(lines.features[a : a + n].ravel())
                    lengths.append(lines.lengths[a : a + n])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[part], pa.array(flat, pa.list_(pa.float32())),
                     pa.array(lengths, pa.list_(pa.int64())), batch.column(2)[part]],
                    names=["label", "features", "lengths", "n"],
                )

    found = joined.mapInArrow(features, "label int, features array<float>, lengths array<long>, n long")
    rows_found = sorted(map(tuple, found.collect()), key=lambda r: (r[0], len(r[2]), r[1]))
    if not rows_found:
        return None
    label = np.array([r[0] for r in rows_found])
    lines = Lines(
        np.concatenate([np.array(r[1], np.float32) for r in rows_found]).reshape(-1, N_FEATURES),
        np.concatenate([np.array(r[2]) for r in rows_found]),
        np.array([len(r[2]) for r in rows_found]),
    )
    times = np.array([r[3] for r in rows_found])
    drawn = np.bincount(label, times, minlength=2)
    weight = np.array([sizes.get(k, 0) / max(drawn[k], 1) for k in (0, 1)])[label] * times
    return train(lines, label, weight)


def score_quality(
    docs: DataFrame, model: Crf | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``doc_id, score`` and the columns in ``keep``, one row per input row.

    A map without a shuffle; the model (a few hundred numbers) travels with the
    task. Null and empty texts are scored as one empty line; without a model
    every score is 0.5. Repeated rows are each scored. Long texts are read in
    windows of whole lines and scored as one chain; a single line is not cut.
    """
    kept = keep or []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c) for c in kept]
    )
    out = rows.schema
    names = ["doc_id", "score", *kept]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(1))
            scores = model.score(texts) if model else np.full(len(texts), 0.5)
            columns = [batch.column(0), pa.array(scores, pa.float64()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [out["doc_id"].dataType.simpleString(), "double"]
    fields += [out.fields[2 + i].dataType.simpleString() for i in range(len(kept))]
    return rows.mapInArrow(score, ", ".join(f"`{n}` {t}" for n, t in zip(names, fields, strict=True)))


def keep_good(docs: DataFrame, model: Crf | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, whose text scores at least ``least``;
    all rows where there is no model."""
    if model is None:
        return docs
    return keep_rows(docs, lambda texts: model.score(texts) >= least, text_col)
