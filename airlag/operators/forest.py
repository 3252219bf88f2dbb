"""A regression forest over sparse vectors, grown level by level.

A row is kept by the bins of its entries only. Slots in which a vector holds
zero are never visited: their share of a node follows from the node's total. So
one-hot slots cost as much as there are categories in a row, and not as much as
there are categories, and rows are stored in a few dozen bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.functions.profiles import with_range_ranks
from airlag.session import let_workers_import, materialize

#: Bins per slot; one with as many distinct values or fewer is cut between any two.
BINS = 32
NODE = "tree int, node int, weight binary, total binary"
SPLIT = "tree int, node int, slot int, bin int, gain double, weight double, total double, left_weight double, left_total double"


def entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the entries of a column of vectors that are not 0."""
    values, slots = vectors.field("values"), vectors.field("indices")
    size = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    place[sparse[row]] = slots.flatten().to_numpy()
    value = values.flatten().to_numpy()
    if not np.isfinite(value).all():
        raise ValueError("vectors must not hold NaN or infinite values")
    kept = value != 0
    return row[kept], place[kept], value[kept]


def value_counts(rows: DataFrame) -> DataFrame:
    """``slot, v, n``: how often each value other than 0 stands in each slot;
    the number of all rows stands in slot -1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, slot, value = entries(batch.column(0))
            order = np.lexsort((value, slot))
            slot, value = slot[order], value[order]
            first = np.flatnonzero(np.diff(slot, prepend=-1).astype(bool) | np.diff(value, prepend=np.nan).astype(bool))
            yield pa.RecordBatch.from_pydict(
                {
                    "slot": pa.array(np.append(slot[first], -1), pa.int32()),
                    "v": pa.array(np.append(value[first], 0.0)),
                    "n": pa.array(np.append(np.diff(first, append=len(slot)), batch.num_rows), pa.int64()),
                }
            )

    found = rows.mapInArrow(count, "slot int, v double, n long")
    return found.groupBy("slot", "v").agg(F.sum("n").alias("n"))


def thresholds(rows: DataFrame, slots: int, bins: int = BINS) -> list[np.ndarray]:
    """Per slot, the values between its bins: between any two distinct values
    if they are few, else between ``bins`` parts of as many rows each. All rows
    are counted, and at most ``bins`` values per slot reach the driver."""
    counts = materialize(value_counts(rows))
    every = counts.where("slot < 0").first().n
    counts = counts.where("slot >= 0")
    zeros = counts.groupBy("slot").agg(F.lit(0.0).alias("v"), (F.lit(every) - F.sum("n")).alias("n"))
    counts = counts.unionByName(zeros.where("n > 0"))
    distinct = counts.groupBy("slot").agg(F.count(F.lit(1)).alias("distinct"))
    ranked = with_range_ranks(counts, ["slot"]).join(distinct, "slot")
    part = F.floor((F.col("upto") - 1) * bins / F.col("known")).cast("double")
    few = F.col("distinct") <= bins
    parts = ranked.groupBy("slot", F.when(few, F.col("v")).otherwise(part).alias("part")).agg(
        F.min("v").alias("least"), F.max("v").alias("most")
    )
    bounds: list[list[tuple[float, float]]] = [[] for _ in range(slots)]
    for row in parts.select("slot", "least", "most").collect():
        bounds[row.slot].append((row.least, row.most))
    found = []
    for pairs in map(sorted, bounds):
        # Never the upper value itself, not even where no number lies between.
        middles = [min(a + (b - a) / 2, np.nextafter(b, a)) for (_, a), (b, _) in zip(pairs, pairs[1:])]
        found.append(np.array(middles, np.float64))
    return found


class Bins:
    """The bins of all slots under one running number, the code."""

    def __init__(self, cuts: list[np.ndarray]):
        self.slots = len(cuts)
        most = max((len(c) for c in cuts), default=0)
        self.steps = [1 << i for i in reversed(range(most.bit_length()))]
        self.cuts = np.full((self.slots, (1 << most.bit_length()) - 1 or 1), np.inf)
        for at, values in enumerate(cuts):
            self.cuts[at, : len(values)] = values
        sizes = np.array([len(c) + 1 for c in cuts], np.int64)
        self.base = np.cumsum(sizes) - sizes
        self.codes = int(sizes.sum())
        self.slot = np.repeat(np.arange(self.slots), sizes)
        self.zero = self.base + self.bin(np.arange(self.slots), np.zeros(self.slots))

    def bin(self, slot: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values between bins lie below each value: halving."""
        found = np.zeros(len(slot), np.int64)
        for step in self.steps:
            found += step * (value > self.cuts[slot, found + step - 1])
        return found


def binned(rows: DataFrame, bins: Bins, trees: int, seed: int) -> DataFrame:
    """``label, codes, drawn``: the codes of a row's entries that lie in another
    bin than 0 does, and how often each tree draws the row (Poisson, mean 1).
    Draws follow from a row's partition and its place there."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isfinite(label).all():
                raise ValueError("labels must not be null, NaN or infinite")
            row, slot, value = entries(batch.column(0))
            codes = bins.base[slot] + bins.bin(slot, value)
            kept = codes != bins.zero[slot]
            ends = np.cumsum(np.bincount(row[kept], minlength=len(label)))
            drawn = draw.poisson(1.0, (len(label), trees)).astype(np.uint8)
            places = np.arange(len(label) + 1, dtype=np.int32) * trees
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(label, pa.float64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(0, ends), pa.int32()), pa.array(codes[kept], pa.int32())
                    ),
                    pa.BinaryArray.from_buffers(
                        pa.binary(), len(label), [None, pa.py_buffer(places), pa.py_buffer(drawn.tobytes())]
                    ),
                ],
                names=["label", "codes", "drawn"],
            )

    return rows.mapInArrow(code, "label double, codes array<int>, drawn binary")


@dataclass
class Trees:
    """Trees as heaps: the children of node i are 2 i + 1 and 2 i + 2."""

    slot: np.ndarray
    cut: np.ndarray
    prediction: np.ndarray

    @classmethod
    def unsplit(cls, trees: int, depth: int, prediction: float) -> Trees:
        shape = (trees, (1 << (depth + 1)) - 1)
        return cls(np.full(shape, -1), np.zeros(shape), np.full(shape, prediction))

    def leaves(self, row: np.ndarray, slot: np.ndarray, value: np.ndarray, default: np.ndarray, rows: int,
               depth: int) -> np.ndarray:
        """(tree, row): the node of at most ``depth`` that each row comes to.
        Rows hold ``value`` at their entries' slots, and ``default`` elsewhere."""
        split = self.slot >= 0
        used, column = np.unique(self.slot[split], return_inverse=True)
        asked, which = np.unique(
            np.stack([column.astype(np.float64), self.cut[split]]), axis=1, return_inverse=True
        )
        test = np.full(self.slot.shape, -1)
        test[split] = which.reshape(-1)
        held = np.repeat(default[used][:, None], rows, axis=1)
        at = np.full(len(default), -1)
        at[used] = np.arange(len(used))
        known = at[slot] >= 0
        held[at[slot[known]], row[known]] = value[known]
        above = np.stack([held[int(c)] > cut for c, cut in asked.T]) if len(asked.T) else np.zeros((1, rows), bool)
        node = np.zeros((len(test), rows), np.int64)
        for tree in range(len(test)):
            here, tests = node[tree], test[tree]
            for _ in range(depth):
                asks = tests[here]
                below = 2 * here + 1 + above[asks, np.arange(rows)]
                here = np.where(asks >= 0, below, here)
            node[tree] = here
        return node


def histograms(rows: DataFrame, bins: Bins, trees: Trees, depth: int) -> DataFrame:
    """Per task, tree and node of a level: draws and drawn labels per code, and
    those of the whole node behind them."""
    first, nodes, width = (1 << depth) - 1, 1 << depth, bins.codes + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = len(trees.slot)
        weight = np.zeros((number, nodes * width))
        total = np.zeros((number, nodes * width))
        bin_of = np.arange(bins.codes) - bins.base[bins.slot]
        for batch in batches:
            n = batch.num_rows
            label = batch.column(0).to_numpy()
            lists = batch.column(1)
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            row, codes = np.repeat(np.arange(n), size), lists.flatten().to_numpy()
            _, _, data = batch.column(2).buffers()
            drawn = np.frombuffer(data, np.uint8, n * number).reshape(n, number)
            node = trees.leaves(row, bins.slot[codes], bin_of[codes], (bins.zero - bins.base).astype(float), n, depth)
            # The node as a whole is one more entry of every row.
            row = np.concatenate([row, np.arange(n)])
            codes = np.concatenate([codes, np.full(n, bins.codes)])
            for tree in range(number):
                # A row that ended in a leaf above this level counts nowhere.
                local = node[tree] - first
                times = np.where(local >= 0, drawn[:, tree], 0).astype(np.float64)
                at = (np.maximum(local, 0) * width)[row] + codes
                weight[tree] += np.bincount(at, times[row], nodes * width)
                total[tree] += np.bincount(at, (times * label)[row], nodes * width)
        for tree in range(number):
            of_node = weight[tree].reshape(nodes, width)
            there = np.flatnonzero(of_node[:, -1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(there), tree, np.int32)), pa.array(there + first, pa.int32()),
                    pa.array([of_node[i].tobytes() for i in there], pa.binary()),
                    pa.array([total[tree].reshape(nodes, width)[i].tobytes() for i in there], pa.binary()),
                ],
                names=["tree", "node", "weight", "total"],
            )

    return rows.mapInArrow(count, NODE)


def best_splits(found: DataFrame, bins: Bins) -> DataFrame:
    """Per tree and node, the split that lowers the squared error most (slot -1
    if none does), by how much, and what the node and its left side hold."""
    last = np.append(bins.base[1:], bins.codes) - 1

    def per_code(parts: pa.ChunkedArray) -> tuple[np.ndarray, float]:
        """The values of all codes summed, and the sum over all rows."""
        held = sum(np.frombuffer(part, np.float64) for part in parts.to_pylist())
        codes, whole = held[:-1].copy(), held[-1]
        codes[bins.zero] += whole - np.add.reduceat(codes, bins.base)
        upto = np.cumsum(codes)
        return upto - (upto[bins.base] - codes[bins.base])[bins.slot], whole

    def best(node: pa.Table) -> pa.Table:
        left, all_weight = per_code(node.column("weight"))
        left_total, all_total = per_code(node.column("total"))
        right, right_total = all_weight - left, all_total - left_total
        possible = (left > 0.5) & (right > 0.5)
        possible[last] = False
        here = all_total * all_total / all_weight
        gain = np.full(bins.codes, -np.inf)
        gain[possible] = (
            left_total[possible] ** 2 / left[possible] + right_total[possible] ** 2 / right[possible] - here
        )
        at = int(gain.argmax())
        splits = gain[at] > 1e-12 * max(here, 1e-300)
        slot, cut = (bins.slot[at], at - bins.base[bins.slot[at]]) if splits else (-1, 0)
        values = [
            node.column("tree")[0].as_py(), node.column("node")[0].as_py(), int(slot), int(cut),
            float(gain[at]) if splits else 0.0, all_weight, all_total, left[at], left_total[at],
        ]
        kinds = [pa.int32()] * 4 + [pa.float64()] * 5
        names = [field.split()[0] for field in SPLIT.split(", ")]
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

    return found.groupBy("tree", "node").applyInArrow(best, SPLIT)


@dataclass(frozen=True)
class ForestModel:
    trees: Trees
    depth: int
    slots: int
    gains: np.ndarray

    @cached_property
    def featureImportances(self) -> DenseVector:
        """The gains of each slot: shares within a tree, averaged over the trees."""
        whole = self.gains.sum(axis=1, keepdims=True)
        shares = np.divide(self.gains, whole, out=np.zeros_like(self.gains), where=whole > 0).sum(axis=0)
        return Vectors.dense(shares / shares.sum() if shares.any() else shares)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``prediction``, the mean over the trees; all columns stay."""
        let_workers_import(rows.sparkSession)
        trees, depth, slots = self.trees, self.depth, self.slots

        @F.arrow_udf("double")
        def predict(vectors: pa.Array) -> pa.Array:
            row, slot, value = entries(vectors)
            leaf = trees.leaves(row, slot, value, np.zeros(slots), len(vectors), depth)
            return pa.array(np.take_along_axis(trees.prediction, leaf, axis=1).mean(axis=0))

        return rows.withColumn("prediction", predict("features"))


@dataclass(frozen=True)
class ForestRegression:
    """Bagged regression trees; every split may take any slot.

    A level of all trees is one pass over the stored bins. Tasks sum draws and
    labels per tree, node and bin, each node's sums meet in a task of their own,
    and only the chosen splits come to the driver.
    """

    label: str
    trees: int
    depth: int
    seed: int

    def fit(self, rows: DataFrame) -> ForestModel:
        let_workers_import(rows.sparkSession)
        rows = rows.select("features", F.col(self.label).cast("double").alias("label"))
        one = rows.first()
        if one is None:
            raise ValueError("a forest needs rows")
        slots = len(one.features)
        cuts = thresholds(rows, slots)
        bins = Bins(cuts)
        stored = materialize(binned(rows, bins, self.trees, self.seed))
        mean = stored.agg(F.avg("label")).first()[0]
        # By bins while the trees grow; at last by values.
        grown = Trees.unsplit(self.trees, self.depth, mean)
        gains = np.zeros((self.trees, slots))
        for depth in range(self.depth):
            splits = best_splits(histograms(stored, bins, grown, depth), bins).collect()
            for s in splits:
                grown.prediction[s.tree, s.node] = s.total / s.weight
                if s.slot >= 0:
                    grown.slot[s.tree, s.node], grown.cut[s.tree, s.node] = s.slot, s.bin
                    left, right = 2 * s.node + 1, 2 * s.node + 2
                    grown.prediction[s.tree, left] = s.left_total / s.left_weight
                    grown.prediction[s.tree, right] = (s.total - s.left_total) / (s.weight - s.left_weight)
                    gains[s.tree, s.slot] += s.gain
            if all(s.slot < 0 for s in splits):
                break
        for at in zip(*np.nonzero(grown.slot >= 0)):
            grown.cut[at] = cuts[grown.slot[at]][int(grown.cut[at])]
        return ForestModel(grown, self.depth, slots, gains)
