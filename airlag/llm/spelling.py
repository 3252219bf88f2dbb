"""Groups spelling variants: words one edit apart, each under its commonest form.

Words of one length, or of two adjacent lengths, make a block of letter counts.
The product of two blocks gives the squared distances of all their rows at once
(|a|^2 + |b|^2 - 2ab): one replaced letter is a distance of 2 at most, one
inserted or deleted letter one of 1. Pairs at a distance of at most two go on to
the exact check of the edit. Blocks are cut further: one edit leaves the first
or the last half of the shorter word as it is, so only words that share a half
meet, and a large block is cut into tiles that meet two by two in tasks of their
own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import materialize

MIN_LENGTH, MIN_COUNT, STEP = 5, 3, 97
#: Words of one block that meet in one task, rows of a task's group of blocks,
#: and letters (columns of the count matrices) that code points are folded into.
TILE, GROUP_ROWS, LETTERS = 2048, 1 << 15, 48
#: Code points of a tile at most, and of the pairs that are checked at once.
TILE_CHARS, CHECK_CHARS = 1 << 17, 1 << 22

_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, n``: runs of letters, lower-cased in A-Z only, with a letter left
    out where 97 divides the hash of document and run.

    A null text has no runs; a null id counts as the empty text in the hash.
    Rows that repeat count as often as they stand there. Counts are summed
    before they move, so a word that a third of all texts share is one row per
    task.
    """
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = F.explode(F.regexp_extract_all(F.translate(text_col, _UPPER, _LOWER), F.lit(_RUN), F.lit(0)))
    found = docs.select(name.alias("id"), runs.alias("run")).where(F.length("run") >= min_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    less = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))
    )
    word = F.when(h % STEP == 0, less).otherwise(F.col("run"))
    counts = found.select(word.alias("word")).where(F.length("word") >= min_length)
    return counts.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _memberships(words: DataFrame) -> DataFrame:
    """(block, short, length, half, word, n): the four blocks of every word.

    A block is a side, the length of the shorter word and its half on that
    side: of a word itself, or of a word shorter by one that it may extend.
    """
    size = F.length("word")

    def block(side: str, short: Column) -> Column:
        half = F.floor(short / 2).cast("int")
        shared = (
            F.substring("word", F.lit(1), half) if side == "first" else F.substring("word", size - half + 1, half)
        )
        return F.struct(
            F.xxhash64(F.lit(side), short, shared).alias("block"),
            (size == short).alias("short"),
            F.lit(side == "last").alias("last"),
            half.alias("half"),
        )

    blocks = [block(side, short) for side in ("first", "last") for short in (size, size - 1)]
    return words.select(F.explode(F.array(*blocks)).alias("b"), "word", "n").select("b.*", "word", "n")


def _units(members: DataFrame) -> DataFrame:
    """Adds ``unit`` and ``side``: the pairs of tiles that a row takes part in.

    A block of up to ``TILE`` words (fewer of very long ones) is one unit. In a
    larger one words fall into tiles by hash, and every two tiles are a unit.
    """
    chars = F.sum(F.length("word")).alias("chars")
    sizes = members.groupBy("block").agg(F.count("*").alias("rows"), chars)
    tiles = F.greatest(F.ceil(F.col("rows") / TILE), F.ceil(F.col("chars") / TILE_CHARS)).cast("int")
    large = sizes.select("block", tiles.alias("tiles")).where("tiles > 1")
    rows = members.join(large, "block", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tile = F.pmod(F.xxhash64(F.lit("tile"), "word"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    met = rows.withColumn("tile", tile).select("*", other)
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    return met.select(
        F.xxhash64("block", low, high).alias("unit"),
        (F.col("tile") > F.col("other")).alias("right"),
        (F.col("tile") == F.col("other")).alias("alone"),
        "short", "last", "half", "word", "n",
    )


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all code points, code points per word)."""
    spelled = words.to_pylist()
    sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
    return np.frombuffer("".join(spelled).encode("utf-32-le"), np.uint32), sizes


def letter_counts(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of letter counts per word. Folding code points into fewer letters
    can only bring words nearer, so no pair is lost by it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    cells = owner * LETTERS + points % LETTERS
    return np.bincount(cells, minlength=len(sizes) * LETTERS).reshape(-1, LETTERS).astype(np.float32)


def near_in_counts(a: np.ndarray, b: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks at a squared distance of at most ``most``."""
    gram = a @ b.T
    gram *= -2
    gram += np.einsum("ij,ij->i", a, a)[:, None]
    gram += np.einsum("ij,ij->i", b, b)[None, :]
    return np.nonzero(gram <= most + 0.5)


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two equally wide matrices differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``b``, one wider, are those of ``a`` with one more point."""
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= a.shape[1]


def _matrix(points: np.ndarray, begins: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    return points[begins[rows][:, None] + np.arange(width)]


def _near_pairs(
    points: np.ndarray, begins: np.ndarray, counts: np.ndarray,
    a: np.ndarray, b: np.ndarray, width: int, longer: bool, last: bool, half: int, within: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """Checked pairs of the rows ``a``, of one width, and ``b``, as wide or one
    wider. Pairs that share the first half belong to the block of that half."""
    p, q = near_in_counts(counts[a], counts[b], 1 if longer else 2)
    if within:
        keep = p < q
        p, q = p[keep], q[keep]
    found = []
    step = max(1, CHECK_CHARS // (width + 1))
    for i in range(0, len(p), step):
        x, y = a[p[i : i + step]], b[q[i : i + step]]
        left, right = _matrix(points, begins, x, width), _matrix(points, begins, y, width + longer)
        good = inserted(left, right) if longer else replaced(left, right)
        if last:
            good &= (left[:, :half] != right[:, :half]).any(axis=1)
        found.append((x[good], y[good]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _summed(word: np.ndarray, near: np.ndarray, n: np.ndarray, spelled: list[str]) -> pa.Table:
    """Per word of the pairs: how many words are near, and the best of them."""
    rank = np.empty(len(spelled), np.int64)
    rank[sorted(range(len(spelled)), key=spelled.__getitem__)] = np.arange(len(spelled))
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(word)))
    best = near[first]
    return pa.table(
        [
            pa.array([spelled[i] for i in word[first]], pa.string()), pa.array(size),
            pa.array(n[best]), pa.array([spelled[i] for i in best], pa.string()),
        ],
        names=["word", "near", "best_n", "best"],
    )


def _compare(rows: pa.Table) -> pa.Table:
    """The near pairs of all units in ``rows``, summed by word."""
    rows = rows.sort_by("unit")
    spelled = rows.column("word").combine_chunks()
    points, sizes = code_points(spelled)
    begins = np.cumsum(sizes) - sizes
    counts = letter_counts(points, sizes)
    unit, n, short, right, last, alone, half = (
        rows.column(c).to_numpy() for c in ("unit", "n", "short", "right", "last", "alone", "half")
    )
    bounds = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]]))
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - begin < 2:
            continue
        at = np.arange(begin, end)
        small, side = short[begin:end], right[begin:end]
        if not small.any():
            continue
        width = int(sizes[begin:end][small][0])
        call = (bool(last[begin]), int(half[begin]))
        if alone[begin]:
            s, t = at[small], at[~small]
            units = [(s, s, False, True), (s, t, True, False)]
        else:
            s, t = at[small & ~side], at[small & side]
            units = [(s, t, False, False), (s, at[~small & side], True, False), (t, at[~small & ~side], True, False)]
        for a, b, longer, within in units:
            if len(a) and len(b):
                found.append(_near_pairs(points, begins, counts, a, b, width, longer, *call, within))
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    return _summed(np.concatenate([a, b]), np.concatenate([b, a]), n, spelled.to_pylist())


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have a near word; ``best``
    is the near word that occurs most (ties: the smallest). ``words`` is stored.

    Units, not single pairs, are the groups of the Python side, many to a group;
    what leaves it is one row per word and unit, not one per pair.
    """
    units = materialize(_units(_memberships(words)))
    groups = max(1, -(-units.count() // GROUP_ROWS))
    held = units.withColumn("lot", F.pmod("unit", F.lit(groups)))
    found = held.groupBy("lot").applyInArrow(_compare, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from a stored ``word, form``: the last form from each word.

    Every round each word takes the root of its root, so chains halve. A form
    occurs at least twice as often as its word, so there are no circles and the
    rounds are as few as the logarithm of the logarithm of the largest count.
    """
    rooted = materialize(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        jump = rooted.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            rooted.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        )
        rooted = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            return rooted


def spelling_variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    factor: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, n, n_near, form, form_n, root``, one row per word of the corpus.

    ``form`` is the near word that occurs most, where it occurs at least
    ``factor`` times as often as the word, else null; ``root`` is the last word
    on the way along forms. Empty tables and texts without words give no rows;
    of near words that occur equally often the smallest counts. Texts of any
    length are read whole, and so are words of any length.
    """
    words = materialize(word_counts(docs, min_length, min_count, id_col, text_col))
    found = words.join(near_words(words), "word", "left")
    good = F.col("best_n") >= factor * F.col("n")
    formed = materialize(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"),
        )
    )
    return formed.join(roots(formed), "word")
