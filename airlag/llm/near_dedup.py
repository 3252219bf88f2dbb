"""Near duplicates by Order MinHash, verified by banded alignment.

A k-mer is five words, labelled with how often it has occurred in the text
before, so all labelled k-mers of a text differ. Each of several hash functions
samples the ``SAMPLE`` labelled k-mers with the smallest values; kept in text
order, they are one sketch. Texts that share a sketch are candidates, and
candidates are aligned: with distinct k-mers the best alignment is the longest
increasing run of matched places, within a band that every alignment of the
asked similarity stays in. Similarity is matched k-mers over all k-mers of both.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlag.llm.common import balanced, join_grown, materialize, strings
from airlag.llm.components import components
from airlag.llm.fingerprints import mix, shingle_hashes

WORDS, SIMILARITY = 5, 0.8
#: Sketches per text, k-mers per sketch, and sketches that texts are grouped by:
#: two texts of similarity 0.8 share each with a chance of 0.64, and none of 16
#: with one of 8e-8.
SKETCHES, SAMPLE, GROUPED = 64, 2, 16
#: Shared sketches below which a pair of a small group is not aligned: at
#: similarity 0.8 fewer than 18 of 64 have a chance of 1e-9.
LEAST_SHARED = 18
#: Up to so many texts in a group, its pairs are candidates one by one.
SMALL_GROUP = 16
#: Texts of a larger group that are held against each other in one task, and
#: their k-mers; k-mers of fewer texts than this are counted pair by pair.
TILE, TILE_KMERS, RARE, COLUMNS = 1024, 1 << 20, 40, 4096
CHUNK_BYTES = 1 << 20

_SEEDS = np.array([pow(0xD1B54A32D192ED03, 2 * i + 3, 1 << 64) for i in range(SKETCHES)], np.uint64)
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def labelled_kmers(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every labelled k-mer in text order, k-mers per text)."""
    hashes, sizes = shingle_hashes(texts, words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, owner))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    # Place in a run of equal k-mers; lexsort keeps text order within a run.
    at = np.arange(len(hashes))
    label = np.empty(len(hashes), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    return mix(hashes + label * np.uint64(0x9E3779B97F4A7C15)), sizes


def order_sketches(kmers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of ``SKETCHES`` 64-bit sketches per text; texts without k-mers
    have zeros."""
    found = np.zeros((len(sizes), SKETCHES), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return found
    begins = (np.cumsum(sizes) - sizes)[some]
    counts = sizes[some]
    for i, seed in enumerate(_SEEDS):
        values = mix(kmers ^ seed)
        places = []
        for _ in range(SAMPLE):
            least = np.minimum.reduceat(values, begins)
            hits = np.flatnonzero(values == np.repeat(least, counts))
            at = hits[np.searchsorted(hits, begins)]
            places.append(np.where(least == _MAX, np.int64(-1), at))
            values[at] = _MAX
        sketch = np.zeros(len(some), np.uint64)
        for at in np.sort(np.stack(places), axis=0):
            sketch = mix(sketch * np.uint64(3) + np.where(at < 0, np.uint64(1), kmers[at]))
        found[some, i] = sketch
    return found


def sketch_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, h1, h2, kmers, keys, marks``: a 128-bit hash of each text, how
    many k-mers it has, the sketches that texts are grouped by, and the low 16
    bits of all sketches."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"), "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(3))
            for part in balanced(texts, CHUNK_BYTES):
                kmers, sizes = labelled_kmers(texts[part])
                found = order_sketches(kmers, sizes)
                keys = np.ascontiguousarray(found[:, :GROUPED]).view(np.int64)
                marks = found.astype(np.uint16).view(np.int16)
                lists = [
                    pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(kind))
                    for x, kind in ((keys, pa.int64()), (marks, pa.int16()))
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i)[part] for i in range(3)), pa.array(sizes, pa.int64()), *lists],
                    names=["doc_id", "h1", "h2", "kmers", "keys", "marks"],
                )

    return rows.mapInArrow(
        make, "doc_id long, h1 long, h2 long, kmers long, keys array<long>, marks array<smallint>"
    )


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned k-mers over all k-mers of two texts, 0 where it is below ``least``.

    An alignment of similarity s leaves at most (1 - s) / (1 + s) of both texts'
    k-mers unmatched, and so stays that close to the diagonal.
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    band = int((1 - least) / (1 + least) * total + 1e-9)
    if abs(len(a) - len(b)) > band:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    inside = np.abs(i - j) <= band
    i, j = i[inside], j[inside]
    if len(i) < least * (total - len(i)) - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    matched = len(j)
    if (np.diff(j) < 0).any():
        tails: list[int] = []
        for x in j.tolist():
            at = bisect_left(tails, x)
            tails[at : at + 1] = [x]
        matched = len(tails)
    value = matched / (total - matched)
    return value if value >= least - 1e-12 else 0.0


def group_members(nodes: DataFrame) -> DataFrame:
    """``group, node, n, tiles``: the texts of each group of two or more that
    share a sketch. ``tiles`` is 0 for small groups, else the number of parts
    that a group is compared in."""
    keys = [F.struct(F.lit(i).alias("i"), F.col("keys")[i].alias("k")) for i in range(GROUPED)]
    each = nodes.select("node", "kmers", F.explode(F.array(*keys)).alias("g"))
    members = each.select("node", "kmers", F.xxhash64("g.*").alias("group"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n"), F.sum("kmers").alias("kmers")).where("n > 1")
    tiles = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("kmers") / TILE_KMERS))
    sizes = sizes.select("group", "n", F.when(F.col("n") > SMALL_GROUP, tiles).otherwise(0).alias("tiles"))
    return join_grown(members.drop("kmers"), sizes, ["group"])


def candidate_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, shared``: pairs of small groups that share enough sketches."""
    lists = members.where("tiles = 0").groupBy("group").agg(F.sort_array(F.collect_list("node")).alias("at"))

    def with_smaller(b: Column, i: Column) -> Column:
        return F.transform(F.slice("at", 1, i), lambda a: F.struct(a.alias("a"), b.alias("b")))

    pairs = lists.select(F.explode(F.flatten(F.transform("at", with_smaller))).alias("p")).select("p.*").distinct()
    with_a = join_grown(pairs, nodes.select(F.col("node").alias("a"), F.col("marks").alias("ma")), ["a"])
    with_b = join_grown(with_a, nodes.select(F.col("node").alias("b"), F.col("marks").alias("mb")), ["b"])
    shared = F.size(F.filter(F.zip_with("ma", "mb", lambda x, y: x == y), lambda same: same))
    return with_b.select("a", "b", shared.alias("shared")).where(F.col("shared") >= LEAST_SHARED)


def overlaps(kmers: list[np.ndarray]) -> np.ndarray:
    """How many labelled k-mers every two texts have in common.

    A matrix of texts by k-mers, times its transpose, in stretches of columns;
    k-mers of few texts are counted by their pairs instead.
    """
    n = len(kmers)
    distinct, column, count = np.unique(np.concatenate(kmers), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(k) for k in kmers])
    order = np.argsort(column, kind="stable")
    owner, count_of = owner[order], np.repeat(count, count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    both = np.zeros(n * n, np.float32)
    few = np.flatnonzero((count_of > 1) & (count_of <= RARE))
    for step in range(1, RARE):
        few = few[place[few] + step < count_of[few]]
        if not len(few):
            break
        both += np.bincount(owner[few] * n + owner[few + step], minlength=n * n)
    both = both.reshape(n, n)
    both += both.T
    number = np.cumsum(count > RARE) - 1
    many = np.flatnonzero(count_of > RARE)
    at = np.repeat(number, count)[many]
    for begin in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        low, high = np.searchsorted(at, [begin, begin + COLUMNS])
        matrix = np.zeros((n, COLUMNS), np.float32)
        matrix[owner[many[low:high]], at[low:high] - begin] = 1
        both += matrix @ matrix.T
    return both


def spanning_links(node: np.ndarray, label: np.ndarray, side: np.ndarray, kmers: list[np.ndarray], least: float):
    """Links that connect what links of at least ``least`` connect, of pairs of
    different sides, or of any pair where there is one side.

    The share of common k-mers bounds the similarity of any alignment, so only
    pairs above it are aligned, the most alike first, and none whose texts are
    already connected. What comes out is a forest, however alike the texts are.
    """
    sizes = np.array([len(k) for k in kmers])
    both = overlaps(kmers)
    enough = both >= least * (sizes[:, None] + sizes[None, :] - both) - 1e-3
    enough &= side[:, None] != side[None, :] if side.any() and not side.all() else True
    a, b = np.nonzero(np.triu(enough, 1))
    order = np.argsort(-both[a, b] / (sizes[a] + sizes[b] - both[a, b]), kind="stable")
    _, parent = np.unique(label, return_inverse=True)
    parent = parent.tolist()
    group = list(range(max(parent, default=-1) + 1))

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    links = []
    for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
        x, y = find(parent[i]), find(parent[j])
        if x != y and similarity(kmers[i], kmers[j], least) > 0:
            group[x] = y
            links.append(sorted((int(node[i]), int(node[j]))))
    return links


def tile_links(units: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The spanning links of all units (``unit, node, label, side``)."""

    def compare(table: pa.Table) -> pa.Table:
        spelled = strings(table.column("text").combine_chunks())
        kmers = []
        for part in balanced(spelled, CHUNK_BYTES):
            found, sizes = labelled_kmers(spelled[part])
            kmers += np.split(found, np.cumsum(sizes)[:-1])
        node, label, side = (table.column(c).to_numpy() for c in ("node", "label", "side"))
        links = spanning_links(node, label, side.astype(bool), kmers, least)
        return pa.table(
            [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    held = join_grown(units, texts, ["node"]).select("unit", "node", "label", "side", "text")
    return held.groupBy("unit").applyInArrow(compare, "a long, b long")


def _tiled(tiles: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("tile"), "group", "node"), tiles).cast("int")


def first_units(members: DataFrame) -> DataFrame:
    """Units of large groups: a group of one tile whole; of a larger one the
    first tile, which leads, against each other tile."""
    rows = members.where("tiles > 0").withColumn("tile", _tiled(F.col("tiles")))
    others = F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int"))
    met = rows.withColumn("met", F.explode(F.when(F.col("tile") == 0, others).otherwise(F.array("tile"))))
    side = ((F.col("tile") == 0) & (F.col("met") > 0)).cast("int")
    return met.select(F.xxhash64("group", "met").alias("unit"), "node", F.col("node").alias("label"), side.alias("side"))


def last_units(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Units of groups of several tiles that are not one component: the texts
    outside the group's largest component, in tiles of their own, against all."""
    label = F.coalesce("label", "node").alias("label")
    named = members.where("tiles > 1").join(labels, "node", "left").select("group", "node", "tiles", label)
    parts = named.groupBy("group", "label").agg(F.count("*").alias("texts"), F.first("tiles").alias("tiles"))
    largest = parts.groupBy("group").agg(
        F.max_by("label", F.struct("texts", "label")).alias("most"), F.count("*").alias("parts"),
        F.sum("texts").alias("all"), F.max("texts").alias("in_most"), F.first("tiles").alias("of"),
    ).where("parts > 1")
    aside = F.ceil((F.col("all") - F.col("in_most")) * F.col("of") / F.col("all"))
    open_ = join_grown(named, largest.select("group", "most", aside.alias("aside")), ["group"])
    x, y = (_tiled(F.col(c)) for c in ("aside", "tiles"))
    every_x, every_y = (F.explode(F.sequence(F.lit(0), (F.col(c) - 1).cast("int"))) for c in ("aside", "tiles"))
    leading = open_.where("label <> most").select("*", x.alias("x"), every_y.alias("y"), F.lit(1).alias("side"))
    met = open_.select("*", every_x.alias("x"), y.alias("y"), F.lit(0).alias("side"))
    return leading.unionByName(met).select(F.xxhash64("group", "x", "y").alias("unit"), "node", "label", "side")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs whose alignment has the asked similarity. ``texts``: node, text."""
    first = join_grown(pairs, texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), ["a"])
    both = join_grown(first, texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), ["b"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = strings(batch.column(2)), strings(batch.column(3))
            for part in balanced(left, CHUNK_BYTES):
                sides = []
                for column in (left, right):
                    kmers, sizes = labelled_kmers(column[part])
                    sides.append(np.split(kmers, np.cumsum(sizes)[:-1]))
                for row, (x, y) in enumerate(zip(*sides, strict=True), part.start):
                    keep[row] = similarity(x, y, least) > 0
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "ta", "tb").mapInArrow(align, "a long, b long")


def _texts_of(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """``node, text`` for the nodes in ``wanted`` (node, h1, h2)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(
        F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"), text.alias("text")
    )
    # Of equal texts one is enough.
    return join_grown(hashed, wanted, ["h1", "h2"]).groupBy("node").agg(F.first("text").alias("text"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not connected."""
    for side in ("a", "b"):
        named = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = pairs.join(named, side, "left")
    return pairs.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def text_classes(
    docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, h1, h2`` per row, ``h1, h2, class_id, stays`` per text).

    A class holds the texts that links of at least ``least`` connect, and its id
    is the smallest document id in it. Equal texts are one text from the start,
    so any number of exact copies costs one candidate; null and empty texts are
    equal. A text of fewer than five words is one k-mer. Texts that share a
    sketch are a group. The texts of a large group are held against each other
    in tiles, whose tasks pass on the links of a forest, not all links; a group
    of more than one tile goes on, if its first tile has not connected it, with
    all texts outside its largest component. Of a small group each text is
    aligned with its best candidate first, then only across what is not yet
    connected. ``stays`` marks one text of each class: of those that carry the
    smallest id, the one with the smallest hash. Very long texts are single
    k-mer arrays of their own (8 bytes a word), never cut.

    Texts are fetched once, for all that share a sketch with another text.
    """
    table = materialize(sketch_table(docs, id_col, text_col))
    by_text = table.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("kmers", "keys", "marks")]
    )
    nodes = materialize(by_text.withColumn("node", F.monotonically_increasing_id()))
    keyed = nodes.where(F.col("keys")[0] != 0)
    members = materialize(group_members(keyed))
    pairs = materialize(candidate_pairs(members, keyed))
    wanted = _ends(pairs).unionAll(members.where("tiles > 0").select("node")).distinct()
    wanted = join_grown(nodes.select("node", "h1", "h2"), wanted, ["node"])
    texts = materialize(_texts_of(docs, wanted, text_col))

    best = F.max(F.struct("shared", (-F.col("a")).alias("a")))
    nearest = pairs.groupBy("b").agg(best.alias("best")).select((-F.col("best.a")).alias("a"), "b")
    found = verified(nearest, texts, least).unionAll(tile_links(first_units(members), texts, least))
    links = materialize(found)
    labels = components(links)
    rest = verified(_apart(pairs.join(nearest, ["a", "b"], "left_anti"), labels), texts, least)
    more = materialize(rest.unionAll(tile_links(last_units(members, labels), texts, least)))
    if not more.isEmpty():
        labels = components(links.unionAll(more))

    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Null ids come last here, so a class is named by an id wherever it has one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")).alias("first")
    classes = named.groupBy("label").agg(first)
    stays = (F.col("h1") == F.col("first.h1")) & (F.col("h2") == F.col("first.h2"))
    of_text = named.join(classes, "label").select(
        "h1", "h2", F.col("first.doc_id").alias("class_id"), stays.alias("stays")
    )
    return table.select("doc_id", "h1", "h2"), materialize(of_text)


def near_duplicates(
    docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, class_id``, one row per input row; see ``text_classes``.

    Rows with a null id come out with the class of their text (null where no
    row of the class has an id).
    """
    rows, of_text = text_classes(docs, least, id_col, text_col)
    return rows.join(of_text, ["h1", "h2"]).select("doc_id", "class_id")


def keep_one(
    docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of every class, with all its columns: that of the smallest id.

    Rows are joined on id and text, so the copies of a text that a third of all
    rows share do not meet. Of rows that repeat both, one stays, the one whose
    other columns have the smallest hash.
    """
    _, of_text = text_classes(docs, least, id_col, text_col)
    staying = of_text.where("stays").select("h1", "h2", "class_id")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    keyed = packed.select(
        "row", F.col("row")[id_col].cast("long").alias("id"), F.xxhash64(text).alias("h1"),
        F.xxhash64(text, F.lit(1)).alias("h2"),
    )
    found = join_grown(
        keyed,
        staying.withColumnsRenamed({"h1": "k1", "h2": "k2"}),
        (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & F.col("id").eqNullSafe(F.col("class_id")),
    )
    others = [F.col("row")[c] for c in docs.columns if c != text_col]
    same = Window.partitionBy("h1", "h2", "id").orderBy(F.xxhash64(*others))
    return found.withColumn("nth", F.row_number().over(same)).where("nth = 1").select("row.*")
