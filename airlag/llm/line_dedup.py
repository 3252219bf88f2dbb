"""Deletes later copies of line runs that repeat within or across documents.

Documents are sequences of line ids. Prefix doubling ranks all suffixes by
their first 1, 2, 4, ... lines; the ranks of one round are ordered pairs of
ranks of the round before. Suffixes that agree in their first m lines are an
interval of the suffix array, and two ranks of overlapping blocks name it: that
of the first and that of the last 2^k of the m lines. In an interval that is
long enough all suffixes but the one at the earliest place start a later copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlag.llm.common import materialize

#: A run counts from so many words on; a line counts as one word at least.
MIN_WORDS = 50

_DOC = ["doc_id", "text_hash"]


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per line: document, number, 128-bit id of the line, words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    lines = rows.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1))
    )
    return lines.select(
        *_DOC,
        F.col("pos").alias("line_no"),
        F.xxhash64("col").alias("h1"),
        F.xxhash64("col", F.lit(1)).alias("h2"),
        F.greatest(F.regexp_count("col", F.lit(r"\S+")), F.lit(1)).alias("words"),
    )


def _ranked(keys: DataFrame, name: str, *order: str) -> DataFrame:
    """Stored ranks of distinct keys: numbers that grow in the order of keys.

    A range exchange and a sort within its partitions give the global order;
    numbers need not be dense, so no counts have to be summed.
    """
    in_order = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(in_order.select(*order, F.monotonically_increasing_id().alias(name)))


def _repeated_segments(lines: DataFrame, min_words: int) -> DataFrame:
    """Stretches of repeated lines with enough words, a row per line.

    A line that occurs once ends every run, so only such stretches take part in
    the doubling. ``begin`` is the number of words of the stretch before a line;
    ``left`` and ``right`` are the lines of the shortest run with enough words
    that starts, or ends, at a line (0 where the stretch has none).
    """
    # Pre-aggregated, so a line that a third of all documents share is one row per task.
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    rank0 = _ranked(repeated, "r0", "h1", "h2")
    found = lines.join(rank0, ["h1", "h2"]).select(*_DOC, "line_no", "words", "r0")
    # Rows that repeat a document whole are that document.
    placed = found.repartition(*_DOC).dropDuplicates([*_DOC, "line_no"])
    in_doc = Window.partitionBy(*_DOC).orderBy("line_no")
    placed = placed.withColumn("stretch", F.col("line_no") - F.row_number().over(in_doc))
    stretch = Window.partitionBy(*_DOC, "stretch")
    along = stretch.orderBy("line_no")
    placed = (
        placed.withColumn("end", F.sum("words").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("begin", F.col("end") - F.col("words"))
        .withColumn("total", F.sum("words").over(stretch))
        .where(F.col("total") >= min_words)
    )
    # Every line has a word, so the lines that begin within min_words words of a
    # place are those of the shortest run from there.
    ahead = stretch.orderBy("begin").rangeBetween(0, min_words - 1)
    behind = stretch.orderBy("end").rangeBetween(1 - min_words, 0)
    placed = placed.withColumn("left", F.count("*").over(ahead)).withColumn("right", F.count("*").over(behind))
    left = F.when(F.col("begin") + min_words <= F.col("total"), F.col("left")).otherwise(0)
    right = F.when(F.col("end") >= min_words, F.col("right")).otherwise(0)
    placed = placed.withColumn("left", left.cast("int")).withColumn("right", right.cast("int"))
    longest = F.max(F.greatest("left", "right")).over(stretch)
    return placed.select(*_DOC, "stretch", "line_no", "left", "right", "r0", _level(longest).alias("levels"))


def _level(lines: Column) -> Column:
    """Largest k with 2^k <= lines."""
    return F.floor(F.log2(lines.cast("double"))).cast("int")


def suffix_ranks(segments: DataFrame) -> tuple[DataFrame, int]:
    """Adds ``r1``, ``r2``, ...: the rank of the first 2^k lines from each place.

    (table, largest k). A pair that occurs once is not ranked: no run of that
    length from there repeats, and the place drops out of later rounds. There
    are at most log2(``MIN_WORDS``) rounds, for no shortest run has more lines.
    """
    along = Window.partitionBy(*_DOC, "stretch").orderBy("line_no")
    table = materialize(segments)
    top = table.agg(F.max("levels")).first()[0] or 0
    for k in range(1, top + 1):
        half = f"r{k - 1}"
        # Places without a pair get a key of their own, which none shares.
        apart = -1 - F.pmod(F.xxhash64(*_DOC, "line_no"), F.lit(1 << 40))
        second = F.lead(half, 1 << (k - 1)).over(along)
        paired = materialize(
            table.withColumn("second", F.when((F.col("levels") >= k) & F.col(half).isNotNull(), second))
            .withColumn("a", F.when(F.col("second").isNotNull(), F.col(half)).otherwise(apart))
            .withColumn("b", F.coalesce("second", F.lit(-1)))
            .drop("second")
        )
        pairs = paired.where("b >= 0").groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
        ranks = _ranked(pairs.select("a", "b"), f"r{k}", "a", "b")
        table = materialize(paired.join(ranks, ["a", "b"], "left").drop("a", "b"))
    return table, top


def repeated_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_hash, first_line, last_line`` of every maximal run of
    lines (numbered from 0, both ends included) that is a later copy."""
    lines = materialize(line_table(docs, id_col, text_col))
    table, top = suffix_ranks(_repeated_segments(lines, min_words))
    ranks = [f"r{k}" for k in range(top + 1)]
    stretches = table.groupBy(*_DOC, "stretch").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "left", "right", F.array(*ranks).alias("r")))).alias("at")
    )

    def run(i: Column, size: Column, first: Column) -> Column:
        k = _level(size)
        last = first + size - F.pow(F.lit(2.0), k).cast("int")
        return F.struct(
            size.alias("size"),
            F.get(F.get("at", first)["r"], k).alias("a"),
            F.get(F.get("at", last)["r"], k).alias("b"),
            F.get("at", first)["line_no"].alias("line_no"),
        )

    def both(x: Column, i: Column) -> Column:
        return F.array(
            F.when(x["left"] > 0, run(i, x["left"], i)),
            F.when(x["right"] > 0, run(i, x["right"], i - x["right"] + 1)),
        )

    runs = stretches.select(*_DOC, F.explode(F.flatten(F.transform("at", both))).alias("run"))
    runs = materialize(
        runs.select(*_DOC, "run.*").where("a is not null and b is not null").distinct()
    )
    # Text hashes order documents with equal ids.
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), "text_hash", "line_no")
    first = materialize(
        runs.groupBy("size", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    )
    later = runs.join(first, ["size", "a", "b"]).where(place > F.col("first"))
    # Runs that touch or overlap become one.
    in_doc = Window.partitionBy(*_DOC).orderBy("line_no", "last_line")
    before = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    spans = later.select(*_DOC, "line_no", (F.col("line_no") + F.col("size") - 1).alias("last_line"))
    fresh = F.col("line_no") > F.coalesce(F.max("last_line").over(before), F.lit(-2)) + 1
    spans = spans.withColumn("fresh", fresh.cast("int")).withColumn("island", F.sum("fresh").over(in_doc))
    return spans.groupBy(*_DOC, "island").agg(
        F.min("line_no").alias("first_line"), F.max("last_line").alias("last_line")
    ).drop("island")


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without later copies, one row per input row.

    All columns stay; ``text`` loses the deleted lines, and ``n_lines``,
    ``n_removed`` and ``removed`` (first and last line of every deleted run, in
    order) are added; columns of these names in the input are replaced. The
    earliest place of a run, by document id and line number, always stays, so
    every line is left somewhere. A null text has no repeated lines and stays
    null; an empty one is one empty line. Null ids come before all others. Rows
    that repeat both id and text are one document: they lose the same lines.
    """
    runs = repeated_runs(docs, min_words, id_col, text_col)
    cuts = runs.groupBy(*_DOC).agg(
        F.array_sort(F.collect_list(F.struct("first_line", "last_line"))).alias("cuts")
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    keyed = packed.withColumn("id", F.col("row")[id_col].cast("long")).withColumn("hash", F.xxhash64(text))
    joined = keyed.join(
        cuts, F.col("id").eqNullSafe(cuts["doc_id"]) & (F.col("hash") == cuts["text_hash"]), "left"
    )
    kept = F.filter(
        F.split(F.col("row")[text_col], "\n", -1),
        lambda line, i: ~F.exists("cuts", lambda c: i.between(c["first_line"], c["last_line"])),
    )
    no_cut = F.array().cast("array<struct<first_line: int, last_line: int>>")
    removed = F.coalesce("cuts", no_cut)
    lengths = F.transform(removed, lambda c: c["last_line"] - c["first_line"] + 1)
    added = {
        "n_lines": F.size(F.split(text, "\n", -1)).cast("long"),
        "n_removed": F.aggregate(lengths, F.lit(0), lambda a, b: a + b).cast("long"),
        "removed": removed,
    }
    shown = F.when(F.col("cuts").isNull(), F.col("row")[text_col]).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[
            (shown if c == text_col else F.col("row")[c]).alias(c)
            for c in docs.columns if c not in added
        ],
        *[value.alias(name) for name, value in added.items()],
    )
