"""Exact "k first rows" choices without a global sort.

Rows are ordered by a hash. Counting rows per hash prefix tells which prefix
the k-th row has; rows below it are in, rows above it are out, and only the
rows that share it have to be ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Five hex digits: the prefix table has at most 1,048,576 rows per group.
PREFIX = 5
PAST_ALL = "g"
#: A stored column that holds the order hash of a table's rows.
ORDER_KEY = "__order_key"
CHUNK = 100_000


def order_hash(columns: Sequence[str], seed: int) -> Column:
    """md5 over the seed and the columns' text; nulls are left out."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def with_order_key(df: DataFrame, columns: Sequence[str], seed: int) -> DataFrame:
    """``df`` with its order hash as a column, to be stored: every later choice
    by ``seed`` over ``columns`` then reads it, and hashes no row again."""
    return df if ORDER_KEY in df.columns else df.withColumn(ORDER_KEY, order_hash(columns, seed))


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as ``times`` says. The copies are unfolded in pieces
    that are spread over the tasks, so a huge count is not one task's work."""
    columns = [c for c in df.columns if c != times]
    last_piece = F.floor((F.col(times) - 1) / CHUNK)
    pieces = df.where(F.col(times) > 0).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), last_piece))
    )
    size = F.least(F.lit(CHUNK), F.col(times) - F.col("piece") * CHUNK).cast("int")
    return (
        pieces.repartition("piece", *columns)
        .select(*columns, F.explode(F.sequence(F.lit(1), size)).alias("copy"))
        .drop("copy")
    )


def join_null_safe(df: DataFrame, other: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on ``by`` in which null equals null; the columns of ``by``
    come from ``df``. ``other`` has one row per class, few by nature, and goes
    to every task: Spark cannot tell so from a count over a large table, and
    would deal all of ``df`` by class, that is, to as few tasks as classes."""
    renamed = F.broadcast(other.withColumnsRenamed({c: f"{c}__key" for c in by}))
    same = [F.col(c).eqNullSafe(F.col(f"{c}__key")) for c in by]
    return df.join(renamed, same).drop(*[f"{c}__key" for c in by])


def cut_points(df: DataFrame, take: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: the prefix of the ``take``-th row and how many rows of that
    prefix are still in. ``df`` has the column ``prefix``."""
    counts = df.groupBy(*by, "prefix").agg(F.count(F.lit(1)).alias("rows"))
    running = Window.partitionBy(*by).orderBy("prefix")
    ranked = counts.withColumn(
        "upto", F.sum("rows").over(running.rowsBetween(Window.unboundedPreceding, 0))
    )
    edge = (F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("rows") < F.col("take"))
    if by:
        joined = join_null_safe(ranked, take, by)
    else:
        joined = ranked.withColumn("take", take.select("take").scalar())
    return (
        joined.groupBy(*by)
        .agg(
            F.max("take").alias("take"),
            F.max(F.when(edge, F.col("prefix"))).alias("edge"),
            F.max(F.when(edge, F.col("take") - F.col("upto") + F.col("rows"))).alias("left_over"),
        )
        .select(
            *by,
            F.when(F.col("take") <= 0, "")
            .otherwise(F.coalesce("edge", F.lit(PAST_ALL)))
            .alias("cut"),
            F.coalesce("left_over", F.lit(0)).alias("left_over"),
        )
    )


def mark_first(
    df: DataFrame,
    take: DataFrame,
    hash_columns: Sequence[str],
    seed: int,
    by: Sequence[str] = (),
    keep_rest: bool = True,
) -> DataFrame:
    """``df`` with ``chosen``: true for the ``take`` first rows of each group.

    ``take`` holds one row per group ``by`` with the column ``take``; the groups
    are classes, few by nature. ``df`` is read a few times, so it should be
    stored, with its ``ORDER_KEY``, which is hashed here only where it is
    missing. Rows of the cut prefix are
    collapsed to one row per distinct content with its number of copies, which
    keeps a large group of copies out of any single task.
    """
    columns = [c for c in df.columns if c != ORDER_KEY]
    kept = df.columns
    hashed = with_order_key(df, hash_columns, seed)
    hashed = hashed.withColumn("prefix", F.substring(ORDER_KEY, 1, PREFIX))
    cuts = cut_points(hashed, take, by)
    if by:
        placed = join_null_safe(hashed, cuts, by)
    else:
        placed = hashed.withColumn(
            "at", cuts.select(F.struct("cut", "left_over")).scalar()
        ).select("*", "at.*")
    inside, outside = F.col("prefix") < F.col("cut"), F.col("prefix") > F.col("cut")
    clear = placed.where(inside | outside if keep_rest else inside).select(
        *kept, inside.alias("chosen")
    )

    first = Window.partitionBy(*by).orderBy(ORDER_KEY, *columns)
    tied = (
        placed.where(F.col("prefix") == F.col("cut"))
        .groupBy(*columns, ORDER_KEY, "left_over")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn(
            "upto", F.sum("copies").over(first.rowsBetween(Window.unboundedPreceding, 0))
        )
    )
    before = F.col("upto") - F.col("copies")
    picked = F.greatest(F.lit(0), F.least(F.col("copies"), F.col("left_over") - before))
    shares = [F.struct(F.lit(True).alias("chosen"), picked.alias("times"))]
    if keep_rest:
        rest = F.col("copies") - picked
        shares.append(F.struct(F.lit(False).alias("chosen"), rest.alias("times")))
    tied = tied.select(*kept, F.inline(F.array(*shares)))
    return clear.unionByName(repeat_rows(tied, "times"))


def sample_exact(
    df: DataFrame, n: int, seed: int, hash_columns: Sequence[str] | None = None
) -> DataFrame:
    """Exactly ``n`` rows, or all rows if there are no more than ``n``."""
    take = df.sparkSession.range(1).select(F.lit(n).cast("bigint").alias("take"))
    marked = mark_first(df, take, hash_columns or df.columns, seed, keep_rest=False)
    return marked.drop("chosen", ORDER_KEY)


def test_sizes(df: DataFrame, label: str, fraction: tuple[int, int]) -> DataFrame:
    """Test rows per class as ``take``: the total is rounded up, the training
    rows are shared out in proportion, and the largest remainders get the rows
    still missing (the smaller label wins a tie)."""
    part, whole = fraction
    every = Window.partitionBy(F.lit(0))
    wide = "decimal(38,0)"
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.withColumn("total", F.sum("rows").over(every))
    sizes = sizes.withColumn(
        "train", F.col("total") - F.expr(f"(total * {part} + {whole - 1}) div {whole}")
    )
    product = F.col("train").cast(wide) * F.col("rows").cast(wide)
    sizes = sizes.withColumns(
        {
            "share": F.floor(product / F.col("total").cast(wide)).cast("bigint"),
            "remainder": product % F.col("total").cast(wide),
        }
    )
    sizes = sizes.withColumns(
        {
            "missing": F.col("train") - F.sum("share").over(every),
            "turn": F.row_number().over(every.orderBy(F.desc("remainder"), label)),
        }
    )
    extra = F.when(F.col("turn") <= F.col("missing"), 1).otherwise(0)
    return sizes.select(label, (F.col("rows") - F.col("share") - extra).alias("take"))


def stratified_split(
    df: DataFrame,
    label: str,
    seed: int,
    fraction: tuple[int, int] = (1, 5),
    hash_columns: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with ``is_test``; every class is split in the same proportion."""
    take = test_sizes(df, label, fraction)
    marked = mark_first(df, take, hash_columns or df.columns, seed, by=[label])
    return marked.withColumnRenamed("chosen", "is_test")
