"""CSV inputs and small CSV outputs."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlag.functions.columns import decoded_path
from airlag.session import list_folder, path_exists

QUOTE = '"'
# Columns beside the cells, named so that no header has them.
PATH, FILE = "__path", "__file"


@dataclass(frozen=True)
class CsvFile:
    """One input file with the schema that all its cells fit.

    ``layout`` tells how its records are found: each line is one (``LINES``),
    lines are put together by their quotes (``QUOTED``), or the file is read
    from its start to its end by one task (``WHOLE``).
    """

    path: str
    name: str
    schema: T.StructType
    empty: bool
    layout: str = "lines"


LINES, QUOTED, WHOLE = "lines", "quoted", "whole"
# A record whose quotes open and close cells and nothing else.
_CELL = r'(?:[^",\n]*|"(?:[^"]|"")*")'
STRICT = rf"(?s)^{_CELL}(?:,{_CELL})*$"

# What a cell must look like, and be read as, for a column to
# have the type. Narrower types come first; a column that fits none is text.
CELL_TYPES = [
    (T.LongType(), r"^[+-]?[0-9]+$"),
    (T.DoubleType(), r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)$"),
    (T.DateType(), r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    (T.TimestampNTZType(), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}[0-9:.]*$"),
    (T.BooleanType(), r"^(?i:true|false)$"),
]
SHORT_WHOLE = r"^[+-]?[0-9]{1,18}$"


def list_csv(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(path, name) of the ``*.csv`` files directly in ``folder``, by name."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"folder {folder} not found")
    files = list_folder(spark, folder, ".csv")
    if not files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return files


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value, path, block, nth``: the lines of files with their places."""
    return spark.read.text(paths).select(
        "value",
        decoded_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(QUOTE), F.lit("")))


def quoted_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value, path, first``: the records of files whose quoted cells may hold
    line breaks; ``first`` marks a file's header.

    A line starts a record if an even number of quotes stands before it in its
    file. Quotes are summed per block of a file; how many stand before a block
    follows from these sums, one row per block, and inside a block from a
    running sum. So a file is read by as many tasks as it has blocks, and a
    record that crosses blocks is put together by the place where it starts.
    """
    lines = _lines(spark, paths).withColumn("quotes", _quotes(F.col("value")))
    along = Window.partitionBy("path", "block").orderBy("nth")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.withColumn("ahead", F.coalesce(F.sum("quotes").over(before), F.lit(0)))

    in_file = Window.partitionBy("path").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    sums = lines.groupBy("path", "block").agg(F.sum("quotes").alias("sum"))
    sums = sums.withColumn("odd", F.coalesce(F.sum("sum").over(earlier), F.lit(0)) % 2)
    placed = inside.join(sums.select("path", "block", "odd"), ["path", "block"])
    starts = (F.col("ahead") + F.col("odd")) % 2 == 0
    placed = placed.withColumn("start", F.max(F.when(starts, F.col("nth"))).over(along)).drop("quotes", "ahead")

    # Lines before the first start of a block end the last record before it.
    last = placed.groupBy("path", "block").agg(F.max("start").alias("last"))
    last = last.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).select("path", "block", "carried")
    opened = F.when(F.col("start").isNull(), F.col("carried")).otherwise(F.col("start"))
    whole = placed.join(last, ["path", "block"]).withColumn("record", opened)
    # A task numbers lines in the order of a block; blocks are ordered by place.
    ordered = F.array_sort(F.collect_list(F.struct("block", "nth", "value")))
    records = whole.groupBy("path", "record").agg(ordered.alias("held"), F.min("block").alias("block"))
    text = F.array_join(F.transform("held", lambda line: line["value"]), "\n")
    # The header starts where block 0 does.
    heads = F.min(F.when(F.col("block") == 0, F.col("record"))).over(Window.partitionBy("path", "block"))
    first = (F.col("block") == 0) & (F.col("record") == heads)
    return records.select(text.alias("value"), "path", first.alias("first")).where(F.length(F.trim("value")) > 0)


def _names(cells: list[str | None]) -> list[str]:
    """Column names of a header; unnamed and repeated ones get a number."""
    have = [(c or "").lower() for c in cells]
    return [
        f"_c{i}" if not c else f"{c}{i}" if have.count(c.lower()) > 1 else c
        for i, c in enumerate(cells)
    ]


def _parsed(records: DataFrame, names: list[str]) -> DataFrame:
    """Records as text cells, beside their other columns."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"escape": QUOTE, "mode": "PERMISSIVE", "multiLine": "true"}
    return records.withColumn("cells", F.from_csv("value", schema, options))


def _cells(spark: SparkSession, names: list[str], layout: str, paths: list[str]) -> DataFrame:
    """All cells as text, by place, with the ``path`` and the ``file`` they come from."""
    if layout == QUOTED:
        rows = _parsed(quoted_records(spark, paths).where("not first"), [f"c{i}" for i in range(len(names))])
        return rows.select(
            *[F.col("cells")[f"c{i}"].alias(n) for i, n in enumerate(names)],
            F.col("path").alias(PATH), F.element_at(F.split("path", "/"), -1).alias(FILE),
        )
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", QUOTE)
        .option("multiLine", layout == WHOLE)
        .csv(paths)
    )
    return rows.select(
        "*",
        decoded_path(F.col("_metadata.file_path")).alias(PATH),
        decoded_path(F.col("_metadata.file_name")).alias(FILE),
    )


def _kinds_of(cell: Column) -> Column:
    """Which types a cell fits, one bit for each of ``CELL_TYPES``.

    Looks exclude one another, but for whole numbers, which are numbers too: so a
    cell is held against one look after the other, and the first that it has decides.
    """

    def bit(place: int) -> Column:
        return F.when(cell.try_cast(CELL_TYPES[place][0]).isNotNull(), 1 << place).otherwise(0)

    (_, whole), *rest = CELL_TYPES
    # Up to 18 digits fit both numbers without being read as such.
    kinds = F.when(cell.rlike(SHORT_WHOLE), 0b11).when(cell.rlike(whole), bit(0).bitwiseOR(bit(1)))
    for place, (_, look) in enumerate(rest, start=1):
        kinds = kinds.when(cell.rlike(look), bit(place))
    return F.when(cell.isNotNull(), kinds.otherwise(0))


def _fits(cells: list[Column]) -> list[Column]:
    """Per column: the types that all its cells fit, as bits; null without a cell.
    A number is what Spark can add up in place, without sorting the rows."""
    return [F.bit_and(_kinds_of(cell)).alias(f"f{i}") for i, cell in enumerate(cells)]


def _schema(names: list[str], row: Row) -> T.StructType:
    kinds = [
        next((kind for place, (kind, _) in enumerate(CELL_TYPES) if (row[f"f{i}"] or 0) >> place & 1), T.StringType())
        for i in range(len(names))
    ]
    return T.StructType([T.StructField(n, k, True) for n, k in zip(names, kinds)])


def _heads(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file, by path key."""
    first = _lines(spark, paths).where("block = 0").groupBy("path").agg(F.min_by("value", "nth").alias("head"))
    return {_path_key(row.path): row.head for row in first.collect()}


def _path_key(path: str) -> str:
    """A path without its scheme, as files are told apart."""
    return "/" + re.sub(r"^[a-z0-9]+:/+", "", path).lstrip("/")


def inspect_files(spark: SparkSession, listed: list[tuple[str, str]]) -> list[CsvFile]:
    """Schemas from all cells: a column takes a type only if every cell of the
    file fits it, so no cell is lost; else it stays text.

    One job over all lines finds whether each file starts with the first file's
    header, whether its quotes cross lines, and the types of its cells as far as
    that is its header. Files with another header take one job that reads their
    first lines; they, or files with quotes that cross lines, take one more per
    distinct header. The driver gets a few flags per file and
    column.
    """
    paths = [p for p, _ in listed]
    assumed = spark.read.text(paths[:1]).limit(1).collect()
    head = assumed[0].value if assumed else ""
    same = [f"c{i}" for i in range(len(next(csv.reader([head]), [])))]
    is_head, filled = F.col("value") == head, F.length(F.trim("value")) > 0
    # Asked once a line, not once a cell: the header's and blank lines' cells are null.
    lines = _parsed(_lines(spark, paths), same or ["c0"]).withColumn("cells", F.when(~is_head & filled, F.col("cells")))
    cell_of = [F.col("cells")[c] for c in same]
    in_first = F.col("block") == 0
    # Numbers only: text among the aggregates would have all lines sorted first.
    found = lines.groupBy("path").agg(
        F.min(F.when(in_first, F.col("nth"))).alias("starts"),
        F.min(F.when(in_first & is_head, F.col("nth"))).alias("head_at"),
        F.bool_or(_quotes(F.col("value")) % 2 == 1).alias("broken"),
        F.count_if(is_head).alias("heads"),
        F.count_if(filled).alias("lines"),
        *_fits(cell_of),
    )
    first_pass = {_path_key(row.path): row for row in found.collect()}
    other = [p for p in paths if (row := first_pass.get(_path_key(p))) and row.starts != row.head_at]
    heads = {key: head for key in first_pass} | (_heads(spark, other) if other else {})
    schemas: dict[str, T.StructType] = {}
    names_of: dict[str, list[str]] = {}
    layout_of: dict[str, str] = {}
    groups: dict[tuple, list[str]] = {}
    for path, name in listed:
        row = first_pass.get(_path_key(path))
        if row is None:
            raise ValueError(f"{name} has no header")
        own = heads[_path_key(path)]
        layout_of[path] = QUOTED if row.broken else LINES
        if row.broken and own.count(QUOTE) % 2:
            # The header itself holds a line break: its record is read whole.
            first = spark.read.option("header", False).option("multiLine", True).option("escape", QUOTE)
            names_of[path] = _names(list(first.csv(path).first()))
        else:
            names_of[path] = _names(next(csv.reader([own])))
        if not row.broken and own == head and row.heads == 1:
            if row.lines > 1:
                schemas[path] = _schema(names_of[path], row)
        else:
            groups.setdefault((tuple(names_of[path]), layout_of[path]), []).append(path)
    for (names, layout), members in list(groups.items()):
        if layout != QUOTED:
            continue
        kept = quoted_records(spark, members).groupBy("path").agg(F.bool_and(F.col("value").rlike(STRICT)).alias("good"))
        good = {_path_key(row.path) for row in kept.collect() if row.good}
        for path in members:
            if _path_key(path) not in good:
                # Quotes inside plain cells open nothing: only a whole read tells.
                layout_of[path] = WHOLE
                groups.setdefault((names, WHOLE), []).append(path)
        groups[names, layout] = [p for p in members if layout_of[p] == QUOTED]
    for (names, layout), members in groups.items():
        if not members:
            continue
        places = [f"c{i}" for i in range(len(names))]
        cells = _cells(spark, places, layout, members)
        rows = cells.groupBy(PATH).agg(*_fits([F.col(place) for place in places])).collect()
        by_path = {_path_key(row[PATH]): _schema(list(names), row) for row in rows}
        schemas |= {p: by_path[_path_key(p)] for p in members if _path_key(p) in by_path}
    result = []
    for path, name in listed:
        text = T.StructType([T.StructField(n, T.StringType(), True) for n in names_of[path]])
        schema = schemas.get(path)
        result.append(CsvFile(path, name, schema or text, schema is None, layout_of[path]))
    return result


def read_csv(spark: SparkSession, like: CsvFile, paths: list[str]) -> DataFrame:
    """Rows of files that share the schema and the layout of ``like``, with
    ``source_file``. Every cell fits its type."""
    cells = _cells(spark, like.schema.names, like.layout, paths)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in like.schema]
    return cells.select(*typed, F.col(FILE).alias("source_file"))


def write_report_csv(df: DataFrame, path: str, rows: int) -> None:
    """Write a report of at most ``rows`` rows, in its own order, as one file."""
    df.limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
