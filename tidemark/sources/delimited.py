"""Delimited text with a header row."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TRACKER

_BAD_LINE = "_bad_line"
_ESCAPE = '"'
# A quoted cell: quotes inside are doubled, line feeds are part of it.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
# The places of a line in the input: file, where its split begins, place within the split.
_SPLIT, _PLACE = ["file", "block"], ["file", "block", "nth"]


def read_text_table(spark: SparkSession, path: str | list[str], sep: str = "\t", quoted_breaks: bool | None = None) -> DataFrame:
    """Every column as a string, named as in the header.

    A line with too few cells is filled with NULL; one with too many fails the job
    rather than lose its tail. Every file must have the same header, else the job fails. Files split, so
    many tasks read one large file.

    A quoted cell may hold line feeds, wherever the file splits. Such cells are looked for beforehand, in a pass that only tests lines for
    quotes; `quoted_breaks=False` says that there are none and saves it, True says that there are. A quote that is never closed fails the job.
    """
    lines = _file_lines(spark, path)
    if quoted_breaks is None:
        quoted_breaks = not lines.where(_ends_open("line", sep)).isEmpty()
    if quoted_breaks:
        return _table_of_records(_records(lines, sep), sep)
    reader = spark.read.option("sep", sep).option("header", True).option("escape", _ESCAPE)
    reader = reader.option("enforceSchema", False)
    header = reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, _BAD_LINE]])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", _BAD_LINE).csv(path)
    return _refuse_long_lines(rows, sep)


def text_table_of_files(files: DataFrame, sep: str = "\t") -> DataFrame:
    """The same from landed files: `content` holds the bytes of text files with one common header.

    One task cuts one file into records, so a file must fit in a row, as it does to be landed; large files are
    better read from their folder.
    """
    text = files.select(F.decode("content", "UTF-8").alias("text"))
    s = re.escape(sep)
    # a record ends at a line feed outside quotes; a quote within an unquoted cell is a character like others
    cell = rf'(?:{_QUOTED}"[^{s}\n]*+|(?!")[^{s}\n]*+)'
    whole = F.regexp_extract_all("text", F.lit(rf"\G({cell}(?:{s}{cell})*+)(?:\n|\z)"), F.lit(1))
    read = F.aggregate(whole, F.lit(0), lambda n, r: n + F.char_length(r) + 1)
    closed = F.when(read < F.char_length("text"), F.raise_error(F.lit("a quote is never closed"))).otherwise(whole)
    lines = text.select(F.posexplode(closed).alias("at", "line"))
    return _table_of_records(lines.select((F.col("at") == 0).alias("first"), F.regexp_replace("line", r"\r\z", "").alias("line")), sep)


def _table_of_records(records: DataFrame, sep: str) -> DataFrame:
    """Records `(first, line)`, where `first` marks the header of each file, as text columns."""
    head = records.where("first").first()
    if head is None:
        raise ValueError("no file to read")
    header = next(csv.reader([head.line], delimiter=sep), [""])
    other = F.raise_error(F.concat(F.lit("another header than the first file's: "), F.col("line")))
    below = F.when(~F.col("first"), F.lit(True)).when(F.col("line") == head.line, F.lit(False)).otherwise(other)
    rows = records.where(below & (F.trim("line", F.lit(" \t")) != ""))
    columns = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{c} STRING" for c in [*columns, _BAD_LINE])
    options = {"sep": sep, "escape": _ESCAPE, "columnNameOfCorruptRecord": _BAD_LINE, "multiLine": "true"}
    rows = rows.select(F.from_csv("line", schema, options).alias("r")).select("r.*")
    return _refuse_long_lines(rows, sep).toDF(*header)


def _file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`(file, block, nth, line)`: lines and where they stand. Many tasks read one large file."""
    lines = spark.read.option("lineSep", "\n").text(path)
    block = F.col("_metadata.file_block_start").alias("block")
    return lines.select(F.col("_metadata.file_path").alias("file"), block, F.monotonically_increasing_id().alias("nth"), F.col("value").alias("line"))


def _ends_open(line: str, sep: str) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted cell."""
    s = re.escape(sep)
    cells = rf'(?:(?:{_QUOTED}"[^{s}]*+|(?!")[^{s}]*+){s})*+'
    return F.contains(F.col(line), F.lit('"')) & F.col(line).rlike(rf"\A{cells}{_QUOTED}\z")


def _stays_open(line: str, sep: str) -> Column:
    """Whether a line that begins inside a quoted cell ends inside one, that or a later one."""
    s = re.escape(sep)
    inside = '[^"]*+(?:""[^"]*+)*+'
    cells = rf'(?:(?:{_QUOTED}"[^{s}]*+|(?!")[^{s}]*+){s})*+'
    return F.col(line).rlike(rf'\A{inside}(?:"[^{s}]*+{s}{cells}{_QUOTED})?+\z')


def _state_after(rows: DataFrame, group: list[str], order: str, before: Column | None) -> DataFrame:
    """Adds `after`: whether a quote is open after each row, from what rows `from_closed` and `from_open` do one after another.

    A row either settles the state, whatever it was, or keeps or turns it; so the state follows from the last row that settles it and the number of
    turns since. `before` is the state that a group begins with; without it columns `of_closed` and `of_open` give the state after either.
    """
    so_far = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    settled = F.when(F.col("from_closed") == F.col("from_open"), F.col("from_closed"))
    turns = F.sum((F.col("from_closed") & ~F.col("from_open")).cast("long")).over(so_far)
    rows = rows.withColumn("_turns", turns)
    last = F.last(F.when(settled.isNotNull(), F.struct(settled.alias("open"), "_turns")), ignorenulls=True).over(so_far)
    rows = rows.withColumn("_last", last)
    turned = (F.col("_turns") - F.coalesce("_last._turns", F.lit(0))) % 2 == 1

    def after(begin: Column) -> Column:
        return F.coalesce("_last.open", begin) != turned

    if before is None:
        rows = rows.withColumns({"of_closed": after(F.lit(False)), "of_open": after(F.lit(True))})
    else:
        rows = rows.withColumn("after", after(before))
    return rows.drop("_turns", "_last")


def _records(lines: DataFrame, sep: str) -> DataFrame:
    """`(first, line)`: lines joined where a quoted cell goes on over a line feed.

    What a line does to an open quote is known from the line alone. That is put together within each split, then over the splits of a file, one row
    for each, and so every line learns how it begins, although many tasks read a file. Only lines that belong together are gathered.
    """
    marked = lines.withColumns({"from_closed": _ends_open("line", sep), "from_open": _stays_open("line", sep)})
    marked = _state_after(marked, _SPLIT, "nth", None)
    in_split = Window.partitionBy(*_SPLIT).orderBy("nth")
    before = {f"before_{s}": F.lag(f"of_{s}").over(in_split) for s in ("closed", "open")}
    marked = marked.withColumns(before)
    ends = marked.groupBy(*_SPLIT).agg(F.max_by(F.struct("of_closed", "of_open"), "nth").alias("s"))
    splits = ends.select(*_SPLIT, F.col("s.of_closed").alias("from_closed"), F.col("s.of_open").alias("from_open"))
    splits = _state_after(splits, ["file"], "block", F.lit(False))
    by_file = Window.partitionBy("file").orderBy("block")
    last_open = F.last("after").over(by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    begins = F.coalesce(F.lag("after").over(by_file), F.lit(False))
    never = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file")))
    splits = splits.select(*_SPLIT, F.when(last_open, never).otherwise(begins).alias("begins"))
    states = marked.join(splits, _SPLIT).withColumns(
        {
            "inside": F.coalesce(F.when(F.col("begins"), F.col("before_open")).otherwise(F.col("before_closed")), F.col("begins")),
            "goes_on": F.when(F.col("begins"), F.col("of_open")).otherwise(F.col("of_closed")),
        }
    )
    place = F.struct("block", "nth")
    whole = states.where("not inside and not goes_on").select("file", place.alias("at"), "line")
    # lines of records that go on: the record is named by the line that begins it, in this split or in the last one before that has such a line
    pieces = states.where("inside or goes_on")
    started = F.last(F.when(~F.col("inside"), place), ignorenulls=True)
    pieces = pieces.withColumn("at", started.over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    open_at_end = pieces.groupBy(*_SPLIT).agg(F.max(F.when(~F.col("inside"), place)).alias("last"))
    earlier = F.last("last", ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.join(open_at_end.select(*_SPLIT, earlier.alias("earlier")), _SPLIT).withColumn("at", F.coalesce("at", "earlier"))
    joined = pieces.groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("block", "nth", "line"))).alias("parts"))
    joined = joined.select("file", "at", F.array_join("parts.line", "\n").alias("line"))
    records = whole.unionByName(joined)
    head = lines.groupBy("file").agg(F.min(place).alias("at"), F.lit(True).alias("first"))
    marked = records.join(head, ["file", "at"], "left")
    return marked.select(F.coalesce("first", F.lit(False)).alias("first"), F.regexp_replace("line", r"\r\z", "").alias("line"))


def _refuse_long_lines(rows: DataFrame, sep: str) -> DataFrame:
    # Only a line with the wrong number of cells carries its text in the extra column.
    unquoted = F.regexp_replace(F.col(_BAD_LINE), '"[^"]*"', "")
    too_long = F.size(F.split(unquoted, re.escape(sep))) > len(rows.columns) - 1
    fits = F.when(
        F.col(_BAD_LINE).isNotNull() & too_long,
        F.raise_error(F.concat(F.lit("too many cells in line: "), F.col(_BAD_LINE))),
    ).otherwise(F.lit(True))
    return rows.where(fits).drop(_BAD_LINE)


def read_tracker_csv(spark: SparkSession, path: str) -> DataFrame:
    """The tracker as text columns; a numeric-looking file name stays a text."""
    return spark.read.schema(TRACKER).option("header", True).option("escape", _ESCAPE).csv(path)
