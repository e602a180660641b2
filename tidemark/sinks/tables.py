"""Plain file writers and run identifiers."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import or_fail
from tidemark.schemas import TRACKER_COLUMNS, empty_table


RUN_TIME = r"[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01]) ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"


def run_id(run_ts: str) -> str:
    """A run time as a folder name: `2025-03-06 08:30:00` gives `r20250306083000`.

    Only this one fixed-width form, in UTC, is a run time: it sorts as text and no two share a folder.
    """
    if not re.fullmatch(RUN_TIME, run_ts or ""):
        raise ValueError(f"not a run time of the form 2025-03-06 08:30:00: {run_ts!r}")
    return "r" + re.sub(r"[^0-9]", "", run_ts)


def checked_run_time(c: Column) -> Column:
    """The same test for a column: anything else fails the job."""
    return or_fail(
        F.when(c.rlike(f"^{RUN_TIME}$"), c), F.concat(F.lit("not a run time: "), F.coalesce(c, F.lit("(missing)")))
    )


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def empty_folder(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Replace the files of a folder by one without rows."""
    empty_table(spark, schema).coalesce(1).write.mode("overwrite").parquet(path)


def write_tracker_csv(tracker: DataFrame, path: str) -> None:
    """The tracker as comma-separated text with a header, in a new folder.

    Blanks at the ends of a cell are kept. A cell with a line break fails, as lines are read on their own.
    """
    cells = [
        F.when(F.col(c).rlike(r"[\r\n]"), F.raise_error(F.concat(F.lit("line break in a cell: "), F.col(c))))
        .otherwise(F.col(c))
        .alias(c)
        for c in TRACKER_COLUMNS
    ]
    writer = tracker.select(cells).write.option("header", True).option("escape", '"')
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_json_table(df: DataFrame, path: str) -> None:
    """A table as JSON, one record per line, replacing the previous snapshot."""
    df.write.mode("overwrite").json(path)


def write_json_documents(payloads: DataFrame, path: str, column: str = "payload") -> None:
    """JSON texts as fetched, one document per line; invalid JSON fails before anything is committed.

    A document may be as long as a cell, and keys may repeat: nothing is built from it, its tokens are only read. It must be
    the one value of an array and of an object that are put around it, so nothing can follow it.
    """
    text = F.col(column)
    inside = F.concat(F.lit('{"k":'), text, F.lit("}"))
    strict = F.from_json(inside, "x string, bad string", {"columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false"})
    valid = (
        (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1)
        & (F.size(F.json_object_keys(inside)) == 1)
        & strict["bad"].isNull()
    )
    # A line feed can only stand between the tokens of valid JSON.
    one_line = F.when(valid, F.regexp_replace(text, r"[\r\n]+", " "))
    message = F.concat(F.lit("not JSON: "), F.substring(F.coalesce(text, F.lit("(missing)")), 1, 80))
    payloads.select(or_fail(one_line, message).alias("value")).write.mode("overwrite").text(path)
