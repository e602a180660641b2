"""Declared schemas and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form that the optimizer recognises as empty."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns).where(F.lit(False))


LISTING_COLUMNS = ["file_name", "file_timestamp", "full_url"]
TRACKER_COLUMNS = [*LISTING_COLUMNS, "start_timestamp", "end_timestamp", "is_active"]

LISTING = _strings(*LISTING_COLUMNS)
TRACKER = _strings(*TRACKER_COLUMNS)

# One landed directory-listing page: which of how many pages of its listing it is, from 1.
PAGE = T.StructType(
    [
        T.StructField("run_ts", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("pages", T.LongType()),
        *_strings("url", "html").fields,
    ]
)

# One row per file whose state changed in a run; `old_*` is the version that was closed.
CHANGES = _strings(
    "file_name",
    "status",
    "file_timestamp",
    "full_url",
    "old_file_timestamp",
    "old_full_url",
    "old_start_timestamp",
    "run_ts",
)

SERIES = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("period", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

POPULATION_RECORD = T.StructType(
    [
        T.StructField("ID Year", T.LongType()),
        T.StructField("Population", T.LongType()),
    ]
)

POPULATION_SOURCE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("measures", T.ArrayType(T.StringType())),
        T.StructField("annotations", T.StructType([T.StructField("source_name", T.StringType())])),
    ]
)

POPULATION_DOCUMENT = T.StructType(
    [
        T.StructField("data", T.ArrayType(POPULATION_RECORD)),
        T.StructField("source", T.ArrayType(POPULATION_SOURCE)),
    ]
)

# Cell texts that mean "missing" in a delimited file, matched before trimming.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
