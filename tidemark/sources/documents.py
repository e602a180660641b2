"""JSON documents that hold arrays of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import or_fail


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    one_per_file: bool = True,
) -> DataFrame:
    """One row per document; invalid JSON fails the job.

    `one_per_file=False` reads one document per line, which splits, so use it for large
    inputs. Without a schema it is inferred, so that every key of a record is kept.
    """
    reader = spark.read.option("multiLine", one_per_file).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def records(documents: DataFrame, field: str = "data") -> DataFrame:
    """One row per element of an array of records, nested objects flattened."""
    array = or_fail(F.col(f"`{field}`"), f"a document has no '{field}' array")
    return flatten(documents.select(F.inline(array)))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested objects as `outer.inner` columns; lists stay lists."""
    return df.select(*[c for f in df.schema.fields for c in _leaves(f, F.col(f"`{f.name}`"), f.name, sep)])


def _leaves(field: T.StructField, value: Column, name: str, sep: str) -> list[Column]:
    if not isinstance(field.dataType, T.StructType):
        return [value.alias(name)]
    return [
        leaf
        for inner in field.dataType.fields
        for leaf in _leaves(inner, value.getField(inner.name), f"{name}{sep}{inner.name}", sep)
    ]
