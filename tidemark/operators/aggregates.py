"""Aggregations over series and whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import exact_decimal


def sum_by(df: DataFrame, keys: list[str], value: str, places: int = 3) -> DataFrame:
    """Exact sum of `value` per key as column `total`.

    Missing values are skipped, a group of only missing values sums to 0, and rows with a
    missing key are dropped. Decimal addition is exact, so the order of rows cannot decide a tie; a value with more than
    `places` decimals fails, and so does a sum of more than 25 digits before them.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    total = F.coalesce(F.sum(exact_decimal(F.col(value), value, places)), F.lit(0))
    return df.groupBy(*keys).agg(total.alias("total"))


def arg_max(df: DataFrame, key: str, by: str, what: str) -> DataFrame:
    """Per key the row with the largest `by`; among equals the smallest `what`.

    The best pair is an aggregate, so a hot key shrinks to one row per task before the shuffle.
    """
    best = F.max(F.struct(F.col(by), (-F.col(what).cast("bigint")).alias("neg")))
    what_type = df.schema[what].dataType
    return (
        df.groupBy(key)
        .agg(best.alias("best"))
        .select(key, (-F.col("best.neg")).cast(what_type).alias(what), F.col(f"best.{by}").alias(by))
    )


def mean_and_deviation(df: DataFrame, value: str) -> DataFrame:
    """One row: mean and sample standard deviation; NULL where undefined.

    Of whole numbers the count, the sum and the sum of squares are exact, and only the last steps are not, so no order of rows and no number of
    tasks changes a bit. Where a sum has more than 38 digits, and for fractions, the usual floating moments count.
    """
    mean, std = F.avg(value), F.stddev_samp(value)
    if isinstance(df.schema[value].dataType, T.IntegralType):
        x = F.col(value).cast("decimal(19,0)")
        n, total, squares = F.count(value).cast("decimal(19,0)"), F.try_sum(x), F.try_sum(x * x)
        spread = F.try_subtract(F.try_multiply(n, squares), F.try_multiply(total, total))  # n (n - 1) times the variance
        mean = F.coalesce(F.try_divide(total.cast("double"), n.cast("double")), mean)
        pairs = n.cast("double") * (n.cast("double") - 1)
        std = F.when(F.count(value) > 1, F.coalesce(F.sqrt(F.try_divide(spread.cast("double"), pairs)), std))
    return df.agg(mean.alias("mean"), std.alias("std"))


def deviation_band(df: DataFrame, value: str) -> DataFrame:
    """Each row with the mean of `value` and the bounds one deviation below and above.

    The statistics are a scalar subquery: one row, computed once.
    """
    stats = mean_and_deviation(df, value).select(F.struct("mean", "std")).scalar()
    with_stats = df.withColumn("_stats", stats)
    mean, std = F.col("_stats.mean"), F.col("_stats.std")
    return with_stats.withColumns(
        {"mean": mean, "lower": mean - std, "upper": mean + std}
    ).drop("_stats")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, non-missing values, rows of the table. One pass."""
    counts: list[Column] = [
        F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)
    ]
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), *counts)
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null_count"),
            F.col("row_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return totals.select(F.inline(F.array(*lines)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def first_row(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """The first row in the given order; each task keeps one candidate."""
    return df.orderBy(*order).limit(1).select(*columns)
