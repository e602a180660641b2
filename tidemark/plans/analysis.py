"""Clean the series and population inputs and answer the three questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import na_to_null, or_fail, round_half_even, strip, to_double, to_int
from tidemark.operators.aggregates import arg_max, mean_and_deviation, sum_by
from tidemark.operators.joins import settle
from tidemark.sources.delimited import read_text_table, text_table_of_files
from tidemark.sources.documents import read_documents, records

FIRST_YEAR, LAST_YEAR = 2013, 2018
SERIES_ID, PERIOD = "PRS30006032", "Q01"


def clean_series(raw: DataFrame) -> DataFrame:
    """Padded text columns to typed ones, in one projection.

    Names and text cells are trimmed; cells that mean "missing" are NULL; `year` must be an integer
    in every row; `value` is rounded to three places. A bad cell fails the job that reads its column.
    """
    named = raw.toDF(*[c.strip() for c in raw.columns])
    cells = {
        f.name: strip(na_to_null(F.col(f"`{f.name}`")))
        if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in named.schema.fields
    }
    cells["year"] = to_int(cells["year"], "year")
    cells["value"] = round_half_even(to_double(cells["value"], "value"))
    return named.select(*[c.alias(name) for name, c in cells.items()])


def prepare_series(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return clean_series(read_text_table(spark, path))


def prepare_landed_series(files: DataFrame) -> DataFrame:
    """The same from landed files `(file_name, content)`, such as the current copies of a raw store."""
    return clean_series(text_table_of_files(files))


def prepare_population(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    one_per_file: bool = True,
) -> DataFrame:
    documents = read_documents(spark, path, schema, one_per_file)
    if "source" not in documents.columns:
        raise ValueError("a document has no 'source'")
    return records(documents.where(or_fail(F.nullif(F.col("source").isNotNull(), F.lit(False)), "a document has no 'source'")), "data")


def population_metrics(
    population: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
) -> tuple[DataFrame, DataFrame]:
    """The rows of the years asked for, and one row with their mean and sample deviation."""
    chosen = population.where(F.col("ID Year").between(first_year, last_year))
    return chosen, mean_and_deviation(chosen, "Population")


def best_years(series: DataFrame, ordered: bool = True) -> DataFrame:
    """Per series the year with the largest sum of values; the earliest one on a tie."""
    return best_of_sums(yearly_sums(series), ordered)


def yearly_sums(series: DataFrame) -> DataFrame:
    """`(series_id, year, total)`: exact sums, which may be kept and added up."""
    return sum_by(series, ["series_id", "year"], "value")


def best_of_sums(yearly: DataFrame, ordered: bool = True) -> DataFrame:
    """The same from kept sums."""
    best = arg_max(yearly, "series_id", by="total", what="year").select(
        "series_id", "year", F.col("total").cast("double").alias("summed_value")
    )
    return best.orderBy("series_id") if ordered else best


def series_with_population(
    series: DataFrame,
    population: DataFrame,
    series_id: str = SERIES_ID,
    period: str = PERIOD,
    ordered: bool = True,
) -> DataFrame:
    """One series and period with the population of its years; years without one drop out.

    Population is cut to two numbers and written once (which runs a job), so that the join knows its bytes: a small one
    is broadcast, a large one shuffled on the year, where adaptive execution splits a hot year.
    """
    chosen = series.where((F.col("series_id") == series_id) & (F.col("period") == period))
    known = population.select("ID Year", "Population").where(F.col("Population").isNotNull())
    known = settle(known, "population")
    joined = (
        chosen.join(known, F.col("year") == F.col("ID Year"), "left")
        .where(F.col("Population").isNotNull())
        .select("series_id", "year", "period", "value", "Population")
    )
    return joined.orderBy("year", "period", "value") if ordered else joined


@dataclass(frozen=True)
class Questions:
    """The literals of the three questions."""

    first_year: int = FIRST_YEAR
    last_year: int = LAST_YEAR
    series_id: str = SERIES_ID
    period: str = PERIOD


def answer(
    series: DataFrame, population: DataFrame, questions: Questions | None = None, sums: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All three questions over prepared tables. Given the yearly `sums` of the series, they are not added up again."""
    q = questions or Questions()
    _, stats = population_metrics(population, q.first_year, q.last_year)
    return {
        "population_stats": stats,
        "best_years": best_of_sums(yearly_sums(series) if sums is None else sums),
        "series_with_population": series_with_population(series, population, q.series_id, q.period),
    }


def analyze(
    spark: SparkSession,
    series_path: str,
    population_path: str,
    questions: Questions | None = None,
    clean_path: str | None = None,
) -> dict[str, DataFrame]:
    """The whole analysis from files.

    Two questions read the series. Given `clean_path`, the cleaned series is written there once as
    parquet, so that the text is parsed once and later scans read only the columns they need.
    """
    series = prepare_series(spark, series_path)
    if clean_path is not None:
        series.write.mode("overwrite").parquet(clean_path)
        series = spark.read.parquet(clean_path)
    return answer(series, prepare_population(spark, population_path), questions)
