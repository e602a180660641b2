"""A newly landed population snapshot triggers the analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.analysis import Questions, answer
from tidemark.schemas import POPULATION_DOCUMENT
from tidemark.sinks.series_store import SeriesStore
from tidemark.sources.documents import records

SNAPSHOT_NAME = r".*/population-([^/]+?)(?:\.json)?(?:/[^/]*)?$"


def population_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = POPULATION_DOCUMENT,
    one_per_file: bool = True,
) -> DataFrame:
    """Documents under `directory/population-<run>[.json]` with the run as `snapshot`.

    The file source remembers paths, so every snapshot needs a name of its own.
    """
    return (
        spark.readStream.schema(schema)
        .option("multiLine", one_per_file)
        .option("mode", "FAILFAST")
        .json(f"{directory.rstrip('/')}/population-*")
        .withColumn("snapshot", F.regexp_extract("_metadata.file_path", SNAPSHOT_NAME, 1))
    )


def analyze_on_arrival(
    documents: DataFrame,
    series: DataFrame | SeriesStore,
    results: str,
    checkpoint: str,
    questions: Questions | None = None,
) -> StreamingQuery:
    """Answer the questions for the newest snapshot that has arrived, then stop.

    Each answer goes to `results/<question>/snapshot=<run>`, so a batch delivered twice
    replaces its own output. Of a series that is kept in a store, an arrival reads the sums and, for one series and period, its
    rows; nothing is parsed or added up again.
    """

    def answer_batch(batch: DataFrame, _: int) -> None:
        newest = batch.agg(F.max("snapshot").alias("s")).first().s
        if newest is None:
            return
        population = records(batch.where(F.col("snapshot") == newest), "data")
        kept = isinstance(series, SeriesStore)
        rows, sums = (series.series(), series.sums()) if kept else (series, None)
        for name, table in answer(rows, population, questions, sums).items():
            table.write.mode("overwrite").parquet(f"{results}/{name}/snapshot={newest}")

    return (
        documents.writeStream.foreachBatch(answer_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_result(spark: SparkSession, results: str, question: str) -> DataFrame:
    """The answer for the newest snapshot."""
    every = spark.read.option("basePath", f"{results}/{question}").parquet(f"{results}/{question}/snapshot=*")
    newest = every.agg(F.max("snapshot").alias("s"))
    return every.where(F.col("snapshot") == newest.scalar()).drop("snapshot")
