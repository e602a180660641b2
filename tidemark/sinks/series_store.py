"""The cleaned series between analyses, with what its questions need of it.

Layout under one folder, all parquet, per version of a part (such as a file of the series, or all of it):

- `clean/part=<id>/version=<v>`: the cleaned rows.
- `sums/part=<id>/version=<v>`: exact sums per series and year, which add up over parts.
- `log`: one row per version that is complete; a version counts once its row is there, and replaces earlier ones of its part.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.analysis import yearly_sums
from tidemark.schemas import SERIES
from tidemark.sinks.tables import read_if_exists

SUMS = T.StructType(
    [T.StructField("series_id", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("total", T.DecimalType(38, 3))]
)
PLACE = [T.StructField("part", T.StringType()), T.StructField("version", T.StringType())]
LOG = T.StructType([*PLACE, T.StructField("nth", T.LongType())])


class SeriesStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def keep(self, series: DataFrame, version: str, part: str = "all") -> None:
        """Clean a part of the series once: write its rows, and from what is written its sums.

        Keeping a version again, after a failure or not, replaces it. Other parts are neither read nor written.
        """
        for name in (version, part):
            if not re.fullmatch(r"[A-Za-z0-9._-]+", name):
                raise ValueError(f"not a name of a folder: {name!r}")
        place = f"part={part}/version={version}"
        series.select(SERIES.names).write.mode("overwrite").parquet(f"{self.path}/clean/{place}")
        clean = self.spark.read.schema(SERIES).parquet(f"{self.path}/clean/{place}")
        sums = yearly_sums(clean).withColumn("total", F.col("total").cast("decimal(38,3)"))
        sums.write.mode("overwrite").parquet(f"{self.path}/sums/{place}")
        last = self._log().agg(F.max("nth")).first()[0]
        values = zip(LOG.fields, (part, version, 0 if last is None else last + 1), strict=True)
        row = self.spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in values])
        row.write.mode("append").parquet(f"{self.path}/log")

    def series(self) -> DataFrame:
        """The cleaned rows of the newest version of every part."""
        return self._newest("clean", SERIES)

    def sums(self) -> DataFrame:
        """`(series_id, year, total)` over all parts; reads no rows of the series."""
        added = self._newest("sums", SUMS).groupBy("series_id", "year").agg(F.sum("total").alias("total"))
        return added.select("series_id", "year", F.col("total").cast("decimal(38,3)").alias("total"))

    def _log(self) -> DataFrame:
        return read_if_exists(self.spark, f"{self.path}/log", LOG)

    def _newest(self, table: str, schema: T.StructType) -> DataFrame:
        newest = self._log().groupBy("part").agg(F.max_by("version", "nth").alias("version"))
        chosen = [f"{r.part}/{r.version}" for r in newest.collect()]  # one row per part
        if not chosen:
            raise ValueError("no series is kept")
        held = self.spark.read.schema(T.StructType([*schema.fields, *PLACE])).parquet(f"{self.path}/{table}")
        return held.where(F.concat_ws("/", "part", "version").isin(chosen)).select(schema.names)
