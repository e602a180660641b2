"""Tables written once, so that their size is known to the joins that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What reads it no longer depends on how it was made: it is computed once and a lost executor costs nothing. Its bytes are
    known, so a join broadcasts it below `spark.sql.autoBroadcastJoinThreshold` and shuffles it otherwise.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

