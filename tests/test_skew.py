"""One key holds a third of all rows."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.history import replay
from tidemark.plans import analysis as A


@pytest.fixture
def tiny_partitions(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def hot(column, key, other):
    """`key` for every third row."""
    return F.when(F.pmod(column, F.lit(3)) == 0, key).otherwise(other)


def test_hot_series(spark):
    i = F.col("id")
    series = spark.range(0, 90_000, 1, 6).select(
        hot(i, F.lit("HOT"), F.concat(F.lit("S"), i % 500)).alias("series_id"),
        (1990 + i % 20).cast("int").alias("year"),
        F.lit("Q01").alias("period"),
        ((i % 1000) / 1000).alias("value"),
    )
    got = {r.series_id: (r.year, r.summed_value) for r in A.best_years(series).collect()}
    sums = {}
    for n in range(0, 90_000):
        s, y = ("HOT" if n % 3 == 0 else f"S{n % 500}"), 1990 + n % 20
        sums[s, y] = sums.get((s, y), 0) + n % 1000
    best = {}
    for (s, y), v in sorted(sums.items()):
        if s not in best or v > best[s][1]:
            best[s] = (y, v)
    assert got == {s: (y, v / 1000) for s, (y, v) in best.items()}


def test_hot_year_beyond_the_broadcast_limit(spark, tiny_partitions):
    i = F.col("id")
    series = spark.range(0, 60_000, 1, 6).select(
        F.lit("S").alias("series_id"),
        hot(i, F.lit(2000), 1900 + i % 90).cast("int").alias("year"),
        F.lit("Q01").alias("period"),
        i.cast("double").alias("value"),
    )
    population = spark.range(1900, 2001).select(i.alias("ID Year"), (i * 10).alias("Population"))
    joined = A.series_with_population(series, population, "S", ordered=False)
    assert (joined.count(), joined.agg(F.sum("value")).first()[0]) == (60_000, float(sum(range(60_000))))
    assert joined.where("Population <> year * 10").isEmpty()
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_file_in_a_history(spark):
    """One file is in every run, the others in few; chunks hold at most eight runs."""
    runs = [f"2024-{1 + n // 28:02d}-{1 + n % 28:02d} 12:00:00" for n in range(300)]
    data = [("hot", f"t{n // 7 % 2}", "u", run) for n, run in enumerate(runs)]
    data += [(f"f{n}", "t", "u", runs[n]) for n in range(0, 300, 2)]
    history = spark.createDataFrame(data, "file_name string, file_timestamp string, full_url string, run_ts string")
    got = rows(replay(history, spark.createDataFrame([(r,) for r in runs], "run_ts string"), chunk_runs=8))
    spells = [(n, min(n + 7, 300)) for n in range(0, 300, 7)]
    expected = []
    for a, b in spells:
        end, state = (None, "Y") if b == 300 else (runs[b], "N")
        expected.append(("hot", f"t{a // 7 % 2}", "u", runs[a], end, state))
    expected += [(f"f{n}", "t", "u", runs[n], runs[n + 1], "N") for n in range(0, 300, 2)]
    assert got == sorted(expected, key=repr)
