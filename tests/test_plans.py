import re

import pytest

from tidemark.operators import scd2
from tidemark.operators.history import replay
from tidemark.plans import analysis as A
from workload import derive as D
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    """The final physical plan after a run, as text."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def written(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.fixture
def big_joins(spark):
    """Joins as they are on large inputs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_on_the_executors(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|MapInPandas|MapInArrow|PythonUDF|FlatMapGroups", text)
    assert "CartesianProduct" not in text


def test_population_join_is_an_inner_broadcast(spark):
    q = D.QUESTIONS
    text = plan(A.series_with_population(D.series(spark, SF), D.population(spark, SF), q.series_id, q.period))
    joins = re.findall(r"(\w*Join) \[[^\]]*\], \[[^\]]*ID Year[^\]]*\], (\w+)", text)
    assert joins == [("BroadcastHashJoin", "Inner")]


def test_large_population_is_not_broadcast(spark, big_joins):
    q = D.QUESTIONS
    joined = A.series_with_population(D.series(spark, SF), D.population(spark, SF), q.series_id, q.period)
    assert "Broadcast" not in plan(joined)


def test_best_years_aggregates_before_each_shuffle(spark, tmp_path):
    series = written(spark, D.series(spark, SF).withColumn("unused", A.F.lit("x")), tmp_path / "s")
    text = plan(A.best_years(series, ordered=False))
    assert "Window" not in text
    assert text.count("Exchange hashpartitioning") == 2
    assert len(re.findall(r"partial_(?:sum|max)", text)) == 2
    assert "HashAggregate(keys=[series_id" in text
    read = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "unused" not in read and "period" not in read


def test_one_shuffle_per_side_of_the_comparison(spark, tmp_path, big_joins):
    listing = written(spark, D.shipping_listing(spark, SF, "O"), tmp_path / "l")
    tracker = written(spark, scd2.bootstrap(D.shipping_listing(spark, SF, "F"), "2024-01-01 12:00:00"), tmp_path / "t")
    text = plan(scd2.changes(tracker, listing, "2024-01-02 12:00:00"))
    assert text.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in text and "FullOuter" in text
    assert "PushedFilters: [IsNotNull(is_active), EqualTo(is_active,Y)]" in text


def test_replay_shuffles_history_once(spark, tmp_path):
    history, runs = D.part_history(spark, SF)
    history, runs = written(spark, history, tmp_path / "h"), written(spark, runs, tmp_path / "r")
    text = plan(replay(history, runs))
    assert len(re.findall(r"Exchange hashpartitioning\(file_name", text)) == 1


def test_statistics_need_no_join(spark):
    assert "Join" not in plan(QUERIES["population_band"](spark, SF))
