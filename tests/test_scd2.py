import naive
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import scd2
from tidemark.operators.history import replay, run_calendar
from tidemark.schemas import LISTING, TRACKER, TRACKER_COLUMNS

U, V = "u", "v"
RUNS = {
    "2024-01-01 12:00:00": {"a": ("t1", U), "b": ("t1", U), "c": ("t1", U), "d": ("t1", U)},
    "2024-01-02 12:00:00": {"a": ("t1", U), "b": ("t2", U), "c": ("t1", V), "e": ("t1", U)},
    "2024-01-03 12:00:00": {"a": ("t1", U), "b": ("t2", U), "c": ("t1", V), "d": ("t1", U), "e": ("t1", U)},
}
RUNS["2024-01-04 12:00:00"] = RUNS["2024-01-03 12:00:00"]
EXPECTED = [
    ("a", "t1", U, "2024-01-01 12:00:00", None, "Y"),
    ("b", "t1", U, "2024-01-01 12:00:00", "2024-01-02 12:00:00", "N"),
    ("b", "t2", U, "2024-01-02 12:00:00", None, "Y"),
    ("c", "t1", U, "2024-01-01 12:00:00", "2024-01-02 12:00:00", "N"),
    ("c", "t1", V, "2024-01-02 12:00:00", None, "Y"),
    ("d", "t1", U, "2024-01-01 12:00:00", "2024-01-02 12:00:00", "N"),
    ("d", "t1", U, "2024-01-03 12:00:00", None, "Y"),
    ("e", "t1", U, "2024-01-02 12:00:00", None, "Y"),
]


def listing(spark, entries):
    return spark.createDataFrame([(n, *v) for n, v in entries.items()], LISTING)


def tracker(spark, data):
    return spark.createDataFrame(data, TRACKER)


def history(spark, runs):
    data = [(n, *v, run) for run, entries in runs.items() for n, v in entries.items()]
    return spark.createDataFrame(data, "file_name string, file_timestamp string, full_url string, run_ts string")


def statuses(df):
    return sorted((r.file_name, r.status) for r in df.collect())


def test_four_runs(spark):
    state = scd2.empty_tracker(spark)
    feeds = {}
    for run, entries in RUNS.items():
        feed = scd2.changes(state, listing(spark, entries), run)
        feeds[run] = statuses(scd2.label_reactivated(feed, state))
        if run == "2024-01-02 12:00:00":
            plan = rows(scd2.sync_plan(feed))
            assert [(n, a) for n, _, a in plan] == [("b", "fetch"), ("c", "fetch"), ("d", "delete"), ("e", "fetch")]
        state = tracker(spark, scd2.apply_listing(state, listing(spark, entries), run).collect())
    assert rows(state) == EXPECTED
    assert feeds == {
        "2024-01-01 12:00:00": [("a", "new"), ("b", "new"), ("c", "new"), ("d", "new")],
        "2024-01-02 12:00:00": [("b", "changed"), ("c", "changed"), ("d", "removed"), ("e", "new")],
        "2024-01-03 12:00:00": [("d", "reactivated")],
        "2024-01-04 12:00:00": [],
    }


def test_bootstrap(spark):
    got = scd2.bootstrap(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")
    assert got.columns == TRACKER_COLUMNS
    assert rows(got) == [(n, "t1", U, "2024-01-01 12:00:00", None, "Y") for n in "abcd"]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("missing", [False, True])
def test_random_runs_equal_a_naive_loop(spark, seed, missing):
    state, model = scd2.empty_tracker(spark), []
    for run, entries in sorted(naive.random_history(seed, runs=4, missing=missing).items()):
        feed = scd2.changes(state, listing(spark, entries), run)
        after = scd2.apply_listing(state, listing(spark, entries), run).collect()
        model, model_feed = naive.apply_listing(model, entries, run)
        assert statuses(feed) == model_feed
        state = tracker(spark, after)
        assert rows(state) == sorted(model, key=repr)
        active = [r for r in model if r[5] == "Y"]
        assert len({r[0] for r in active}) == len(active) == len(entries)


def test_same_listing_twice_changes_nothing(spark):
    state = tracker(spark, scd2.bootstrap(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00").collect())
    assert scd2.changes(state, listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-02 12:00:00").isEmpty()
    assert rows(scd2.apply_listing(state, listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-02 12:00:00")) == rows(state)


def test_missing_url_is_a_change(spark):
    state = tracker(spark, [("a", "t1", None, "2024-01-01 12:00:00", None, "Y")])
    assert statuses(scd2.changes(state, listing(spark, {"a": ("t1", None)}), "2024-01-02 12:00:00")) == [("a", "changed")]


def test_empty_listing_is_refused(spark):
    nothing = spark.createDataFrame([], LISTING)
    state = tracker(spark, EXPECTED)
    with pytest.raises(scd2.EmptyListingError):
        scd2.apply_listing(state, nothing, "2024-01-05 12:00:00")
    assert scd2.apply_listing(scd2.empty_tracker(spark), nothing, "2024-01-01 12:00:00").isEmpty()
    only_closed = tracker(spark, [r for r in EXPECTED if r[5] == "N"])
    assert scd2.apply_listing(only_closed, nothing, "2024-01-05 12:00:00").count() == 3


def test_duplicates_and_missing_names_are_refused(spark, failing):
    twice = spark.createDataFrame([("a", "t1", U), ("a", "t2", U)], LISTING)
    state = scd2.empty_tracker(spark)
    assert "listed more than once: a" in failing(scd2.changes(state, twice, "2024-01-01 12:00:00"))
    assert "no name" in failing(scd2.changes(state, spark.createDataFrame([(None, "t", U)], LISTING), "2024-01-01 12:00:00"))
    broken = tracker(spark, [("a", "t1", U, "2024-01-01 12:00:00", None, "Y"), ("a", "t2", U, "2024-01-02 12:00:00", None, "Y")])
    assert "several active versions: a" in failing(scd2.changes(broken, listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-03 12:00:00"))
    assert rows(scd2.first_active(broken)) == [("a", "2024-01-01 12:00:00", "t1", U, 2)]


def test_failed_fetches_stay_open(spark):
    state = tracker(spark, scd2.bootstrap(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00").collect())
    feed = scd2.changes(state, listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-02 12:00:00")
    failed = spark.createDataFrame([("b",), ("e",), ("d",)], "file_name string")
    assert statuses(scd2.without_failed(feed, failed)) == [("c", "changed"), ("d", "removed")]


def test_replay_of_four_runs(spark):
    assert rows(replay(history(spark, RUNS))) == EXPECTED


@pytest.mark.parametrize("seed", range(4))
def test_replay_equals_a_naive_loop_for_any_chunk(spark, seed):
    runs = naive.random_history(seed, runs=11, missing=seed % 2 == 1)
    expected = naive.replay(runs)
    for chunk in (1, 2, 3, 4096):
        assert rows(replay(history(spark, runs), chunk_runs=chunk)) == expected, chunk


def test_replay_without_broadcast(spark):
    runs = naive.random_history(11)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(replay(history(spark, runs), chunk_runs=2)) == naive.replay(runs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(6))
def test_replay_refuses_what_applying_would_refuse(spark, seed):
    """Runs that list nothing: both fail, or both give the same tracker."""
    runs = naive.random_history(seed, names=3, runs=5, empty=0.3)
    times = spark.createDataFrame([(r,) for r in runs], "run_ts string")
    try:
        expected = naive.replay(runs)
    except naive.Empty:
        with pytest.raises(scd2.EmptyListingError):
            replay(history(spark, runs), times)
    else:
        assert rows(replay(history(spark, runs), times)) == expected


def test_replay_loses_no_row(spark, failing):
    h = history(spark, RUNS)
    known = spark.createDataFrame([(r,) for r in list(RUNS)[:3]], "run_ts string")
    assert "not known: 2024-01-04 12:00:00" in failing(replay(h, known))
    nameless = h.unionByName(spark.createDataFrame([(None, "t", "u", "2024-01-01 12:00:00")], h.schema))
    assert "no name" in failing(replay(nameless))
    for bad in ("2024-1-1", "2024-01-01T12:00:00", "listing-7", None):
        with pytest.raises(Exception, match="not a run time"):
            replay(h.unionByName(spark.createDataFrame([("a", "t", "u", bad)], h.schema)))


def test_replay_knows_runs_that_listed_nothing_of_a_file(spark):
    h = history(spark, {"2024-01-01 12:00:00": {"a": ("t", U)}, "2024-01-03 12:00:00": {"a": ("t", U)}})
    runs = spark.createDataFrame([("2024-01-01 12:00:00",), ("2024-01-02 12:00:00",), ("2024-01-03 12:00:00",)], "run_ts string")
    assert rows(replay(h)) == [("a", "t", U, "2024-01-01 12:00:00", None, "Y")]
    with pytest.raises(scd2.EmptyListingError):
        replay(h, runs)
    assert rows(replay(h, runs, allow_empty=True)) == [("a", "t", U, "2024-01-01 12:00:00", "2024-01-02 12:00:00", "N"), ("a", "t", U, "2024-01-03 12:00:00", None, "Y")]


@pytest.mark.parametrize("chunk", [2, 4096])
def test_replay_refuses_duplicates(spark, failing, chunk):
    h = history(spark, RUNS).unionByName(history(spark, {"2024-01-03 12:00:00": {"e": ("t9", U)}}))
    assert "more than once in a run: e" in failing(replay(h, chunk_runs=chunk))


def test_calendar(spark):
    runs = [f"20{y}-{m:02d}-{d:02d} 00:00:00" for y in (23, 24) for m in (1, 5, 12) for d in (3, 9, 30)]
    df = spark.createDataFrame([(r,) for r in reversed(runs * 2)], "run_ts string")
    assert [tuple(r) for r in run_calendar(df).orderBy("ord").collect()] == list(enumerate(runs))


def test_versions_of_a_file_do_not_overlap(spark):
    got = replay(history(spark, naive.random_history(21, runs=11)), chunk_runs=3)
    a, b = got.alias("a"), got.alias("b")
    overlap = a.join(b, F.expr("a.file_name = b.file_name and a.start_timestamp < b.start_timestamp"))
    assert overlap.where(F.expr("a.end_timestamp is null or a.end_timestamp > b.start_timestamp")).isEmpty()
