import json
import os
import time

import naive
import pytest
from conftest import rows
from test_listing import BASE

from tidemark.plans.analysis import Questions
from tidemark.plans.ingest import ingest_population
from tidemark.sinks.raw_store import RawStore
from tidemark.sinks.tracker_store import TrackerStore
from tidemark.streaming.listings import listing_stream, track_listings
from tidemark.streaming.population import analyze_on_arrival, latest_result, population_stream

RUNS = {
    "2024-01-01 12:00:00": {"a": ("01/01/2024 08:30 AM", "/x/a"), "b": ("01/01/2024 08:30 AM", "/x/b")},
    "2024-01-02 12:00:00": {"a": ("01/02/2024 08:30 AM", "/x/a"), "c": ("01/02/2024 08:30 AM", "/x/c")},
    "2024-01-03 12:00:00": {"a": ("01/02/2024 08:30 AM", "/x/a"), "b": ("01/03/2024 08:30 AM", "/y/b")},
}
FIRST, SECOND, THIRD = RUNS


def page(run_ts, entries, number=1, pages=1):
    lines = "<br>\n".join(f'{t} 5 <A HREF="{u}">{n}</A>' for n, (t, u) in entries.items())
    return json.dumps({"run_ts": run_ts, "page": number, "pages": pages, "url": BASE, "html": f"<pre>{lines}</pre>"})


def land(folder, run_ts, entries):
    (folder / f"listing-{run_ts[:10]}.json").write_text(page(run_ts, entries))


def expected(*runs):
    return naive.replay({r: {n: (t, BASE + u) for n, (t, u) in RUNS[r].items()} for r in runs})


@pytest.fixture
def job(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = TrackerStore(spark, str(tmp_path / "tracker"))

    def run(checkpoint="checkpoint", **options):
        pages = listing_stream(spark, str(landing))
        track_listings(pages, store, BASE, str(tmp_path / checkpoint), **options).awaitTermination()
        return rows(store.tracker())

    return landing, store, run


def test_stop_and_restart_between_listings(job):
    landing, _, run = job
    land(landing, FIRST, RUNS[FIRST])
    assert run() == expected(FIRST)
    assert run() == expected(FIRST)
    land(landing, SECOND, RUNS[SECOND])
    assert run() == expected(FIRST, SECOND)
    land(landing, THIRD, RUNS[THIRD])
    assert run() == expected(*RUNS)


def test_waiting_listings_are_applied_in_order(job):
    landing, _, run = job
    for age, run_ts in enumerate(RUNS):
        land(landing, run_ts, RUNS[run_ts])
        # The newest listing has the oldest file.
        when = time.time() - 1000 * (age + 1)
        os.utime(landing / f"listing-{run_ts[:10]}.json", (when, when))
    assert run() == expected(*RUNS)


def test_files_delivered_again_change_nothing(job):
    landing, store, run = job
    for run_ts in RUNS:
        land(landing, run_ts, RUNS[run_ts])
    assert run("one") == run("two") == expected(*RUNS)
    assert store.log().count() == 3


FOURTH = "2024-01-04 12:00:00"


def test_a_late_listing_is_refused_and_the_stream_goes_on(job):
    landing, store, run = job
    land(landing, FIRST, RUNS[FIRST])
    land(landing, THIRD, RUNS[THIRD])
    run()
    before = rows(store.tracker())
    land(landing, SECOND, RUNS[SECOND])
    assert run() == before
    assert [(r.run_ts, "older than the last run" in r.reason) for r in store.refused().collect()] == [(SECOND, True)]
    land(landing, FOURTH, RUNS[SECOND])
    assert run() == naive.replay({r: {n: (t, BASE + u) for n, (t, u) in e.items()} for r, e in ((FIRST, RUNS[FIRST]), (THIRD, RUNS[THIRD]), (FOURTH, RUNS[SECOND]))})


def test_a_refused_listing_can_stop_the_stream(job):
    landing, store, run = job
    land(landing, FIRST, RUNS[FIRST])
    run()
    land(landing, SECOND, {})
    with pytest.raises(Exception, match="the listing is empty"):
        run(fail_on_refusal=True)
    assert run() == expected(FIRST)


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 1, 2), (2, 3, 1)])
def test_a_listing_in_three_files_over_three_starts(job, order):
    """It is applied when it is whole, and a page that lands again changes nothing."""
    landing, store, run = job
    land(landing, FIRST, RUNS[FIRST])
    run()
    entries = RUNS[SECOND] | {"d": ("01/02/2024 08:30 AM", "/x/d")}
    parts = [dict([e]) for e in entries.items()]
    for i, number in enumerate(order):
        assert run() == expected(FIRST)
        (landing / f"part-{i}.json").write_text(page(SECOND, parts[number - 1], number, 3))
        (landing / f"again-{i}.json").write_text(page(SECOND, parts[order[0] - 1], order[0], 3))
    runs = {FIRST: RUNS[FIRST], SECOND: entries}
    whole = naive.replay({r: {n: (t, BASE + u) for n, (t, u) in e.items()} for r, e in runs.items()})
    assert run() == run() == whole and store.refused().isEmpty()


def test_bad_listings_between_good_ones(job):
    """An empty one, one that names a file twice, one whose pages disagree, and one that grows after it was applied."""
    landing, store, run = job
    land(landing, FIRST, RUNS[FIRST])
    (landing / "none.json").write_text(page("2024-01-01 18:00:00", {}))
    twice = page("2024-01-01 19:00:00", RUNS[FIRST]).replace("</pre>", "<br>1/1/2024 08:30 AM 5 <a href=/x/a>a</a></pre>")
    (landing / "twice.json").write_text(twice)
    (landing / "p1.json").write_text(page("2024-01-01 20:00:00", RUNS[FIRST], 1, 2))
    (landing / "p2.json").write_text(page("2024-01-01 20:00:00", RUNS[SECOND], 2, 3))
    land(landing, SECOND, RUNS[SECOND])
    assert run() == expected(FIRST, SECOND)
    (landing / "more.json").write_text(page(SECOND, {"z": ("01/02/2024 08:30 AM", "/z")}, 2, 2))
    land(landing, THIRD, RUNS[THIRD])
    assert run() == expected(*RUNS)
    reasons = {r.run_ts: r.reason for r in store.refused().collect()}
    assert sorted(reasons) == ["2024-01-01 18:00:00", "2024-01-01 19:00:00", "2024-01-01 20:00:00", SECOND]
    assert "empty" in reasons["2024-01-01 18:00:00"] and "more than once" in reasons["2024-01-01 19:00:00"]
    assert "disagree" in reasons["2024-01-01 20:00:00"] and "more pages" in reasons[SECOND]


def test_files_are_landed(spark, job, tmp_path):
    landing, store, run = job
    mirror = tmp_path / "mirror"
    mirror.mkdir()
    raw = RawStore(spark, str(tmp_path / "raw"))
    for run_ts in RUNS:
        for name in RUNS[run_ts]:
            (mirror / name).write_text(f"{name} of {run_ts}")
        land(landing, run_ts, RUNS[run_ts])
        run(raw=raw, mirror=str(mirror))
    current = {r.file_name: bytes(r.content).decode() for r in raw.current(store.active()).collect()}
    assert current == {"a": f"a of {SECOND}", "b": f"b of {THIRD}"}


def document(*years):
    return {"data": [{"ID Year": y, "Population": 100 * y} for y in years], "source": []}


def test_a_new_snapshot_triggers_the_analysis(spark, tmp_path):
    inbox, results = tmp_path / "inbox", str(tmp_path / "results")
    inbox.mkdir()
    series = spark.createDataFrame(
        [("S", 2013, "Q01", 1.0), ("S", 2014, "Q01", 3.0)], "series_id string, year int, period string, value double"
    )

    def run():
        documents = population_stream(spark, str(inbox))
        checkpoint = str(tmp_path / "checkpoint")
        analyze_on_arrival(documents, series, results, checkpoint, Questions(series_id="S")).awaitTermination()
        return [r.year for r in latest_result(spark, results, "series_with_population").orderBy("year").collect()]

    (inbox / "population-r1.json").write_text(json.dumps(document(2013), indent=4))
    assert run() == [2013]
    assert rows(latest_result(spark, results, "population_stats")) == [(201300.0, None)]
    assert rows(latest_result(spark, results, "best_years")) == [("S", 2014, 3.0)]
    # A rewritten file is not seen; a new name is, and the newest of several counts.
    (inbox / "population-r1.json").write_text(json.dumps(document(2014), indent=4))
    assert run() == [2013]
    (inbox / "population-r3.json").write_text(json.dumps(document(2013, 2014), indent=4))
    (inbox / "population-r2.json").write_text(json.dumps(document(2014)))
    assert run() == [2013, 2014]
    # So does a snapshot written by the ingest job.
    payloads = spark.createDataFrame([(json.dumps(document(2014)),)], "payload string")
    ingest_population(payloads, str(inbox), "4000-01-01 00:00:00")
    assert run() == [2014]


BAD = "2024-01-01 15:00:00"


@pytest.mark.parametrize(
    "line",
    [
        '13/45/2025 08:30 AM 5 <a href="/x/a">a</a>',
        '1/2/2024 25:30 AM 5 <a href="/x/a">a</a>',
        '1/2/2024 08:30 AM 99999999999999999999 <a href="/x/a">a</a>',
        '1/2/2024 morning 5 <a href="/x/a">a</a>',
    ],
)
def test_an_entry_that_cannot_be_read_refuses_its_listing_only(job, line):
    landing, store, run = job
    land(landing, FIRST, RUNS[FIRST])
    (landing / "bad.json").write_text(json.dumps({"run_ts": BAD, "page": 1, "pages": 2, "url": "u", "html": f"<pre>{line}<br></pre>"}))
    (landing / "good.json").write_text(page(BAD, RUNS[SECOND], 2, 2))
    assert run() == expected(FIRST)
    (refused,), (put_aside,) = store.refused().collect(), store.unreadable().collect()
    assert refused.run_ts == BAD and refused.reason.startswith(("no such", "not read"))
    assert put_aside.asDict() == {"run_ts": BAD, "page": 1, "pages": 2, "page_url": "u", "problem": refused.reason}
    land(landing, SECOND, RUNS[SECOND])
    land(landing, THIRD, RUNS[THIRD])
    assert run() == expected(*RUNS)


def test_records_that_are_no_pages_are_put_aside(job):
    landing, store, run = job
    land(landing, FIRST, RUNS[FIRST])
    whole = json.loads(page(BAD, RUNS[SECOND]))
    for i, missing in enumerate(("run_ts", "page", "pages", "html")):
        (landing / f"bad-{i}.json").write_text(json.dumps({k: v for k, v in whole.items() if k != missing} | ({"run_ts": f"{BAD[:-1]}{i}"} if i else {})))
    odd = [{"run_ts": "yesterday"}, {"run_ts": "2024-01-01 16:00:00", "page": 3, "pages": 2}, {"run_ts": "2024-01-01 17:00:00", "page": "one"}]
    for i, change in enumerate(odd):
        (landing / f"odd-{i}.json").write_text(json.dumps(whole | change))
    (landing / "broken.json").write_text('{"run_ts": "2024-01-01 18:00:00", "page"')
    land(landing, SECOND, RUNS[SECOND])
    assert run() == run() == expected(FIRST, SECOND)
    reasons = {r.run_ts: r.reason for r in store.refused().collect()}
    assert {k: v[:30] for k, v in reasons.items()} == {
        "(missing)": "not a page: {\"run_ts\": \"2024-0"[:30],
        "2024-01-01 15:00:01": "a page does not say 'page'",
        "2024-01-01 15:00:02": "a page does not say 'pages'",
        "2024-01-01 15:00:03": "a page does not say 'html'",
        "yesterday": "not a run time: yesterday",
        "2024-01-01 16:00:00": "a page is not among those of its listing"[:30],
        "2024-01-01 17:00:00": reasons["2024-01-01 17:00:00"][:30],
    }
    assert reasons["2024-01-01 17:00:00"].startswith("not a page: {")
    assert store.unreadable().count() == 8


def test_a_backlog_equals_one_listing_after_another(spark, tmp_path):
    import random

    from test_scd2 import listing

    some = random.Random(8)
    runs = [f"2024-02-{d:02d} 12:00:00" for d in range(1, 13)]
    contents = {}
    for r in runs:
        names = [n for n in "abcdefghij" if some.random() < 0.6]
        contents[r] = {n: (some.choice([None, "t1", "t2"]) if some.random() < 0.1 else some.choice(["t1", "t2"]), "u") for n in names}
    contents[runs[4]] = {}  # refused, as files are active
    contents[runs[6]] = contents[runs[5]]  # nothing changes
    single, several = TrackerStore(spark, str(tmp_path / "single")), TrackerStore(spark, str(tmp_path / "several"))
    for r in runs:
        try:
            single.apply(listing(spark, contents[r]), r)
        except ValueError:
            pass
    refused = {}
    for part in (runs[:1], runs[1:8], runs[5:12]):  # some come twice
        rows_ = [(r, n, t, u) for r in part for n, (t, u) in contents[r].items()]
        refused |= several.apply_backlog(spark.createDataFrame(rows_, "run_ts string, file_name string, file_timestamp string, full_url string"), part)
    assert list(refused) == [runs[4]]
    assert rows(several.tracker()) == rows(single.tracker())
    assert rows(several.active()) == rows(single.active())
    assert rows(several.all_changes()) == rows(single.all_changes())
    assert [rows(several.feed(r)) for r in runs if r != runs[4]] == [rows(single.feed(r)) for r in runs if r != runs[4]]
    assert sorted(r.run_ts for r in several.log().collect()) == [r for r in runs if r != runs[4]]


SERIES = "series_id string, year int, period string, value double"


def test_an_arrival_reads_kept_sums_only(spark, tmp_path):
    """The text of the series is gone when population arrives; what is kept of it answers, and no plan adds rows up again."""
    from tidemark.plans import analysis as A
    from tidemark.sinks.series_store import SeriesStore

    text = tmp_path / "series.tsv"
    text.write_text("series_id\tyear\tperiod\tvalue\n" + "".join(f"S{i % 3}\t{2013 + i % 4}\tQ0{i % 2 + 1}\t{i / 8}\n" for i in range(200)))
    store = SeriesStore(spark, str(tmp_path / "kept"))
    with pytest.raises(ValueError, match="no series is kept"):
        store.sums()
    cleaned = A.prepare_series(spark, str(text))
    expected = {q: rows(t) for q, t in A.answer(cleaned, spark.createDataFrame([(2013, 5), (2014, 7)], "`ID Year` long, Population long"), Questions(series_id="S1")).items()}
    store.keep(cleaned.where("year < 2015"), "v1", "old")
    store.keep(cleaned, "v1", "new")  # replaced by the next
    store.keep(cleaned.where("year >= 2015"), "v2", "new")
    store.keep(cleaned.where("year >= 2015"), "v2", "new")
    text.unlink()
    inbox, results = tmp_path / "inbox", str(tmp_path / "results")
    inbox.mkdir()
    for years in ((2013,), (2013, 2014)):
        (inbox / f"population-r{len(years)}.json").write_text(json.dumps({"data": [{"ID Year": y, "Population": 2 * y - 4021} for y in years], "source": []}))
        stream = population_stream(spark, str(inbox))
        analyze_on_arrival(stream, store, results, str(tmp_path / "checkpoint"), Questions(series_id="S1")).awaitTermination()
    assert {q: rows(latest_result(spark, results, q)) for q in expected} == expected
    plan = A.best_of_sums(store.sums())._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [series_id#" in plan and ",value#" not in plan and "csv" not in plan
    best = A.answer(store.series(), spark.createDataFrame([(2013, 5)], "`ID Year` long, Population long"), Questions(series_id="S1"))["series_with_population"]
    assert "PushedFilters: [IsNotNull(series_id), IsNotNull(period), EqualTo(series_id,S1)" in best._jdf.queryExecution().executedPlan().toString()


def test_names_of_kept_parts(spark, tmp_path):
    from tidemark.sinks.series_store import SeriesStore

    with pytest.raises(ValueError, match="not a name"):
        SeriesStore(spark, str(tmp_path)).keep(spark.createDataFrame([], SERIES), "../v")
