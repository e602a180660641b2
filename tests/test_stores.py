import json

import naive
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_listing import BASE
from test_scd2 import EXPECTED, RUNS, listing, statuses

from tidemark.operators import scd2
from tidemark.operators.history import backlog_changes
from tidemark.plans.ingest import apply_and_land, ingest, ingest_population
from tidemark.schemas import LISTING, POPULATION_DOCUMENT, TRACKER
from tidemark.sinks.raw_store import RawStore, after_sync, fetch, wanted
from tidemark.sinks.tables import run_id, write_json_documents, write_json_table, write_tracker_csv
from tidemark.sinks.tracker_store import TrackerStore
from tidemark.sources.delimited import read_tracker_csv
from tidemark.sources.documents import read_documents, records
from tidemark.sources.files import file_sizes, missing_files, read_files, read_wanted
from tidemark.sources.pages import page_parts


@pytest.fixture
def store(spark, tmp_path):
    return TrackerStore(spark, str(tmp_path / "tracker"))


def test_runs_over_a_store(spark, store, tmp_path):
    for run, entries in RUNS.items():
        store.apply(listing(spark, entries), run)
    assert rows(store.tracker()) == EXPECTED
    assert rows(store.active()) == [r for r in EXPECTED if r[5] == "Y"]
    # The last run changed nothing: it is on record, but wrote no version.
    assert store.last_run().asDict() == {"run_ts": "2024-01-04 12:00:00", "run": "r20240104120000", "active_run": "r20240103120000"}
    assert not (tmp_path / "tracker" / "active" / "r20240104120000").exists()
    assert store.feed("2024-01-04 12:00:00").isEmpty()


def test_a_backlog_is_written_by_run_and_equals_its_runs_one_by_one(spark, tmp_path):
    wide = "r string, file_name string, file_timestamp string, full_url string"
    listed = [(f"2024-01-{r:02d} 12:00:00", f"f{i}", f"t{(r * i) // 9 % 3}", "u") for r in range(1, 6) for i in range(60) if (i * 7 + r * r) % 5]
    history = spark.createDataFrame(listed, wide).withColumnRenamed("r", "run_ts").repartition(4)
    runs = sorted({r[0] for r in listed})
    single, several = (TrackerStore(spark, str(tmp_path / name), buckets=3) for name in ("single", "several"))
    for run in runs:
        single.apply(history.where(F.col("run_ts") == run).drop("run_ts"), run)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several tasks find the feeds
    try:
        for part in (runs[:1], runs[1:3], runs[2:]):
            assert several.apply_backlog(history, part) == {}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(several.active()) == rows(single.active())
    assert rows(several.tracker()) == rows(single.tracker())
    for run in runs:
        assert rows(several.feed(run)) == rows(single.feed(run))
        assert len(list((tmp_path / "several" / "changes" / f"run={run_id(run)}").glob("part-*"))) == 1


def test_changes_of_a_backlog_say_which_versions_stay(spark):
    history = [("1", "a", "t"), ("2", "a", "t"), ("3", "a", "t"), ("1", "b", "t"), ("2", "b", "s"), ("1", "c", "t"), ("3", "c", "t")]
    listings = spark.createDataFrame([(*h, "u") for h in history], "run_ts string, file_name string, file_timestamp string, full_url string")
    held = spark.createDataFrame([("a", "t", "u", "0", None, "Y"), ("d", "t", "u", "0", None, "Y")], TRACKER)
    found = backlog_changes(held, listings, ["1", "2", "3"]).select("file_name", "status", "run_ts", "old_start_timestamp", "stays")
    assert rows(found) == [
        ("b", "changed", "2", "1", False),
        ("b", "new", "1", None, False),
        ("b", "removed", "3", "2", False),
        ("c", "new", "1", None, False),
        ("c", "new", "3", None, True),
        ("c", "removed", "2", "1", False),
        ("d", "removed", "1", "0", False),
    ]


def test_buckets_without_a_change_are_neither_read_nor_written(spark, tmp_path):
    store = TrackerStore(spark, str(tmp_path / "tracker"), buckets=5)
    entries = {f"f{i}": ("t1", "u") for i in range(100)}
    store.apply(listing(spark, entries), "2024-01-01 12:00:00")
    changed = entries | {"f7": ("t2", "u")}
    bucket = spark.createDataFrame([("f7",)], "file_name string").select(F.pmod(F.xxhash64("file_name"), F.lit(5))).first()[0]
    first = tmp_path / "tracker" / "active" / "r20240101120000"
    for other in range(5):
        if other != bucket:  # these could not be read
            for file in (first / f"bucket={other}").glob("part-*"):
                file.rename(file.with_name("kept-" + file.name[5:]).with_suffix(".hidden"))
                file.write_bytes(b"no table")
    assert statuses(store.apply(listing(spark, changed), "2024-01-02 12:00:00")) == [("f7", "changed")]
    backlog = spark.createDataFrame([(r, n, *v) for r in "34" for n, v in (changed | {"f7": (f"t{r}", "u")}).items()], "r string, file_name string, file_timestamp string, full_url string")
    backlog = backlog.select(F.concat(F.lit("2024-01-0"), "r", F.lit(" 12:00:00")).alias("run_ts"), "file_name", "file_timestamp", "full_url")
    assert store.apply_backlog(backlog, ["2024-01-03 12:00:00", "2024-01-04 12:00:00"]) == {}
    for run in ("r20240102120000", "r20240104120000"):
        assert [f.name for f in (tmp_path / "tracker" / "active" / run).glob("bucket=*")] == [f"bucket={bucket}"]
    for file in first.glob("*/kept-*"):
        file.rename(file.with_name("part-" + file.name[5:]).with_suffix(".parquet"))
        file.with_name("." + file.with_suffix("").name).unlink(missing_ok=True)
    for crc in first.glob("*/.part-*.crc"):
        crc.unlink()
    assert store.active().count() == 100
    assert sorted((r.file_timestamp, r.start_timestamp) for r in store.tracker().where("file_name = 'f7'").collect()) == [
        (f"t{i}", f"2024-01-0{i} 12:00:00") for i in range(1, 5)
    ]


def test_missing_values_are_always_compared(spark, tmp_path):
    """A file without a time or url has changed in every run, so its bucket is never passed over."""
    store = TrackerStore(spark, str(tmp_path / "tracker"), buckets=2)
    for i in (1, 2, 3):
        feed = store.apply(listing(spark, {"a": ("t1", None), "b": ("t1", "u")}), f"2024-01-0{i} 12:00:00")
    assert statuses(feed) == [("a", "changed")]
    with pytest.raises(Exception, match="more than once"):
        twice = listing(spark, {"b": ("t1", "u")})
        store.apply(twice.unionByName(twice).unionByName(twice), "2024-01-04 12:00:00")


def test_a_run_is_applied_once(spark, store):
    first = rows(store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00"))
    assert rows(store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-01 12:00:00")) == first
    assert store.log().count() == 1


def test_older_listings_are_refused(spark, store):
    store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")
    store.apply(listing(spark, RUNS["2024-01-03 12:00:00"]), "2024-01-03 12:00:00")
    with pytest.raises(scd2.StaleListingError):
        store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-02 12:00:00")
    assert store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00").count() == 4


def test_empty_listings(spark, store):
    nothing = spark.createDataFrame([], LISTING)
    assert store.apply(nothing, "2023-12-31 12:00:00").isEmpty() and store.last_run() is None
    store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")
    before = rows(store.tracker())
    with pytest.raises(scd2.EmptyListingError):
        store.apply(nothing, "2024-01-02 12:00:00")
    assert rows(store.tracker()) == before
    # Replacing every file at once is not an empty listing, and the failed run may be repeated.
    store.apply(listing(spark, {"z": ("t1", "u")}), "2024-01-02 12:00:00")
    assert [r.file_name for r in store.active().collect()] == ["z"]


def test_what_a_failed_run_left_is_not_read(spark, store):
    store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")

    def broken(feed, run_ts):
        raise OSError("disk full")

    with pytest.raises(OSError):
        store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-02 12:00:00", land=broken)
    assert rows(store.tracker()) == [(n, "t1", "u", "2024-01-01 12:00:00", None, "Y") for n in "abcd"]
    store.apply(listing(spark, RUNS["2024-01-03 12:00:00"]), "2024-01-03 12:00:00")
    expected, _ = naive.apply_listing(rows(scd2.bootstrap(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")), RUNS["2024-01-03 12:00:00"], "2024-01-03 12:00:00")
    assert rows(store.tracker()) == sorted(expected, key=repr)


def test_failed_fetches_come_again(spark, store):
    store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")
    failed = spark.createDataFrame([("b",)], "file_name string")
    assert statuses(store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-02 12:00:00", failed=failed)) == [
        ("c", "changed"),
        ("d", "removed"),
        ("e", "new"),
    ]
    assert statuses(store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-03 12:00:00")) == [("b", "changed")]


def test_seeding_from_an_existing_tracker(spark, store, tmp_path):
    after_r3 = [r for r in EXPECTED]
    path = str(tmp_path / "csv")
    write_tracker_csv(spark.createDataFrame(after_r3, TRACKER), path)
    store.seed(read_tracker_csv(spark, path))
    assert rows(store.tracker()) == EXPECTED
    assert store.apply(listing(spark, RUNS["2024-01-04 12:00:00"]), "2024-01-04 12:00:00").isEmpty()
    assert statuses(store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-05 12:00:00")) == [("d", "removed")]
    with pytest.raises(ValueError):
        store.seed(spark.createDataFrame(after_r3, TRACKER))
    twice = [("a", "t1", "u", "2024-01-01 12:00:00", None, "Y"), ("a", "t2", "u", "2024-01-01 12:00:00", None, "Y")]
    with pytest.raises(ValueError):
        TrackerStore(spark, str(tmp_path / "other")).seed(spark.createDataFrame(twice, TRACKER))


def test_pruning_keeps_the_tracker(spark, store):
    for run, entries in RUNS.items():
        store.apply(listing(spark, entries), run)
    store.prune()
    assert rows(store.tracker()) == EXPECTED
    # Only buckets that are still current hold rows.
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{store.path}/active").count() == store.active().count()


def test_long_json_documents(spark, tmp_path):
    """More than a variant could hold."""
    path = str(tmp_path / "json")
    record = F.concat(F.lit('{"k":"'), F.repeat(F.lit("x"), 1000), F.lit('"},'))
    long = spark.range(1).select(F.concat(F.lit("["), F.repeat(record, 140_000), F.lit("0]")).alias("payload"))
    write_json_documents(long, path)
    assert spark.read.text(path).select(F.length("value").alias("n")).first().n > 140_000_000


@pytest.mark.parametrize("run", ["R1", "2024-1-11", "2024-01-01", "2024-01-01T12:00:00", "2024-13-01 12:00:00", "", None])
def test_other_run_times_are_refused(spark, store, run):
    with pytest.raises(ValueError, match="not a run time"):
        store.apply(listing(spark, {"a": ("t1", "u")}), run)
    assert store.last_run() is None and not spark.sparkContext._jvm.java.io.File(store.path).exists()


def test_an_empty_listing_is_one_without_rows(spark, store):
    """A listing of which nothing could be fetched is not empty."""
    nothing, failed = spark.createDataFrame([], LISTING), spark.createDataFrame([("z",)], "file_name string")
    store.apply(listing(spark, {"a": ("t1", "u")}), "2024-01-01 12:00:00")
    feed = store.apply(listing(spark, {"z": ("t1", "u")}), "2024-01-02 12:00:00", failed=failed)
    assert statuses(feed) == [("a", "removed")] and store.active().isEmpty()
    store.apply(listing(spark, {"z": ("t1", "u")}), "2024-01-03 12:00:00")
    with pytest.raises(scd2.EmptyListingError):
        store.apply(nothing, "2024-01-04 12:00:00", failed=failed)


def test_compaction_around_month_and_year_ends(spark, store, tmp_path, mirror):
    raw = RawStore(spark, str(tmp_path / "raw"))
    times = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-10 00:00:00", "2024-01-31 12:00:00", "2024-02-01 00:00:00"]
    for i, run in enumerate(times):
        (mirror / "a").write_bytes(run.encode())
        entries = {"a": (f"t{i}", "u"), "b": ("t1", "u"), "c": (f"t{i // 2}", "u")}
        (mirror / "c").unlink(missing_ok=True) if i else None
        store.apply(listing(spark, entries), run, lambda f, r: raw.land_from_directory(str(mirror), f, r))
        if i % 2:
            raw.compact(store.active(), run)
        current = {r.file_name: bytes(r.content) for r in raw.current(store.active()).collect()}
        assert current == {"a": run.encode(), "b": b"b\x00\xff", "c": b"c\x00\xff"}


def test_bytes_are_not_shuffled_and_other_runs_not_read(spark, store, tmp_path, mirror, monkeypatch):
    raw = RawStore(spark, str(tmp_path / "raw"))
    for i in (1, 2, 3):
        entries = {"a": ("t1", "u"), "b": (f"t{i}", "u"), "c": (f"t{i // 2}", "u")}
        store.apply(listing(spark, entries), f"2024-01-0{i} 12:00:00", lambda f, r: raw.land_from_directory(str(mirror), f, r))
    for limit in (64 << 20, 100):
        monkeypatch.setattr("tidemark.sinks.raw_store.KEY_BYTES", limit)
        current = raw.current(store.active())
        assert sorted(r.file_name for r in current.collect()) == ["a", "b", "c"]
        plan = current._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "PartitionFilters: [run" in plan and "Shuffle" not in plan
        assert not [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]


def test_tracker_csv_round_trip(spark, tmp_path):
    data = [
        (" lead", "trail ", "  ", "R1", None, "Y"),
        ("007", "03/06/2025 08:30 AM", 'https://e/x?a="1",2', "2024-01-01 12:00:00", None, "Y"),
        ("a,b", "t1", "back\\slash", "2024-01-01 12:00:00", "2024-01-02 12:00:00", "N"),
    ]
    path = str(tmp_path / "csv")
    write_tracker_csv(spark.createDataFrame(data, TRACKER), path)
    got = read_tracker_csv(spark, path)
    assert got.schema == TRACKER and rows(got) == sorted(data, key=repr)
    for i, name in enumerate(("a\nb", "a\rb")):
        with pytest.raises(Exception, match="line break"):
            write_tracker_csv(spark.createDataFrame([(name, *data[0][1:])], TRACKER), str(tmp_path / f"bad{i}"))


def test_json_snapshots(spark, tmp_path):
    path = str(tmp_path / "json")
    df = spark.createDataFrame([(2013, 1), (2014, None)], "`ID Year` bigint, Population bigint")
    write_json_table(spark.range(1), path)
    write_json_table(df, path)
    assert rows(spark.read.schema(df.schema).json(path)) == rows(df)

    texts = [json.dumps({"data": [{"ID Year": 2013, "Population": 5}], "source": []}, indent=4)]
    payloads = spark.createDataFrame([(t,) for t in texts], "payload string")
    write_json_documents(payloads, path)
    assert rows(records(read_documents(spark, path, POPULATION_DOCUMENT, one_per_file=False))) == [(2013, 5)]
    for good in ('{"a":1,"a":2}', "[1, 2]", '"x"', "5", "null", '{\n "a":\r\n [ ] }\n'):
        write_json_documents(spark.createDataFrame([(good,)], "payload string"), path)
        assert [json.loads(r.value) for r in spark.read.text(path).collect()] == [json.loads(good)]
    for bad in ('{"data":', "", None, '{"a":1} x', '{"a":1}] [', '{"a":1}, {"b":2}', "{'a':1}", '{"a":"\n"}', "[1,]", "01"):
        with pytest.raises(Exception):
            write_json_documents(spark.createDataFrame([(bad,)], "payload string"), str(tmp_path / "bad"))


@pytest.fixture
def mirror(tmp_path):
    folder = tmp_path / "mirror"
    folder.mkdir()
    for name in ("a", "b", "c", "d", "odd name [1]"):
        (folder / name).write_bytes(name.encode() + b"\x00\xff")
    return folder


ODD_NAMES = ["odd name [1]", "a*", "b?{c,d}", "back\\slash", "x,y", "caf\u00e9 %41"]


@pytest.mark.parametrize("size", [1, 7, 256 << 20])
def test_reading_wanted_files(spark, mirror, monkeypatch, size):
    """Exactly the wanted files are opened, whatever their names; the others couldn't be read."""
    monkeypatch.setattr("tidemark.sources.files.TASK_BYTES", size)
    for name in ODD_NAMES:
        (mirror / name).write_bytes(name.encode() + b"\x00\xff")
    assert read_files(spark, str(mirror)).count() == 4 + len(ODD_NAMES)
    for name in ("b", "d"):
        (mirror / name).chmod(0)
    for names in (["a", "c", "absent", None], ODD_NAMES, ["absent"], []):
        wish = spark.createDataFrame([(n,) for n in names], "file_name string")
        found = read_wanted(spark, str(mirror), wish).collect()
        got = sorted((r.file_name, bytes(r.content)) for r in found)
        assert all(r.path == f"file:{mirror}/{r.file_name}" for r in found)
        assert got == sorted((n, n.encode() + b"\x00\xff") for n in names if n not in ("absent", None))
        missing = [r.file_name for r in missing_files(spark, str(mirror), wish).collect()]
        assert missing == [n for n in names if n == "absent"]


def test_names_that_lead_out_of_the_directory_have_no_file(spark, mirror):
    (mirror / "sub").mkdir()
    (mirror / "sub" / "e").write_bytes(b"inside")
    (mirror.parent / "secret").write_bytes(b"outside")
    wish = spark.createDataFrame([(n,) for n in ("../secret", "sub/../../secret", "sub", "", "sub/e")], "file_name string")
    assert [(r.file_name, bytes(r.content)) for r in read_wanted(spark, str(mirror), wish).collect()] == [("sub/e", b"inside")]
    assert missing_files(spark, str(mirror), wish).count() == 4


def test_a_file_system_that_only_spark_opens(spark, mirror, monkeypatch):
    monkeypatch.setattr("tidemark.sources.files.SCHEMES", ())
    wish = spark.createDataFrame([("a",), ("absent",), ("odd name [1]",), (None,)], "file_name string")
    assert sorted(r.file_name for r in read_wanted(spark, str(mirror), wish).collect()) == ["a", "odd name [1]"]
    assert [r.file_name for r in missing_files(spark, str(mirror), wish).collect()] == ["absent"]


def test_fetching_brings_no_name_to_the_driver(spark, mirror):
    """Names go from their table to the tasks that open the files: one plan, whatever their number."""
    wish = spark.range(500).select(F.concat(F.lit("n"), "id").alias("file_name"))
    read = read_wanted(spark, str(mirror), wish.unionByName(spark.createDataFrame([("a",)], "file_name string")))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "n499" not in plan and "LocalTableScan" not in plan and "FileScan binaryFile" not in plan
    assert [r.file_name for r in read.collect()] == ["a"]


def test_a_range_of_names_reads_its_row_groups_only(spark, store, tmp_path, monkeypatch):
    """Copies are read once in all, by pushed-down ranges of the hash, and never shuffled."""
    folder = tmp_path / "many"
    folder.mkdir()
    names = [f"f{i}" for i in range(60)]
    for n in names:
        (folder / n).write_bytes(n.encode() * 100)
    monkeypatch.setattr("tidemark.sources.files.TASK_BYTES", 3000)
    raw = RawStore(spark, str(tmp_path / "raw"))
    store.apply(listing(spark, {n: ("t1", "u") for n in names}), "2024-01-01 12:00:00", lambda f, r: raw.land_from_directory(str(folder), f, r))
    stored = spark.read.parquet(f"{raw.path}/copies").select("h", F.col("_metadata.file_path").alias("file"))
    ranges = sorted(tuple(r)[1:] for r in stored.groupBy("file").agg(F.min("h"), F.max("h")).collect())
    assert len(ranges) > 3 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    monkeypatch.setattr("tidemark.sinks.raw_store.KEY_BYTES", 1000)
    current = raw.current(store.active())
    assert sorted(r.file_name for r in current.collect()) == sorted(names)
    plan = current._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "content" in x]
    assert len(scans) >= 4 and all("GreaterThanOrEqual(h," in x and "LessThanOrEqual(h," in x for x in scans)
    assert not [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]


def test_sizes_of_files(spark, mirror):
    assert {r.file_name: r.n_bytes for r in file_sizes(spark, str(mirror)).collect()}["a"] == 3


def test_landing_and_deleting(spark, store, tmp_path, mirror):
    raw = RawStore(spark, str(tmp_path / "raw"))

    def land(feed, run_ts):
        raw.land_from_directory(str(mirror), feed, run_ts)

    def current():
        return {r.file_name: bytes(r.content) for r in raw.current(store.active()).collect()}

    store.apply(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00", land)
    assert current() == {n: n.encode() + b"\x00\xff" for n in "abcd"}
    # b changes, c's fetch gives nothing, d leaves, e is listed but absent.
    (mirror / "b").write_bytes(b"second")
    (mirror / "c").unlink()
    store.apply(listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-02 12:00:00", land)
    assert current() == {"a": b"a\x00\xff", "b": b"second", "c": b"c\x00\xff"}
    raw.land_from_directory(str(mirror), store.feed("2024-01-02 12:00:00"), "2024-01-02 12:00:00")
    assert current() == {"a": b"a\x00\xff", "b": b"second", "c": b"c\x00\xff"}
    (mirror / "d").write_bytes(b"back")
    store.apply(listing(spark, RUNS["2024-01-03 12:00:00"]), "2024-01-03 12:00:00", land)
    expected = {"a": b"a\x00\xff", "b": b"second", "c": b"c\x00\xff", "d": b"back"}
    assert current() == expected
    assert raw.landed().count() > 4
    raw.compact(store.active(), "2024-01-03 12:00:00")
    assert current() == expected
    assert raw.landed().count() == 4
    assert spark.read.parquet(f"{raw.path}/copies").count() == 4
    store.apply(listing(spark, {"a": ("t9", "u"), "d": ("t1", "u")}), "2024-01-05 12:00:00", land)
    assert current() == {"a": b"a\x00\xff", "d": b"back"}


def test_absent_files_can_be_left_for_the_next_run(spark, store, tmp_path, mirror):
    raw = RawStore(spark, str(tmp_path / "raw"))
    first = listing(spark, {"a": ("t1", "u"), "z": ("t1", "u")})
    assert statuses(apply_and_land(store, first, "2024-01-01 12:00:00", raw, str(mirror), retry_missing=True)) == [("a", "new")]
    (mirror / "z").write_bytes(b"late")
    assert statuses(apply_and_land(store, first, "2024-01-02 12:00:00", raw, str(mirror), retry_missing=True)) == [("z", "new")]
    assert sorted(r.file_name for r in raw.current(store.active()).collect()) == ["a", "z"]


def test_sync_of_a_file_table(spark):
    state = scd2.bootstrap(listing(spark, RUNS["2024-01-01 12:00:00"]), "2024-01-01 12:00:00")
    feed = scd2.changes(state, listing(spark, RUNS["2024-01-02 12:00:00"]), "2024-01-02 12:00:00")
    assert rows(wanted(feed)) == [("u", "b"), ("u", "e"), ("v", "c")]
    source = spark.createDataFrame([(n, bytearray(f"{n}2", "ascii")) for n in "abe"], "file_name string, content binary")
    held = spark.createDataFrame([(n, bytearray(f"{n}1", "ascii")) for n in "abc"], "file_name string, content binary")
    got = after_sync(held, feed, fetch(source, feed)).select("file_name", F.col("content").cast("string"))
    assert rows(got) == [("a", "a1"), ("b", "b2"), ("c", "c1"), ("e", "e2")]


PAGE = '<pre><A HREF="/">[To Parent Directory]</A><br> 3/6/2025  8:30 AM 3 <A HREF="/x/a">a</A><br></pre>'


def test_scheduled_run(spark, store, tmp_path, mirror):
    raw = RawStore(spark, str(tmp_path / "raw"))
    pages = spark.createDataFrame([("u", PAGE)], "url string, html string")
    payloads = spark.createDataFrame([('{"data":[],"source":[]}',)], "payload string")
    target = tmp_path / "population"
    ingest(store, pages, BASE, payloads, str(target), "2025-03-06 09:00:00", raw, str(mirror))
    assert rows(store.active()) == [
        ("a", "03/06/2025 08:30 AM", BASE + "/x/a", "2025-03-06 09:00:00", None, "Y")
    ]
    assert [r.file_name for r in raw.current(store.active()).collect()] == ["a"]
    assert (target / f"population-{run_id('2025-03-06 09:00:00')}").exists()
    # A listing that fails stops the run before population is written.
    with pytest.raises(scd2.EmptyListingError):
        ingest(store, pages.withColumn("html", F.lit("")), BASE, payloads, str(target), "2025-03-07 09:00:00")
    assert not (target / f"population-{run_id('2025-03-07 09:00:00')}").exists()
    assert ingest_population(payloads, str(target), "2024-01-09 12:00:00").endswith("population-r20240109120000")


def test_scheduled_run_from_page_files(spark, store, tmp_path):
    """Pages read in parts are a listing like pages in rows."""
    (tmp_path / "page.html").write_text(PAGE)
    payloads = spark.createDataFrame([('{"data":[],"source":[]}',)], "payload string")
    parts = page_parts(spark, str(tmp_path / "page.html"))
    ingest(store, parts, BASE, payloads, str(tmp_path / "population"), "2025-03-06 09:00:00", block=None)
    assert [r.file_name for r in store.active().collect()] == ["a"]
