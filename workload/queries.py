"""One query per operator. Each takes `(spark, sf_dir)` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import paths
from tidemark.operators import aggregates as agg
from tidemark.operators import scd2
from tidemark.operators.history import replay
from tidemark.plans import analysis
from tidemark.operators.joins import settle
from tidemark.plans.ingest import ingest, ingest_population, run_time
from tidemark.schemas import POPULATION_DOCUMENT
from tidemark.session import scratch_path
from tidemark.sinks import raw_store
from tidemark.sinks.series_store import SeriesStore
from tidemark.sinks.tables import RUN_TIME, write_json_table, write_tracker_csv
from tidemark.sinks.tracker_store import TrackerStore
from tidemark.sources.delimited import read_tracker_csv
from tidemark.sources.documents import read_documents, records
from tidemark.sources.files import file_sizes, read_files
from tidemark.sources.pages import LINK_END, LINK_ENTRY, entries, extract_listing, page_parts
from tidemark.streaming.listings import listing_stream, track_listings
from tidemark.streaming.population import analyze_on_arrival, latest_result, population_stream
from workload import derive as D

Query = Callable[[SparkSession, str], DataFrame]


# Cleaning


def clean_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.prepare_series(spark, D.padded_series(spark, sf_dir))


def _population_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ingest_population(D.population_payloads(spark, sf_dir), scratch_path(spark, "population"), D.FIRST_RUN)
    return read_documents(spark, path, POPULATION_DOCUMENT, one_per_file=False)


def population_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(_population_from_files(spark, sf_dir), "data")


def population_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = records(_population_from_files(spark, sf_dir), "source")
    name = F.col("`annotations.source_name`").alias("source_name")
    return source.select("name", F.array_join("measures", ",").alias("measures"), name)


# Questions


def population_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = D.QUESTIONS
    _, stats = analysis.population_metrics(D.population(spark, sf_dir), q.first_year, q.last_year)
    return stats


def population_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = D.QUESTIONS
    return analysis.population_metrics(D.population(spark, sf_dir), q.first_year, q.last_year)[0]


def population_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.deviation_band(population_rows(spark, sf_dir), "Population")


def best_year_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.best_years(D.series(spark, sf_dir))


def best_year_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.best_years(clean_series(spark, sf_dir))


def best_year_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a file with missing values and keys, other white space and ties of rounding."""
    return analysis.best_years(analysis.prepare_series(spark, D.odd_series(spark, sf_dir)))


def clean_series_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.prepare_series(spark, D.odd_series(spark, sf_dir))


def clean_series_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a file whose quoted cells hold line feeds, read by many tasks."""
    return analysis.prepare_series(spark, D.quoted_series(spark, sf_dir))


def clean_landed_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file as landed bytes."""
    return analysis.prepare_landed_series(read_files(spark, D.quoted_series(spark, sf_dir)))


def best_year_from_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.best_years(analysis.prepare_landed_series(read_files(spark, D.padded_series(spark, sf_dir))))


def yearly_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = agg.sum_by(D.series(spark, sf_dir), ["series_id", "year"], "value")
    return sums.select("series_id", "year", F.col("total").cast("double").alias("value"))


def series_with_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = D.QUESTIONS
    return analysis.series_with_population(
        D.series(spark, sf_dir), D.population(spark, sf_dir), q.series_id, q.period
    )


def _tagged(answers: dict[str, DataFrame]) -> DataFrame:
    """The three answers in one table."""
    stats = answers["population_stats"].withColumn("question", F.lit("population_stats"))
    best = answers["best_years"].withColumn("question", F.lit("best_years"))
    joined = answers["series_with_population"].withColumn("question", F.lit("series_with_population"))
    return stats.unionByName(best, allowMissingColumns=True).unionByName(joined, allowMissingColumns=True)


def analysis_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from a series file and one indented document of all years."""
    series, document = D.padded_series(spark, sf_dir), D.population_document(spark, sf_dir)
    return _tagged(analysis.analyze(spark, series, document, D.QUESTIONS, scratch_path(spark, "clean")))


def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.distinct_values(series_with_population(spark, sf_dir), "year")


def distinct_populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.distinct_values(series_with_population(spark, sf_dir), "Population")


def first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.first_row(series_with_population(spark, sf_dir), ["year", "period", "value"], ["series_id", "period"])


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.profile(D.series(spark, sf_dir).withColumn("missing", F.nullif(F.col("period"), F.lit("Q02"))))


def table_profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.profile(D.table(spark, sf_dir, "lineitem"))


# Listings and paths


def listing_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_listing(D.part_pages(spark, sf_dir), D.BASE_URL).drop("file_ts")


def listing_extract_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_listing(D.odd_pages(spark, sf_dir), D.BASE_URL).drop("file_ts")


def listing_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing whose pages are files, each read by as many tasks as it has splits."""
    path = D.listing_page_files(D.shipping_listing(spark, sf_dir, "F"), "pages")
    return extract_listing(page_parts(spark, path), D.BASE_URL, block=None).select("file_name", "file_timestamp", "full_url")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = D.table(spark, sf_dir, "pages").select("page_id", "html")
    found = entries(pages, LINK_ENTRY, ["href", "label"], block=None, cut=LINK_END)
    return found.select("page_id", F.concat(F.lit(D.BASE_URL), "href").alias("full_url"), "label")


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.regexp_replace("url", "^http://", "s3://")
    return D.table(spark, sf_dir, "pages").select(
        "page_id",
        paths.is_object_url(url).alias("is_object"),
        paths.is_http_url(url).alias("is_http"),
        paths.container(url).alias("container"),
        paths.key(url).alias("key"),
        paths.directory_of(url).alias("directory"),
        paths.file_name_of(url).alias("file_name"),
        paths.join_path(paths.directory_of(url), F.lit("index.html")).alias("joined"),
    )


# Tracker


def scd2_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.bootstrap(D.shipping_listing(spark, sf_dir, "F"), D.FIRST_RUN)


def scd2_bootstrap_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run at the time of the clock: how many files there are, and whether all bear that one time, in the one form and of this day."""
    stamp = run_time()
    tracker = scd2.bootstrap(D.shipping_listing(spark, sf_dir, "F"), stamp)
    age = F.abs(F.unix_timestamp("start_timestamp", "yyyy-MM-dd HH:mm:ss") - F.unix_timestamp())
    return tracker.groupBy((F.col("start_timestamp") == stamp).alias("stamped")).agg(
        F.count("*").alias("n_files"), F.every(F.col("start_timestamp").rlike(f"^{RUN_TIME}$")).alias("well_formed"), (F.max(age) < 86_400).alias("of_today")
    )


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = D.shipping_listing(spark, sf_dir, "O")
    return scd2.apply_listing(scd2_bootstrap(spark, sf_dir), listing, D.SECOND_RUN)


def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = D.shipping_listing(spark, sf_dir, "O")
    return scd2.changes(scd2_bootstrap(spark, sf_dir), listing, D.SECOND_RUN)


def scd2_reactivated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back to the first listing: what left in the second run comes back."""
    tracker = settle(scd2_apply(spark, sf_dir), "tracker")
    feed = scd2.changes(tracker, D.shipping_listing(spark, sf_dir, "F"), "2024-01-03 12:00:00")
    return scd2.label_reactivated(feed, tracker).select("file_name", "status")


def first_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.first_active(scd2_apply(spark, sf_dir)).select("file_name", "start_timestamp", "n_active")


def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.sync_plan(scd2_changes(spark, sf_dir))


def tracker_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tracker-csv")
    write_tracker_csv(scd2_apply(spark, sf_dir), path)
    return read_tracker_csv(spark, path)


def tracker_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TrackerStore(spark, scratch_path(spark, "tracker"))
    for status, run_ts in (("F", D.FIRST_RUN), ("O", D.SECOND_RUN)):
        store.apply(D.shipping_listing(spark, sf_dir, status), run_ts)
    return store.tracker()


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(*D.event_history(spark, sf_dir))


def scd2_history_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(*D.part_history(spark, sf_dir))


# Files


def raw_after_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = D.document_listings(spark, sf_dir)
    held = D.document_files(spark, sf_dir).join(first, "file_name", "left_semi")
    feed = settle(scd2.changes(scd2.bootstrap(first, D.FIRST_RUN), second, D.SECOND_RUN), "feed")
    fetched = raw_store.fetch(D.document_files(spark, sf_dir, suffix=" v2"), feed)
    after = raw_store.after_sync(held, feed, fetched)
    return after.select("file_name", F.octet_length("content").alias("n_bytes"), F.md5("content").alias("md5"))


def raw_store_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TrackerStore(spark, scratch_path(spark, "tracker"))
    raw = raw_store.RawStore(spark, scratch_path(spark, "raw"))
    first, second = D.document_listings(spark, sf_dir)
    for listing, run_ts, suffix in ((first, D.FIRST_RUN, ""), (second, D.SECOND_RUN, " v2")):
        files = D.document_files(spark, sf_dir, suffix)
        store.apply(listing, run_ts, lambda feed, run, files=files: raw.land(raw_store.fetch(files, feed), feed, run))
    current = raw.current(store.active())
    return current.select("file_name", F.octet_length("content").alias("n_bytes"), F.md5("content").alias("md5"))


def raw_from_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs whose files are fetched out of a directory.

    The second listing drops some files, and some that it lists are not in the directory.
    """
    mirror = D.supplier_files(spark, sf_dir)
    store, raw = TrackerStore(spark, scratch_path(spark, "tracker")), raw_store.RawStore(spark, scratch_path(spark, "raw"))
    for listing, run_ts in zip(D.supplier_listings(spark, sf_dir), (D.FIRST_RUN, D.SECOND_RUN), strict=True):
        store.apply(listing, run_ts, lambda feed, run: raw.land_from_directory(mirror, feed, run))
    current = raw.current(store.active())
    return current.select("file_name", F.octet_length("content").alias("n_bytes"), "run_ts")


def scheduled_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scheduled runs, the last without a change, each with its pages from files and its population; what the tracker and the folder then hold."""
    store, inbox = TrackerStore(spark, scratch_path(spark, "tracker")), scratch_path(spark, "population")
    for status, run_ts in (("F", D.FIRST_RUN), ("O", D.SECOND_RUN), ("O", "2024-01-03 12:00:00")):
        pages = page_parts(spark, D.listing_page_files(D.shipping_listing(spark, sf_dir, status), "pages"))
        ingest(store, pages, D.BASE_URL, D.population_payloads(spark, sf_dir), inbox, run_ts, block=None)
    versions = store.tracker().groupBy("start_timestamp", "end_timestamp").agg(F.count("*").alias("n"))
    run = F.regexp_extract("_metadata.file_path", "population-(r[0-9]+)", 1).alias("start_timestamp")
    snapshots = spark.read.text(f"{inbox}/*").select(run).groupBy("start_timestamp").agg(F.count("*").alias("n"))
    return versions.unionByName(snapshots, allowMissingColumns=True)


def file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files per language and read back as opaque bytes."""
    path = scratch_path(spark, "files")
    D.table(spark, sf_dir, "documents").select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(path)
    folder = paths.file_name_of(paths.directory_of(F.col("path")))
    return file_sizes(spark, f"{path}/*").groupBy(folder.alias("folder")).agg(F.sum("n_bytes").alias("n_bytes"))


def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshot")
    population = D.population(spark, sf_dir)
    write_json_table(population, path)
    return spark.read.schema(population.schema).json(path)


# Streams


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listings land one after the other; the job is started after each."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    store = TrackerStore(spark, scratch_path(spark, "tracker"))
    for status, run_ts in (("F", D.FIRST_RUN), ("O", D.SECOND_RUN)):
        pages = D.listing_pages(D.shipping_listing(spark, sf_dir, status), run_ts)
        pages.write.json(f"{landing}/{status}")
        track_listings(listing_stream(spark, f"{landing}/*"), store, D.BASE_URL, checkpoint).awaitTermination()
    return store.tracker()


def stream_scd2_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose pages land in several files over several starts, an empty and a late one among them."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    store = TrackerStore(spark, scratch_path(spark, "tracker"))
    first = settle(D.listing_pages(D.shipping_listing(spark, sf_dir, "F"), D.FIRST_RUN), "pages")
    second = settle(D.listing_pages(D.shipping_listing(spark, sf_dir, "O"), D.SECOND_RUN), "pages")
    none = first.withColumns({"run_ts": F.lit("2024-01-01 18:00:00"), "html": F.lit("<pre></pre>")})
    late = first.withColumn("run_ts", F.lit("2023-12-31 12:00:00"))
    starts = [
        first.where("page <= 9"),
        first.where("page > 5").unionByName(second.where("page % 3 = 0")),
        none.unionByName(second.where("page % 3 = 1")),
        late.unionByName(second.where("page % 3 = 2")),
    ]
    for i, pages in enumerate(starts):
        pages.repartition(3).write.json(f"{landing}/{i}")
        track_listings(listing_stream(spark, f"{landing}/*"), store, D.BASE_URL, checkpoint).awaitTermination()
    refused = store.refused().select(F.col("run_ts").alias("start_timestamp"), F.lit("refused").alias("is_active"))
    return store.tracker().unionByName(refused, allowMissingColumns=True)


def stream_scd2_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between two good listings land one with an impossible date and pages that don't say what they belong to; all wait for one start."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    store = TrackerStore(spark, scratch_path(spark, "tracker"))
    first = settle(D.listing_pages(D.shipping_listing(spark, sf_dir, "F"), D.FIRST_RUN), "pages")
    dated = F.when(F.col("page") == 7, F.lit('<pre>13/45/2025 08:30 AM 1 <a href="/x">x</a><br></pre>')).otherwise(F.col("html"))
    landed = [
        first,
        first.withColumns({"run_ts": F.lit("2024-01-01 15:00:00"), "html": dated}),
        first.where("page < 4").withColumn("run_ts", F.lit(None).cast("string")),
        first.where("page < 3").withColumns({"run_ts": F.lit("2024-01-01 16:00:00"), "page": F.lit(None).cast("long")}),
        D.listing_pages(D.shipping_listing(spark, sf_dir, "O"), D.SECOND_RUN),
    ]
    for i, pages in enumerate(landed):
        pages.write.json(f"{landing}/{i}")
    track_listings(listing_stream(spark, f"{landing}/*"), store, D.BASE_URL, checkpoint).awaitTermination()
    refused = store.refused().select(F.col("run_ts").alias("start_timestamp"), F.col("reason").alias("full_url"), F.lit("refused").alias("is_active"))
    apart = store.unreadable().select(F.col("page").cast("string").alias("file_name"), F.col("problem").alias("full_url"), F.lit("unreadable").alias("is_active"))
    return store.tracker().unionByName(refused, allowMissingColumns=True).unionByName(apart, allowMissingColumns=True)


def scd2_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly listings of parts: the first two months one after another, the others in two passes on top, in which some come again."""
    history, runs = D.part_history(spark, sf_dir)
    history = settle(history, "history")
    store = TrackerStore(spark, scratch_path(spark, "tracker"))
    names = sorted(r.run_ts for r in runs.collect())  # one row per month
    for run in names[:2]:
        store.apply(history.where(F.col("run_ts") == run).drop("run_ts"), run)
    for part in (names[:7], names[5:]):
        store.apply_backlog(history, part)
    return store.tracker()


def stream_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A population snapshot lands and starts the analysis."""
    inbox, results = scratch_path(spark, "population"), scratch_path(spark, "results")
    ingest_population(D.population_payloads(spark, sf_dir), inbox, D.FIRST_RUN)
    arriving = population_stream(spark, inbox, one_per_file=False)
    analyze_on_arrival(
        arriving, D.series(spark, sf_dir), results, scratch_path(spark, "checkpoint"), D.QUESTIONS
    ).awaitTermination()
    names = ("population_stats", "best_years", "series_with_population")
    return _tagged({n: latest_result(spark, results, n) for n in names})


def stream_analysis_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series is kept by quarter, one of them in an older version too; then two population snapshots arrive, one after the other."""
    inbox, results, checkpoint = (scratch_path(spark, n) for n in ("population", "results", "checkpoint"))
    kept, cleaned = SeriesStore(spark, scratch_path(spark, "kept")), settle(clean_series(spark, sf_dir), "cleaned")
    kept.keep(cleaned, "v1", "Q01")
    for quarter in ("Q01", "Q02", "Q03", "Q04"):
        kept.keep(cleaned.where(F.col("period") == quarter), "v2", quarter)
    older = D.population_payloads(spark, sf_dir).where("payload like '%1999%'")
    for run_ts, payloads in ((D.FIRST_RUN, older), (D.SECOND_RUN, D.population_payloads(spark, sf_dir))):
        ingest_population(payloads, inbox, run_ts)
        analyze_on_arrival(population_stream(spark, inbox, one_per_file=False), kept, results, checkpoint, D.QUESTIONS).awaitTermination()
    names = ("population_stats", "best_years", "series_with_population")
    return _tagged({n: latest_result(spark, results, n) for n in names})


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_series,
        population_prepared,
        population_source,
        population_stats,
        population_rows,
        population_band,
        best_year_per_series,
        best_year_from_text,
        best_year_odd,
        clean_series_odd,
        clean_series_quoted,
        clean_landed_quoted,
        best_year_from_landed,
        yearly_sums,
        series_with_population,
        analysis_all,
        distinct_years,
        distinct_populations,
        first_label,
        table_profile,
        table_profile_lines,
        listing_extract,
        listing_extract_odd,
        listing_from_files,
        page_links,
        path_parts,
        scd2_bootstrap,
        scd2_bootstrap_now,
        scd2_apply,
        scd2_changes,
        scd2_reactivated,
        first_active,
        sync_plan,
        tracker_round_trip,
        tracker_store,
        scd2_history,
        scd2_history_parts,
        scd2_backlog,
        raw_after_sync,
        raw_store_current,
        raw_from_directory,
        scheduled_run,
        file_bytes,
        snapshot_round_trip,
        stream_scd2,
        stream_scd2_pages,
        stream_scd2_unreadable,
        stream_analysis,
        stream_analysis_kept,
    )
}
