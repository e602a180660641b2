"""Recurring ingest: listing first, population only when the listing went through."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame

from tidemark.schemas import LISTING_COLUMNS
from tidemark.sinks.raw_store import RawStore
from tidemark.sinks.tables import run_id, write_json_documents
from tidemark.sinks.tracker_store import TrackerStore
from tidemark.sources.files import missing_files
from tidemark.sources.pages import PRE_BLOCK, extract_listing


def run_time() -> str:
    """The clock, in UTC, as a run time. Read it once per run, at the edge."""
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")


def ingest_listing(
    store: TrackerStore,
    pages: DataFrame,
    base_url: str,
    run_ts: str,
    raw: RawStore | None = None,
    mirror: str | None = None,
    retry_missing: bool = False,
    block: str | None = PRE_BLOCK,
) -> DataFrame:
    """Pages of one listing to tracker and landed files; returns the change feed.

    Pages of any size are given as `page_parts`, with no `block`.

    `mirror` is the directory in which the files named on the pages can be read. A file that is
    listed but absent there counts as done, unless `retry_missing` leaves it for the next run.
    """
    listing = extract_listing(pages, base_url, block=block).select(LISTING_COLUMNS)
    return apply_and_land(store, listing, run_ts, raw, mirror, retry_missing)


def apply_and_land(
    store: TrackerStore,
    listing: DataFrame,
    run_ts: str,
    raw: RawStore | None = None,
    mirror: str | None = None,
    retry_missing: bool = False,
) -> DataFrame:
    """Apply a listing to the tracker; files are landed before the run counts as finished."""
    land = failed = None
    if mirror is not None and retry_missing:
        failed = missing_files(store.spark, mirror, listing)
    if mirror is not None and raw is not None:

        def land(feed: DataFrame, run: str) -> None:
            raw.land_from_directory(mirror, feed, run)

    return store.apply(listing, run_ts, land, failed)


def ingest_population(payloads: DataFrame, directory: str, run_ts: str) -> str:
    """A fetched population document under a name of its own, so that watchers see it."""
    path = f"{directory.rstrip('/')}/population-{run_id(run_ts)}"
    write_json_documents(payloads, path)
    return path


def ingest(
    store: TrackerStore,
    pages: DataFrame,
    base_url: str,
    payloads: DataFrame,
    population_dir: str,
    run_ts: str,
    raw: RawStore | None = None,
    mirror: str | None = None,
    block: str | None = PRE_BLOCK,
) -> DataFrame:
    """One scheduled run."""
    feed = ingest_listing(store, pages, base_url, run_ts, raw, mirror, block=block)
    ingest_population(payloads, population_dir, run_ts)
    return feed
