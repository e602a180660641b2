"""Type-2 history of files: compare one full listing with the tracker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import CHANGES, TRACKER, TRACKER_COLUMNS, empty_table

ACTIVE, CLOSED = "Y", "N"


class EmptyListingError(ValueError):
    """An empty listing would close every file; it is far more likely a failed fetch."""


class StaleListingError(ValueError):
    """A listing older than the last one applied."""


def empty_tracker(spark: SparkSession) -> DataFrame:
    return empty_table(spark, TRACKER)


def active_versions(tracker: DataFrame) -> DataFrame:
    return tracker.where(F.col("is_active") == ACTIVE)


def first_active(tracker: DataFrame) -> DataFrame:
    """Per file name the active version that started first, and how many are active.

    An aggregate rather than a ranking, so copies of one name collapse before the shuffle.
    """
    version = F.struct("start_timestamp", "file_timestamp", "full_url")
    return (
        active_versions(tracker)
        .groupBy("file_name")
        .agg(F.min(version).alias("v"), F.count(F.lit(1)).alias("n_active"))
        .select("file_name", "v.start_timestamp", "v.file_timestamp", "v.full_url", "n_active")
    )


def require_listing(listing: DataFrame, tracker: DataFrame) -> None:
    """Refuse an empty listing when the tracker has active files."""
    if listing.isEmpty() and not active_versions(tracker).isEmpty():
        raise EmptyListingError("the listing is empty but the tracker has active files")


def classify(tracker: DataFrame, listing: DataFrame, run_ts: str, one_active: bool = False) -> DataFrame:
    """Every listed or active file with its status: new, changed, unchanged or removed.

    Each side is shuffled once by name. Duplicates are found on the order that the join needs anyway, so
    no side is sorted before its shuffle. `one_active` says that the tracker is known to have one active version per file.
    """
    listed = _numbered(listing.select("file_name", F.struct("file_timestamp", "full_url").alias("new")), "n_listed")
    held = active_versions(tracker).select(
        "file_name", F.struct("file_timestamp", "full_url", "start_timestamp").alias("old")
    )
    held = held.withColumn("n_active", F.lit(1)) if one_active else _numbered(held, "n_active")
    same = (F.col("old.file_timestamp") == F.col("new.file_timestamp")) & (
        F.col("old.full_url") == F.col("new.full_url")
    )
    status = (
        F.when(F.col("n_listed") > 1, F.raise_error(_about("file listed more than once: ")))
        .when(F.col("n_active") > 1, F.raise_error(_about("file has several active versions: ")))
        .when(F.col("file_name").isNull(), F.raise_error(F.lit("a file has no name")))
        .when(F.col("n_listed").isNull(), "removed")
        .when(F.col("n_active").isNull(), "new")
        # A missing url or time equals nothing, not even another missing one.
        .when(F.coalesce(same, F.lit(False)), "unchanged")
        .otherwise("changed")
    )
    return (
        listed.join(held, "file_name", "full_outer")
        .withColumn("status", status)
        .select(
            "file_name",
            "status",
            "new.file_timestamp",
            "new.full_url",
            F.col("old.file_timestamp").alias("old_file_timestamp"),
            F.col("old.full_url").alias("old_full_url"),
            F.col("old.start_timestamp").alias("old_start_timestamp"),
            F.lit(run_ts).alias("run_ts"),
        )
    )


def _numbered(rows: DataFrame, number: str) -> DataFrame:
    """Rows with their place among the rows of their name, from 1."""
    return rows.withColumn(number, F.row_number().over(Window.partitionBy("file_name").orderBy("file_name")))


def _about(text: str) -> Column:
    return F.concat(F.lit(text), F.col("file_name"))


def changes(tracker: DataFrame, listing: DataFrame, run_ts: str, one_active: bool = False) -> DataFrame:
    """The change feed: new, changed and removed files."""
    return classify(tracker, listing, run_ts, one_active).where(F.col("status") != "unchanged").select(CHANGES.names)


def label_reactivated(feed: DataFrame, tracker: DataFrame) -> DataFrame:
    """Relabel `new` as `reactivated` where a closed version of the file exists."""
    known = tracker.where(F.col("is_active") == CLOSED).select("file_name").distinct()
    marked = feed.join(known.withColumn("_known", F.lit(True)), "file_name", "left")
    again = (F.col("status") == "new") & F.col("_known").isNotNull()
    return marked.withColumn("status", F.when(again, "reactivated").otherwise(F.col("status"))).drop("_known")


def without_failed(feed: DataFrame, failed: DataFrame) -> DataFrame:
    """Leave out files whose fetch failed, so that the next run sees them as changed again.

    Without this step a failed fetch counts as done, which is the default.
    """
    names = failed.select("file_name").distinct().withColumn("_failed", F.lit(True))
    marked = feed.join(names, "file_name", "left")
    keep = F.col("_failed").isNull() | (F.col("status") == "removed")
    return marked.where(keep).select(feed.columns)


def _version(time: Column, url: Column, start: Column, end: Column, state: str) -> Column:
    values = [F.col("file_name"), time, url, start, end, F.lit(state)]
    return F.struct(*[v.alias(n) for v, n in zip(values, TRACKER_COLUMNS, strict=True)])


def _closed() -> Column:
    return _version(
        F.col("old_file_timestamp"),
        F.col("old_full_url"),
        F.col("old_start_timestamp"),
        F.col("run_ts"),
        CLOSED,
    )


def _opened() -> Column:
    no_end = F.lit(None).cast("string")
    return _version(F.col("file_timestamp"), F.col("full_url"), F.col("run_ts"), no_end, ACTIVE)


def _kept() -> Column:
    no_end = F.lit(None).cast("string")
    return _version(
        F.col("old_file_timestamp"), F.col("old_full_url"), F.col("old_start_timestamp"), no_end, ACTIVE
    )


def closed_versions(feed: DataFrame) -> DataFrame:
    """Tracker rows that a change feed closed."""
    return feed.where(F.col("status").isin("changed", "removed")).select(F.inline(F.array(_closed())))


def opened_versions(feed: DataFrame) -> DataFrame:
    """Tracker rows that a change feed opened."""
    return feed.where(F.col("status").isin("new", "changed")).select(F.inline(F.array(_opened())))


def apply_listing(tracker: DataFrame, listing: DataFrame, run_ts: str) -> DataFrame:
    """The tracker after one full listing: versions closed, opened and kept."""
    require_listing(listing, tracker)
    return _after(tracker, listing, run_ts)


def bootstrap(listing: DataFrame, run_ts: str) -> DataFrame:
    """The first tracker: every listed file active since `run_ts`."""
    return _after(empty_tracker(listing.sparkSession), listing, run_ts)


def _after(tracker: DataFrame, listing: DataFrame, run_ts: str) -> DataFrame:
    versions = (
        F.when(F.col("status") == "changed", F.array(_closed(), _opened()))
        .when(F.col("status") == "new", F.array(_opened()))
        .when(F.col("status") == "removed", F.array(_closed()))
        .otherwise(F.array(_kept()))
    )
    moved = classify(tracker, listing, run_ts).select(F.inline(versions))
    history = tracker.where(~F.coalesce(F.col("is_active") == ACTIVE, F.lit(False)))
    return history.select(TRACKER_COLUMNS).unionByName(moved)


def sync_plan(feed: DataFrame) -> DataFrame:
    """What a change feed asks for: fetch new and changed files, delete removed ones."""
    action = F.when(F.col("status") == "removed", "delete").otherwise("fetch")
    url = F.coalesce(F.col("full_url"), F.col("old_full_url"))
    return feed.select("file_name", url.alias("full_url"), action.alias("action"))
