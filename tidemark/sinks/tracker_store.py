"""The tracker between runs.

Layout under one folder, all parquet:

- `changes/run=<id>`: the change feed of a run. Closed versions are a projection of it, so
  history is only ever appended.
- `active/<id>/bucket=<n>`: active versions, by a hash of the file name. A run writes the buckets that it changed.
- `manifest/<id>`: for each bucket after a run that changed something, the run that wrote it last, and a checksum of its versions.
- `refused`: one row per listing that was not applied, with the reason.
- `unreadable/batch=<n>`: pages and entries that a stream could not read.
- `log`: one row per finished run. A run counts once its row is there; what a failed run
  left behind is not read, and running it again overwrites it.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import MARKED_CHANGES, UNFIT, backlog_changes
from tidemark.operators.joins import settle
from tidemark.operators.scd2 import (
    CLOSED,
    EmptyListingError,
    StaleListingError,
    active_versions,
    changes,
    closed_versions,
    empty_tracker,
    first_active,
    opened_versions,
    without_failed,
)
from tidemark.schemas import CHANGES, LISTING_COLUMNS, TRACKER, empty_table
from tidemark.session import scratch_path
from tidemark.sinks.tables import checked_run_time, empty_folder, read_if_exists, run_id

REFUSED = T.StructType([T.StructField(n, T.StringType()) for n in ("run_ts", "reason")])
UNREADABLE = T.StructType(
    [T.StructField("run_ts", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("page", "pages")]]
    + [T.StructField(n, T.StringType()) for n in ("page_url", "problem")]
)
LOG = T.StructType([T.StructField(n, T.StringType()) for n in ("run_ts", "run", "active_run")])
# Files in a bucket of a new store, about, and the most buckets.
BUCKET_FILES, MOST_BUCKETS = 500_000, 4096
MANIFEST = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("run", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("n", "inexact", "x", "y")]
)
CHANGES_BY_RUN = T.StructType([*CHANGES.fields, T.StructField("run", T.StringType())])


def checksums() -> list[Column]:
    """Of a set of listed files: how many, how many of them can't be compared as a value is missing, and two 64-bit hashes of the rest.

    They do not depend on order, and sums of parts can be joined; a file listed twice shows in the number.
    """
    of = [F.col(c) for c in LISTING_COLUMNS]
    missing = of[0].isNull() | of[1].isNull() | of[2].isNull()
    x, y = F.xxhash64(*of), F.xxhash64(F.lit("y"), *reversed(of))
    return [F.count("*").alias("n"), F.count_if(missing).alias("inexact"), F.bit_xor(x).alias("x"), F.bit_xor(y).alias("y")]


def _count_statuses(feed: DataFrame) -> dict[str, int]:
    return {row["status"]: row["count"] for row in feed.groupBy("status").count().collect()}


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("file_name"), F.lit(buckets)).cast("int")


class TrackerStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """`buckets` counts for a new store, which has as many as its first listing asks for if none is given; an old store keeps its own."""
        self.spark, self.path, self._buckets = spark, path.rstrip("/"), buckets

    def log(self) -> DataFrame:
        return read_if_exists(self.spark, f"{self.path}/log", LOG)

    def refused(self) -> DataFrame:
        """Listings that were not applied: run time and reason."""
        return read_if_exists(self.spark, f"{self.path}/refused", REFUSED).distinct()

    def refuse(self, run_ts: str, reason: str) -> None:
        """Put on record that a listing was not applied."""
        row = self.spark.range(0, 1, 1, 1).select(F.lit(run_ts).alias("run_ts"), F.lit(reason).alias("reason"))
        self.refuse_all(row)

    def refuse_all(self, listings: DataFrame) -> None:
        """The same for rows of (run_ts, reason), in one write."""
        listings.select(REFUSED.names).write.mode("append").parquet(f"{self.path}/refused")

    def unreadable(self) -> DataFrame:
        """Landed pages, or entries of them, that could not be read: where they are and why."""
        return read_if_exists(self.spark, f"{self.path}/unreadable", UNREADABLE).select(UNREADABLE.names).distinct()

    def keep_unreadable(self, pages: DataFrame, batch: int) -> None:
        """Put what could not be read aside; a batch that comes again replaces its own rows."""
        pages.select(UNREADABLE.names).write.mode("overwrite").parquet(f"{self.path}/unreadable/batch={batch}")

    def last_run(self) -> Row | None:
        return self.log().orderBy(F.desc("run_ts")).first()

    def active(self) -> DataFrame:
        """The active versions only; reads no history."""
        last = self.last_run()
        if last is None:
            return empty_tracker(self.spark)
        return self._active(last.active_run)

    def _active(self, run: str) -> DataFrame:
        return self._versions(self._manifest(run))

    def _new_manifest(self, files: int) -> dict[int, Row]:
        """The buckets of a store that begins with so many files."""
        buckets = self._buckets or min(1 + files // BUCKET_FILES, MOST_BUCKETS)
        return {b: Row(bucket=b, run=None, n=0, inexact=0, x=0, y=0) for b in range(buckets)}

    def _manifest(self, run: str) -> dict[int, Row]:
        """Bucket to its line after a run."""
        lines = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{run}").collect()
        return {r.bucket: r for r in lines}

    def _versions(self, lines: dict[int, Row], buckets: set[int] | None = None) -> DataFrame:
        """The active versions of some buckets, or of all; no other bucket is opened."""
        chosen = [r for b, r in sorted(lines.items()) if r.n and (buckets is None or b in buckets)]
        if not chosen:
            return empty_tracker(self.spark)
        return self.spark.read.schema(TRACKER).parquet(*[f"{self.path}/active/{r.run}/bucket={r.bucket}" for r in chosen])

    def _differing(self, lines: dict[int, Row], listed: list[Row]) -> set[int]:
        """Buckets in which a listing may differ from the active versions, given its checksums by bucket."""
        seen = {r.bucket: r for r in listed}
        found = set()
        for b, held in lines.items():
            new = seen.get(b)
            if new is None:
                same = held.n == 0
            else:
                same = not (held.inexact or new.inexact) and (held.n, held.x, held.y) == (new.n, new.x, new.y)
            if not same:
                found.add(b)
        return found

    def all_changes(self) -> DataFrame:
        """The change feeds of all finished runs."""
        feeds = read_if_exists(self.spark, f"{self.path}/changes", CHANGES_BY_RUN)
        return feeds.join(self.log().select("run"), "run", "left_semi").select(CHANGES.names)

    def tracker(self) -> DataFrame:
        """Closed and active versions."""
        return closed_versions(self.all_changes()).unionByName(self.active())

    def feed(self, run_ts: str) -> DataFrame:
        return self.spark.read.schema(CHANGES).parquet(self._feed_path(run_ts))

    def _feed_path(self, run_ts: str) -> str:
        return f"{self.path}/changes/run={run_id(run_ts)}"

    def apply(
        self,
        listing: DataFrame,
        run_ts: str,
        land: Callable[[DataFrame, str], None] | None = None,
        failed: DataFrame | None = None,
    ) -> DataFrame:
        """Apply one full listing and return its change feed.

        The listing is evaluated once. In a store of several buckets it is written by bucket; where the checksum of a bucket is that of its
        active versions, nothing has changed, and the bucket is neither compared nor written. The feed of the others is written first and
        read back for everything else. `land` stores the files of the feed before the run counts as finished. A run that is already
        finished is not applied again; without changes no new active version is written. Another form than a run time is refused before
        anything is read.
        """
        run = run_id(run_ts)
        before = self.log().agg(
            F.max(F.struct("run_ts", "active_run")).alias("last"),
            F.count_if(F.col("run_ts") == run_ts).alias("finished"),
        )
        last, finished = before.first()
        if finished:
            return self.feed(run_ts)
        if last is not None and run_ts < last.run_ts:
            raise StaleListingError(f"listing of {run_ts} is older than the last run, {last.run_ts}")

        lines, differing = {} if last is None else self._manifest(last.active_run), None
        if len(lines) > 1:
            listing = self._by_bucket(listing, len(lines))
            differing = self._differing(lines, listing.groupBy("bucket").agg(*checksums()).collect())  # one row per bucket
            listing = listing.where(F.col("bucket").isin(sorted(differing)))
        active = self._versions(lines, differing)
        found = changes(active, listing, run_ts, one_active=True)
        if failed is not None:
            found = settle(found, "found")
        else:
            found.write.mode("overwrite").parquet(self._feed_path(run_ts))
            found = self.feed(run_ts)
        per_status = _count_statuses(found)
        # Every listed file is new, changed or still active: when all that happened is that every
        # active file left, the listing had no row. Files that couldn't be fetched were listed all the same.
        if set(per_status) == {"removed"} and per_status["removed"] == sum(r.n for r in lines.values()):
            raise EmptyListingError("the listing is empty but the tracker has active files")
        lines = lines or self._new_manifest(per_status.get("new", 0))
        if failed is not None:
            without_failed(found, failed).write.mode("overwrite").parquet(self._feed_path(run_ts))
            per_status = _count_statuses(self.feed(run_ts))
        feed = self.feed(run_ts)
        if not per_status:
            if last is not None:
                self._finish([run_ts], last.active_run)
            return feed

        if land is not None:
            land(feed, run_ts)
        self._write_active(feed, opened_versions(feed), run_ts, lines)
        self._finish([run_ts], run)
        return feed

    def apply_backlog(
        self, listings: DataFrame, runs: list[str], land: Callable[[DataFrame, str], None] | None = None
    ) -> dict[str, str]:
        """Apply several full listings in one pass; equals applying them one after another.

        `listings` has the listing columns and `run_ts`, and `runs` names all runs, also those whose listing is empty. A listing that can't be applied is
        left out, and the result says why for each of these. The change feeds of all runs are found together, then the active
        versions after the last run are written, once. `land` stores the files of each run's feed before any of the runs counts as
        finished. Runs that are already finished are skipped.
        """
        runs = sorted(runs, key=run_id)
        done = {r.run_ts for r in self.log().where(F.col("run_ts").isin(runs)).collect()}
        last = self.last_run()
        known = listings.where(F.col("run_ts").isin(runs))
        if last is None:  # all is new
            counts = known.groupBy("run_ts").agg(F.count("*").alias("n")).collect()  # one row per run
            lines, listed, differing = self._new_manifest(max((r.n for r in counts), default=0)), {r.run_ts for r in counts}, None
        else:
            lines = self._manifest(last.active_run)
            known = known.withColumn("bucket", _bucket(len(lines)))
            sums = known.groupBy("run_ts", "bucket").agg(*checksums()).collect()  # one row per run and bucket
            listed = {r.run_ts for r in sums}
            differing = set().union(*[self._differing(lines, [r for r in sums if r.run_ts == run]) for run in runs if run not in done])
            known = known.where(F.col("bucket").isin(sorted(differing)))
        active, listings, unfit = self._versions(lines, differing), known, {}
        filled = any(r.n for r in lines.values())
        while True:
            accepted, refused = self._admitted([r for r in runs if r not in done], listed, unfit, last, filled)
            if not accepted:
                return refused
            written = self._write_feeds(backlog_changes(active, listings, accepted), accepted)
            tally = written.groupBy("run_ts", "status").count().collect()  # a few rows per run
            if not any(r.status in UNFIT for r in tally):
                break
            named = written.where(F.col("status").isin(*UNFIT)).groupBy("run_ts", "status").agg(F.min("file_name").alias("name"))
            # once more without them
            unfit |= {r.run_ts: r.status if r.name is None else f"{r.status}: {r.name}" for r in named.collect()}
        changed = {r.run_ts for r in tally}
        for run in accepted:
            if run not in changed:  # what an attempt that failed may have left
                empty_folder(self.spark, self._feed_path(run), CHANGES)
            elif land is not None:
                land(self.feed(run), run)
        if changed:
            # versions that were active before have started earlier than all these runs, and each is closed once
            ended = written.where(F.col("old_start_timestamp") < accepted[0])
            self._write_active(ended, opened_versions(written.where("stays")), accepted[-1], lines)
            self._finish(accepted, run_id(accepted[-1]))
        elif last is not None:
            self._finish(accepted, last.active_run)
        return refused

    def _write_feeds(self, feeds: DataFrame, runs: list[str]) -> DataFrame:
        """Write the feeds of some runs, each to its folder; returns what this attempt has written.

        The rows are dealt out by run first: otherwise each task would sort all its rows by run and write a file for each. A large run is split.
        """
        attempt = uuid4().hex
        by_run = feeds.hint("rebalance", "run_ts").withColumn("run", F.concat(F.lit("r"), F.regexp_replace("run_ts", "[^0-9]", "")))
        writer = by_run.withColumn("attempt", F.lit(attempt)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run").parquet(f"{self.path}/changes")
        schema = T.StructType([*MARKED_CHANGES.fields, T.StructField("attempt", T.StringType()), CHANGES_BY_RUN["run"]])
        held = read_if_exists(self.spark, f"{self.path}/changes", schema).where(F.col("run").isin([run_id(r) for r in runs]))
        return held.where(F.col("attempt") == attempt).select(MARKED_CHANGES.names)

    def _admitted(
        self, runs: list[str], listed: set[str], unfit: dict[str, str], last: Row | None, filled: bool
    ) -> tuple[list[str], dict[str, str]]:
        """The runs that can be applied, and why the others can't."""
        accepted, refused = [], {}
        for run in runs:
            if last is not None and run < last.run_ts:
                refused[run] = f"listing of {run} is older than the last run, {last.run_ts}"
            elif run in unfit:
                refused[run] = unfit[run]
            elif run in listed:
                filled = True  # from here on
                accepted.append(run)
            elif filled:
                refused[run] = "the listing is empty but the tracker has active files"
            else:
                accepted.append(run)
        return accepted, refused

    def seed(self, tracker: DataFrame) -> None:
        """Start an empty store from an existing tracker, such as one read from CSV."""
        if self.last_run() is not None:
            raise ValueError("the store already has runs")
        several = first_active(tracker).where(F.col("n_active") > 1)
        if not several.isEmpty():
            raise ValueError("the tracker has several active versions of one file")
        times = F.greatest(checked_run_time(F.col("start_timestamp")), "end_timestamp")
        latest = tracker.agg(F.max(times).alias("t")).first().t
        if latest is None:
            return
        closed = tracker.where(F.col("is_active") == CLOSED).select(
            "file_name",
            F.lit("removed").alias("status"),
            F.lit(None).cast("string").alias("file_timestamp"),
            F.lit(None).cast("string").alias("full_url"),
            F.col("file_timestamp").alias("old_file_timestamp"),
            F.col("full_url").alias("old_full_url"),
            F.col("start_timestamp").alias("old_start_timestamp"),
            F.col("end_timestamp").alias("run_ts"),
        )
        closed.write.mode("overwrite").parquet(self._feed_path(latest))
        nothing = empty_table(self.spark, CHANGES)
        self._write_active(nothing, active_versions(tracker), latest, self._new_manifest(active_versions(tracker).count()))
        self._finish([latest], run_id(latest))

    def prune(self) -> None:
        """Empty the active versions of earlier runs; history stays in the change feeds."""
        last = self.last_run()
        if last is None:
            return
        held = {(r.run, r.bucket) for r in self._manifest(last.active_run).values()}
        # One row per finished run, and a few per bucket.
        earlier = self.log().select("active_run").where(F.col("active_run") != last.active_run).distinct()
        for row in earlier.collect():
            for line in self._manifest(row.active_run).values():
                if line.run == row.active_run and line.n and (line.run, line.bucket) not in held:
                    empty_folder(self.spark, f"{self.path}/active/{line.run}/bucket={line.bucket}", TRACKER)

    def _by_bucket(self, listing: DataFrame, buckets: int) -> DataFrame:
        """A listing, written once by bucket."""
        rows = listing.select(LISTING_COLUMNS)
        path = scratch_path(self.spark, "listing")
        rows.withColumn("bucket", _bucket(buckets)).write.partitionBy("bucket").parquet(path)
        schema = T.StructType([*rows.schema.fields, T.StructField("bucket", T.IntegerType())])
        return read_if_exists(self.spark, path, schema)

    def _write_active(self, feed: DataFrame, opened: DataFrame, run_ts: str, lines: dict[int, Row]) -> None:
        """Write the buckets in which something changed: the active versions without those of the files of a feed, and what was opened."""
        run, bucket, touched = run_id(run_ts), _bucket(len(lines)), set(lines)
        if len(lines) > 1:
            touched = {r.bucket for r in feed.select(bucket.alias("bucket")).unionByName(opened.select(bucket.alias("bucket"))).distinct().collect()}
        stayed = self._versions(lines, touched).join(feed.select("file_name"), "file_name", "left_anti")
        versions = stayed.unionByName(opened).select(*TRACKER.names, bucket.alias("bucket"))
        path = f"{self.path}/active/{run}"
        versions.write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = read_if_exists(self.spark, path, T.StructType([*TRACKER.fields, T.StructField("bucket", T.IntegerType())]))
        sums = {r.bucket: r for r in written.groupBy("bucket").agg(*checksums()).collect()}  # one row per bucket
        rows = []
        for b, line in lines.items():
            if b in touched:
                line = Row(run=run, **(sums[b].asDict() if b in sums else dict(bucket=b, n=0, inexact=0, x=0, y=0)))
            rows.append(tuple(line[c] for c in MANIFEST.names))
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{run}")

    def _finish(self, runs: list[str], active_run: str) -> None:
        """Put finished runs on record, all at once."""
        rows = [tuple(zip(LOG.names, (run, run_id(run), active_run), strict=True)) for run in runs]
        lines = F.array(*[F.struct(*[F.lit(v).alias(name) for name, v in row]) for row in rows])
        self.spark.range(0, 1, 1, 1).select(F.inline(lines)).write.mode("append").parquet(f"{self.path}/log")
