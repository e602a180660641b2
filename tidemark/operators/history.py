"""Replay a history of listings into a tracker in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import or_fail
from tidemark.operators.joins import settle
from tidemark.operators.scd2 import ACTIVE, CLOSED, EmptyListingError
from tidemark.schemas import CHANGES, TRACKER_COLUMNS
from tidemark.sinks.tables import checked_run_time

# Runs per window. A file's listed runs are cut into chunks of this length.
CHUNK_RUNS = 4096
# Statuses of rows that spoil a listing.
UNFIT = ("a file has no name", "file listed more than once")
# A change, and whether it opened a version that is still active after the last run.
MARKED_CHANGES = T.StructType([*CHANGES.fields, T.StructField("stays", T.BooleanType())])


def run_calendar(runs: DataFrame) -> DataFrame:
    """Runs numbered from 0 without gaps: `(ord, run_ts)`. Another form than a run time fails.

    Numbered per month and shifted by the size of the earlier months, so the only window over everything has
    one row per month.
    """
    listed = settle(runs.select(checked_run_time(F.col("run_ts")).alias("run_ts")).distinct(), "runs")
    listed = listed.withColumn("month", F.substring("run_ts", 1, 7))
    earlier = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        listed.groupBy("month")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("month", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("month").orderBy("run_ts"))
    return (
        listed.withColumn("nth", within)
        .join(shift, "month")
        .select((F.col("before") + F.col("nth") - 1).alias("ord"), "run_ts")
    )


def replay(
    history: DataFrame,
    runs: DataFrame | None = None,
    chunk_runs: int = CHUNK_RUNS,
    allow_empty: bool = False,
) -> DataFrame:
    """The tracker that applying every listing of `history` in turn would give.

    `history` has the listing columns and `run_ts`; `runs` names the runs that took place and
    defaults to those seen in `history`. A version lasts while consecutive runs list the file with the
    same time and url. No window holds more than `chunk_runs` runs of a file: the rows are cut
    there, solved in pieces, and the few pieces that touch a cut are joined up.

    A row of a run that is not among `runs`, and a row without a file name, fail the job. So does a run without rows after one with
    rows, as applying it would, unless `allow_empty` says that such a run closes every file. Runs jobs: the calendar of
    runs is written first.
    """
    calendar = settle(run_calendar(history if runs is None else runs), "calendar")
    if runs is not None and not allow_empty:
        _refuse_empty_runs(history, calendar)
    named = F.when(F.col("file_name").isNull(), F.raise_error(F.lit("a file has no name"))).otherwise(F.col("file_name"))
    unknown = F.concat(F.lit("a file is listed in a run that is not known: "), F.coalesce("run_ts", F.lit("(missing)")))
    rows = history.join(calendar, "run_ts", "left").select(
        named.alias("file_name"), "file_timestamp", "full_url", or_fail(F.col("ord"), unknown).alias("ord")
    )
    spells = _spells(rows, chunk_runs)
    started = calendar.select(F.col("ord").alias("start_ord"), F.col("run_ts").alias("start_timestamp"))
    ended = calendar.select((F.col("ord") - 1).alias("end_ord"), F.col("run_ts").alias("end_timestamp"))
    return (
        spells.join(started, "start_ord")
        .join(ended, "end_ord", "left")
        .withColumn("is_active", F.when(F.col("end_timestamp").isNull(), ACTIVE).otherwise(CLOSED))
        .select(TRACKER_COLUMNS)
    )


def backlog_changes(active: DataFrame, listings: DataFrame, runs: list[str]) -> DataFrame:
    """The change feeds that applying some listings in turn would give, on top of a tracker's active versions.

    `listings` has the listing columns and `run_ts`; `runs` names them in order, also those without rows, and rows of other runs are
    left out. Each version that is active beforehand is a spell that is open before the first run. One shuffle by file; a file has at most a row
    for each run, and one more. A listing that names a file twice, or a file without a name, gives rows of the statuses in `UNFIT`; then
    the feeds are of use only without that run. `stays` marks the changes that opened a version which is active after the last run.
    """
    ordinals = F.array(*[F.lit(r) for r in runs])
    known = listings.where(F.col("run_ts").isin(runs)).select(
        "file_name", "file_timestamp", "full_url", "run_ts", (F.array_position(ordinals, F.col("run_ts")) - 1).alias("ord")
    )
    before = active.select("file_name", "file_timestamp", "full_url", F.col("start_timestamp").alias("run_ts"), F.lit(-1).cast("long").alias("ord"))
    in_order, whole = Window.partitionBy("file_name").orderBy("ord"), Window.partitionBy("file_name")
    joined = F.coalesce(F.lag("ord").over(in_order) == F.col("ord") - 1, F.lit(False))
    rows = known.unionByName(before).withColumns(
        {"joined": joined, "same": _same_version(F.lag, in_order, -1), "until": F.lead("ord").over(in_order)}
    )
    opens = ~F.col("same") | (F.col("ord") < 0)
    rows = rows.withColumn("start", F.last(F.when(opens, F.col("run_ts")), ignorenulls=True).over(in_order))
    old = {f"old_{c}": F.when(F.col("joined"), F.lag(c).over(in_order)) for c in ("file_timestamp", "full_url", "start")}
    rows = rows.withColumns(old)
    again = F.coalesce(F.lag("ord").over(in_order) == F.col("ord"), F.lit(False))
    rows = rows.withColumn("unfit", F.when(F.col("file_name").isNull(), UNFIT[0]).when(again, UNFIT[1]))
    last_opened = F.max(F.when(opens, F.col("ord"))).over(whole) == F.col("ord")
    rows = rows.withColumn("stays", last_opened & (F.max("ord").over(whole) == len(runs) - 1))
    opened = F.when(
        F.col("unfit").isNotNull() | ~F.col("same") & (F.col("ord") >= 0),
        _change(
            F.coalesce("unfit", F.when(F.col("joined"), "changed").otherwise("new")),
            *[F.col(c) for c in ("file_timestamp", "full_url", "old_file_timestamp", "old_full_url", "old_start", "run_ts", "stays")],
        ),
    )
    # a file that the next run does not list leaves in it
    next_run = F.get(ordinals, (F.col("ord") + 1).cast("int"))
    leaves = (F.coalesce("until", F.lit(len(runs))) > F.col("ord") + 1) & next_run.isNotNull()
    missing = F.lit(None).cast("string")
    left = F.when(
        leaves, _change(F.lit("removed"), missing, missing, *[F.col(c) for c in ("file_timestamp", "full_url", "start")], next_run, F.lit(False))
    )
    # nulls are left out afterwards, as a filter of arrays is not compiled
    return rows.select("file_name", F.inline(F.array(opened, left))).where(F.col("status").isNotNull()).select(MARKED_CHANGES.names)


def _change(*values: Column) -> Column:
    return F.struct(*[v.alias(n) for v, n in zip(values, MARKED_CHANGES.names[1:], strict=True)])


def _refuse_empty_runs(history: DataFrame, calendar: DataFrame) -> None:
    listed = history.select("run_ts").distinct().withColumn("_listed", F.lit(True))
    seen = calendar.join(listed, "run_ts", "left")
    first = seen.where("_listed").agg(F.min("ord")).scalar()
    empty = seen.where(F.col("_listed").isNull() & (F.col("ord") > first)).orderBy("ord").first()
    if empty is not None:
        raise EmptyListingError(f"the listing of {empty.run_ts} is empty but files were listed before")


def _spells(rows: DataFrame, chunk_runs: int) -> DataFrame:
    """Maximal stretches of consecutive runs with one version: `start_ord` to `end_ord`."""
    # A row next to a cut is also shown to the neighbouring chunk, as context only.
    chunk = F.floor(F.col("ord") / chunk_runs)
    cut_before = F.col("ord") == F.col("chunk") * chunk_runs
    cut_after = F.col("ord") == (F.col("chunk") + 1) * chunk_runs - 1
    seen_in = F.array(
        chunk,
        F.when(F.col("ord") == chunk * chunk_runs, chunk - 1),
        F.when(F.col("ord") == (chunk + 1) * chunk_runs - 1, chunk + 1),
    )
    rows = rows.withColumn("chunk", F.explode(F.array_compact(seen_in)))
    rows = rows.withColumn("own", F.col("chunk") == chunk)

    in_order = Window.partitionBy("file_name", "chunk").orderBy("ord")
    twice = F.coalesce(F.lag("ord").over(in_order) == F.col("ord"), F.lit(False))
    message = F.concat(F.lit("file listed more than once in a run: "), F.col("file_name"))
    marked = rows.withColumns(
        {
            "from_before": F.when(twice, F.raise_error(message)).otherwise(_same_version(F.lag, in_order, -1)),
            "to_after": _same_version(F.lead, in_order, 1),
        }
    )
    # Only the first and last row of each piece are kept; a first row is followed by its last one.
    edges = marked.withColumns(
        {"begins": ~F.col("from_before") | cut_before, "ends": ~F.col("to_after") | cut_after}
    ).where(F.col("own") & (F.col("begins") | F.col("ends")))
    pieces = (
        edges.withColumns(
            {
                "goes_back": F.col("from_before"),
                "end_ord": F.when(F.col("ends"), F.col("ord")).otherwise(F.lead("ord").over(in_order)),
                "goes_on": F.when(F.col("ends"), F.col("to_after")).otherwise(F.lead("to_after").over(in_order)),
            }
        )
        .where("begins")
        .withColumnRenamed("ord", "start_ord")
    )
    columns = ["file_name", "file_timestamp", "full_url", "start_ord", "end_ord"]
    at_cut = F.col("goes_back") | F.col("goes_on")
    by_start = (
        Window.partitionBy("file_name")
        .orderBy("start_ord")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    mended = (
        pieces.where(at_cut)
        .withColumn("nth", F.sum(F.when(F.col("goes_back"), 0).otherwise(1)).over(by_start))
        .groupBy("file_name", "nth", "file_timestamp", "full_url")
        .agg(F.min("start_ord").alias("start_ord"), F.max("end_ord").alias("end_ord"))
    )
    return pieces.where(~at_cut).select(columns).unionByName(mended.select(columns))


def _same_version(neighbour, window, step: int) -> Column:
    """Whether the neighbouring run lists the file with the same time and url; missing is not equal."""
    equal = (
        (neighbour("ord").over(window) == F.col("ord") + step)
        & (neighbour("file_timestamp").over(window) == F.col("file_timestamp"))
        & (neighbour("full_url").over(window) == F.col("full_url"))
    )
    return F.coalesce(equal, F.lit(False))
