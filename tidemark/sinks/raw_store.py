"""Landed files, kept per run.

A run appends the bytes of the files it fetched under `run=<id>`. What is current follows from
the tracker: the copy landed by the run that opened the active version. So replacing or
deleting a copy rewrites nothing; `compact` frees the space when it is worth it.

Copies are stored in the order of a hash of their name, `h`: files are opened in that order when they land, so a stored file holds a narrow
range of it. Reading many versions goes range by range: names of a range are broadcast, and of the copies only the row groups of
that range are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import settle
from tidemark.operators.scd2 import sync_plan
from tidemark.sinks.tables import empty_folder, read_if_exists, run_id
from tidemark.sources.files import name_hash, read_wanted

COPIES = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("run_ts", T.StringType()),
        T.StructField("h", T.LongType()),
    ]
)
COPIES_BY_RUN = T.StructType([*COPIES.fields, T.StructField("run", T.StringType())])
# Bytes of names that are broadcast at once.
KEY_BYTES = 64 << 20
BASE = T.StructType([T.StructField("base", T.StringType())])


def wanted(feed: DataFrame) -> DataFrame:
    """Url and name of the files to fetch."""
    return sync_plan(feed).where(F.col("action") == "fetch").select("full_url", "file_name")


def fetch(files: DataFrame, feed: DataFrame) -> DataFrame:
    """The files, out of a table of files, that the change feed asks for."""
    return files.join(wanted(feed), "file_name", "left_semi").select("file_name", "content")


def after_sync(raw: DataFrame, feed: DataFrame, fetched: DataFrame) -> DataFrame:
    """A table of files after a run: deleted and replaced copies out, fetched copies in.

    A file whose fetch gave nothing keeps its old copy; deleting an absent copy is no error.
    """
    gone = sync_plan(feed).where(F.col("action") == "delete").select("file_name")
    replaced = gone.unionByName(fetched.select("file_name"))
    return raw.join(replaced, "file_name", "left_anti").unionByName(fetched.select(raw.columns))


class RawStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, run: str) -> str:
        return f"{self.path}/copies/run={run}"

    def _landed(self) -> DataFrame:
        """Copies since the last compaction, which holds the older ones."""
        copies = read_if_exists(self.spark, f"{self.path}/copies", COPIES_BY_RUN)
        base = self._base()
        return copies if base is None else copies.where(F.col("run") >= base)

    def _base(self) -> str | None:
        """The folder of the last compaction."""
        return read_if_exists(self.spark, f"{self.path}/bases", BASE).agg(F.max("base").alias("base")).first().base

    def land(self, files: DataFrame, feed: DataFrame, run_ts: str) -> None:
        """Store fetched `(file_name, content)` rows under a run; running again replaces them.

        A changed file whose fetch gave nothing keeps its previous copy, carried into this run.
        """
        self._write(files, run_ts, "overwrite")
        self._carry(feed, run_ts)

    def land_from_directory(self, directory: str, feed: DataFrame, run_ts: str) -> None:
        """Store the files a change feed asks for, out of a directory that mirrors the source.

        Only the wanted files are opened, by as many tasks as their bytes ask for, in one job; the directory is not listed.
        """
        self._write(read_wanted(self.spark, directory, wanted(feed)), run_ts, "overwrite")
        self._carry(feed, run_ts)

    def _write(self, files: DataFrame, run_ts: str, mode: str) -> None:
        rows = files.select("file_name", "content", F.lit(run_ts).alias("run_ts"), name_hash().alias("h"))
        rows.write.mode(mode).parquet(self._folder(run_id(run_ts)))

    def _carry(self, feed: DataFrame, run_ts: str) -> None:
        """Copy what the run lost out of the folders of the runs that landed it; no other folder is read."""
        run = run_id(run_ts)
        fetched = read_if_exists(self.spark, self._folder(run), COPIES).select("file_name")
        lost = feed.where(F.col("status") == "changed").join(fetched, "file_name", "left_anti")
        previous = settle(lost.select("file_name", F.col("old_start_timestamp").alias("run_ts")), "lost")
        if not previous.isEmpty():
            self._write(self._copies(previous, F.col("run") != run), run_ts, "append")

    def landed(self) -> DataFrame:
        """Every copy held: `(file_name, content, run_ts)`."""
        return self._landed().drop("run", "h")

    def current(self, active: DataFrame) -> DataFrame:
        """The copies that belong to active versions. Runs jobs.

        Folders of runs without an active version are not read, and the bytes of files are never shuffled, however many names there are.
        """
        return self._copies(settle(active.select("file_name", F.col("start_timestamp").alias("run_ts")), "versions"))

    def _copies(self, versions: DataFrame, of: Column | None = None) -> DataFrame:
        """`(file_name, content, run_ts)` of some versions, a settled table of `(file_name, run_ts)`.

        The names are dealt into ranges of `h` of at most about `KEY_BYTES`, each of which is broadcast. A range reads the row groups of the
        copies that reach into it, so the copies are read once in all.
        """
        size = versions.agg(F.sum(F.octet_length("file_name") + 64)).first()[0]
        if size is None:
            return self.landed().where(F.lit(False))
        held, parts, found = self._of_runs(versions), -(-size // KEY_BYTES), None
        if of is not None:
            held = held.where(of)
        for part in range(parts):
            low, high = (-(2**63) + i * 2**64 // parts for i in (part, part + 1))
            inside = F.col("h").between(low, high - 1)
            own = versions.withColumn("h", name_hash())
            copies = held.where(inside).join(F.broadcast(own.where(inside)), ["file_name", "run_ts", "h"], "left_semi")
            copies = copies.select("file_name", "content", "run_ts")
            found = copies if found is None else found.unionByName(copies)
        return found

    def _of_runs(self, versions: DataFrame) -> DataFrame:
        """The copies in the folders of the runs that `versions` names, as partitions to prune by."""
        # One row per run.
        runs = [run_id(r.run_ts) for r in versions.select("run_ts").distinct().collect()]
        base = self._base()
        # After a compaction the copies of earlier runs lie in its folder.
        folders = {r if base is None or r >= base else base for r in runs}
        return self._landed().where(F.col("run").isin(sorted(folders)))

    def compact(self, active: DataFrame, run_ts: str) -> None:
        """Drop the bytes of replaced and deleted copies, after the run `run_ts` has finished.

        Current copies are written together, then counted as the base; only then are the
        folders before it emptied, so stopping at any point loses nothing.
        """
        base = run_id(run_ts) + "c"
        older = self._landed().where(F.col("run") < base).select("run").distinct()
        self.current(active).withColumn("h", name_hash()).write.mode("overwrite").parquet(self._folder(base))
        row = self.spark.range(0, 1, 1, 1).select(F.lit(base).alias("base"))
        # One row per run that landed something.
        superseded = [r.run for r in older.collect()]
        row.write.mode("append").parquet(f"{self.path}/bases")
        for run in superseded:
            empty_folder(self.spark, self._folder(run), COPIES)
