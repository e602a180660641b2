"""Opaque files: which to fetch, and their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import file_name_of
from tidemark.operators.joins import settle

# Bytes of files that one task opens, about, and that it hands on at once.
TASK_BYTES, BATCH_BYTES = 256 << 20, 16 << 20


def read_files(spark: SparkSession, directory: str) -> DataFrame:
    """`(file_name, path, content)` of all files in a directory."""
    return _named(spark.read.format("binaryFile").load(directory))


def file_sizes(spark: SparkSession, directory: str) -> DataFrame:
    """`(file_name, path, n_bytes)` of all files in a directory; opens none of them."""
    files = spark.read.format("binaryFile").load(directory)
    return files.select(file_name_of(F.col("path")).alias("file_name"), "path", F.col("length").alias("n_bytes"))


def locate(spark: SparkSession, directory: str, names: DataFrame) -> DataFrame:
    """`(file_name, path, n_bytes)` for each different name; `n_bytes` is NULL where the directory has no such file.

    Tasks ask the file system for the names they hold, so the directory is never listed, no file is opened, and no name
    comes to the driver. A name that leads out of the directory has no file.
    """
    wanted = names.select("file_name").where(F.col("file_name").isNotNull()).distinct()
    root = _qualified(spark, directory)
    if not _opens_in_tasks(root):
        return wanted.join(file_sizes(spark, directory), "file_name", "left")
    return wanted.mapInArrow(_asker(root), "file_name string, path string, n_bytes long")


def read_wanted(spark: SparkSession, directory: str, wanted: DataFrame) -> DataFrame:
    """`(file_name, path, content)` of the files named in `wanted`; a name without a file gives no row.

    One job, however many files there are: they are located, dealt to tasks in the order of `name_hash`, so many bytes to a task, and opened there. Runs a
    job that locates them when called. A file system that only Spark's readers can open (see `_connector`) is listed, and read whole.
    """
    root = _qualified(spark, directory)
    if not _opens_in_tasks(root):
        return read_files(spark, directory).join(wanted.select("file_name"), "file_name", "left_semi")
    found = settle(locate(spark, directory, wanted).where("n_bytes is not null"), "located")
    total = found.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = total // TASK_BYTES + 1
    dealt = found.withColumn("h", name_hash()).repartitionByRange(tasks, "h").sortWithinPartitions("h")
    return dealt.select("file_name", "path", "n_bytes").mapInArrow(_opener(root), "file_name string, path string, content binary")


def missing_files(spark: SparkSession, directory: str, listed: DataFrame) -> DataFrame:
    """Listed names without a file in the directory."""
    return locate(spark, directory, listed).where("n_bytes is null").select("file_name")


def name_hash(name: str = "file_name") -> Column:
    """The order in which files are stored."""
    return F.xxhash64(F.col(name))


def _qualified(spark: SparkSession, directory: str) -> str:
    """The directory with its scheme, as Spark's own readers resolve it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(folder).toString().rstrip("/")


# Schemes of file systems that a task can open by itself.
SCHEMES = ("file", "s3", "s3a", "s3n", "hdfs", "gs", "abfs", "abfss")


def _opens_in_tasks(root: str) -> bool:
    return root.partition(":")[0] in SCHEMES


# What runs in tasks carries all it needs, so that workers need not have this package.


def _asker(root: str):
    connect = _connector(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as fs

        store, base = connect()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo in range(0, len(names), 1000):
                some = names[lo : lo + 1000]
                inside = [n != "" and ".." not in n.split("/") for n in some]
                asked = iter(store.get_file_info([f"{base}/{n}" for n, ok in zip(some, inside, strict=True) if ok]))
                infos = [next(asked) if ok else None for ok in inside]
                sizes = [i.size if i is not None and i.type == fs.FileType.File else None for i in infos]
                paths = [f"{root}/{n}" for n in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.string()), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["file_name", "path", "n_bytes"]
                )

    return run


def _opener(root: str, most: int = BATCH_BYTES):
    connect = _connector(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = connect()
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["file_name", "path", "content"])

        size = 0
        for batch in batches:
            for name, path, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n >= 2**31 - 1:
                    raise ValueError(f"too large for a row: {path}")
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows.append((name, path, stream.read()))
                size += n
                if size >= most:
                    yield out()
                    rows.clear()
                    size = 0
        if rows:
            yield out()

    return run


def _connector(root: str):
    """A function that opens the file system of a directory inside a task: local folders, hdfs, s3, gs and abfs."""

    def connect():
        import pyarrow.fs as fs

        scheme, _, rest = root.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        if scheme in ("s3", "s3a", "s3n"):
            return fs.S3FileSystem(), rest.lstrip("/")
        return fs.FileSystem.from_uri(root)

    return connect


def _named(files: DataFrame) -> DataFrame:
    return files.select(file_name_of(F.col("path")).alias("file_name"), "path", "content")
