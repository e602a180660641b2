"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of some documents in ascending doc_id order, each ended by id 0:

    magic, version                        8 bytes
    ids, documents, blocks                3 x u64
    begin of each block in the block area (blocks + 1) x u64
    block area
    ids of each document                  documents x u32

A block holds 1,024 ids (the last fewer): minimum u32, width u8, exceptions u16, then every id less the minimum
in `width` bits, least bits first, then for each exception its place u16 and what lies above those bits u32. The width is that of
the percentile which needs the fewest bytes. Files are written to the shared folder by the tasks and listed by
the rows that the tasks return, so a file of a lost or repeated task is in no listing and is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import as_binary, buffers, partitions, pieces, reach, settle
from tidemark.llm.packing import END, TEXT_BYTES
from tidemark.llm.tokens import BYTE_BPE, encoder, vocabulary_path
from tidemark.session import scratch_path

MAGIC = b"PFORIDS1"
BLOCK = 1024
#: Percentiles of the values of a block whose widths are tried.
PERCENTILES = (50, 75, 90, 95, 98, 100)
#: Ids of a file, rounded up to whole documents.
FILE_IDS = 1 << 22
_EXCEPTION = np.dtype([("place", "<u2"), ("above", "<u4")])


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _choose(offsets: np.ndarray) -> np.ndarray:
    """The width of each row of values: of the percentile that needs the fewest bytes."""
    rows, n = offsets.shape
    bits = np.sort(_widths(offsets), axis=1)
    tried = bits[:, [min(n - 1, max(0, -(-p * n // 100) - 1)) for p in PERCENTILES]]
    bytes_ = np.stack(
        [-(-n * tried[:, j] // 8) + _EXCEPTION.itemsize * (bits > tried[:, j : j + 1]).sum(axis=1) for j in range(tried.shape[1])], axis=1
    )
    return tried[np.arange(rows), bytes_.argmin(axis=1)]


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each row of values, as rows of bytes."""
    if not width:
        return np.zeros((len(rows), 0), np.uint8)
    bits = (rows[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(data: np.ndarray, count: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros((len(data), count), np.uint32)
    bits = np.unpackbits(data, axis=1, count=count * width, bitorder="little").reshape(len(data), count, width)
    out = np.zeros((len(data), count), np.uint32)
    for b in range(width):
        out |= bits[:, :, b].astype(np.uint32) << np.uint32(b)
    return out


#: Blocks handled at once.
_TOGETHER = 256


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The block area of some ids, and where each block begins in it (one more entry than blocks)."""
    out, sizes = [], []
    whole = len(ids) // BLOCK * BLOCK
    parts = [ids[a : min(a + BLOCK * _TOGETHER, whole)].reshape(-1, BLOCK) for a in range(0, whole, BLOCK * _TOGETHER)]
    if whole < len(ids):
        parts.append(ids[whole:].reshape(1, -1))
    for rows in parts:
        least = rows.min(axis=1)
        offsets = (rows - least[:, None]).astype(np.uint32)
        widths = _choose(offsets)
        packed: dict[int, bytes] = {}
        for width in np.unique(widths):
            some = np.flatnonzero(widths == width)
            for i, line in zip(some, _pack(offsets[some], int(width)), strict=True):
                packed[int(i)] = line.tobytes()
        for i in range(len(rows)):
            above = offsets[i].astype(np.uint64) >> np.uint64(widths[i])
            places = np.flatnonzero(above)
            extra = np.zeros(len(places), _EXCEPTION)
            extra["place"], extra["above"] = places, above[places]
            head = np.uint32(least[i]).tobytes() + bytes([int(widths[i])]) + np.uint16(len(places)).tobytes()
            out.append(head + packed[i] + extra.tobytes())
            sizes.append(len(out[-1]))
    return b"".join(out), np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)


def decode_block(data: bytes, count: int) -> np.ndarray:
    """The ids of one block."""
    least, width, extra = np.frombuffer(data, "<u4", 1)[0], data[4], int(np.frombuffer(data, "<u2", 1, 5)[0])
    size = -(-count * width // 8)
    values = _unpack(np.frombuffer(data, np.uint8, size, 7).reshape(1, -1), count, width)[0]
    if extra:
        more = np.frombuffer(data, _EXCEPTION, extra, 7 + size)
        values[more["place"]] |= (more["above"].astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    return values + least


def encode_file(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A file of some documents: their ids in a row, and how many each has."""
    area, begins = encode_blocks(ids.astype(np.uint32))
    head = np.array([len(ids), len(counts), len(begins) - 1], "<u8").tobytes()
    return MAGIC + head + begins.astype("<u8").tobytes() + area + counts.astype("<u4").tobytes()


class IdFile:
    """Reads a file; any range of ids opens only the blocks that hold it."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a file of ids")
        self.ids, self.documents, blocks = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        self.begins = np.frombuffer(data, "<u8", blocks + 1, 32).astype(np.int64)
        self.area = 32 + 8 * (blocks + 1)
        self.data = data
        self.counts = np.frombuffer(data, "<u4", self.documents, self.area + int(self.begins[-1])).astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        parts = []
        for b in range(start // BLOCK, -(-stop // BLOCK)):
            count = min(BLOCK, self.ids - b * BLOCK)
            block = decode_block(self.data[self.area + self.begins[b] : self.area + self.begins[b + 1]], count)
            parts.append(block[max(0, start - b * BLOCK) : stop - b * BLOCK])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder; a path without a scheme is a local one, and s3a is read as s3."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _writer(vocabulary: str, folder: str, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, at = _filesystem(folder)
        partition, number = TaskContext.get().partitionId(), 0
        ids_, counts, docs, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids_, counts, docs, size, number
            name = f"{partition:06d}-{number:06d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{at}/{name}") as out:
                out.write(encode_file(np.concatenate(ids_), np.concatenate(counts)))
            row = {"name": [name], "partition": [partition], "number": [number], "ids": [size], "doc_ids": [np.concatenate(docs)]}
            ids_, counts, docs, size, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_pydict(row, schema=_MANIFEST)

        store.create_dir(at, recursive=True)
        for batch in batches:
            known = batch.column(0)
            keys = known.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            data, begins = buffers(as_binary(batch.column(1)))
            for lo, hi in pieces(begins, TEXT_BYTES):
                ids, edges = encoder(vocabulary).encode(data[begins[lo] : begins[hi]], begins[lo : hi + 1] - begins[lo])
                full = np.insert(ids, edges[1:], END)
                ids_.append(full.astype(np.uint32))
                counts.append(np.diff(edges) + 1)
                docs.append(keys[lo:hi])
                size += len(full)
                if size >= file_ids:
                    yield flush()
        if size:
            yield flush()

    return run


#: Stands for a missing doc_id, which sorts first, inside files.
NO_ID = -(2**63)
_MANIFEST = pa.schema(
    [("name", pa.string()), ("partition", pa.int64()), ("number", pa.int64()), ("ids", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
)


def write_ids(documents: DataFrame, folder: str, vocabulary: str = BYTE_BPE, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents to files under `folder`, in ascending order of doc_id over all files.

    Returns the listing, written once: name, partition, number, ids, doc_ids, and `first`, the ids before the file. Rows
    of one doc_id stay apart and follow each other; a missing doc_id comes first; a missing text is the end id
    alone; no rows give no file. Other columns are ignored.
    """
    spark = documents.sparkSession
    reach(spark)
    tie = F.xxhash64("text")
    ordered = documents.select("doc_id", "text").repartitionByRange(partitions(spark), F.col("doc_id"), tie)
    ordered = ordered.sortWithinPartitions(F.col("doc_id"), tie).select(F.col("doc_id").cast("long"), "text")
    schema = "name string, partition long, number long, ids long, doc_ids array<long>"
    listing = settle(ordered.mapInArrow(_writer(vocabulary_path(vocabulary), folder, file_ids), schema), "listing")
    before = Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    sizes = listing.select("name", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    return listing.join(sizes, "name")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, first, docs in zip(*(batch.column(c) for c in ("content", "first", "doc_ids")), strict=True):
            file, first = IdFile(data.as_py()), first.as_py()
            keys = docs.values.to_numpy()
            ends = np.cumsum(file.counts)
            starts = ends - file.counts
            crc = np.zeros(file.documents, np.int64)
            for lo in range(0, file.documents, 512):
                hi = min(lo + 512, file.documents)
                some = file.read(int(starts[lo]), int(ends[hi - 1])).astype("<u4")
                for i in range(lo, hi):
                    crc[i] = zlib.crc32(some[starts[i] - starts[lo] : ends[i] - starts[lo]].tobytes())
            columns = [pa.array(keys, pa.int64(), mask=keys == NO_ID), *(pa.array(x, pa.int64()) for x in (first + starts, file.counts, crc))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_back(spark: SparkSession, folder: str, listing: DataFrame) -> DataFrame:
    """A row for each document in the listed files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    joined = named.join(listing.select("name", "first", "doc_ids"), "name")
    return joined.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_of(documents: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Write all documents to files in the shared folder and read them back (see `write_ids`, `read_back`)."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "ids")
    listing = write_ids(documents, folder, vocabulary)
    if listing.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_back(spark, folder, listing)
