"""Benchmark passages in documents, by winnowed fingerprints.

A window is `WINDOW` words of an item in a row; an item of fewer words is one window. Of every `WINDOW - GRAM + 1` word
grams in a row only the one with the smallest hash is kept, in items and documents alike. A window and its copy in
a document hold the same grams, so both sides keep the same one, and every shared window has a shared fingerprint.
Fingerprints of a piece of text are looked up among those of the items; each hit is extended to the windows of the items
around it, word by word, so chance hits of a hash are no matches. Items shorter than a window get
fingerprints of their own, with the grams and widths that fit their length.

Items are held by every task, in blocks of at most `BLOCK_BYTES`; more of them mean more passes over the
documents, whose results are merged for each row by a key of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.arrays import Words, as_binary, buffers, grams, leftmost, reach, settle, text_pieces

WINDOW, GRAM = 10, 5
#: UTF-8 bytes of items that tasks hold at once.
BLOCK_BYTES = 16 << 20
#: Most words handled at once, so that places fit (see `leftmost`); longer texts are cut into overlapping parts.
MOST_WORDS = 1 << 22
#: Hits extended at once.
MOST_HITS = 1 << 17


def fingerprints(words: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Places of the grams kept of each text (`at`: where its words begin) for windows of `window` words."""
    gram = min(GRAM, window)
    values, kept = grams(words, gram), []
    width = window - gram + 1
    for lo in range(0, max(len(values) - width + 1, 0), MOST_WORDS):
        part = values[lo : lo + MOST_WORDS + width - 1]
        first = lo + np.arange(len(part) - width + 1)
        text = np.searchsorted(at, first, "right") - 1
        inside = first + window <= at[text + 1]
        kept.append(np.unique(lo + leftmost(part, width)[inside]))
    return np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)


class Items:
    """The windows of some items, found by their fingerprints; `find` gives the hits of a text."""

    def __init__(self, ids: list[str | None], texts: list[str | None]):
        data, offsets = buffers(as_binary(pa.array(texts, pa.string())))
        words = Words(data, offsets)
        names: dict[bytes, int] = {}
        raw = bytes(data).lower()
        self.symbols = np.fromiter(
            (names.setdefault(raw[s:e], len(names)) for s, e in zip(words.start, words.end, strict=True)), np.int64, len(words)
        )
        self.ids, self.at, self.names = ids, words.at, names
        self.sizes = np.minimum(np.diff(words.at), WINDOW)
        #: By length of window: sorted hashes of the fingerprints with their places.
        self.prints: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.sizes[self.sizes > 0]):
            kept = fingerprints(words.hash, words.at, int(size))
            kept = kept[self.sizes[np.searchsorted(words.at, kept, "right") - 1] == size]
            hashes = grams(words.hash, min(GRAM, int(size)))[kept]
            order = np.argsort(hashes, kind="stable")
            self.prints[int(size)] = hashes[order], kept[order]

    def find(self, words: Words, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words, item) of every occurrence of a window in some lower-cased texts."""
        found = [np.zeros((3, 0), np.int64)]
        for size, (hashes, places) in self.prints.items():
            kept = fingerprints(words.hash, words.at, size)
            values = grams(words.hash, min(GRAM, size))[kept]
            lo = np.searchsorted(hashes, values)
            hit = np.flatnonzero((lo < len(hashes)) & (hashes[np.minimum(lo, len(hashes) - 1)] == values))
            count = np.searchsorted(hashes, values[hit], "right") - lo[hit]
            here = np.repeat(kept[hit], count)
            there = places[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - lo[hit], count)]
            for at in range(0, len(here), MOST_HITS):
                found.append(self._extend(words, raw, size, here[at : at + MOST_HITS], there[at : at + MOST_HITS]))
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def _extend(self, words: Words, raw: bytes, size: int, here: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Windows around hits that are the same words in the document and the item."""
        gram = min(GRAM, size)
        reach_ = size - gram
        text, item = np.searchsorted(words.at, here, "right") - 1, np.searchsorted(self.at, there, "right") - 1
        first, last = words.at[text], words.at[text + 1]
        low, high = self.at[item], self.at[item + 1]
        near = np.unique((here[:, None] + np.arange(-reach_, size)).ravel())
        near = near[(near >= 0) & (near < len(words))]
        symbol = np.full(len(near) + 1, -1, np.int64)
        for i, w in enumerate(near):
            symbol[i] = self.names.get(raw[words.start[w] : words.end[w]], -1)
        same = np.zeros((len(here), reach_ + size), bool)
        for j, step in enumerate(range(-reach_, size)):
            a, b = here + step, there + step
            inside = (a >= first) & (a < last) & (b >= low) & (b < high)
            x = symbol[np.minimum(np.searchsorted(near, a), len(near))]
            same[:, j] = inside & (x >= 0) & (x == self.symbols[np.clip(b, 0, max(len(self.symbols) - 1, 0))])
        runs = np.cumsum(np.concatenate([np.zeros((len(here), 1), np.int64), same], axis=1), axis=1)
        whole = runs[:, size:] - runs[:, :-size] == size  # begins at here - reach_ + column
        row, column = np.nonzero(whole)
        return np.stack([here[row] - reach_ + column, np.full(len(row), size), item[row]])


def _finder(items: Items):
    """Adds n_words, spans and items to rows whose first column is the text, which is dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_pieces(batch.column(0)):
                words = Words(data, offsets)
                begin, size, item = items.find(words, bytes(data).lower())
                text = np.searchsorted(words.at, begin, "right") - 1
                order = np.argsort(text, kind="stable")
                edges = np.searchsorted(text[order], np.arange(hi - lo + 1))
                spans, names = [], []
                for i in range(hi - lo):
                    own = order[edges[i] : edges[i + 1]]
                    spans.append(_union(begin[own] - words.at[i], begin[own] - words.at[i] + size[own]))
                    names.append(sorted({items.ids[k] for k in item[own]} - {None}))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i)[lo:hi] for i in range(1, batch.num_columns)),
                        pa.array(np.diff(words.at), pa.int64()),
                        pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], pa.list_(_SPAN)),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    names=[*batch.schema.names[1:], "n_words", "spans", "items"],
                )

    return run


def _cleaner(items: Items):
    """Keeps the rows whose text, their first column, holds no window; the text is dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_pieces(batch.column(0)):
                words = Words(data, offsets)
                begin, _, _ = items.find(words, bytes(data).lower())
                clean = np.ones(hi - lo, bool)
                clean[np.searchsorted(words.at, begin, "right") - 1] = False
                rows = [batch.column(i)[lo:hi].filter(pa.array(clean)) for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(rows, names=batch.schema.names[1:])

    return run


_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
SPAN = "struct<first: bigint, last: bigint>"


def _union(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (first word, word after the last) of the words that some spans cover."""
    out: list[tuple[int, int]] = []
    for i in np.argsort(begin, kind="stable"):
        if out and begin[i] <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], int(end[i]))
        else:
            out.append((int(begin[i]), int(end[i])))
    return out


def _blocks(items: DataFrame) -> Iterator[tuple[list[str | None], list[str | None]]]:
    """Items in blocks of at most `BLOCK_BYTES`, one block at the driver at a time."""
    ids, texts, size = [], [], 0
    for r in items.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).toLocalIterator():
        n = len((r.t or "").encode())
        if ids and size + n > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += n
    yield ids, texts


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_words, spans (runs of hit words: first, last + 1) and items (ids found, as strings).

    A missing text has no words, a missing item text no windows. A missing item id still makes hits but is not listed.
    doc_id is only passed on, so missing and repeated ones are kept. Other columns are ignored.
    """
    reach(documents.sparkSession)
    docs, kind, found = documents.select("text", "doc_id"), dict(documents.dtypes)["doc_id"], f"n_words long, spans array<{SPAN}>, items array<string>"
    blocks = list(_blocks(benchmark))
    if len(blocks) == 1:
        return docs.mapInArrow(_finder(Items(*blocks[0])), f"doc_id {kind}, {found}")
    docs = settle(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    merged = _passes(docs, blocks, f"doc_id {kind}, _row long, {found}")
    merged = merged.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = F.aggregate(
        F.array_sort("spans"),
        F.array().cast(f"array<{SPAN}>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["first"] <= F.element_at(done, -1)["last"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first"].alias("first"),
                        F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return merged.drop("_row").withColumn("spans", joined)


def _passes(docs: DataFrame, blocks: list[tuple[list[str | None], list[str | None]]], schema: str) -> DataFrame:
    """What each block of items finds in each of the rows."""
    return reduce(DataFrame.unionByName, (docs.mapInArrow(_finder(Items(*b)), schema) for b in blocks))


def digest(found: DataFrame) -> DataFrame:
    """Counts and a checksum of each document's hits: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns.

    Every row is judged by its own text, whatever its doc_id.
    """
    reach(documents.sparkSession)
    names, blocks = documents.columns, list(_blocks(benchmark))
    rows = documents.select(documents["text"].alias("_text"), *(documents[c].alias(f"_c{i}") for i, c in enumerate(names)))
    if len(blocks) == 1:
        clean = rows.mapInArrow(_cleaner(Items(*blocks[0])), StructType(rows.schema.fields[1:]))
    else:
        rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "keyed")
        found = _passes(rows.select("_text", "_row"), blocks, f"_row long, n_words long, spans array<{SPAN}>, items array<string>")
        clean = rows.join(found.where(F.size("spans") > 0).select("_row").distinct(), "_row", "left_anti")
    return clean.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
