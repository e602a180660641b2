"""Words of passages that occur more than once, found by backward search in an FM-index for each shard.

Every shard (see `repeats`) keeps its passages in an FM-index over a wavelet matrix. All passages stream through it,
many at once: from the last word of a window, ranges of suffixes shrink by one word in front at a time, as long as they hold a second
occurrence. That gives the matching statistics: how far each stretch reaches back before it is unique. Stretches of at least `SIZE` words
are reported as intervals of repeated windows; behind a stretch that ends, the search starts again at the
first window that it hasn't decided.

Words are compared through 64-bit hashes of their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.fmindex import FMIndex
from tidemark.llm.repeats import Block, Kind, exchange

SIZE, GRAM = 35, 8
WORDS = Kind(words=True, size=SIZE, gram=GRAM, across=False)


def repeated(text: np.ndarray, begin: np.ndarray, windows: np.ndarray, many: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window of the passages 1 if it occurs again, in a passage that occurs again or as another window of the index."""
    answers = np.repeat((many > 1).astype(np.int64), windows)
    out = np.cumsum(windows) - windows
    stream = np.flatnonzero(many == 1)
    if not len(stream):
        return answers
    index = FMIndex(text + 1)
    place = np.zeros(len(text), bool)
    passage = np.repeat(np.arange(len(begin)), windows)
    place[begin[passage] + np.arange(len(passage)) - out[passage]] = True
    starts = np.concatenate([[0, 0], np.cumsum(place[index.order])])  # windows among the first suffixes
    low, high = np.zeros(len(stream), np.int64), np.full(len(stream), index.size)
    first = begin[stream]
    end = first + windows[stream] + SIZE - 2  # last word of the window that is searched
    at = end.copy()  # next word in front
    while len(stream):
        left, right = index.search(text[at] + 1, low, high)
        length = end - at + 1
        enough = length >= SIZE
        again = np.where(enough, starts[right] - starts[left], right - left) >= 2
        found = np.flatnonzero(enough & again)
        answers[out[stream[found]] + at[found] - first[found]] = 1
        low, high = left, right
        stop = np.flatnonzero(~again)
        low[stop], high[stop] = 0, index.size
        at -= 1
        # windows that begin behind the failing word are decided, and so are those that hold the unique stretch
        end[stop] = np.minimum(end[stop] - 1, at[stop] + SIZE)
        at[stop] = end[stop]
        going = np.where(again, at >= first, end - SIZE + 1 >= first)
        stream, low, high, first, end, at = (x[going] for x in (stream, low, high, first, end, at))
    return answers


_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def kept_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """Some words of a text, joined by one space."""
    if not len(start):
        return b""
    size = end - start + 1
    to = np.cumsum(size) - size
    step = np.arange(size.sum()) - np.repeat(to, size)
    out = np.append(data, np.uint8(32))[np.minimum(np.repeat(start, size) + step, len(data))]
    out[to + size - 1] = 32
    return out[:-1].tobytes()


def _texts(texts: Block, cover: np.ndarray):
    """(bytes, begins, ends, cover) of the words of every text of a block."""
    for (_, _, at, words, data, offsets), base in zip(texts.parts, texts.start, strict=False):
        for i in range(len(offsets) - 1):
            a, b = at[i], at[i + 1]
            yield data, words.start[a:b], words.end[a:b], cover[base + a : base + b]


def _digest(block: pa.Table, texts: Block | None, cover) -> pa.Table:
    size, removed, sha = [], [], []
    for data, start, end, gone in _texts(texts, cover) if texts else ():
        size.append(len(start))
        removed.append(int(gone.sum()))
        sha.append(hashlib.sha256(kept_words(data, start[~gone], end[~gone])).hexdigest())
    columns = [block.column("_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
    return pa.Table.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def digest(documents: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_words, n_removed, kept_sha256 (of the words left, joined by one space).

    Removed is each word covered by `SIZE` words in a row that also begin anywhere else, judged on the input. A missing text has no words.
    doc_id is only passed on; rows that repeat are copies of each other. Other columns are ignored.
    """
    return exchange(documents.select("doc_id", "text"), WORDS, repeated, _digest, _DIGEST, [])


_KEPT = "doc_id long, text string, intervals array<struct<first: bigint, last: bigint>>"


def _cut(block: pa.Table, texts: Block | None, cover) -> pa.Table:
    kept, runs = [], []
    for data, start, end, gone in _texts(texts, cover) if texts else ():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
        kept.append(kept_words(data, start[~gone], end[~gone]).decode())
        runs.append([{"first": a, "last": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    return pa.Table.from_arrays([block.column("_id"), pa.array(kept, pa.string()), pa.array(runs, kind)], names=["doc_id", "text", "intervals"])


def without_repeats(documents: DataFrame) -> DataFrame:
    """A row for each document: doc_id, text (the words that `digest` keeps, joined by one space), intervals (removed runs of words: first, last + 1)."""
    return exchange(documents.select("doc_id", "text"), WORDS, repeated, _cut, _KEPT, [])
