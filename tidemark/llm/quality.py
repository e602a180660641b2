"""Quality of whole texts: gradient-boosted trees on histograms of document statistics.

Statistics are counted in the tasks; about `SAMPLE` labelled rows train the trees. Values become bins by
quantiles, and each split is found from sums of gradients by bin. The trees are complete, so they flatten into
arrays of features, cuts and leaf values, and all rows of a batch go down all trees level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import SPACED_WORDS, U64, Words, as_binary, buffers, mix, pieces, reach

#: Labelled rows that training takes, about.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, RIDGE, LEAST = 80, 4, 0.15, 64, 1.0, 5.0
NAMES = (
    "bytes words word_bytes lines upper digits marks bangs bars symbols dots commas high newline "
    "distinct common repeated_next repeated_pairs repeated_lines short long marked_words capital_words line_words"
).split()


def _share(mask: np.ndarray, text: np.ndarray, texts: int, of: np.ndarray) -> np.ndarray:
    return np.bincount(text[mask], minlength=texts) / np.maximum(of, 1)


def _repeats(keys: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many different keys it has, and how often its commonest occurs."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    begin = np.flatnonzero(first)
    most = np.zeros(texts)
    np.maximum.at(most, t[begin], np.diff(np.append(begin, len(k))))
    return np.bincount(t[begin], minlength=texts).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of `NAMES` for each text; shares are of its bytes, words or lines, and 0 if it has none."""
    texts, size = len(offsets) - 1, np.diff(offsets).astype(float)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    share = lambda mask: _share(mask, owner, texts, size)
    upper = (data >= 0x41) & (data <= 0x5A)
    letter = upper | (data >= 0x61) & (data <= 0x7A) | (data >= 0x80)
    digit = (data >= 0x30) & (data <= 0x39)
    blank = ~SPACED_WORDS[data]
    any_of = lambda marks: np.isin(data, np.frombuffer(marks, np.uint8))
    words = Words(data, offsets, SPACED_WORDS, lower=False)
    count = np.diff(words.at).astype(float)
    home = np.repeat(np.arange(texts), np.diff(words.at))
    length = words.end - words.start
    lines = np.flatnonzero(data == 10)
    many_lines = np.bincount(owner[lines], minlength=texts) + (size > 0)
    distinct, most = _repeats(words.hash, home, texts)
    next_same = np.zeros(len(words), bool)
    next_same[1:] = (words.hash[1:] == words.hash[:-1]) & (home[1:] == home[:-1])
    pair = words.hash.copy()
    pair[1:] = mix(words.hash[1:] + U64(3) * words.hash[:-1])
    pairs, _ = _repeats(pair, home, texts)
    row = np.searchsorted(lines, words.start)  # words of one line get one number within a batch
    line_first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (home[1:] != home[:-1]))) if len(words) else np.zeros(0, np.int64)
    line_hash = np.add.reduceat(words.hash * U64(5) + mix(words.hash), line_first) if len(line_first) else np.zeros(0, U64)
    line_home = home[line_first] if len(line_first) else np.zeros(0, np.int64)
    line_count = np.bincount(line_home, minlength=texts).astype(float)
    different_lines, _ = _repeats(line_hash, line_home, texts)
    per_word = lambda mask: _share(mask, home, texts, count)
    last = data[words.end - 1] if len(words) else data[:0]
    odd_end = np.isin(last, np.frombuffer(b"!#$%&*|", np.uint8))
    columns = [
        np.log1p(size),
        np.log1p(count),
        np.bincount(home, weights=length, minlength=texts) / np.maximum(count, 1),
        np.log1p(many_lines),
        np.bincount(owner[upper], minlength=texts) / np.maximum(np.bincount(owner[letter], minlength=texts), 1),
        share(digit),
        share(~letter & ~digit & ~blank),
        share(data == 0x21),
        share(data == 0x7C),
        share(any_of(b"#$%&*@^~<>{}[]=+_")),
        share(data == 0x2E),
        share(data == 0x2C),
        share(data >= 0x80),
        share(data == 10),
        distinct / np.maximum(count, 1),
        most / np.maximum(count, 1),
        per_word(next_same),
        1 - pairs / np.maximum(count, 1),
        1 - different_lines / np.maximum(line_count, 1),
        per_word(length <= 2),
        per_word(length >= 13),
        per_word(odd_end),
        per_word(upper[words.start]) if len(words) else np.zeros(texts),
        count / np.maximum(line_count, 1),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class Model:
    """Complete trees of one depth as arrays: a row for each tree, a column for each node, breadth first."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total, trees = np.full(len(rows), self.base), np.arange(len(self.leaf))[None, :]
        node, line = np.zeros((len(rows), len(self.leaf)), np.int64), np.arange(len(rows))[:, None]
        for _ in range(DEPTH):
            right = rows[line, self.feature[trees, node]] > self.cut[trees, node]
            node = 2 * node + 1 + right
        total = total + self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _best_splits(bins: np.ndarray, node: np.ndarray, nodes: int, slope: np.ndarray, bend: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the feature and the last bin of the left side that lower the loss most (no split: bin BINS - 1)."""
    best = np.full(nodes, 1e-6)
    feature, at = np.zeros(nodes, np.int64), np.full(nodes, BINS - 1)
    for f in range(bins.shape[1]):
        slot = node * BINS + bins[:, f]
        g = np.bincount(slot, slope, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
        h = np.bincount(slot, bend, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
        whole_g, whole_h = g[:, -1:], h[:, -1:]
        gain = g**2 / (h + RIDGE) + (whole_g - g) ** 2 / (whole_h - h + RIDGE) - whole_g**2 / (whole_h + RIDGE)
        gain[(h < LEAST / 4) | (whole_h - h < LEAST / 4)] = -1
        top = gain.argmax(axis=1)
        value = gain[np.arange(nodes), top]
        better = value > best
        best[better], feature[better], at[better] = value[better], f, top[better]
    return feature, at


def train(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost trees on binned rows (labels 0 or 1)."""
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS)[1:-1], method="lower")) for f in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    total, inner = np.full(len(rows), base), 2**DEPTH - 1
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        slope, bend = p - labels, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            f, at = _best_splits(bins, node - first, many, slope, bend)
            for i in range(many):
                if at[i] < len(cuts[f[i]]):
                    feature[first + i], cut[first + i] = f[i], cuts[f[i]][at[i]]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > cut[node])
        leaves = node - inner
        leaf = -RATE * np.bincount(leaves, slope, inner + 1) / (np.bincount(leaves, bend, inner + 1) + RIDGE)
        total += leaf[leaves]
        trees.append((feature, cut, leaf))
    return Model(*(np.stack(x) for x in zip(*trees, strict=True)), base)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = buffers(as_binary(batch.column(1)))
        for lo, hi in pieces(at):
            rows = statistics(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array(list(rows), pa.list_(pa.float32()))], names=["label", "place", "row"]
            )


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from `labels` (doc_id, quality): rows without a doc_id or a quality are no examples. None if none has a text row.

    Equal rows (id, label and text) count once, so copies of one row neither fill the sample nor come to the driver; at most `sample` rows
    do, the first by a hash. Labels are thinned by a hash of their id before texts are joined.
    """
    spark = documents.sparkSession
    reach(spark)
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("doc_id is not null and label is not null").distinct()
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * sample / n)))
        # ids with several labels may leave more than that
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(2 * sample)
    place = F.xxhash64("doc_id", "label", "text")
    rows = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("label", "text", place.alias("place"))
    rows = rows.mapInArrow(_counted, "label double, place long, row array<float>")
    got = rows.groupBy("place", "label").agg(F.first("row").alias("row")).orderBy("place").limit(sample).collect()
    if not got:
        return None
    return train(np.array([r.row for r in got], np.float32), np.array([r.label for r in got]))


def _scorer(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(as_binary(batch.column(1)))
            for lo, hi in pieces(at):
                rows = statistics(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                score = model.score(rows) if model else np.full(hi - lo, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def scores(documents: DataFrame, model: Model | None) -> DataFrame:
    """A row for each document: doc_id, score (0 to 1, higher: better; 0.5 for all without a model).

    Missing texts are scored as empty ones. doc_id is only passed on; other columns are ignored.
    """
    reach(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(_scorer(model), f"doc_id {kind}, score double")
