"""Near-duplicate documents by DartMinHash signatures and banded joining.

A text is a weighted set of its shingles of `SHINGLE` words. Over each unit of an element's weight lies a strip of rank without end,
cut into cells of area 1; a hash of element and cell says how many darts hit the cell (Poisson, mean 1) and
where. A text gets the darts below its weights, every dart belongs to one of `COORDINATES` by its hash, and each coordinate keeps the dart
of lowest rank. Two texts keep the same dart with the chance of their weighted Jaccard similarity. Only as much rank is searched
as it takes to fill all coordinates, so a text costs about as many darts as there are coordinates, whatever its weights.

`ROWS` coordinates in a row make a band. Texts that share a band are candidates: each is compared, on its whole
shingles, with the pivot of the bucket, the text that shares most bands with others, as the original of many edited copies does. What is still
apart after that meets the texts of other parts by an exact prefix filter over the shingles of all texts in such buckets, so edits of one's own
lead to no pairs. So no bucket is cut off or spread into all its pairs. Links of similarity `SIMILAR` or more join texts to classes.

A pair of similarity 0.8 shares none of the bands with a chance of about 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import SPREAD, STEP, U64, Words, as_binary, buffers, grams, mix, pieces, reach, settle
from tidemark.llm.prefixjoin import across, arranged, postings

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
#: Chances of at most 0, 1, 2, ... darts in a cell.
_DARTS = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 18)]))
_RANK_BITS = U64(48)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U64(11)).astype(np.float64) * 2.0**-53


def dart_minhash(
    element: np.ndarray, weight: np.ndarray, owner: np.ndarray, owners: int, coordinates: int = COORDINATES
) -> np.ndarray:
    """Signatures of weighted sets, a row for each owner. Entries (element hash, weight above 0, owner) are unique.

    A set without elements has only the largest value.
    """
    out = np.full(owners * coordinates, U64(0xFFFFFFFFFFFFFFFF))
    total = np.bincount(owner, weight, owners)
    enough = coordinates * (np.log(coordinates) + 2)
    step = np.ceil(enough / np.maximum(total, 1e-9)).astype(np.int64)
    # one entry for each unit of weight
    units = np.ceil(weight).astype(np.int64)
    unit = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
    base, limit, own = (np.repeat(x, units) for x in (element, weight, owner))
    base = mix(base + unit.astype(U64) * SPREAD)
    low = np.zeros(owners, np.int64)
    open_ = total > 0
    while open_.any():
        some = np.flatnonzero(open_[own])
        high = low + np.where(open_, step, 0)
        cells = (high - low)[own[some]]
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        source = np.repeat(some, cells)
        rank = cell + low[own[source]]
        key = mix(base[source] + rank.astype(U64) * STEP + U64(1))
        darts = np.searchsorted(_DARTS, _unit(key), "right")
        dart = np.arange(darts.sum()) - np.repeat(np.cumsum(darts) - darts, darts)
        source, rank, key = (np.repeat(x, darts) for x in (source, rank, key))
        key = mix(key + dart.astype(U64) * SPREAD + U64(2))
        inside = unit[source] + _unit(mix(key + U64(3))) < limit[source]
        source, rank, key = source[inside], rank[inside], key[inside]
        value = (rank.astype(U64) << _RANK_BITS) | (mix(key + U64(5)) >> (U64(64) - _RANK_BITS))
        place = own[source] * coordinates + (key % U64(coordinates)).astype(np.int64)
        np.minimum.at(out, place, value)
        empty = (out == U64(0xFFFFFFFFFFFFFFFF)).reshape(owners, coordinates).any(axis=1)
        low = high
        open_ &= empty
    return out.reshape(owners, coordinates)


def shingles(words: Words, counts: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, text) of the different shingles of some texts; fewer words than a shingle are one shingle."""
    size = np.diff(words.at)
    hashes = grams(words.hash, SHINGLE)
    text = np.repeat(np.arange(len(size)), np.maximum(size - SHINGLE + 1, 0))
    first = np.arange(len(text)) - np.repeat(np.cumsum(np.maximum(size - SHINGLE + 1, 0)) - np.maximum(size - SHINGLE + 1, 0), np.maximum(size - SHINGLE + 1, 0))
    value = hashes[words.at[text] + first] if len(text) else np.zeros(0, U64)
    for n in range(1, SHINGLE):
        short = np.flatnonzero(size == n)
        if len(short):
            value = np.append(value, mix(grams(words.hash, n)[words.at[short]] + U64(n)))
            text = np.append(text, short)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    weight = np.diff(np.append(begin, len(value))).astype(float) if counts else np.ones(len(begin))
    return value[begin], weight, text[begin]


def _signer(counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(as_binary(batch.column(1)))
            for lo, hi in pieces(at, 1 << 19):
                words = Words(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                value, weight, text = shingles(words, counts)
                signature = dart_minhash(value, weight, text, hi - lo)
                bands = np.zeros((hi - lo, BANDS), U64) + np.arange(1, BANDS + 1, dtype=U64) * STEP
                for r in range(ROWS):
                    bands = mix(bands * SPREAD + signature[:, r::ROWS])
                size = np.diff(words.at)
                place = np.arange(len(words)) - np.repeat(words.at[:-1], size)
                keys = []
                for odd in (SPREAD, STEP):
                    power = np.cumprod(np.full(int(size.max(initial=0)) + 1, odd, U64))
                    sums = np.concatenate([np.zeros(1, U64), np.cumsum(words.hash * power[place])])
                    keys.append(mix(sums[words.at[1:]] - sums[words.at[:-1]] + size.astype(U64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        batch.column(2)[lo:hi],
                        *(pa.array(k.view(np.int64)) for k in keys),
                        pa.array(np.bincount(text, weight, minlength=hi - lo).astype(np.int64)),
                        pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "print", "k1", "k2", "n", "bands"],
                )

    return run


def _setter(counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(as_binary(batch.column(1)))
            for lo, hi in pieces(at):
                value, weight, text = shingles(Words(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]), counts)
                edges = np.searchsorted(text, np.arange(hi - lo + 1))
                raw = [value[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                heavy = [weight[a:b].astype("<u4").tobytes() if counts else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
                columns = [batch.column(0)[lo:hi], pa.array(raw, pa.binary()), pa.array(heavy, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["text_id", "shingles", "weights"])

    return run


def similarity(a: bytes, b: bytes, weights_a: bytes | None = None, weights_b: bytes | None = None) -> float:
    """Weighted Jaccard similarity of two sorted sets of shingles (weights 1 if not given)."""
    x, y = np.frombuffer(a, U64), np.frombuffer(b, U64)
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if weights_a is None or weights_b is None:
        return len(both) / max(len(x) + len(y) - len(both), 1)
    u, v = np.frombuffer(weights_a, "<u4"), np.frombuffer(weights_b, "<u4")
    common = int(np.minimum(u[i], v[j]).sum())
    return common / max(int(u.sum()) + int(v.sum()) - common, 1)


def _comparer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = zip(*(batch.column(c) for c in ("sa", "sb", "wa", "wb")), strict=True)
        score = [similarity(*(x.as_py() for x in row)) for row in sets]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(score, pa.float64())], names=["a", "b", "similar"])


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The similarity of each pair (a, b), counted on whole shingles; written once."""
    left = sets.select(F.col("text_id").alias("a"), F.col("shingles").alias("sa"), F.col("weights").alias("wa"))
    right = sets.select(F.col("text_id").alias("b"), F.col("shingles").alias("sb"), F.col("weights").alias("wb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "wa", "wb")
    return settle(joined.mapInArrow(_comparer, "a long, b long, similar double"), "compared")


def components(links: DataFrame) -> DataFrame:
    """(node, least): for every node of the links (a, b) the smallest node that it is connected with.

    Every round points each part to its smallest neighbour, follows the pointers two steps, and merges; a round is written,
    so it isn't repeated when executors are lost. The number of rounds grows with the logarithm of the longest path.
    """
    both = links.select(F.col("a"), F.col("b")).union(links.select("b", "a")).where("a <> b").distinct()
    edges = settle(both, "edges")
    labels = settle(edges.select(F.col("a").alias("node"), F.col("a").alias("least")).distinct(), "labels")
    while not edges.isEmpty():
        hook = settle(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")), "hooks")
        for _ in range(2):
            above = hook.select(F.col("a").alias("up"), F.col("up").alias("_over"))
            hook = settle(hook.join(above, "up").select("a", F.col("_over").alias("up")), "hooks")
        to = hook.select(F.col("a").alias("least"), F.col("up").alias("_up"))
        labels = settle(labels.join(to, "least", "left").select("node", F.coalesce("_up", "least").alias("least")), "labels")
        ends = edges.join(hook.select("a", F.col("up").alias("_a")), "a")
        ends = ends.join(hook.select(F.col("a").alias("b"), F.col("up").alias("_b")), "b")
        edges = settle(ends.where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "edges")
    return labels


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle; with weights, one for each time it occurs."""
    for batch in batches:
        sets, at = buffers(as_binary(batch.column("shingles")))
        shingle = np.frombuffer(sets.tobytes(), U64)
        text = np.repeat(batch.column("text_id").to_numpy(), np.diff(at) // 8)
        if batch.column("weights").null_count == 0:
            times = np.frombuffer(buffers(as_binary(batch.column("weights")))[0].tobytes(), "<u4").astype(np.int64)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            text, shingle = np.repeat(text, times), mix(np.repeat(shingle, times) + nth.astype(U64) * SPREAD)
        for lo in range(0, len(text), 1 << 16):
            some = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(text[some]), pa.array(shingle[some].view(np.int64))], names=["node", "gram"])


def _across(buckets: DataFrame, compared: DataFrame, labels: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of texts that are not yet connected, lie in buckets that hold several parts, and may be a link (see `prefixjoin`)."""
    known = compared.select(F.col("a").alias("text_id"), F.col("b").alias("pivot"), "similar")
    placed = (
        buckets.join(known, ["text_id", "pivot"], "left")
        .join(labels.select(F.col("node").alias("text_id"), "least"), "text_id", "left")
        .withColumn("part", F.coalesce("least", "text_id"))
        .where("text_id <> pivot and similar is not null")
    )
    mixed = placed.groupBy("h").agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first <> last").select("h")
    texts = settle(placed.join(mixed, "h", "left_semi").select(F.col("text_id").alias("node"), "part").distinct(), "placed")
    some = sets.withColumnRenamed("text_id", "node").join(texts.select("node"), "node", "left_semi")
    rows = settle(some.select(F.col("node").alias("text_id"), "shingles", "weights").mapInArrow(_spread, "node long, gram long"), "spread")
    similar = round(100 * SIMILAR)
    posted = postings(arranged(sizes.withColumnRenamed("text_id", "node"), rows, similar), similar)
    return across(settle(posted.join(texts, "node"), "postings"), similar)


def near_duplicates(documents: DataFrame, counts: bool = False) -> DataFrame:
    """A row for each document: doc_id, class_id (smallest doc_id of its near-duplicates, or its own), text_id (smallest with the same words).

    Classes are connected by links of similarity `SIMILAR` or more on different shingles (with `counts`, each weighted by how often it
    occurs). A text without words is like no other, and a row without doc_id has no class. Rows that repeat a doc_id are all kept; if
    their texts differ, each has the class of its own text. Other columns are ignored.
    """
    return _classified(documents, counts).drop("print")


def _classified(documents: DataFrame, counts: bool = False) -> DataFrame:
    """The rows of `near_duplicates` with `print`, a hash that tells the texts of one doc_id apart."""
    spark = documents.sparkSession
    reach(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print"))
    schema = "doc_id long, print long, k1 long, k2 long, n long, bands array<long>"
    signed = settle(rows.mapInArrow(_signer(counts), schema), "signed")
    texts = signed.where("n > 0 and doc_id is not null").groupBy("k1", "k2")
    texts = texts.agg(F.min(F.struct("doc_id", "print")).alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    texts = settle(texts.select("k1", "k2", "least.*", "n", "bands", F.monotonically_increasing_id().alias("nth")), "texts")
    # texts go by their smallest doc_id; only if one stands for several texts, they are numbered
    numbered = not texts.groupBy("doc_id").count().where("count > 1").isEmpty()
    texts = texts.withColumn("text_id", F.col("nth" if numbered else "doc_id"))
    sizes = texts.groupBy("text_id").agg(F.max("n").alias("n"))
    banded = texts.select("text_id", F.explode("bands").alias("h"))
    full = banded.groupBy("h").agg(F.count("*").alias("many")).where("many > 1")
    held = settle(banded.join(full, "h").select("h", "text_id", "many"), "held")
    weights = settle(held.groupBy("text_id").agg(F.sum("many").alias("weight")), "weights")
    best = F.max(F.struct("weight", (-F.col("text_id")).alias("least")))
    pivots = held.join(weights, "text_id").groupBy("h").agg((-best["least"]).alias("pivot"))
    buckets = settle(held.join(pivots, "h").select("h", "text_id", "pivot"), "buckets")
    needed = texts.select("text_id", "doc_id", "print").join(buckets.select("text_id").distinct(), "text_id")
    words = rows.join(needed, ["doc_id", "print"]).select("text_id", "text")
    sets = settle(words.mapInArrow(_setter(counts), "text_id long, shingles binary, weights binary"), "sets")
    sets = sets.dropDuplicates(["text_id"])
    near = buckets.where("text_id <> pivot").select(F.col("text_id").alias("a"), F.col("pivot").alias("b")).distinct()
    compared = compare(near, sets)
    links = compared.where(F.col("similar") >= SIMILAR)
    labels = components(links)
    more = compare(_across(buckets, compared, labels, sizes, sets), sets).where(F.col("similar") >= SIMILAR)
    if not more.isEmpty():
        labels = components(links.union(more))
    classes = texts.select("k1", "k2", "doc_id", "text_id").join(labels.withColumnRenamed("node", "text_id"), "text_id", "left")
    classes = classes.select("k1", "k2", F.col("doc_id").alias("text_id"), F.coalesce("least", "text_id").alias("class_id"))
    if numbered:
        least = classes.groupBy("class_id").agg(F.min("text_id").alias("least"))
        classes = classes.join(least, "class_id").select("k1", "k2", "text_id", F.col("least").alias("class_id"))
    found = signed.select("doc_id", "print", "k1", "k2", (F.col("n") > 0).alias("filled")).join(classes, ["k1", "k2"], "left")
    alone = F.col("doc_id").isNull() | ~F.col("filled")
    own = lambda c: F.when(alone, F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return found.select("doc_id", own("class_id"), own("text_id"), "print")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose doc_id is the smallest of its near-duplicates (or missing).

    Rows that share a doc_id but not a text are judged one by one.
    """
    gone = _classified(documents).where("class_id <> doc_id").select(F.col("doc_id").alias("_gone"), F.col("print").alias("_print")).distinct()
    same = (documents["doc_id"] == gone["_gone"]) & (F.xxhash64(documents["text"]) == gone["_print"])
    return documents.join(gone, same, "left_anti")
