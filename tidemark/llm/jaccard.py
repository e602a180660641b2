"""Exact Jaccard join of documents on sets of word n-grams, by vertical partitioning.

All n-grams stand in one global order, which is cut into fragments at the same places for every document, so a set falls into segments and the
overlap of two sets is the sum of the overlaps of their segments.

1. The order of hashes is cut into `SLICES` ranges. In the first range alone it is counted how many of a set's n-grams occur in no other
   set. Two sets are `SIMILAR` only if no more than a tenth of either is missing from the other, so a set with more n-grams of its own
   is like no other and leaves. Few sets stay; for those all ranges are counted.
2. What stays is put in the order of (number of sets, hash), rare n-grams first. Two similar sets share one of the first tenth and one
   more, and the first one they share stands early enough in both. Sets that share one meet there, first only with the
   one of them that has fewest n-grams of its own, as the original of many copies does. What is then connected needs no comparison;
   sets of other parts meet those of all parts but their own, if sizes, places and numbers of shared n-grams allow a link.
3. The order is cut into fragments by number of sets (powers of two). Overlaps of candidate pairs are counted fragment by fragment and
   summed per pair.

Equal sets are joined before, and nothing is left out: each step only drops what can't be a link. N-grams and sets are compared by hashes of
64 and of twice 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, SPACED_WORDS, SPREAD, STEP, U64, Words, as_binary, buffers, grams, mix, reach, settle
from tidemark.llm.neardup import components
from tidemark.llm.prefixjoin import across, arranged, enough, may_miss, pairs, postings

#: Words of an n-gram; similarity of a link is at least `SIMILAR` / 100.
WORDS, SIMILAR = 3, 90
#: Ranges of hashes, of which the first is looked at for all sets.
SLICES = 4
#: Bytes of text that are cut into words at once, and bytes from which a word is hashed on its own.
PIECE, LONG_WORD = 1 << 19, 1 << 12
#: Bits of the filter that says which texts are worth cutting a second time; its size never grows.
FILTER_BITS = 1 << 23


def _cuts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text in pieces of about `PIECE` bytes that end between words, however long a word is."""
    lo = 0
    while lo < len(data):
        hi = lo + PIECE
        while hi < len(data) and not (gaps := np.flatnonzero(~SPACED_WORDS[data[hi : hi + PIECE]])).size:
            hi += PIECE
        hi = min(hi + int(gaps[0]) if hi < len(data) else len(data), len(data))
        yield data[lo:hi]
        lo = hi


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a piece of text, A-Z as a-z."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = SPACED_WORDS[data]
    edge = np.diff(inside)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = np.flatnonzero(stop - start > LONG_WORD)
    if not len(long):
        return Words(data, np.array([0, len(data)]), SPACED_WORDS).hash
    short = data.copy()
    for i in long:
        short[start[i] + 1 : stop[i]] = 0x20  # its first byte keeps its place
    hashes = Words(short, np.array([0, len(data)]), SPACED_WORDS).hash.copy()
    for i in long:
        digest = hashlib.blake2b(LOWER[data[start[i] : stop[i]]].tobytes(), digest_size=8).digest()
        hashes[i] = mix(np.frombuffer(digest, U64))[0]
    return hashes


def ngram_set(text: np.ndarray) -> np.ndarray:
    """The different n-gram hashes of a text, in order; all words together if they are fewer, none without words."""
    found, rest, words = [], np.zeros(0, U64), 0
    for piece in _cuts(text):
        hashes = word_hashes(piece)
        words += len(hashes)
        rest = np.concatenate([rest, hashes])
        found.append(np.unique(grams(rest, WORDS)))
        rest = rest[-(WORDS - 1) :]
    if 0 < words < WORDS:
        return mix(grams(rest, words) + U64(words))
    return np.unique(np.concatenate(found)) if found else rest


_SIGNED = "doc_id long, n long, k1 long, k2 long, low array<long>"
_LOW = U64((1 << 64) // SLICES)


def _key(values: np.ndarray, odd: np.uint64) -> int:
    return int(np.add.reduce(mix(values * odd + odd)).astype(np.int64))


def _signer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, hashes and first range of each document's set."""
    for batch in batches:
        data, at = buffers(as_binary(batch.column(1)))
        sizes, keys, low = np.zeros(batch.num_rows, np.int64), np.zeros((2, batch.num_rows), np.int64), []
        for row in range(batch.num_rows):
            own = ngram_set(data[at[row] : at[row + 1]])
            sizes[row], keys[:, row] = len(own), (_key(own, SPREAD), _key(own, STEP))
            low.append(own[: np.searchsorted(own, _LOW)].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(keys[0]), pa.array(keys[1]), pa.array(low, pa.list_(pa.int64()))],
            names=["doc_id", "n", "k1", "k2", "low"],
        )


def _places(doc_id: np.ndarray) -> np.ndarray:
    return (mix(doc_id.astype(np.int64).view(U64)) % U64(FILTER_BITS)).astype(np.int64)


def _filter(ids: DataFrame) -> bytes:
    """A bitmap of the hashed ids, of `FILTER_BITS` bits whatever their number, put together by tasks."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[_places(batch.column(0).to_numpy())] = True
        packed = np.packbits(bits).reshape(64, -1)
        some = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([packed[i].tobytes() for i in some], pa.binary())], names=["part", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in table.column("bits")])
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([both.tobytes()], pa.binary())})

    schema, size = "part long, bits binary", FILTER_BITS // 8 // 64
    parts = ids.mapInArrow(mark, schema).groupBy("part").applyInArrow(merge, schema).collect()  # at most 64 rows of 16 KB
    held = {r.part: bytes(r.bits) for r in parts}
    return b"".join(held.get(i, bytes(size)) for i in range(64))


def _setter(bits: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for batch in batches:
            some = np.flatnonzero(wanted[_places(batch.column(0).to_numpy())])
            if not len(some):
                continue
            data, at = buffers(as_binary(batch.column(1)))
            for row in some:
                own = ngram_set(data[at[row] : at[row + 1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[row : row + 1],
                        *(pa.array([_key(own, odd)], pa.int64()) for odd in (SPREAD, STEP)),
                        pa.array([own.view(np.int64)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "k1", "k2", "grams"],
                )

    return run


def _alive(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """The sets (node, n, ...) with at most a tenth of n-grams that no other set has, counted in `rows` (node, gram); adds their number `own`."""
    alone = rows.groupBy("gram").agg(F.count("*").alias("many"), F.min("node").alias("node")).where("many = 1")
    alone = alone.groupBy("node").agg(F.count("*").alias("own"))
    return sets.join(alone, "node", "left").withColumn("own", F.coalesce("own", F.lit(0))).where(may_miss("own", "n", SIMILAR))


def _ordered(sets: DataFrame) -> DataFrame:
    """(node, n, own, grams): the n-grams that other sets have too, as (many, gram) from rare to frequent."""
    rows = sets.select("node", F.explode("grams").alias("gram"))
    alive = settle(_alive(sets, rows).select("node", "n", "own", "grams"), "alive")
    # sets that left take the partners of some n-grams with them, so more of the others' are their own now
    return arranged(alive, alive.select("node", F.explode("grams").alias("gram")), SIMILAR)


def segments(ordered: DataFrame) -> DataFrame:
    """(node, fragment, grams): the sets cut where the number of sets of an n-gram doubles."""
    rows = ordered.select("node", F.explode("grams").alias("g"))
    # the exponent of the number: 2 and 3, 4 to 7, 8 to 15, ...
    fragment = F.length(F.bin("g.many")).alias("fragment")
    return rows.groupBy("node", fragment).agg(F.collect_list("g.gram").alias("grams"))


def _links(found: DataFrame, cut: DataFrame, sizes: DataFrame) -> DataFrame:
    """The similar ones of some pairs: overlaps are counted in each fragment, then summed."""
    found = settle(found, "pairs")
    left = cut.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga"))
    right = cut.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb"))
    partial = found.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", F.size(F.array_intersect("ga", "gb")).alias("common"))
    common = partial.groupBy("a", "b").agg(F.sum("common").alias("common"))
    common = common.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
    common = common.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    return settle(common.where(enough("common", "na", "nb", SIMILAR)).select("a", "b"), "links")


def _connected(ordered: DataFrame) -> DataFrame:
    """(node, least): sets connected by links with others, and the smallest node they are connected with."""
    posted = settle(postings(ordered, SIMILAR), "postings")
    cut, sizes = settle(segments(ordered), "segments"), ordered.select("node", "n")
    best = F.min(F.struct("own", "node", "n", "at"))
    pivots = posted.groupBy("gram").agg(best.alias("p"), F.count("*").alias("many")).where("many > 1").select("gram", "p.*")
    links = _links(pairs(posted, pivots, F.col("x.node") != F.col("y.node"), SIMILAR), cut, sizes)
    labels = components(links)
    # what is not connected yet: every set outside the largest part of an n-gram meets those of all other parts
    placed = posted.join(labels.withColumnRenamed("least", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    more = _links(across(settle(placed, "placed"), SIMILAR), cut, sizes)
    return labels if more.isEmpty() else components(links.unionByName(more))


def jaccard_components(documents: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_shingles (size of its set), component_id (smallest doc_id that links lead to, its own included).

    Sets are the different n-grams of `WORDS` words between ASCII white space, A-Z as a-z, of the whole text; a text of fewer words has one, a text
    without words or a missing one none, and is linked with nothing. Documents link from a similarity of `SIMILAR` percent. A row without doc_id
    counts its n-grams and has no component. Rows that repeat a doc_id are judged each by its own text. An empty table gives no rows; other
    columns are ignored. A text is cut into words in pieces, so a very long one costs 8 bytes for each of its n-grams and little else.
    """
    spark = documents.sparkSession
    reach(spark)
    rows = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text"))
    signed = settle(rows.mapInArrow(_signer, _SIGNED), "signed")
    sets = signed.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("least_id"), F.first("low").alias("low"))
    sets = settle(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    alive = _alive(sets.drop("low"), sets.select("node", F.explode("low").alias("gram")))
    alive = settle(alive.select("node", "n", "k1", "k2", "least_id"), "candidates")
    again = rows.where("doc_id is not null").mapInArrow(_setter(_filter(alive.select("least_id"))), "doc_id long, k1 long, k2 long, grams array<long>")
    whole = again.withColumnRenamed("doc_id", "least_id").join(alive, ["least_id", "k1", "k2"]).dropDuplicates(["node"])
    labels = _connected(_ordered(settle(whole.select("node", "n", "grams"), "whole")))
    joined = sets.select("node", "k1", "k2", "n", "least_id").join(labels, "node", "left").withColumn("part", F.coalesce("least", "node"))
    smallest = joined.groupBy("part").agg(F.min("least_id").alias("component_id"))
    named = joined.where("least is not null").join(smallest, "part").select("k1", "k2", "n", "component_id")
    alone = joined.where("least is null").select("k1", "k2", "n", F.col("least_id").alias("component_id"))
    found = signed.select("doc_id", "n", "k1", "k2").join(named.unionByName(alone), ["k1", "k2", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
