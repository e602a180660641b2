"""Best-fit packing of tokenised documents into sequences of a fixed length.

The lengths of all pieces make a histogram of at most `capacity` bars, however many documents there are.
On it a configuration linear program (fewest sequences, each filled by one pattern of lengths, that cover
the histogram) is solved by multiplicative weights: lengths covered little weigh much, and the pattern
of greatest weight that fits comes from an unbounded-knapsack dynamic program over steps of `GRID` ids; lengths that need as many steps are one
class. Rounds go on, with ever smaller changes of weight, until the solution is within `GAP` of what its dual or the ids alone
demand. Classes that the rounds cover too little keep patterns of their own, so every length is covered. The uses of each pattern are rounded down; what remains of the histogram is placed by best fit, largest first, whole
groups of equal sequences at a time, also into the room that patterns leave. The plan says, for each length, which ranks go where, so every piece finds its
sequence by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import as_binary, buffers, pieces, reach, settle
from tidemark.llm.tokens import WORD_BPE, encoder, vocabulary_path

CAPACITY = 2048
#: Id that ends each document.
END = 0
#: Ids in a step of the program's lengths.
GRID = 8
#: How near to the least number of sequences the program is solved, and the rounds after which it is rounded in any case.
GAP, ROUNDS = 0.03, 7500
#: Bytes of text tokenised at once.
TEXT_BYTES = 2 << 20


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    return [(at, min(capacity, tokens - at)) for at in range(0, tokens, capacity)]


def _tokenise(path: str, capacity: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            data, at = buffers(as_binary(batch.column(1)))
            for lo, hi in pieces(at, TEXT_BYTES):
                ids, edges = encoder(path).encode(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                row, number, start, length, crc, nth, kept = [], [], [], [], [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[edges[i] : edges[i + 1]], END).astype("<u4")
                    for k, (s, n) in enumerate(cut(len(own), capacity)):
                        row.append(lo + i)
                        number.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(own[s : s + n].tobytes()))
                        nth.append(seen[n])
                        seen[n] += 1
                        if keep:
                            kept.append(own[s : s + n].astype(np.int32))
                columns = {
                    "doc_id": batch.column(0).take(pa.array(row, pa.int64())),
                    "piece": pa.array(number, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "_block": pa.array(np.full(len(row), block, np.int64)),
                    "_nth": pa.array(nth, pa.int64()),
                }
                if keep:
                    columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def tokenised_pieces(
    documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = WORD_BPE, keep_ids: bool = False
) -> DataFrame:
    """A row for each piece, written once: its place in its document, length, checksum and (if wanted) ids.

    `_block` and `_nth` number the pieces of each length within the task that made them.
    """
    reach(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _block long, _nth long"
    run = _tokenise(vocabulary_path(vocabulary), capacity, keep_ids)
    made = documents.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * keep_ids)
    return settle(made, "pieces")


@dataclass
class Plan:
    """Where the pieces of each length go.

    Entry i places the pieces of length `length[i]` with ranks from `first[i]` on: `each[i]` of them in every sequence from
    `sequence[i]` on, side by side from `offset[i]`. Entries are in order of length and rank.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces of given lengths and ranks."""
        at = np.zeros(len(length), np.int64)
        for n in np.unique(length):
            lo, hi = np.searchsorted(self.length, [n, n + 1])
            some = length == n
            at[some] = lo + np.searchsorted(self.first[lo:hi], rank[some], "right") - 1
        past = rank - self.first[at]
        return self.sequence[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


def _best_pattern(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """How often each length is in the pattern of greatest value that fits (unbounded knapsack), and that value."""
    best, used = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(int(lengths[0]), capacity + 1):
        sums = best[c - lengths[: fits[c]]] + values[: fits[c]]
        i = int(sums.argmax())
        if sums[i] > best[c - 1]:
            best[c], used[c] = sums[i], i
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(lengths), np.int64), capacity
    while c >= lengths[0]:
        if used[c] < 0:
            c -= 1
        else:
            pattern[used[c]] += 1
            c -= int(lengths[used[c]])
    return pattern, float(best[capacity])


@dataclass
class Solution:
    """Patterns of lengths and how often each is used, so that every length is covered; `value` sequences, of `least` that any solution needs."""

    patterns: np.ndarray
    uses: np.ndarray
    value: float
    least: float


def fractional_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP, rounds: int = ROUNDS) -> Solution:
    """Solve the configuration program to within `gap`, or as far as some rounds go.

    Rounds are averaged, all of a phase or the later ones; a phase is twice as long as the one before and changes weights half as much. What
    the average covers less than the rest is covered by patterns of one length alone.
    """
    weights, rate, phase, done = np.ones(len(lengths)), 0.5, 500, 0
    least = float(lengths @ counts) / capacity
    alone = np.diag(capacity // lengths)
    best = Solution(alone, counts / np.diag(alone), float((counts / np.diag(alone)).sum()), least)
    while best.value > (1 + gap) * best.least and done < rounds:
        patterns, uses = np.zeros((phase, len(lengths)), np.int64), np.zeros(phase)
        for t in range(phase):
            patterns[t], value = _best_pattern(lengths, weights / counts, capacity)
            best.least = max(best.least, weights.sum() / value)
            pattern = patterns[t]
            inside = pattern > 0
            share = (pattern[inside] / counts[inside]).max()
            uses[t] = 1 / share
            weights *= np.exp(-rate * pattern / counts / share)
            weights /= weights.sum()
        for first in (0, phase // 4, phase // 2):
            cover = uses[first:] @ patterns[first:] / counts
            for level in np.unique(np.quantile(cover, [0, 0.01, 0.03, 0.1, 0.3])):
                short = np.flatnonzero(cover < level)
                extra = counts[short] * (1 - cover[short] / max(level, 1e-300)) / (capacity // lengths[short])
                if level > 0 and (value := float(uses[first:].sum() / level + extra.sum())) < best.value:
                    different, back = np.unique(patterns[first:], axis=0, return_inverse=True)
                    many = np.bincount(back.ravel(), uses[first:], len(different)) / level
                    best = Solution(np.concatenate([different, alone[short]]), np.concatenate([many, extra]), value, best.least)
        rate, phase, done = rate / 2, 2 * phase, done + phase
    return best


def _place_all(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, of_class: np.ndarray, patterns: np.ndarray, uses: np.ndarray
) -> tuple[list, int]:
    """Use each pattern of classes as often as said and as pieces last, then place the rest by best fit, largest first, for whole
    runs of equal sequences."""
    left, used, entries, sequences = counts.copy(), np.zeros(len(lengths), np.int64), [], 0

    def put(i: int, each: int, many: int, sequence: int, offset: int) -> None:
        entries.append((int(lengths[i]), int(used[i]), each, sequence, offset))
        used[i] += each * many
        left[i] -= each * many

    free: dict[int, list[tuple[int, int]]] = {}  # room: runs of (first sequence, sequences)
    members = [np.flatnonzero(of_class == c) for c in range(int(of_class.max(initial=-1)) + 1)]
    for p in np.argsort(-uses, kind="stable"):
        inside = np.flatnonzero(patterns[p])
        if not len(inside):
            continue
        held = np.array([left[members[c]].sum() for c in inside])
        many = min(int(uses[p] + 1e-9), int((held // patterns[p][inside]).min()))
        if many <= 0:
            continue
        runs = [(sequences, many, 0)]  # sequences filled alike so far: first, how many, up to where
        for c in inside:
            for _ in range(int(patterns[p][c])):
                after = []
                for first, n, offset in runs:
                    while n:  # the longest of the class that are left
                        i = int(members[c][np.flatnonzero(left[members[c]])[-1]])
                        take = min(n, int(left[i]))
                        put(i, 1, take, first, offset)
                        after.append((first, take, offset + int(lengths[i])))
                        first, n = first + take, n - take
                runs = after
        for first, n, offset in runs:
            if offset < capacity:
                free.setdefault(capacity - offset, []).append((first, n))
        sequences += many
    for i in range(len(lengths) - 1, -1, -1):
        n = int(lengths[i])
        while left[i]:
            room = min((r for r in free if r >= n), default=0)
            if room:
                first, many = free[room].pop()
                if not free[room]:
                    del free[room]
                each = min(room // n, int(left[i]))
                if (take := max(1, min(many, int(left[i]) // each))) < many:
                    free.setdefault(room, []).append((first + take, many - take))
                    many = take
            else:
                each = min(capacity // n, int(left[i]))
                first, many, room = sequences, max(1, int(left[i]) // each), capacity
                sequences += many
            put(i, each, many, first, capacity - room)
            if room > each * n:
                free.setdefault(room - each * n, []).append((first, many))
    return entries, sequences


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Place a histogram of lengths below `capacity`: the rounded solution that needs the fewest sequences.

    The program's solution is rounded down as it is, shrunk, and without its short lengths, so that more is left to best fit. Best fit alone
    counts only if it needs fewer sequences than all of these.
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if c > 0), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    if not len(lengths):
        return Plan(*np.zeros((5, 0), np.int64), 0)
    steps = -(-lengths // GRID) if capacity % GRID == 0 and capacity > 64 * GRID else lengths
    grid = GRID if steps is not lengths else 1
    sizes, of_class = np.unique(steps, return_inverse=True)
    solved = fractional_patterns(sizes, np.bincount(of_class, counts), capacity // grid, rounds=rounds)
    bound = float(lengths @ counts) / capacity
    # classes are as long as their longest, so the ids alone may need fewer sequences than the program, never more
    if not bound <= solved.value * (1 + 1e-9):
        raise AssertionError(f"{solved.value} sequences cannot hold what fills {bound}")
    tried = []
    for short in (0, 16, 8, 4):  # lengths below such a part of a sequence are left to best fit, to fill what is open
        patterns = np.where(sizes * grid * short < capacity, 0, solved.patterns) if short else solved.patterns
        tried += [(patterns, solved.uses * x) for x in (1.0, bound / solved.value, 0.8, 0.5, 0.25)]
    tried.append((solved.patterns[:0], solved.uses[:0]))
    entries, sequences = min((_place_all(lengths, counts, capacity, of_class, *t) for t in tried), key=lambda found: found[1])
    return Plan(*np.array(sorted(entries), np.int64).T, sequences)


def _placer(plan: Plan, capacity: int):
    def run(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, offset = -1 - rank, np.zeros(len(rank), np.int64)  # a full piece is a sequence of its own
        some = length < capacity
        sequence[some], offset[some] = plan.place(length[some], rank[some])
        return pa.StructArray.from_arrays([pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], ["sequence_id", "offset"])

    return F.arrow_udf(run, "sequence_id long, offset long")


def pack(
    documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = WORD_BPE, keep_ids: bool = True
) -> DataFrame:
    """A row for each piece of a document: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    A missing or empty text is the end id alone; doc_id is only passed on, so missing and repeated ones are
    kept. Only documents of more than `capacity` ids are cut. No rows give no rows; other columns are ignored.
    """
    pieces_ = tokenised_pieces(documents, capacity, vocabulary, keep_ids)
    counts = pieces_.groupBy("_block", "length").agg(F.count("*").alias("_n"))
    histogram = {r.length: r.n for r in pieces_.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing({n: c for n, c in histogram.items() if n < capacity}, capacity)
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # rows with their ids are long: they are not sorted to meet the few offsets, and only lengths and ranks go to Python
    ranked = pieces_.join(offsets.hint("shuffle_hash"), ["_block", "length"])
    placed = _placer(plan, capacity)("length", F.col("_before") + F.col("_nth"))
    names = [c for c in pieces_.columns if not c.startswith("_")]
    return ranked.select(*names, placed.alias("_placed")).select(*names, "_placed.sequence_id", "_placed.offset")
