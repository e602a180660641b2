"""The exchange behind both removers of repeated passages.

A window is a number of units (bytes or words) in a row of one document. The question for every window is whether its units also
begin elsewhere; shards answer it, each for all windows that could be equal to each other:

1. Documents are dealt into blocks by a hash. In each window the gram of the smallest hash is its anchor, so equal windows have equal anchors, at the same
   place. A window that reaches at least `Kind.reach` units back from its anchor holds these units too, any other as many behind it: either stretch, the window's
   key, is much longer than the anchor, so few are equal by chance, however much text there is. Each block sends the hashes of its keys to the shards that
   own their anchors, and hears which of them occur often enough. Windows whose key does not cannot be repeated; nothing else is left out.
2. Windows in a row with one anchor are sent to its shard as one passage, equal passages of a block once.
   The windows of a key that occurs more than `HOT` times are sent one by one, to the shards that own their own hashes, so no shard gets
   the surroundings of a very common passage.
3. Each shard takes equal passages together, indexes those that share a key with a different one (a suffix order or an FM-index), and answers with the
   runs of windows that are repeated. Blocks mark the units.

Copies of whole texts are found before, by two 64-bit hashes, and need no search: only one of each takes part, in the name of all.

Blocks and shards are as many as the bytes of all texts ask for, so that each fits in a task; a task works on one after another. What a block sends is cut
into a row for each shard, and what a shard answers into a row for each block, from arrays in that order: work per block must not grow with the number of shards. Documents are
shuffled once; the same exchange feeds all three steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import PIECE_BYTES, SPACED_WORDS, SPREAD, STEP, U64, Words, buffers, byte_table, leftmost, mix, partitions, pieces, reach, text_pieces

#: Occurrences of a key from which its windows travel one by one.
HOT = 2048
#: Units whose windows are looked at at once. Only a text of more is cut, at multiples of it from its own begin, so passages do not depend on the order
#: in which a block's texts arrive, which may be another one each time.
SEGMENT = 1 << 17
#: Symbols that a shard indexes at once; passages of one anchor, or single windows of one hash, stay together.
SHARD_SYMBOLS = 1 << 18
#: Bytes of text in a block, and the least that blocks send to a shard on average.
BLOCK_BYTES, SENT_BYTES = 8 << 20, 64
#: Bits of a key's hash that travel. Equal hashes of different keys cost time, not results.
_HASH = U64(40)
#: Bits of the number of a row in its block.
_ROW = U64(64) - _HASH
#: Bytes in a chunk of binary values, whose offsets have 32 bits.
_CHUNK = 1 << 30
#: Stands for a missing doc_id, which is smaller than none.
NO_ID = 2**63 - 1


def _inverse(odd: np.uint64) -> np.uint64:
    return U64(pow(int(odd), -1, 1 << 64))


@dataclass(frozen=True)
class Kind:
    """What is compared: bytes, or words between white space; windows of `size` units with anchors of `gram`.

    With `across`, only windows of other documents with a smaller doc_id count, else all others.
    """

    words: bool
    size: int
    gram: int
    across: bool

    @property
    def reach(self) -> int:
        """Units in front of its anchor from which a window's key lies there."""
        return (self.size - self.gram) // 2

    def keys(self, sums: Sums, anchor: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Hashes of the stretches that windows of these anchors hold: up to the anchor's end if they reach `back` far enough, else from its begin on."""
        return sums.of(np.where(back, anchor - self.reach, anchor), anchor + np.where(back, self.gram, self.size - self.reach + 1))

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words | None]:
        """Symbols of some texts, and where each text's symbols begin."""
        if not self.words:
            return data, offsets, None
        words = Words(data, offsets, SPACED_WORDS, lower=False)
        return words.hash, words.at, words


_POWERS: dict[int, np.ndarray] = {}


def _powers(odd: np.uint64, count: int) -> np.ndarray:
    """The first powers of a number, from 1."""
    known = _POWERS.get(int(odd))
    if known is None or len(known) < count:
        known = _POWERS[int(odd)] = np.cumprod(np.concatenate([[U64(1)], np.full(max(count, 1 << 16) - 1, odd, U64)]))
    return known[:count]


class Sums:
    """Hashes of any stretch of some symbols, from sums of their weighted values up to each place."""

    def __init__(self, values: np.ndarray, odd: np.uint64):
        n = len(values)
        self.before = np.zeros(n + 1, U64)
        np.cumsum(values * _powers(odd, n), out=self.before[1:])
        self.back = _powers(_inverse(odd), n + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.before[stop] - self.before[start]) * self.back[start] + (stop - start).astype(U64))

    def all_of(self, size: int) -> np.ndarray:
        """Of every stretch of one size."""
        n = len(self.before) - size
        return mix((self.before[size:] - self.before[:n]) * self.back[:n] + U64(size))


def _values(symbols: np.ndarray) -> np.ndarray:
    return byte_table(3)[symbols] if symbols.dtype == np.uint8 else symbols


@dataclass
class Runs:
    """Windows in a row that have one anchor and one key: first window, windows, anchor (its first unit), hashes of anchor and key."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    owner: np.ndarray
    key: np.ndarray


def _segments(symbols: np.ndarray, at: np.ndarray, kind: Kind) -> Iterator[tuple[int, np.ndarray, Sums, Runs]]:
    """(first unit of a segment, its values, their sums, runs of the windows that begin in it): all counted from the first unit."""
    last = len(symbols) - kind.size + 1
    for first in range(0, max(last, 0), SEGMENT):
        count = min(SEGMENT, last - first)
        values = _values(symbols[first : first + count + kind.size - 1])
        sums = Sums(values, SPREAD)
        hashes = sums.all_of(kind.gram)
        anchor = leftmost(hashes, kind.size - kind.gram + 1)
        # no window goes on into the next text
        starts = np.minimum(np.maximum(at - first, 0), count)
        ends = np.maximum(np.minimum(at[1:] - first - kind.size + 1, count), starts[:-1])
        side = anchor << 1 | (anchor - np.arange(count) < kind.reach)
        new = np.ones(count, bool)
        new[1:] = side[1:] != side[:-1]
        new[starts[:-1][starts[:-1] < count]] = True
        new[ends[ends < count]] = True
        start = np.flatnonzero(new)
        text = np.searchsorted(starts, start, "right") - 1
        whole = (text < len(ends)) & (start < ends[np.minimum(text, len(ends) - 1)])
        windows = np.diff(np.append(start, count))[whole]
        start = start[whole]
        of_run = anchor[start]
        key = kind.keys(sums, of_run, of_run - start >= kind.reach)
        yield first, values, sums, Runs(start, windows, of_run, hashes[of_run] >> (U64(64) - _HASH), key >> (U64(64) - _HASH))


@dataclass
class Passages:
    """Runs of windows in a block: first unit (over the block), windows, shard, two content hashes, document (row of the block), and
    whether the run is one window of a hot anchor."""

    first: np.ndarray
    windows: np.ndarray
    shard: np.ndarray
    one: np.ndarray
    two: np.ndarray
    row: np.ndarray
    single: np.ndarray

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """For each passage the number of its content among the different ones of its shard, and the order by (shard, number).

        Numbers follow from the contents alone, so they are the same whenever a block is read again.
        """
        order = np.lexsort((self.two, self.one, self.shard))
        s, a, b = self.shard[order], self.one[order], self.two[order]
        new = np.ones(len(order), bool)
        new[1:] = (s[1:] != s[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        total = np.cumsum(new) - 1
        first = np.searchsorted(s, s)
        number = np.empty(len(order), np.int64)
        number[order] = total - total[first] if len(order) else total
        return number, order


class Block:
    """The texts of a block, as symbols in a row.

    `heard` tells which of them are copies: `copied` texts have a copy that counts, those that take `part` stand for all their copies.
    """

    def __init__(self, block: pa.Table, heard: pa.Table, kind: Kind):
        self.kind = kind
        self.parts = []  # (first row, symbols, begins, words, data, offsets)
        self.start = [0]
        self.ids = block.column("_id").combine_chunks().fill_null(NO_ID).to_numpy()
        self.copied, self.part, self.weight = self._copies(block, heard)
        for lo, _, data, offsets in text_pieces(block.column("_text"), SEGMENT):
            symbols, at, words = kind.units(data, offsets)
            self.parts.append((lo, symbols, at, words, data, offsets))
            self.start.append(self.start[-1] + len(symbols))

    def _copies(self, block: pa.Table, heard: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        told = heard.filter(pa.compute.equal(heard.column("_step"), 2)) if heard.num_rows else heard
        n = block.num_rows
        copied, part, weight = np.zeros(n, bool), np.ones(n, bool), np.ones(n, np.int64)
        classes = {(x, y): (z, s) for x, y, z, s in zip(*(told.column(c).to_pylist() for c in ("x", "y", "z", "_shard")), strict=True)}
        seen = set()
        number = block.column("_block")[0].as_py() if n else 0
        if classes:
            for row, key in enumerate(zip(block.column("_h1").to_pylist(), block.column("_h2").to_pylist(), strict=True)):
                if key in classes:
                    least, owner = classes[key]
                    if self.kind.across:
                        copied[row] = least < self.ids[row]
                        part[row] = not copied[row]
                    else:
                        copied[row], weight[row] = True, 2
                        part[row] = owner == number and key not in seen
                        seen.add(key)
        return copied, part, weight

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hashes of the block's keys, the rows they are in and the hashes of their anchors."""
        keys, rows, owners = [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, U64)]
        for lo, symbols, at, *_ in self.parts:
            for first, _, _, runs in _segments(symbols, at, self.kind):
                row = lo + np.searchsorted(at, first + runs.start, "right") - 1
                some = self.part[row]
                keys.append(runs.key[some])
                rows.append(row[some])
                owners.append(runs.owner[some])
        return np.concatenate(keys), np.concatenate(rows), np.concatenate(owners)

    def passages(self, alive: np.ndarray, hot: np.ndarray, shards: int) -> Passages:
        """The windows whose keys are among `alive` (sorted), together if they are in a row with one anchor; those of `hot` keys one by one."""
        found: list[list[np.ndarray]] = [[] for _ in range(7)]
        for (lo, symbols, at, *_), base in zip(self.parts, self.start, strict=False):
            for first, values, sums, runs in _segments(symbols, at, self.kind):
                if not len(runs.key) or not len(alive):
                    continue
                place = np.minimum(np.searchsorted(alive, runs.key), len(alive) - 1)
                held = np.flatnonzero(alive[place] == runs.key)
                if not len(held):
                    continue
                start, count, anchor, owner = runs.start[held], runs.count[held], runs.anchor[held], runs.owner[held]
                single = hot[place[held]]
                new = np.ones(len(held), bool)
                new[1:] = single[1:] | single[:-1] | (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + count[:-1])
                begin = np.flatnonzero(new)
                start, single, owner, count = start[begin], single[begin], owner[begin], np.add.reduceat(count, begin)
                times = np.where(single, count, 1)
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                start, single, owner = np.repeat(start, times) + step, np.repeat(single, times), np.repeat(owner, times)
                count = np.where(single, 1, np.repeat(count, times))
                stop = start + count + self.kind.size - 1
                one, two = sums.of(start, stop), Sums(values, STEP).of(start, stop)
                owner = np.where(single, one >> (U64(64) - _HASH), owner)
                row = lo + np.searchsorted(at, first + start, "right") - 1
                shard = (owner % U64(shards)).astype(np.int64)
                for to, x in zip(found, (base + first + start, count, shard, one, two, row, single), strict=True):
                    to.append(x[self.part[row]])
        kinds = (np.int64, np.int64, np.int64, U64, U64, np.int64, bool)
        return Passages(*(np.concatenate([np.zeros(0, k), *f]) for f, k in zip(found, kinds, strict=True)))

    def symbols(self, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The symbols of some stretches, in a row."""
        whole = self.parts[0][1] if len(self.parts) == 1 else np.concatenate([p[1] for p in self.parts])
        edges = np.append(0, np.cumsum(count))
        out = np.empty(int(edges[-1]), np.uint64 if self.kind.words else np.uint8)
        for lo, hi in pieces(edges, PIECE_BYTES):
            shift = np.repeat(first[lo:hi] - edges[lo:hi], count[lo:hi])
            out[edges[lo] : edges[hi]] = whole[np.arange(edges[lo], edges[hi]) + shift]
        return out


def _flat(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """The items of all values of a binary column in a row, and where each value begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.cast(pa.large_binary()).combine_chunks()
    data, at = buffers(column)
    size = np.dtype(kind).itemsize
    return (data if size == 1 else np.frombuffer(data.tobytes(), kind)), at // size


def _binary(items: np.ndarray, edges: np.ndarray) -> pa.ChunkedArray:
    """Binary values of the items between edges."""
    data, at = np.ascontiguousarray(items).view(np.uint8), edges * items.dtype.itemsize
    chunks = []
    for lo, hi in pieces(at, _CHUNK):
        offsets = (at[lo : hi + 1] - at[lo]).astype(np.int32)
        chunks.append(pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(data[at[lo] : at[hi]])]))
    return pa.chunked_array(chunks, pa.binary())


def _hash_columns(hashes: np.ndarray, edges: np.ndarray) -> tuple[pa.ChunkedArray, pa.ChunkedArray]:
    """Hashes of `_HASH` bits as the upper four bytes and the last one."""
    return _binary((hashes >> U64(8)).astype("<u4"), edges), _binary((hashes & U64(255)).astype(np.uint8), edges)


def _hashes(upper, last) -> tuple[np.ndarray, np.ndarray]:
    items, at = _flat(upper, "<u4")
    return (items.astype(U64) << U64(8)) | _flat(last, np.uint8)[0], at


def _first_of(sorted_: np.ndarray) -> np.ndarray:
    """Where the stretches of equal values begin, and the end."""
    return np.append(np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])), len(sorted_)) if len(sorted_) else np.zeros(1, np.int64)


_SENT = "_shard int, _block int, a binary, b binary, c binary, d binary, e binary"
_SENT_ARROW = pa.schema([("_shard", pa.int32()), ("_block", pa.int32()), *((c, pa.binary()) for c in "abcde")])
_HEARD = "_block int, _shard int, _step int, a binary, b binary, c binary, d binary, x long, y long, z long"
_HEARD_ARROW = pa.schema(
    [*((c, pa.int32()) for c in ("_block", "_shard", "_step")), *((c, pa.binary()) for c in "abcd"), *((c, pa.int64()) for c in "xyz")]
)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _table(schema: pa.Schema, count: int, **columns) -> pa.Table:
    """So many rows; whole numbers alone go into all of them, columns that aren't given are missing."""
    out = []
    for field in schema:
        x = columns.get(field.name)
        if x is None:
            x = pa.nulls(count, field.type)
        elif not isinstance(x, pa.ChunkedArray):
            x = pa.array(np.full(count, x) if np.isscalar(x) else x, field.type)
        out.append(x)
    return pa.Table.from_arrays(out, schema=schema)


def _send_anchors(kind: Kind, shards: int):
    def run(block: pa.Table, heard: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _rows(_SENT_ARROW, [])
        keys, rows, owners = Block(block, heard, kind).anchors()
        shard = (owners % U64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
        order = np.argsort(shard, kind="stable")
        # hash and row in one value, which sorts faster than two
        both = keys << _ROW
        both |= rows.astype(U64)
        del keys, rows, owners
        both, shard = both[order], shard[order]
        del order
        edges = _first_of(shard)
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            both[lo:hi].sort()
        h = both >> _ROW
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        new[edges[:-1]] = True
        begin = np.flatnonzero(new)
        many = np.diff(np.append(begin, len(h)))
        two = many > 1  # of different documents, where those count
        if kind.across and len(begin):
            two = both[begin] != both[begin + many - 1]
        to = shard[begin]
        edges = _first_of(to)
        a, c = _hash_columns(h[begin], edges)
        b = _binary((many << 1 | two).astype("<u4"), edges)
        return _table(_SENT_ARROW, len(edges) - 1, _shard=to[edges[:-1]].astype(np.int32), _block=block.column("_block")[0].as_py(), a=a, b=b, c=c)

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """Which keys occur at least twice (in different documents, or anywhere), and which of them often."""
    own, at = _hashes(table.column("a"), table.column("c"))
    many = _flat(table.column("b"), "<u4")[0].astype(np.int64)
    different, back = np.unique(own, return_inverse=True)
    alive = np.flatnonzero((np.bincount(back, 1 + (many & 1), len(different)) >= 2)[back])
    hot = (np.bincount(back, many >> 1, len(different)) > HOT)[back]
    edges = np.searchsorted(alive, at)
    some = np.flatnonzero(np.diff(edges))
    edges = np.append(edges[some], len(alive))
    a, c = _hash_columns(own[alive], edges)
    blocks = table.column("_block").to_numpy()[some]
    return _table(_HEARD_ARROW, len(some), _block=blocks, _shard=table.column("_shard")[0].as_py(), _step=0, a=a, b=_binary(hot[alive].astype(np.uint8), edges), c=c)


def _told(heard: pa.Table, step: int) -> pa.Table:
    return heard.filter(pa.compute.equal(heard.column("_step"), step))


def _alive(heard: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    told = _told(heard, 0)
    hashes, _ = _hashes(told.column("a"), told.column("c"))
    hot = _flat(told.column("b"), np.uint8)[0].astype(bool)
    order = np.argsort(hashes)
    return hashes[order], hot[order]


def _send_passages(kind: Kind, shards: int):
    def run(block: pa.Table, heard: pa.Table) -> pa.Table:
        if not block.num_rows or not heard.num_rows:
            return _rows(_SENT_ARROW, [])
        texts = Block(block, heard, kind)
        found = texts.passages(*_alive(heard), shards)
        if not len(found.first):
            return _rows(_SENT_ARROW, [])
        number, order = found.numbered()
        ids, weight = texts.ids[found.row[order]], texts.weight[found.row[order]]
        first = _first_of((found.shard << 32 | number)[order])[:-1]
        many = np.add.reduceat(weight, first)
        pick = order[first]
        size, to = found.windows[pick], found.shard[pick]
        length = size + kind.size - 1
        edges = _first_of(to)
        columns = {
            "a": _binary(size.astype("<u4"), edges),
            "b": _binary(texts.symbols(found.first[pick], length), np.append(0, np.cumsum(length))[edges]),
            "c": _binary((many << 1 | found.single[pick]).astype("<u4"), edges),
        }
        if kind.across:
            columns |= {"d": _binary(np.minimum.reduceat(ids, first), edges), "e": _binary(np.maximum.reduceat(ids, first), edges)}
        return _table(_SENT_ARROW, len(edges) - 1, _shard=to[edges[:-1]].astype(np.int32), _block=block.column("_block")[0].as_py(), **columns)

    return run


#: Given symbols (each passage ended by 0, symbols from 1), begins and windows of the passages, how often each occurs and its smallest id: for each window (in order of
#: the passages) whether it is repeated, or the smallest id of its equals.
Judge = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _answer_passages(kind: Kind, judge: Judge):
    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(_HEARD_ARROW, [])
        windows, at = _flat(table.column("a"), "<u4")
        windows = windows.astype(np.int64)
        source = np.repeat(np.arange(table.num_rows), np.diff(at))
        number = np.arange(len(windows)) - at[source]
        symbols = _flat(table.column("b"), np.uint64 if kind.words else np.uint8)[0]
        many = _flat(table.column("c"), "<u4")[0].astype(np.int64)
        many, single = many >> 1, (many & 1).astype(bool)
        if kind.across:
            least, most = (_flat(table.column(c), np.int64)[0] for c in "de")
        else:
            least = most = np.zeros(len(windows), np.int64)
        blocks, shard = table.column("_block").to_numpy(), table.column("_shard")[0].as_py()
        del table
        length = windows + kind.size - 1
        begin = np.cumsum(length) - length
        found = [np.zeros((5, 0), np.int64)]
        for group in _groups(symbols, begin, length, single, kind):
            answers = _judged(kind, judge, symbols, begin[group], length[group], windows[group], many[group], least[group], single[group])
            own = np.repeat(group, windows[group])
            step = np.arange(len(own)) - np.repeat(np.cumsum(windows[group]) - windows[group], windows[group])
            flag = answers < most[own] if kind.across else answers > 0
            at = np.flatnonzero(flag)
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (own[at][1:] != own[at][:-1]) | (at[1:] != at[:-1] + 1) | (answers[at][1:] != answers[at][:-1])
            first = np.flatnonzero(new)
            of = own[at[first]]
            found.append(np.stack([source[of], number[of], step[at[first]], np.diff(np.append(first, len(at))), answers[at[first]]]))
        of, a, b, c, d = np.concatenate(found, axis=1)
        order = np.argsort(of, kind="stable")
        edges = _first_of(of[order])
        columns = {name: _binary(x[order].astype("<u4"), edges) for name, x in zip("abc", (a, b, c), strict=True)}
        if kind.across:
            columns["d"] = _binary(d[order], edges)
        return _table(_HEARD_ARROW, len(edges) - 1, _block=blocks[of[order][edges[:-1]]], _shard=shard, _step=1, **columns)

    return run


def _anchors_of(symbols: np.ndarray, begin: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each passage's anchor and its place in the passage, which are those of its first window, as the block found them."""
    out, places = np.empty(len(begin), U64), np.empty(len(begin), np.int64)
    for lo in range(0, len(begin), 1 << 14):
        some = slice(lo, lo + (1 << 14))
        place = begin[some, None] + np.arange(kind.size)
        values = _values(symbols[place.ravel()]).reshape(place.shape)
        n = kind.size - kind.gram + 1
        powers = _powers(SPREAD, kind.gram)
        hashes = np.zeros((len(values), n), U64)
        for j in range(kind.gram):
            hashes += values[:, j : j + n] * powers[j]
        hashes = mix(hashes + U64(kind.gram)) >> (U64(64) - _HASH)
        places[some] = hashes.argmin(axis=1)
        out[some] = hashes.min(axis=1)
    return out, places


def _groups(symbols: np.ndarray, begin: np.ndarray, length: np.ndarray, single: np.ndarray, kind: Kind) -> Iterator[np.ndarray]:
    """Passages in parts of at most about `SHARD_SYMBOLS`, so that windows that may be equal are in one part.

    Those of one anchor stay together; single windows of hot anchors only with their equals.
    """
    total = int(length.sum()) + len(length)
    if total <= SHARD_SYMBOLS:
        yield np.arange(len(begin))
        return
    key, _ = _anchors_of(symbols, begin, kind)
    for lo in range(0, len(begin), 1 << 14):
        own = np.flatnonzero(single[lo : lo + (1 << 14)]) + lo
        values = _values(symbols[(begin[own, None] + np.arange(kind.size)).ravel()]).reshape(-1, kind.size)
        key[own] = (values * _powers(STEP, kind.size)).sum(axis=1, dtype=U64)
    key = mix(key)
    order = np.argsort(key, kind="stable")
    sorted_, cost = key[order], np.cumsum(length[order] + 1)
    lo = 0
    while lo < len(order):
        hi = int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + SHARD_SYMBOLS, "right"))
        hi = int(np.searchsorted(sorted_, sorted_[max(hi - 1, lo)], "left")) if hi < len(order) else hi
        if hi <= lo:
            hi = int(np.searchsorted(sorted_, sorted_[lo], "right"))
        yield order[lo:hi]
        lo = hi


def _shared(kind: Kind, text: np.ndarray, begin: np.ndarray, windows: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of different passages the windows (from, up to) whose key is in another one too; the other windows equal none but themselves.

    Windows of a passage have one anchor and are at different distances from it, so no two of them are equal. Single ones are a passage each.
    """
    several = np.flatnonzero(~single)
    lo, hi = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    if not len(several):
        return lo, hi
    begin, windows = begin[several], windows[several]
    place = _anchors_of(text, begin, kind)[1]
    back = np.clip(place - kind.reach + 1, 0, windows)  # windows that reach far back
    sums = Sums(_values(text), SPREAD)
    far, near = np.flatnonzero(back > 0), np.flatnonzero(back < windows)
    keys = np.concatenate([kind.keys(sums, (begin + place)[x], np.full(len(x), side)) for x, side in ((far, True), (near, False))])
    _, key, many = np.unique(keys, return_inverse=True, return_counts=True)
    again = many[key] > 1
    from_, to = back.copy(), back.copy()
    from_[far[again[: len(far)]]] = 0
    some = near[again[len(far) :]]
    to[some] = windows[some]
    lo[several], hi[several] = from_, to
    return lo, hi


def _judged(kind, judge, symbols, begin, length, windows, many, least, single) -> np.ndarray:
    """The answers for some passages; equal ones are one, with their counts added and the smallest of their ids, and those that `_shared` finds are indexed."""
    to = np.cumsum(length) - length
    step = np.arange(length.sum()) - np.repeat(to, length)
    text = symbols[np.repeat(begin, length) + step]
    values = _values(text)
    one, two = Sums(values, SPREAD).of(to, to + length), Sums(values, STEP).of(to, to + length)
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    first = order[new]
    total = np.bincount(group, many, len(first)).astype(np.int64)
    small = np.full(len(first), NO_ID, np.int64)
    np.minimum.at(small, group, least)
    count = windows[first]
    at = np.cumsum(count) - count
    answers = np.repeat(small if kind.across else (total > 1).astype(np.int64), count)
    lo, hi = _shared(kind, text, to[first], count, single[first])
    some = np.flatnonzero(lo < hi)
    if len(some):
        lo, inner = lo[some], (hi - lo)[some]
        size = inner + kind.size - 1
        ends = np.cumsum(size + 1)
        starts = ends - size - 1
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pick = text[np.repeat(to[first[some]] + lo, size) + place]
        if kind.words:
            pick = np.unique(pick, return_inverse=True)[1] + 1
        flat = np.zeros(int(ends[-1]), np.int64)
        flat[np.repeat(starts, size) + place] = pick + (0 if kind.words else 1)
        steps = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner)
        answers[np.repeat(at[some] + lo, inner) + steps] = judge(flat, starts, inner, total[some], small[some])
    steps = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return answers[np.repeat(at[group], windows) + steps]


def covered(kind: Kind, block: pa.Table, heard: pa.Table, shards: int) -> tuple[Block, np.ndarray]:
    """The texts of a block, and for each of its units whether a repeated window covers it."""
    texts = Block(block, heard, kind)
    edges = np.zeros(texts.start[-1] + 1, np.int32)
    for (lo, _, at, *_), base in zip(texts.parts, texts.start, strict=False):
        long = np.flatnonzero(texts.copied[lo : lo + len(at) - 1] & (np.diff(at) >= kind.size))
        np.add.at(edges, base + at[long], 1)
        np.add.at(edges, base + at[long + 1], -1)
    if heard.num_rows:
        found = texts.passages(*_alive(heard), shards)
        number, order = found.numbered()
        code = (found.shard << 32) | number
        code, ids = code[order], texts.ids[found.row[order]]
        first = found.first[order]
        told = _told(heard, 1)
        (which, at), skip, count = _flat(told.column("a"), "<u4"), _flat(told.column("b"), "<u4")[0], _flat(told.column("c"), "<u4")[0]
        which = np.repeat(told.column("_shard").to_numpy().astype(np.int64) << 32, np.diff(at)) | which
        least = _flat(told.column("d"), np.int64)[0]
        for some in range(0, len(which), PIECE_BYTES):
            some = slice(some, some + PIECE_BYTES)
            lo, hi = np.searchsorted(code, which[some]), np.searchsorted(code, which[some], "right")
            times = hi - lo
            at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - lo, times)
            begin, many = first[at] + np.repeat(skip[some].astype(np.int64), times), np.repeat(count[some].astype(np.int64), times)
            if kind.across:
                later = np.repeat(least[some], times) < ids[at]
                begin, many = begin[later], many[later]
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + many + kind.size - 1, -1)
    return texts, np.cumsum(edges[:-1]) > 0


def _copies(base: DataFrame, kind: Kind) -> DataFrame:
    """For each block the texts of it that occur more than once: hashes (x, y), smallest id (z), smallest block (_shard)."""
    least = F.min(F.coalesce("_id", F.lit(NO_ID)))
    held = base.where(F.octet_length("_text") >= kind.size).groupBy("_h1", "_h2", "_block")
    held = held.agg(F.count("*").alias("n"), least.alias("least"))
    groups = held.groupBy("_h1", "_h2").agg(F.sum("n").alias("n"), F.min("least").alias("z"), F.min("_block").alias("_shard"))
    found = held.select("_h1", "_h2", "_block").join(groups.where("n > 1"), ["_h1", "_h2"])
    nothing = (F.lit(None).cast("binary").alias(c) for c in "abcd")
    block = (F.col("_block") + 0).alias("_block")  # a column of its own, as the blocks themselves are met with these rows
    return found.select(block, "_shard", F.lit(2).alias("_step"), *nothing, F.col("_h1").alias("x"), F.col("_h2").alias("y"), "z")


def _shards(documents: DataFrame) -> int:
    """How many blocks, and shards: about `BLOCK_BYTES` each, but not so many that what a block sends to a shard is less than `SENT_BYTES`."""
    total = documents.agg(F.sum(F.octet_length(documents["text"]))).first()[0] or 0
    return max(partitions(documents.sparkSession), min(-(-total // BLOCK_BYTES), math.isqrt(total // SENT_BYTES)))


def exchange(documents: DataFrame, kind: Kind, judge: Judge, finish, schema: str, keep: list[str]) -> DataFrame:
    """Run the three steps. `finish(block, texts, cover)` makes the rows of a block; `keep` are columns that it may read (as `_k0`, ...)."""
    spark = documents.sparkSession
    reach(spark)
    shards = _shards(documents)
    number = F.pmod(F.xxhash64(documents["doc_id"], documents["text"]), F.lit(shards)).cast("int")
    passed = (documents[c].alias(f"_k{i}") for i, c in enumerate(keep))
    text = F.coalesce(documents["text"], F.lit(""))
    base = documents.select(
        number.alias("_block"),
        documents["doc_id"].cast("long").alias("_id"),
        documents["text"].alias("_text"),
        F.xxhash64(text).alias("_h1"),
        F.xxhash64(F.lit(1), text, F.lit(2)).alias("_h2"),
        *passed,
    )
    dealt = base.repartition(min(shards, partitions(spark)), "_block")
    copies = _copies(base, kind)
    anchors = dealt.groupBy("_block").cogroup(copies.groupBy("_block")).applyInArrow(_send_anchors(kind, shards), _SENT)
    alive = anchors.groupBy("_shard").applyInArrow(_answer_anchors, _HEARD).unionByName(copies)
    sent = dealt.groupBy("_block").cogroup(alive.groupBy("_block")).applyInArrow(_send_passages(kind, shards), _SENT)
    judged = sent.groupBy("_shard").applyInArrow(_answer_passages(kind, judge), _HEARD)

    def last(block: pa.Table, heard: pa.Table) -> pa.Table:
        return finish(block, *covered(kind, block, heard, shards)) if block.num_rows else finish(block, None, None)

    return dealt.groupBy("_block").cogroup(alive.unionByName(judged).groupBy("_block")).applyInArrow(last, schema)
