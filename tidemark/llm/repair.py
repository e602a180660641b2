"""Repair of conversations whose turns don't follow one another as they should, by lightest derivations.

A repaired conversation is an optional system turn and pairs of user and assistant turns, or nothing. An item says how many rows are read
and which turn came last; a deduction takes an item and an edit of the next row (or an inserted turn) to another item. Weights are
(cost, audit), where the audit spells the edits; a deduction adds to the cost and appends to the audit, so no conclusion is lighter than what it
follows from, and items can be taken from an agenda in order of weight, each final when it is taken (Knuth). The search ends with the goal item.

Rows are read in spans. The items at the end of a span are the axioms of the next, and what their audits begin with in common is
set aside, so a long conversation costs no more per row than a short one. Audits of equal cost that have read the same rows differ before either
ends, so appending keeps their order.

A row is one byte here: which role it has and what is wrong with it. Texts are read apart, once, as a sorted stream that
carries each conversation's audit in front of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import reach

#: Rows read by one search, and rows in one chunk of a conversation.
SPAN, CHUNK = 64, 1 << 20
#: What a row is: 4 * fault + role.
ROLES, FAULTS = "sua?", ("", "blank", "duplicate", "truncated")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
KEEP, REROLE, DELETE, INSERT, UNDELETED = 0, 2, 3, 2, 1
#: The turn that came last: none, system, user, assistant; what may follow it. A conversation may end after none and after an assistant's.
NONE, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {NONE: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
COMPLETE = (NONE, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
Weight = tuple[int, str]
_SPACE = " \t\n\x0b\x0c\r"


def _edits(symbol: int, last: int) -> Iterator[tuple[int, str, int]]:
    """(cost, initial, turn that comes last) of the edits of a row."""
    role, fault = ROLES[symbol % 4], symbol // 4
    yield DELETE, "D", last
    if fault not in (BLANK, DUPLICATE):
        more = UNDELETED if fault == TRUNCATED else 0
        if role in FOLLOWS[last]:
            yield KEEP + more, "K", FOLLOWS[last][role]
        for turn, after in FOLLOWS[last].items():
            if turn in NAMES:
                yield REROLE + more, "R", after


_EDITS = {(s, q): tuple(_edits(s, q)) for s in range(16) for q in FOLLOWS}
_INSERTS = {q: tuple(after for turn, after in FOLLOWS[q].items() if turn in NAMES) for q in FOLLOWS}


def derive(rows: bytes, axioms: dict[int, Weight], goals: tuple[int, ...], first_only: bool) -> dict[int, Weight]:
    """The lightest weight of each goal (the turn that comes last, with all rows read); with `first_only` only of the lightest one."""
    agenda = [(cost, audit, 0, last) for last, (cost, audit) in axioms.items()]
    agenda.sort()
    final, found, n = set(), {}, len(rows)
    while agenda:
        cost, audit, at, last = heappop(agenda)
        if (at, last) in final:
            continue
        final.add((at, last))
        if at == n:
            if last in goals:
                found[last] = cost, audit
                if first_only or len(found) == len(goals):
                    break
        else:
            for weight, edit, after in _EDITS[rows[at], last]:
                if (at + 1, after) not in final:
                    heappush(agenda, (cost + weight, audit + edit, at + 1, after))
        for after in _INSERTS[last]:
            if (at, after) not in final:
                heappush(agenda, (cost + INSERT, audit + "I", at, after))
    return found


def repair(rows: bytes) -> Weight:
    """Cost and audit of the lightest repair of a conversation's rows."""
    items, before, done = {NONE: (0, "")}, [], 0
    while len(rows) - done > SPAN:
        items = derive(rows[done : done + SPAN], items, tuple(FOLLOWS), False)
        done += SPAN
        common = commonprefix([audit for _, audit in items.values()])
        before.append(common)
        items = {last: (cost, audit[len(common) :]) for last, (cost, audit) in items.items()}
    ((cost, audit),) = derive(rows[done:], items, COMPLETE, True).values()
    return cost, "".join([*before, audit])


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by a checksum of their place; 0 copies of a row that is gone, 2 of a repeated one.

    Missing values count as one space in the checksum, as role and as text; a missing turn stays missing.
    """
    ids = [conversations[c].cast("long").alias(c) for c in ("conv_id", "turn")]
    rows = conversations.select(*ids, *[F.coalesce(conversations[c].cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("fate", F.crc32(place.cast("binary")) % 20)
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def _identity() -> Column:
    """A hash of role and text, which also orders rows of one turn."""
    return F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))


_CHUNK = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int32()), ("rows", pa.binary())]
    + [(c, pa.int64()) for c in ("low", "high", "turns")]
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by conversation and turn, their bytes, in chunks: first and last turn, and how many different ones, of each."""
    part, nth = TaskContext.get().partitionId(), 0
    conv, rows, low, high, turns = None, None, None, None, 0
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "first", "rest", "many"))
        for c, turn, first, rest, many in zip(*columns, strict=True):
            if rows is None or c != conv or len(rows) > CHUNK:
                if rows is not None:
                    out.append((conv, part, nth, bytes(rows), low, high, turns))
                    nth += 1
                conv, rows, low, high, turns = c, bytearray(), None, None, 0
            if many:
                rows.append(first)
                rows += bytes([rest]) * (many - 1)
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
        yield _table(out, _CHUNK)
    if rows is not None:
        yield _table([(conv, part, nth, bytes(rows), low, high, turns)], _CHUNK)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPORT_ARROW = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _REPORT.split(", ")])
_LEGAL = [(ROLES.index(a), ROLES.index(b)) for a, b in ("su", "ua", "au")]
_ROLE_OF = bytes(s % 4 for s in range(256))


def report(rows: bytes, known: dict[bytes, Weight] | None = None) -> tuple:
    """Counts of blank, duplicate and truncated rows and of adjacent roles that don't fit, then the cost and audit of the repair."""
    faults = [sum(rows.count(4 * fault + role) for role in range(4)) for fault in (BLANK, DUPLICATE, TRUNCATED)]
    roles = rows.translate(_ROLE_OF)
    legal = sum(roles.count(bytes(pair)) for pair in _LEGAL)  # none of them overlaps itself
    weight = known.get(rows) if known is not None else None
    if weight is None:
        weight = repair(rows)
        if known is not None and len(rows) <= 32 and len(known) < 100_000:
            known[rows] = weight
    return *faults, max(len(rows) - 1, 0) - legal, *weight


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chunks sorted by conversation, a row for each conversation."""
    known: dict[bytes, Weight] = {}
    conv, rows, low, high, turns = None, None, None, None, 0

    def solved() -> tuple:
        gaps = min(high - low + 1 - turns, 2**63 - 1) if turns else 0
        return conv, gaps, *report(bytes(rows), known)

    for batch in batches:
        out = []
        for c, more, first, last, some in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "rows", "low", "high", "turns")), strict=True):
            if rows is None or c != conv:
                if rows is not None:
                    out.append(solved())
                conv, rows, low, high, turns = c, bytearray(), None, None, 0
            rows += more
            if some:
                turns += some - (first == high)
                low, high = first if low is None else low, last
        yield _table(out, _REPORT_ARROW)
    if rows is not None:
        yield _table([solved()], _REPORT_ARROW)


def reports(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id: the faults of its damaged rows, and cost and audit of their repair."""
    rows = damaged(conversations).withColumn("bare", F.rtrim("text", F.lit(_SPACE)))
    kept = F.col("copies") > 0
    role = F.coalesce(*[F.when(F.substring("role", 1, 1) == r, i) for i, r in enumerate(ROLES[:3])], F.lit(3))
    fault = F.when(F.col("bare") == "", BLANK).when(F.substring("bare", -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    rows = rows.select("conv_id", F.when(kept, F.col("turn")).alias("turn"), F.when(kept, _identity()).alias("id"), (4 * fault + role).alias("as_first"), "copies")
    # equal rows of one turn become one before anything is shuffled
    alike = rows.groupBy("conv_id", "turn", "id").agg(F.min("as_first").alias("as_first"), F.sum("copies").alias("many"))
    earlier = Window.partitionBy("conv_id", "id").orderBy("turn")
    again = (F.row_number().over(earlier) > 1) & (F.col("many") > 0)
    as_copy = F.when(F.expr(f"as_first div 4 = {BLANK}"), F.col("as_first")).otherwise(4 * DUPLICATE + F.col("as_first") % 4)
    rows = alike.withColumn("again", again).select(
        "conv_id", "turn", "id", F.when(F.col("again"), as_copy).otherwise(F.col("as_first")).alias("first"), as_copy.alias("rest"), "many"
    )
    order = ["conv_id", "turn", "id"]
    chunks = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = chunks.mapInArrow(_chunks, "conv_id long, part int, nth int, rows binary, low long, high long, turns long")
    return chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth").mapInArrow(_solved, _REPORT)


class Rewriter:
    """Applies the edits of an audit to rows that arrive in order, and hashes what comes out."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last, self.count = audit, 0, NONE, 0
        self.digest = hashlib.sha256()

    def _put(self, role: bytes, text: bytes, turn: str) -> None:
        if self.count:
            self.digest.update(b"\n")
        self.digest.update(role + b":")
        self.digest.update(text)
        self.count, self.last = self.count + 1, FOLLOWS[self.last][turn]

    def _due(self) -> str:
        """The turn that an inserted or relabelled row becomes."""
        return next(turn for turn in FOLLOWS[self.last] if turn in NAMES)

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put(NAMES[self._due()].encode(), b"", self._due())
            self.at += 1

    def row(self, role: bytes, text: bytes) -> None:
        self._insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._put(role, text, chr(role[0]))
        elif edit == "R":
            self._put(NAMES[self._due()].encode(), text, self._due())

    def end(self) -> str:
        self._insert()
        return self.digest.hexdigest()


_COUNTS = [c.split()[0] for c in _REPORT.split(", ")]
_RESULT_ARROW = pa.schema([*_REPORT_ARROW, ("repaired_sha256", pa.string())])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's report, then its rows in order: the report with the hash of the repaired text. One row is held at a time."""
    head, rewriter = None, None
    for batch in batches:
        out = []
        heads = pa.Table.from_batches([batch]).select(_COUNTS)
        role, text = batch.column("role"), batch.column("text")
        for i, copies in enumerate(batch.column("copies").to_pylist()):
            if copies is None:
                if head is not None:
                    out.append((*head, rewriter.end()))
                head = [heads.column(c)[i].as_py() for c in _COUNTS]
                rewriter = Rewriter(head[-1])
            else:
                for _ in range(copies):
                    rewriter.row(role[i].as_py(), text[i].as_py())
        yield _table(out, _RESULT_ARROW)
    if head is not None:
        yield _table([(*head, rewriter.end())], _RESULT_ARROW)


def repaired(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id (a missing one is one more): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged first (`damaged`), then taken by turn, missing first; different rows of one turn go by a hash of role and
    text, equal ones stand together. A row is blank, or has the role and text of an earlier one, or ends without a full stop: its first fault
    counts. A conversation that lost all its rows has zeros, an empty audit and the hash of nothing; an empty table gives no rows. Roles other
    than system, user and assistant can be kept if they begin alike. Gaps beyond a long are its largest value. Other columns are ignored. The longest conversation must fit in a task with
    a byte or two a row, as its audit is one value; texts are streamed.
    """
    reach(conversations.sparkSession)
    rows = damaged(conversations).where("copies > 0").withColumn("id", _identity())
    rows = rows.select("conv_id", "turn", "id", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "copies")
    both = reports(conversations).unionByName(rows, allowMissingColumns=True)
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("copies").isNotNull(), "turn", "id")
    return stream.mapInArrow(_rewritten, _REPORT + ", repaired_sha256 string")
