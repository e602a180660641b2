"""Prefix tree of conversations by ROLLUP over positional turn columns.

A conversation is a row of up to `BLOCK` turn columns, and one ROLLUP over them aggregates all its prefixes at once; grouping_id says which
prefix a result row is. A longer conversation goes on in further rows, each keyed by the node that its earlier rows end in. That
key is the exclusive-or of two 64-bit hashes of every (place, turn) before, so all rows of all conversations go through one ROLLUP, however
long the longest is. A turn is the MD5 of its role and text, with the code points of the text behind it.

What a subtree holds is summed by a second ROLLUP over the nodes themselves; nodes of later rows are counted at the conversation that
represents them, in each of its earlier rows.

No step gathers the rows of one conversation: they are numbered by a sort over all rows, cut into spans of `SPAN` places, and running
values are taken span by span. Only the digest of a node reads all conversations that end there in order, as chunks of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import reach, settle

#: Turns in a row, and places (or rows) of a conversation that are handled together.
BLOCK, SPAN = 8, 4096
#: Conversations whose id is a multiple of `FAMILY` lend their first turns, at most `BORROWED`, to the ids after them.
FAMILY, BORROWED = 100, 5
_COLUMNS = [f"c{i}" for i in range(1, BLOCK + 1)]
_NODE = ["depth", "nx", "ny"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id): each turn under the hash of its role and text."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    size = F.lpad(F.hex(F.char_length(text).cast("long")), 8, "0")
    ids = conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn")
    return conversations.select(*ids, F.unhex(F.concat(digest, size)).alias("id")).where("conv_id is not null")


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, id): places from 1, in the order of turn (missing first), then id.

    Rows are sorted over all tasks, numbered within each, and shifted by what the tasks before hold of the same
    conversation, so one that has a third of all rows is numbered by many tasks.
    """
    keys = ["conv_id", "turn", "id", "nth"]
    ranged = rows.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*keys)
    ranged = settle(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    held = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("many"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only a task's first conversation can have begun before it: at most one row for each task
    shift = held.withColumn("shift", F.sum("many").over(earlier)).where("shift is not null").select("conv_id", "part", "shift")
    within = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("turn", "id", "nth"))
    placed = ranged.withColumn("nth", within).join(F.broadcast(shift), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("nth") + F.coalesce("shift", F.lit(0))).cast("long").alias("pos"), "id")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns after the first ones were exchanged for those of the family's first conversation.

    Returns (conv_id, pos, id), and (conv_id, size) of all conversations, also of those left without turns.
    """
    rows = settle(rows.withColumn("own", _own("conv_id")), "numbered")
    first = rows.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= BORROWED))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("first"))
    convs = rows.groupBy("conv_id", "own").agg(F.count("*").alias("n")).withColumn("base", F.expr(f"conv_id - conv_id % {FAMILY}"))
    convs = convs.join(first, "base", "left").withColumn("head", F.expr("slice(coalesce(first.id, array()), 1, own)"))
    size = F.size("head") + F.greatest(F.col("n") - F.col("own"), F.lit(0))
    convs = settle(convs.select("conv_id", "own", "n", "head", size.cast("long").alias("size")), "convs")
    heads = convs.select("conv_id", F.posexplode("head").alias("at", "id")).select("conv_id", (F.col("at") + 1).cast("long").alias("pos"), "id")
    # own turns move up where the family lends fewer than are left out
    moved = convs.where("size(head) < own and n > own")
    moved = moved.select("conv_id", (F.size("head") - F.col("own")).alias("move"), F.explode(F.expr(f"sequence(0, n div {SPAN})")).alias("span"))
    kept = rows.where("pos > own").withColumn("span", F.expr(f"pos div {SPAN}")).join(moved, ["conv_id", "span"], "left")
    kept = kept.select("conv_id", (F.col("pos") + F.coalesce("move", F.lit(0))).alias("pos"), "id")
    return heads.unionByName(kept), convs.select("conv_id", "size")


def _own(conv_id: str) -> Column:
    """How many first turns are exchanged."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % (BORROWED + 1)).cast("int")


def _hashes(pos: Column, turn: Column) -> tuple[Column, Column]:
    return F.xxhash64(pos.cast("long"), turn), F.xxhash64(turn, pos.cast("long"), F.lit("y"))


def running(rows: DataFrame, values: dict[str, Column], combine, backwards: bool = False) -> DataFrame:
    """For each row of (conv_id, blk) the `combine`d values of the rows of its conversation before it (or after it); 0 where there is none.

    Spans are combined first, then rows within each.
    """
    order = F.col("blk").desc() if backwards else F.col("blk").asc()
    rows = rows.withColumn("span", F.expr(f"blk div {SPAN}"))
    spans = rows.groupBy("conv_id", "span").agg(*[combine(c).alias(n) for n, c in values.items()])
    over = F.col("span").desc() if backwards else F.col("span").asc()
    outer = Window.partitionBy("conv_id").orderBy(over).rowsBetween(Window.unboundedPreceding, -1)
    far = spans.select("conv_id", "span", *[combine(n).over(outer).alias(f"_{n}") for n in values])
    far = far.where(" or ".join(f"_{n} is not null" for n in values))
    inner = Window.partitionBy("conv_id", "span").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumns({n: combine(c).over(inner) for n, c in values.items()}).join(far, ["conv_id", "span"], "left")
    both = {n: _both(combine, F.coalesce(n, F.lit(0)), F.coalesce(f"_{n}", F.lit(0))) for n in values}
    return near.withColumns(both).drop("span", *[f"_{n}" for n in values])


def _both(combine, a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if combine is F.bit_xor else a + b


def blocks(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, blk, c1.., k, bx, by, kx, ky): the turns of a conversation `BLOCK` to a row, and the key of the node before each row.

    Every conversation has a first row, if only an empty one.
    """
    x, y = _hashes(F.col("pos"), F.col("id"))
    rows = turns.select("conv_id", F.expr(f"(pos - 1) div {BLOCK}").alias("blk"), "pos", "id", x.alias("x"), y.alias("y"))
    cut = rows.groupBy("conv_id", "blk").agg(
        F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("t"), F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by")
    )
    cut = cut.select("conv_id", "blk", F.col("t.id").alias("t"), "bx", "by")
    none = sizes.where("size = 0").selectExpr("conv_id", "0L blk", "cast(array() as array<binary>) t", "0L bx", "0L by")
    cut = settle(cut.unionByName(none), "cut")
    keyed = running(cut, {"kx": F.col("bx"), "ky": F.col("by")}, F.bit_xor)
    turn = [F.get("t", F.lit(i)).alias(c) for i, c in enumerate(_COLUMNS)]
    return settle(keyed.select("conv_id", "blk", *turn, F.size("t").alias("k"), "bx", "by", "kx", "ky"), "blocks")


def _rolled(rows: DataFrame, sums: str) -> DataFrame:
    """Aggregates of every prefix of the rows, as nodes: their depth and key, and the columns of the prefix."""
    columns = ", ".join(_COLUMNS)
    query = f"""SELECT blk, kx, ky, {columns}, grouping_id() AS g, {sums} FROM {{rows}} GROUP BY blk, kx, ky, ROLLUP({columns})"""
    found = rows.sparkSession.sql(query, rows=rows).withColumn("level", F.expr(f"cast({BLOCK} - round(log2(g + 1)) as int)"))
    last = F.coalesce(*[F.col(c) for c in reversed(_COLUMNS)])
    # the turn at the level's own place is missing in rows of shorter conversations; the empty prefix is a node of its own only at the root
    whole = reduce(lambda other, i: F.when(F.col("level") == i, F.col(_COLUMNS[i - 1]).isNotNull()).otherwise(other), range(1, BLOCK + 1), F.col("blk") == 0)
    found = found.where(whole).withColumn("depth", (F.col("blk") * BLOCK + F.col("level")).cast("long"))
    for name, key, which in (("nx", "kx", 0), ("ny", "ky", 1)):
        parts = [F.when(F.col(c).isNotNull(), _hashes(F.col("blk") * BLOCK + F.lit(i + 1), F.col(c))[which]).otherwise(F.lit(0)) for i, c in enumerate(_COLUMNS)]
        found = found.withColumn(name, reduce(Column.bitwiseXOR, parts, F.col(key)))
    return found.withColumn("last", last).drop("g", "level")


def _nodes(cut: DataFrame) -> DataFrame:
    """Every node with its members, children, parent's key, and what it saves itself."""
    found = _rolled(cut, "count(*) AS n_convs, min(conv_id) AS conv_id")
    x, y = _hashes(F.col("depth"), F.col("last"))
    found = found.withColumns({"px": F.when(F.col("depth") > 0, F.col("nx").bitwiseXOR(x)), "py": F.when(F.col("depth") > 0, F.col("ny").bitwiseXOR(y))})
    found = settle(found, "nodes")
    below = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("nx"), F.col("py").alias("ny"))
    below = below.agg(F.count("*").alias("n_children"))
    size = F.coalesce(F.conv(F.hex(F.substring("last", 17, 4)), 16, 10).cast("long"), F.lit(0))
    counted = found.join(below, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return settle(counted.withColumn("saved", (F.col("n_convs") - 1) * size).drop("last"), "counted")


def _subtrees(nodes: DataFrame, cut: DataFrame) -> DataFrame:
    """(depth, nx, ny, n_leaves, saved_tokens): sums over each node and all below it."""
    leaf = (F.col("n_children") == 0).cast("long").alias("leaf")
    here = nodes.select("blk", "kx", "ky", *_COLUMNS, "saved", leaf)
    entered = nodes.where("blk > 0").groupBy("blk", "kx", "ky").agg(
        F.min("conv_id").alias("conv_id"), F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    entered = settle(entered.select("conv_id", "blk", "saved", "leaf"), "entered")
    # what begins in later rows counts in the earlier rows of the conversation that represents it
    bearers = entered.groupBy("conv_id").agg(F.max("blk").alias("blk"))
    bearers = bearers.select("conv_id", F.explode(F.expr("sequence(0L, blk)")).alias("blk"))
    earlier = cut.select("conv_id", "blk", "kx", "ky", *_COLUMNS).join(bearers, ["conv_id", "blk"]).join(entered, ["conv_id", "blk"], "left")
    earlier = earlier.fillna(0, ["saved", "leaf"])
    later = running(earlier, {"saved": F.col("saved"), "leaf": F.col("leaf")}, F.sum, backwards=True).where("saved > 0 or leaf > 0")
    both = here.unionByName(later.select(here.columns))
    return _rolled(both, "sum(leaf) AS n_leaves, sum(saved) AS saved_tokens").select(*_NODE, "n_leaves", "saved_tokens")


_CHUNK = pa.schema([("nx", pa.int64()), ("ny", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_DIGEST = pa.schema([("nx", pa.int64()), ("ny", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])


def _edges(batch: pa.RecordBatch) -> np.ndarray:
    """Where another node begins."""
    new = np.ones(batch.num_rows, bool)
    columns = [batch.column(c).to_numpy() for c in ("nx", "ny", "depth")]
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, the ids of each node in a batch as one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        begin = _edges(batch)
        ids = batch.column("conv_id").cast(pa.string())
        if len(begin) < batch.num_rows:
            ids = pa.array([",".join(ids[a:b].to_pylist()) for a, b in zip(begin, [*begin[1:], batch.num_rows], strict=True)])
        keys = [batch.column(c).take(pa.array(begin)) for c in ("nx", "ny", "depth", "conv_id")]
        yield pa.RecordBatch.from_arrays([*keys, ids], schema=_CHUNK)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted chunks, the SHA-256 of each node's text; only one chunk is held at a time."""
    node, state = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("nx", "ny", "depth", "ids")), strict=True):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
        yield _digests(done)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_DIGEST)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST)


def ends(cut: DataFrame) -> DataFrame:
    """(nx, ny, depth, ends_sha256): digests of the ids of the conversations that end in a node, in order, with commas between them."""
    last = cut.groupBy("conv_id").agg(F.max("blk").alias("blk"))
    ended = cut.join(last, ["conv_id", "blk"]).select(
        F.col("kx").bitwiseXOR(F.col("bx")).alias("nx"),
        F.col("ky").bitwiseXOR(F.col("by")).alias("ny"),
        (F.col("blk") * BLOCK + F.col("k")).cast("long").alias("depth"),
        "conv_id",
    )
    order = ["nx", "ny", "depth"]
    ended = settle(ended, "ended").repartitionByRange(*order, "conv_id").sortWithinPartitions(*order, "conv_id")
    chunks = ended.mapInArrow(_joined, "nx long, ny long, depth long, first long, ids string")
    chunks = chunks.repartition(*order).sortWithinPartitions(*order, "first")
    return chunks.mapInArrow(_hashed, "nx long, ny long, depth long, ends_sha256 string")


def prefix_tree(conversations: DataFrame) -> DataFrame:
    """A row for each different beginning of the rebuilt conversations (`rebuilt`), from the empty one on.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the node's key (nx, ny).

    A missing role or text is empty. Turns come in the order of `turn`, missing first; rows of one turn in the order of a hash of
    their role and text, so repeated rows are turns in a row. Rows without conv_id belong to no conversation; an empty table gives no rows. Other
    columns are ignored, and texts of any length are only hashed and measured.
    """
    reach(conversations.sparkSession)
    turns, sizes = rebuilt(numbered(turn_rows(conversations)))
    cut = blocks(turns, sizes)
    nodes = _nodes(cut)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("nx").alias("px"), F.col("ny").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(_subtrees(nodes, cut), _NODE).join(above, ["depth", "px", "py"], "left").join(ends(cut), _NODE, "left")
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest, "nx", "ny")
