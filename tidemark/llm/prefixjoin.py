"""Pairs of sets that may be similar, by an exact prefix filter.

All n-grams stand in one order, rare ones first. Two sets of a similarity of `similar` percent or more share one of the first few n-grams of each, and the
first one they share stands early enough in both. N-grams that no other set has come first; a set that has too many of them is like no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import settle


def may_miss(missing: str, size: str, similar: int) -> Column:
    """Whether a set of this size may have so many n-grams that a similar one has not."""
    return F.expr(f"100L * {missing} <= {100 - similar}L * {size}")


def enough(common: str, a: str, b: str, similar: int) -> Column:
    """Whether sets of sizes `a` and `b` are similar with so many common n-grams."""
    return F.expr(f"100L * ({common}) >= {similar}L * ({a} + {b} - ({common}))")


def arranged(sizes: DataFrame, rows: DataFrame, similar: int) -> DataFrame:
    """(node, n, own, grams) of sets (node, n) with n-grams (node, gram): those that other sets have too, as (many, gram) from rare to frequent.

    `own` counts the others. Sets with too many of them leave.
    """
    many = rows.groupBy("gram").agg(F.count("*").cast("int").alias("many")).where("many > 1")
    found = rows.join(many, "gram").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("many", "gram"))).alias("grams"))
    kept = sizes.select("node", "n").join(found, "node").withColumn("own", F.col("n") - F.size("grams"))
    return settle(kept.where(may_miss("own", "n", similar)).select("node", "n", "own", "grams"), "arranged")


def postings(sets: DataFrame, similar: int) -> DataFrame:
    """(gram, node, n, own, at): where the n-grams stand of which two similar sets share one; own ones come first."""
    first = F.expr(f"slice(grams, 1, cast(({100 - similar} * n) div 100 + 1 - own as int))")
    return sets.select("node", "n", "own", F.posexplode(first).alias("at", "g")).select(
        F.col("g.gram").alias("gram"), "node", "n", "own", (F.col("own") + F.col("at")).alias("at")
    )


def pairs(x: DataFrame, y: DataFrame, other: Column, similar: int) -> DataFrame:
    """Different pairs (a, b) of postings that share an n-gram and, if it is the first they share, may be similar."""
    common = "least(x.n - x.at, y.n - y.at, x.n - x.own, y.n - y.own)"
    fit = (F.col("x.gram") == F.col("y.gram")) & other & enough(common, "x.n", "y.n", similar)
    met = x.alias("x").join(y.alias("y"), fit)
    return met.select(F.least("x.node", "y.node").alias("b"), F.greatest("x.node", "y.node").alias("a")).distinct()


def across(placed: DataFrame, similar: int) -> DataFrame:
    """Pairs of postings of different `part`s: those outside the largest part of an n-gram meet those of all other parts."""
    parts = placed.groupBy("gram", "part").agg(F.count("*").alias("many")).groupBy("gram")
    parts = parts.agg(F.count("*").alias("parts"), F.max(F.struct("many", "part"))["part"].alias("largest")).where("parts > 1").select("gram", "largest")
    mixed = settle(placed.join(parts, "gram"), "mixed")
    return pairs(mixed.where("part <> largest"), mixed, F.col("x.part") != F.col("y.part"), similar)
