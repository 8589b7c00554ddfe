"""Merkle manifest: a hash per row, a subtree per group, a root over the groups.

A leaf is the SHA-256 of a row's fields, each written as ``-`` if null, else as
its UTF-8 byte count, ``:`` and its value. The leaves of a group, in the order
of an id, are joined two by two (the last one alone if their number is odd)
into the hash of their hex digests, level by level, until one is left: the
subroot. The subroots, in the order of the groups, are joined likewise.

How it runs:

1. Leaves are hashed where the rows are read; from then on only the columns
   asked for and the digests travel. They are dealt by ranges of (group, id),
   sorted within a range and pinned, so that a leaf's rank in its group is its
   place in the range plus the counts of the ranges before: a group of any size
   is many tasks.
2. The low ``BITS`` binary digits of the rank stand in columns of their own and
   are grouped away one after another, lowest first. Each grouping nests the
   one or two child structs in their parent's. All groupings keep (group,
   block), the rank's remaining digits, so the rows move once, and a row never
   holds more than 2 ** ``BITS`` leaves.
3. The roots of the blocks are the leaves of the next roll-up, and so on until
   one node is left in each group; the subroots are rolled up the same way.
4. On the way back the path above a block reaches it by a union and a grouping
   by (group, block), and each level is a ``transform``, that gives every child
   its sibling, and an ``explode``. Proofs need no join.

Results for odd input: null groups form one group, the first; null ids come
first in their group; equal ids follow each other by leaf, and equal rows are
leaves of their own. A group with one row has its leaf as subroot, with an
empty proof up to there. Texts are hashed whole. An empty table gives an empty
manifest. Columns of the table that bear the name of a result column
(``leaf``, ``subroot``, ``root``, ``proof``) are replaced, unless they are asked
for as ``keep``, which raises an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned

BITS = 10  # binary levels of a block
_ROW = 33  # monotonically_increasing_id: partition above this bit, row below


def spelled(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[spelled(v) for v in values]), 256)


# -------------------------------------------------------------------- ranks ----
def _ranked(nodes: DataFrame) -> DataFrame:
    """Rows (g, key, h, x) with ``rank``, the place in the group by (key, h), and
    ``n``, the group's size."""
    rows = pinned(nodes).withColumn("row", F.monotonically_increasing_id())
    order = ["g", "key", "h", "row"]  # the row splits a run of equal leaves
    rows = pinned(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row"))
    place = F.monotonically_increasing_id()
    rows = rows.withColumns({"part": F.shiftright(place, _ROW),
                             "place": place.bitwiseAND(F.lit((1 << _ROW) - 1))})
    runs = rows.groupBy("part", "g").agg(F.min("place").alias("first"), F.count("*").alias("m"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("part").alias("rpart"), F.col("g").alias("rg"),
                       (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first"))
                       .alias("shift"), F.sum("m").over(whole).alias("n"))
    return rows.join(runs, (F.col("part") == F.col("rpart")) & F.col("g").eqNullSafe(F.col("rg"))) \
        .select("g", "n", (F.col("place") + F.col("shift")).alias("rank"), "h", "x")


# ------------------------------------------------------------------ roll-up ----
def _joined(level: int) -> Column:
    """True where a group of ``n`` leaves has more than one node at a level."""
    return F.col("n") > (1 << level)


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    """Roll nodes (g, n, rank, h, x) up into blocks (g, n, block, node)."""
    digits = [f"d{k}" for k in range(bits)]
    rows = nodes.select(
        "g", "n", F.shiftright("rank", bits).alias("block"),
        *[F.shiftright("rank", k).bitwiseAND(F.lit(1)).cast("int").alias(digits[k])
          for k in range(bits)], F.struct("h", "x").alias("node")).repartition("g", "block")
    for k in range(bits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(digits[k]).alias("d"), "node")))
        rows = rows.groupBy("g", "n", "block", *digits[k + 1:]).agg(kids.alias("kids"))
        both = F.array_join(F.transform("kids", lambda c: c["node"]["h"]), "")
        h = F.when(_joined(k), F.sha2(both, 256)).otherwise(F.col("kids")[0]["node"]["h"])
        rows = rows.select("g", "n", "block", *digits[k + 1:],
                           F.struct(h.alias("h"), "kids").alias("node"))
    return pinned(rows)


def _roll(nodes: DataFrame, most_bits: int) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """One node (g, h) for each group, and below it the blocks of each roll-up
    with their height, which is as low as the largest group allows."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while most > 1:
        bits = min(most_bits, (most - 1).bit_length())
        levels.append((_blocks(nodes, bits), bits))
        most = -(-most >> bits)
        nodes = levels[-1][0].select(
            "g", F.shiftright(F.col("n") + ((1 << bits) - 1), bits).alias("n"),
            F.col("block").alias("rank"), F.col("node")["h"].alias("h"),
            F.lit(None).cast("boolean").alias("x"))
    return nodes, levels


def _with_sibling(kid: Column, i: Column) -> Column:
    other = F.coalesce(F.get(F.col("node")["kids"], 1 - i)["node"]["h"], F.lit(""))
    step = F.struct(F.when(i == 1, other).otherwise("").alias("l"),
                    F.when(i == 0, other).otherwise("").alias("r"))
    return F.struct(kid["d"].alias("d"), kid["node"].alias("node"), step.alias("step"))


def _unroll(levels: list[tuple[DataFrame, int]], above: DataFrame,
            carried: list[str]) -> DataFrame:
    """From (g, rank, path, carried columns) of the highest blocks down to the
    leaves: (g, path, h, x, carried columns)."""
    for at, (level, bits) in reversed(list(enumerate(levels))):
        rows = level.unionByName(above.withColumnRenamed("rank", "block"),
                                 allowMissingColumns=True) \
            .groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c)
                                         for c in ["n", "node", "path", *carried]])
        rows = rows.withColumn("rank", F.col("block"))
        for k in reversed(range(bits)):
            rows = rows.select("g", "n", "rank", "path", *carried,
                               F.explode(F.transform(F.col("node")["kids"], _with_sibling))
                               .alias("kid"))
            path = F.when(_joined(k), F.concat(F.array("kid.step"), "path")).otherwise(F.col("path"))
            rows = rows.select("g", "n", (F.col("rank") * 2 + F.col("kid.d")).alias("rank"),
                               path.alias("path"), *carried, F.col("kid.node").alias("node"))
        above = rows.select("g", "rank", "path", *carried, "node.h", "node.x")
        if at:
            above = above.drop("h", "x")
    return above


def manifest(rows: DataFrame, group: str, order: str, leaf: Column,
             keep: Sequence[str | Column] = (), bits: int = BITS) -> DataFrame:
    """One row per row: its group, order and ``keep`` columns, ``leaf``,
    ``subroot``, ``root`` and ``proof``, the siblings from the leaf up to the
    root as (l, r): the digests to the left and right, empty where there are none."""
    made = {"leaf", "subroot", "root", "proof"}
    asked = rows.select(group, order, *keep).columns
    if made & set(map(str.lower, asked)):
        raise ValueError(f"columns named {sorted(made)} are made here")
    leaves = rows.select(F.col(group).alias("g"), F.col(order).alias("key"), leaf.alias("h"),
                         F.struct(group, order, *keep).alias("x"))
    subroots, low = _roll(_ranked(leaves), bits)
    if not low:  # no group has two rows: a leaf is its subroot
        low_rows = subroots
    groups = _ranked(subroots.select(
        F.lit(0).alias("g"), F.col("g").alias("key"), "h",
        F.struct(F.col("g").alias("g"), F.col("h").alias("subroot")).alias("x")))
    root, high = _roll(groups, bits)
    none = F.expr("cast(array() as array<struct<l: string, r: string>>)")
    top = root.select("g", F.lit(0).cast("long").alias("rank"), none.alias("path"),
                      F.col("h").alias("root"))
    if high:
        named = _unroll(high, top, ["root"])
    else:
        named = root.select(none.alias("path"), F.col("h").alias("root"), "x")
    above = named.select(F.col("x.g").alias("g"), F.lit(0).cast("long").alias("rank"), "path",
                         "root", F.col("x.subroot").alias("subroot"))
    if low:
        found = _unroll(low, above, ["root", "subroot"])
    else:
        found = low_rows.select("g", "h", "x").unionByName(above, allowMissingColumns=True) \
            .groupBy("g").agg(*[F.first(c, ignorenulls=True).alias(c)
                                for c in ("h", "x", "path", "root", "subroot")])
    return found.select("x.*", F.col("h").alias("leaf"), "subroot", "root",
                        F.col("path").alias("proof"))


def folded(claim: str | Column, proof: str | Column) -> Column:
    """The root that a claimed leaf leads to along a proof."""
    return F.aggregate(proof, F.col(claim) if isinstance(claim, str) else claim,
                       lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def proof_text(proof: str | Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["l"], s["r"])), "")
