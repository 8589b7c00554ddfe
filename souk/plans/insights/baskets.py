"""Products bought together: similar products per product, and frequent sets of
any size (stated questions; our definitions)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...operators.joins import bounded_broadcast
from ...operators.ranks import ranked
from ...operators.topk import top_k_per_group
from ...session import ensure_checkpoint_dir
from .common import order_categories

SMALL = 32           # an order of as many products makes all its pairs
TILE = 1024          # products of an order that meet the others at a time
LOT = 200_000        # candidate sets that are counted in one pass
LEAST_LOCAL = 64     # a set's least count within a block that makes it a candidate


def _known(order_items: DataFrame, item: str) -> DataFrame:
    """(order_id, item) of every row where both are known."""
    return (order_items.select("order_id", F.col(item).alias("item"))
            .filter(F.col("order_id").isNotNull() & F.col("item").isNotNull()))


def _bought(order_items: DataFrame, item: str) -> DataFrame:
    """Distinct (order_id, item), both known; copies go on the map side."""
    return _known(order_items, item).distinct()


# ------------------------------------------------------------- item to item ----
def _by_size(rows: DataFrame, fits: int) -> tuple[DataFrame, DataFrame]:
    """Distinct (order_id, item) of the orders of at most ``fits`` products, dealt by
    order, and (order_id, item, size) of the larger ones.

    An order of few rows has few products, so only orders of many rows are
    measured. Copies within those go before the shuffle by order: no order brings
    more than ``fits`` rows to it.
    """
    listed = bounded_broadcast(
        rows.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"))
        .filter(F.col("lines") > fits).select("order_id").checkpoint())
    long = rows.join(listed, "order_id", "left_semi").distinct()
    sizes = long.groupBy("order_id").agg(F.count(F.lit(1)).alias("size"))
    sized = long.join(sizes, "order_id").checkpoint()
    small = (rows.join(listed, "order_id", "left_anti")
             .unionByName(sized.filter(F.col("size") <= fits).drop("size")))
    return small.repartition("order_id").distinct(), sized.filter(F.col("size") > fits)


def _pairs(early: DataFrame, tile: int) -> DataFrame:
    """(a, b), a < b, of the products that meet in the orders of ``early``, once an
    order. An order of more than ``tile`` products is cut into tiles, and each
    pair of tiles is a join key of its own."""
    tiles = F.ceil(F.col("size") / tile)
    mine = F.pmod(F.xxhash64("item"), tiles)
    rows = early.select("order_id", "item", tiles.alias("tiles"), mine.alias("tile"))
    first = rows.select("order_id", F.col("tile").alias("lo"), F.col("item").alias("x"),
                        F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("hi"))
    second = rows.select("order_id", F.col("tile").alias("hi"), F.col("item").alias("y"),
                         F.explode(F.sequence(F.lit(0).cast("long"), "tile")).alias("lo"))
    # few bytes make many pairs: a number of tasks is given, or they would be merged
    keys = ["order_id", "lo", "hi"]
    parts = int(early.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = first.repartition(parts, *keys).join(second.repartition(parts, *keys), keys) \
        .filter((F.col("lo") < F.col("hi")) | (F.col("x") < F.col("y")))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def similar_products(order_items: DataFrame, top: int = 3, min_orders: int = 2,
                     min_similarity: float = 0.0, tile: int = TILE) -> DataFrame:
    """For each product the ``top`` products most often bought with it: cosine of
    their sets of orders (orders with both / root of the product of the orders
    with each), ties by orders, then product. Pairs with fewer than
    ``min_orders`` orders in common, or less similar than ``min_similarity``,
    do not count.

    Orders of at most ``SMALL`` products make all their pairs, which are at most
    half of ``SMALL`` for each row. Pairs too rare are dropped as they are
    counted, before they meet anything else.

    Counting all pairs of a larger order would let one huge order decide the cost.
    These are ranked by size, and a product's largest ones are left aside: as many
    as a partner may lack in the rest and still have enough in common. Two
    products similar enough meet in the smaller orders of both (prefix filter), so
    only those make pairs; a bound on the similarity (all orders left aside in
    common) drops more, and the rest are looked up in the orders left aside. With
    ``min_orders`` 2 no pair comes from a huge order that is the largest one of
    all its products, and products that only it has make none.

    The rank of an order in its product's list is exact (``operators/ranks``),
    so a product of a third of all orders is many tasks, and so is an order of a
    third of all items (tiles).
    """
    ensure_checkpoint_dir(order_items.sparkSession)
    small, large = _by_size(_known(order_items, "product_id"), min(SMALL, tile))
    met = (small.select("order_id", F.col("item").alias("a"))
           .join(small.select("order_id", F.col("item").alias("b")), "order_id")
           .filter(F.col("a") < F.col("b")).select("a", "b"))
    one = F.count(F.lit(1))
    per = small.groupBy("item").agg(one.alias("n"))
    # n_b is at least t^2 * n_a, or the cosine could not reach t; then the common
    # orders are at least t^2 * n_a as well

    def need(n: str):
        """Orders that a product of ``n`` must share with any partner: the cosine
        reaches t only where the smaller set has t * t of the larger one's size."""
        least = F.ceil(F.col(n) * min_similarity * min_similarity - 1e-9)
        return F.greatest(F.lit(min_orders), F.lit(1), least)

    huge = not large.isEmpty()
    if huge:
        per = per.unionByName(large.groupBy("item").agg(one.alias("n"))) \
            .groupBy("item").agg(F.sum("n").alias("n")).checkpoint()
        # small orders come first in a product's list, so the ranks of the large
        # ones count from its end
        placed = ranked(large.join(per, "item"), "item", ["size", "order_id"], "rank", "larger")
        member = placed.select("item", "order_id", "size", (
            F.col("rank") <= F.col("larger") - need("n")).alias("early")).checkpoint()
        met = met.unionByName(_pairs(member.filter("early"), tile))

    found = met.groupBy("a", "b").agg(one.alias("shared"))
    root = F.sqrt(F.col("n_a") * F.col("n_b"))

    def with_orders(pairs: DataFrame) -> DataFrame:
        """The orders of each side, n_a and n_b."""
        for side in ("a", "b"):
            pairs = pairs.join(per.select(F.col("item").alias(side), F.col("n").alias(f"n_{side}")),
                               side)
        return pairs

    if not huge:
        pairs = with_orders(found.filter(F.col("shared") >= min_orders)) \
            .select("a", "b", "n_a", "n_b", F.col("shared").alias("orders"))
    else:
        late = bounded_broadcast(member.filter(~F.col("early")).select("item", "order_id"))
        aside = bounded_broadcast(late.groupBy("item").agg(one.alias("aside")))
        for side in ("a", "b"):
            found = found.join(aside.select(F.col("item").alias(side),
                                            F.col("aside").alias(f"aside_{side}")), side, "left")
        most = F.col("shared") + F.coalesce("aside_a", F.lit(0)) + F.coalesce("aside_b", F.lit(0))
        bound = F.least("n_a", "n_b", most)
        found = with_orders(found.filter(most >= min_orders)) \
            .filter((bound >= min_orders) & (bound / root >= min_similarity - 1e-9)).checkpoint()
        pair = found.select("a", "b")

        def looked_up(own: str, other: str, members: DataFrame) -> DataFrame:
            """Orders left aside by one side of a pair that the other one is in."""
            left = pair.join(late.select(F.col("item").alias(own), "order_id"), own)
            return left.join(members.select(F.col("item").alias(other), "order_id"),
                             [other, "order_id"]).select("a", "b")

        more = looked_up("a", "b", member) \
            .unionByName(looked_up("b", "a", member.filter("early"))) \
            .groupBy("a", "b").agg(one.alias("more"))
        pairs = found.join(more, ["a", "b"], "left").select(
            "a", "b", "n_a", "n_b",
            (F.col("shared") + F.coalesce("more", F.lit(0))).alias("orders"))

    pairs = pairs.withColumn("cosine", F.col("orders") / root) \
        .filter((F.col("orders") >= min_orders) & (F.col("cosine") >= min_similarity))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("product_id"), F.col("b").alias("similar_id"), "orders", "cosine"),
        F.struct(F.col("b").alias("product_id"), F.col("a").alias("similar_id"), "orders", "cosine")
    )).alias("p")).select("p.*")
    best = top_k_per_group(both, ["product_id"],
                           [F.desc("cosine"), F.desc("orders"), F.col("similar_id")], top)
    return best.select("product_id", F.col("rank").cast("int").alias("rank"), "similar_id",
                       "orders", F.round("cosine", 6).alias("similarity"))


# ------------------------------------------------------------ frequent sets ----
def _local_sets(baskets: list[list[int]], weights: list[int], least: int,
                most_items: int) -> Iterator[tuple[int, ...]]:
    """Sets of two items and more whose baskets weigh ``least`` together. A set's
    baskets are the bits of an integer, one per basket; a set grows by larger
    items only, while it is heavy enough."""
    bits: dict[int, int] = {}
    for i, basket in enumerate(baskets):
        for x in basket:
            bits[x] = bits.get(x, 0) | 1 << i

    equal = len(set(weights)) <= 1

    def weight(rows: int) -> int:
        if equal:
            return rows.bit_count() * (weights[0] if weights else 0)
        total = 0
        while rows:
            low = rows & -rows
            total += weights[low.bit_length() - 1]
            rows ^= low
        return total

    def grow(chosen: tuple[int, ...], rows: int, rest: list[int]) -> Iterator[tuple[int, ...]]:
        kept = [(x, both) for x in rest if (both := rows & bits[x]) and weight(both) >= least]
        for i, (x, both) in enumerate(kept):
            wider = (*chosen, x)
            if len(wider) > 1:
                yield wider
            if len(wider) < most_items:
                yield from grow(wider, both, [y for y, _ in kept[i + 1:]])

    yield from grow((), (1 << len(baskets)) - 1, sorted(bits))


def frequent_sets(order_items: DataFrame, item: str = "product_id", min_support: float = 0.01,
                  most_items: int = 8, lot: int = LOT) -> DataFrame:
    """All sets of two to ``most_items`` items that are together in at least
    ``min_support`` of the orders: (items, n_items, orders, support).

    1. Items that are too rare alone cannot be in such a set and are dropped. What
       is left of an order is short (few items can be that frequent), even of one
       that held a third of all items; equal baskets become one with a count.
    2. Baskets are dealt into blocks. A set that reaches the support over all
       blocks reaches its share of it in one block at least, so the sets that do
       so in some block are all candidates that are needed. There are as many
       blocks as leave a share of ``LEAST_LOCAL`` orders.
    3. All blocks count all candidates, ``lot`` at a time (a list of bounded size,
       sent to every task), and the sums are exact.
    """
    spark = order_items.sparkSession
    ensure_checkpoint_dir(spark)
    bought = _bought(order_items, item)
    kind = bought.schema["item"].dataType
    n_orders = bought.select("order_id").distinct().count()
    least = max(1, -int(-(n_orders * min_support - 1e-9) // 1))
    often = bought.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least) \
        .drop("n")
    baskets = (bought.join(often, "item").groupBy("order_id")
               .agg(F.sort_array(F.collect_set("item")).alias("items"))
               .filter(F.size("items") > 1)
               .groupBy("items").agg(F.count(F.lit(1)).alias("n")))
    blocks = max(1, min(least // LEAST_LOCAL,
                        int(spark.conf.get("spark.sql.shuffle.partitions"))))
    baskets = baskets.repartition(blocks, F.xxhash64("items")).checkpoint()
    whole = baskets.agg(F.sum("n")).first()[0] or 0
    schema = T.StructType([T.StructField("items", T.ArrayType(kind))])
    arrow_items = pa.list_(_arrow(kind))

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, weights = [], []
        for b in batches:
            sets += b.column(0).to_pylist()
            weights += b.column(1).to_pylist()
        share = -(-least * sum(weights) // max(whole, 1))
        batch: list[list] = []
        for found in _local_sets(sets, weights, max(1, share), most_items):
            batch.append(list(found))
            if len(batch) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(batch, arrow_items)], names=["items"])
                batch = []
        yield pa.RecordBatch.from_arrays([pa.array(batch, arrow_items)], names=["items"])

    candidates = baskets.mapInArrow(mine, schema).distinct() \
        .withColumn("id", F.monotonically_increasing_id()).checkpoint()
    lots = max(1, -(-candidates.count() // lot))
    counted = None
    for k in range(lots):
        some = candidates.filter(F.pmod(F.xxhash64("id"), F.lit(lots)) == k).collect()
        given = spark.sparkContext.broadcast([(r["id"], r["items"]) for r in some])

        def count(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bits: dict = {}
                weights = b.column(1).to_pylist()
                for i, basket in enumerate(b.column(0).to_pylist()):
                    for x in basket:
                        bits[x] = bits.get(x, 0) | 1 << i
                ids, sums = [], []
                for key, items in given.value:
                    rows = reduce(lambda r, x: r & bits.get(x, 0), items, -1)
                    total = 0
                    while rows:
                        low = rows & -rows
                        total += weights[low.bit_length() - 1]
                        rows ^= low
                    if total:
                        ids.append(key)
                        sums.append(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sums, pa.int64())], names=["id", "n"])

        part = baskets.mapInArrow(count, "id long, n long")
        counted = part if counted is None else counted.unionByName(part)
    totals = counted.groupBy("id").agg(F.sum("n").alias("orders")).filter(F.col("orders") >= least)
    return candidates.join(totals, "id").select(
        "items", F.size("items").alias("n_items"), "orders",
        F.round(F.col("orders") / F.lit(max(n_orders, 1)), 6).alias("support"))


def category_sets_above(order_items: DataFrame, products: DataFrame,
                        min_support: float = 0.01) -> DataFrame:
    """Frequent sets of categories, each written as one text."""
    cats = order_categories(order_items, products)
    return frequent_sets(cats, "category", min_support).select(
        F.array_join("items", " + ").alias("categories"), "n_items", "orders", "support")


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)
