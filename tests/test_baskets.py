"""Similar products and frequent sets against brute force."""

import collections
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from souk.plans.insights import baskets as BK


def orders_of(rows):
    by = collections.defaultdict(set)
    for order, item in rows:
        if order is not None and item is not None:
            by[item].add(order)
    return by


def similar(rows, top, least, t):
    by, out = orders_of(rows), {}
    for a in by:
        hits = []
        for b in by:
            both = len(by[a] & by[b])
            cosine = both / math.sqrt(len(by[a]) * len(by[b]))
            if b != a and both >= least and cosine >= t:
                hits.append((-cosine, -both, b))
        for r, (c, n, b) in enumerate(sorted(hits)[:top]):
            out[a, r + 1] = (b, -n, round(-c, 6))
    return out


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"order_id long, product_id {kind}").repartition(6)


def random_rows(seed, orders=160, items=60):
    rnd = random.Random(seed)
    rows = [(o, int(rnd.paretovariate(0.6)) % items) for o in range(orders)
            for _ in range(rnd.randint(1, 9))]
    rows += rnd.choices(rows, k=80)                       # a product twice in an order
    return [*rows, (None, 1), (3, None), (None, None)]


@pytest.mark.parametrize("least,t,tile", [(2, 0.0, 1024), (1, 0.0, 4), (2, 0.3, 2), (3, 0.55, 3),
                                          (1, 0.7, 1024)])
def test_similar_products(spark, least, t, tile):
    rows = random_rows(int(10 * t) + least)
    got = BK.similar_products(frame(spark, rows), 4, least, t, tile).collect()
    assert {(r.product_id, r["rank"]): (r.similar_id, r.orders, r.similarity) for r in got} == \
        similar(rows, 4, least, t)


def test_an_order_with_a_third_of_all_items(spark):
    """It holds every product, some of them nowhere else; one product is in a third
    of all orders."""
    rnd = random.Random(8)
    rows = [(o, rnd.randint(1, 80)) for o in range(1, 150) for _ in range(3)]
    rows += [(o, 0) for o in range(1, 150, 3)] + [(0, p) for p in range(220)]
    got = BK.similar_products(frame(spark, rows), 3, 2, 0.0, 16).collect()
    assert {(r.product_id, r["rank"]): (r.similar_id, r.orders, r.similarity) for r in got} == \
        similar(rows, 3, 2, 0.0)
    # the largest order makes no pair itself, and looked-up pairs are few
    early = []
    pairs = BK._pairs
    try:
        BK._pairs = lambda df, tile: (early.append(df), pairs(df, tile))[1]
        BK.similar_products(frame(spark, rows), 3, 2, 0.0, 16).collect()
    finally:
        BK._pairs = pairs
    assert early[0].filter("order_id = 0").count() == 0


def test_a_huge_order_is_dealt_in_tiles(spark):
    """Where one common order is enough, its pairs come from many join keys."""
    rows = [(0, p) for p in range(120)] + [(1, 0), (1, 1)]
    got = BK.similar_products(frame(spark, rows), 1, 1, 0.0, 10).collect()
    assert {(r.product_id, r["rank"]): (r.similar_id, r.orders, r.similarity) for r in got} == \
        similar(rows, 1, 1, 0.0)


def test_pairs_of_large_orders_are_many_tasks(spark):
    """Their rows are few bytes, but they are not merged into one task."""
    rows = spark.createDataFrame([(o, p, 40) for o in range(9) for p in range(40)],
                                 "order_id long, item long, size long")
    met = BK._pairs(rows, 8)
    assert met.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert met.groupBy("a", "b").count().filter("count = 9 and a < b").count() == 40 * 39 // 2


def test_small_orders_are_counted_in_one_pass(spark, monkeypatch):
    """No row of theirs is ranked or set down, no pair looked up again."""
    rows = random_rows(3)
    df, kept = frame(spark, rows), []
    whole = type(df).checkpoint

    def checkpoint(self, *args):
        kept.append(whole(self, *args))
        return kept[-1]
    monkeypatch.setattr(type(df), "checkpoint", checkpoint)
    got = BK.similar_products(df, 4).collect()
    assert {(r.product_id, r["rank"]): (r.similar_id, r.orders, r.similarity) for r in got} == \
        similar(rows, 4, 2, 0.0)
    assert sum(k.count() for k in kept) == 0


@pytest.mark.parametrize("least,t", [(1, 0.0), (2, 0.0), (3, 0.4)])
def test_orders_around_the_size_of_small_ones(spark, least, t):
    """Small, large and just at the limit, some with every product many times."""
    rnd = random.Random(least)
    sizes = [BK.SMALL + k for k in (-1, 0, 1, 2)] * 3 + [rnd.randint(1, 6) for _ in range(60)]
    rows = [(o, p) for o, n in enumerate(sizes) for p in rnd.sample(range(70), n)]
    rows += [(1000, p % 5) for p in range(100)] + [(0, 3)] * 40
    rows += [(1001, p) for p in range(200)] + [(1002, p) for p in range(50, 250)]
    got = BK.similar_products(frame(spark, rows), 4, least, t, 64).collect()
    assert {(r.product_id, r["rank"]): (r.similar_id, r.orders, r.similarity) for r in got} == \
        similar(rows, 4, least, t)


def test_similar_products_of_nothing(spark):
    assert BK.similar_products(frame(spark, [(1, 2)]).limit(0)).count() == 0
    assert BK.similar_products(frame(spark, [(1, 2), (2, 3)])).count() == 0
    text = frame(spark, [(1, "a"), (1, "b"), (2, "a"), (2, "b")], "string")
    assert [(r.product_id, r.similar_id) for r in
            BK.similar_products(text).orderBy("product_id").collect()] == [("a", "b"), ("b", "a")]


def sets_of(rows, share, most=8):
    by = collections.defaultdict(set)
    for order, item in rows:
        if order is not None and item is not None:
            by[order].add(item)
    n = collections.Counter()
    for items in by.values():
        for k in range(2, most + 1):
            n.update(itertools.combinations(sorted(items), k))
    return {s: c for s, c in n.items() if c >= share * len(by) - 1e-9}


def mined(df, *args, **more):
    got = BK.frequent_sets(df, "product_id", *args, **more).collect()
    assert all(r.n_items == len(r["items"]) for r in got)
    out = {tuple(r["items"]): r.orders for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("share,lot", [(0.02, 200_000), (0.1, 7), (0.5, 3), (1.0, 9)])
def test_frequent_sets(spark, share, lot):
    rnd = random.Random(4)
    rows = [(o, i) for o in range(400) for i in range(9) if rnd.random() < (0.9, 0.3)[i % 2]]
    rows += [(o, 9 + rnd.randrange(300)) for o in range(400)] + [(None, 1), (1, None), (5, 1)]
    assert mined(frame(spark, rows), share, lot=lot) == sets_of(rows, share)


def test_blocks_miss_no_set(spark, monkeypatch):
    """Many small blocks, and a set that is frequent in few of them."""
    monkeypatch.setattr(BK, "LEAST_LOCAL", 4)
    rnd = random.Random(5)
    rows = [(o, i) for o in range(600) for i in rnd.sample(range(40), rnd.randint(1, 6))]
    rows += [(o, 100 + k) for o in range(0, 600, 9) for k in range(4)]
    assert mined(frame(spark, rows), 0.05) == sets_of(rows, 0.05)
    assert (100, 101, 102, 103) in sets_of(rows, 0.05)


def test_sets_with_a_huge_order_and_repeats(spark):
    rows = [(o, i) for o in range(300) for i in ((1, 2, 3), (1, 2), (4, 5))[o % 3]]
    rows += [(999, i % 5000) for i in range(9000)]
    assert mined(frame(spark, rows), 0.3) == sets_of(rows[:-9000] + [(999, i) for i in range(6)],
                                                     0.3)


def test_sets_are_as_long_as_asked_and_texts_work(spark):
    rows = [(o, c) for o in range(5) for c in "abcd"]
    got = mined(frame(spark, rows, "string"), 0.5, most_items=3)
    assert got == sets_of(rows, 0.5, 3) and max(map(len, got)) == 3
    assert mined(frame(spark, rows, "string").limit(0), 0.5) == {}


def test_the_largest_order_is_no_hot_key_in_the_plan(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("order_id"),
                                  (F.col("id") % 77).alias("product_id"))
    plan = BK.similar_products(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_" not in plan and "Cartesian" not in plan
