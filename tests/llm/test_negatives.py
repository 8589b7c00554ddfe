import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import negatives
from tests.compare import compare, duck
from tests.conftest import SF001

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, scale=256, k=5, n=10):
    dims = max((len(e) for _, _, e in rows), default=0)
    v = np.array([np.pad(np.floor(np.float32(e).astype(float) * scale), (0, dims - len(e)))
                  for _, _, e in rows]).astype(np.int64)
    key = [(i is None, i or 0) for i, _, _ in rows]
    out = []
    for a, (i, label, _) in enumerate(rows):
        if i is None or i % 100:
            continue
        s = v @ v[a]
        order = sorted((j for j in range(len(rows)) if j != a), key=lambda j: (-s[j], key[j]))
        for p in [j for j in order if rows[j][1] == label][:k]:
            hits = [j for j in order if rows[j][1] != label
                    and 30 * s[p] <= 100 * s[j] <= 90 * s[p]][:n]
            out += [(i, rows[p][0], r + 1, rows[j][0], int(s[p]), int(s[j]))
                    for r, j in enumerate(hits)]
    return sorted(out, key=repr)


def found(spark, rows, **args):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = negatives.hard_negatives(df, F.col("id") % 100 == 0, **args).collect()
    return sorted(map(tuple, got), key=repr)


def test_query_matches_sql(spark, queries):
    from souk.llm.queries import ORACLE
    ok, msg, _, _ = compare(spark, duck(SF001), "op12_negatives", queries["op12_negatives"],
                            ORACLE["op12_negatives"], SF001)
    assert ok, msg


def clusters(seed, n, dims=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dims))
    at = rng.integers(0, 12, n)
    v = centre[at] + rng.normal(scale=0.05, size=(n, dims))
    return [(int(i) * 10, int(l), [float(x) for x in np.float32(e)])
            for i, l, e in zip(rng.permutation(n), (at + rng.integers(0, 2, n)) % 5, v)]


def test_many_shards_and_blocks(spark):
    rows = clusters(1, 900)
    assert found(spark, rows, shard_rows=40, block_rows=15, anchor_rows=20, sample=120) \
        == brute(rows)


def test_shards_are_left_out(spark):
    """On clustered vectors the ranges of the tree eliminate shards."""
    rows = spark.createDataFrame(clusters(2, 2000), SCHEMA)
    index = negatives.Index(*negatives.to_integers(rows, "vec_id", "label", "embedding", 256),
                            50, 50, 500)
    anchors = index.reader.points([bytes(r.vec) for r in index.rows.limit(50).collect()])
    s = np.diag(anchors.scores(np.arange(50), anchors, np.arange(50)))
    want = negatives.Wanted(anchors, np.zeros(50), np.arange(50),
                            (s * 0.9).astype(np.int64)[:, None], s[:, None], 5, True)
    met = sum(len(a) for _, a in index.tree.visit(anchors, *want.annuli()))
    assert len(index.tree.leaves) >= 40 and met < 0.5 * 50 * len(index.tree.leaves)


def test_leaves_hold_every_row_in_the_annulus():
    rng = np.random.default_rng(4)
    points = negatives.Points(rng.integers(-90, 90, (700, 5)), 90 * 90 * 5)
    tree = negatives.Tree(points, 16)
    assert sorted(np.concatenate(tree.leaves)) == list(range(700))
    s = points.scores(np.arange(700), points, np.arange(700))
    low, high = np.full((700, 1), 2000), np.full((700, 1), 6000)
    want = negatives.Wanted(points, np.zeros(700), np.arange(700), low, high, 5, True)
    got = np.zeros((700, 700), bool)
    for leaf, rows in tree.visit(points, *want.annuli()):
        got[np.ix_(rows, tree.leaves[leaf])] = True
    assert got[(s >= 2000) & (s <= 6000)].all() and not got.all()


def test_odd_rows(spark):
    """Nulls, non-finite parts, ties, repeated rows, short and empty vectors."""
    inf, nan = float("inf"), float("nan")
    good = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 1, [1.0, 1.0]), (2, 1, [1.0, 1.0]),
            (None, 1, [1.0, 1.5]), (3, 2, [0.5, 0.5]), (4, 2, [0.5, 0.5]), (4, 2, [0.5, 0.5]),
            (None, 2, [0.5, 0.5]), (5, 3, [0.9]), (6, 3, []), (100, 3, []), (100, 3, [0.3, 0.1]),
            (7, 4, [-1.0, -2.0]), (200, 9, [1.0, 1.0]), (-300, 2, [0.7, 0.1])]
    bad = [(300, None, [1.0, 1.0]), (400, 1, None), (500, 1, [1.0, nan]), (600, 1, [inf, 1.0]),
           (700, 1, [None, 1.0])]
    assert found(spark, good + bad) == brute(good)


def test_a_vector_that_a_third_of_all_rows_hold(spark):
    rows = clusters(3, 400) + [(100_001 + i, i % 3, [1.0] * 6) for i in range(200)]
    assert found(spark, rows, shard_rows=30, block_rows=20, sample=100) == brute(rows)


def test_large_and_clashing_and_empty(spark):
    rows = [(i, i % 2, [3000.0 + i, -2000.0 + 7 * i]) for i in range(0, 300, 20)]
    assert found(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.withColumns({c: F.lit("x") for c in ("row", "id", "vec", "score", "shard")})
    got = negatives.hard_negatives(extra, F.col("id") % 100 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert negatives.hard_negatives(df.limit(0), F.col("id") % 100 == 0).count() == 0
    with pytest.raises(ValueError):
        negatives.hard_negatives(spark.createDataFrame([(0, 1, [1e30])], SCHEMA),
                                 F.col("id") % 100 == 0)
