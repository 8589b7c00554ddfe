"""Exact quantiles against a sort."""

import math
import random

from pyspark.sql import functions as F

from souk.operators.quantiles import exact_quantiles

QS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 1.0]


def by_sort(values):
    v = sorted(values)
    return [v[max(math.ceil(q * len(v)), 1) - 1] for q in QS]


def test_over_a_million_distinct_values(spark):
    n = 1_000_003
    df = spark.range(n).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % n).alias("v"))
    got = exact_quantiles(df, "g", "v", QS).first().quantiles
    assert got == [max(math.ceil(q * n), 1) - 1 for q in QS]


def test_groups_nulls_ties_and_wild_spreads(spark):
    rng = random.Random(3)
    groups = {
        "ties": [rng.choice([1.0, 2.0, 5.0]) for _ in range(500)],
        "one": [3.25], "same": [7.0] * 40, None: [rng.random() for _ in range(99)],
        "wild": [10.0 ** rng.randint(-12, 12) * rng.choice([-1, 1]) for _ in range(400)],
        "huge": [-1.7e308, 1.7e308, 0.0, 1.0],
        "endless": [1.0, 2.0, 3.0, math.inf], "both ends": [-math.inf, 1.0, 2.0, math.inf],
        "denormal": [0.0, 5e-324, 5e-324, 1e-323], "zeros": [-0.0, 0.0, 0.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rows += [("none", None), ("ties", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.quantiles for r in exact_quantiles(df, "g", "v", QS).collect()}
    assert got == {g: by_sort(v) for g, v in groups.items()}
    assert exact_quantiles(df.limit(0), "g", "v", QS).count() == 0
