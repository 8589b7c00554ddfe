import hashlib
import random

import pytest
from pyspark.sql import functions as F

from souk.llm import merkle
from tests.compare import compare, duck
from tests.conftest import SF001


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def climb(nodes):
    """Root, and the siblings of every node from the bottom up, by plain loops."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            p, other = at[i], at[i] ^ 1
            h = nodes[other] if other < len(nodes) else ""
            path.append((h, "") if other < p else ("", h))
            at[i] = p // 2
        nodes = [sha("".join(nodes[k:k + 2])) for k in range(0, len(nodes), 2)]
    return nodes[0], paths


def spell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def expected(rows):
    """Sorted (lang, id, leaf, subroot, root, proof) of (id, lang, text) rows."""
    groups = {}
    for i, g, t in rows:
        groups.setdefault(g, []).append((i, sha(spell(i) + spell(g) + spell(t))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g, leaves in groups.items():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subs[g] = climb([h for _, h in leaves])
    root, tops = climb([subs[g][0] for g in order])
    return sorted(((g, i, h, subs[g][0], root, tuple(subs[g][1][k] + tops[order.index(g)]))
                   for g, leaves in groups.items() for k, (i, h) in enumerate(leaves)), key=repr)


def found(spark, rows, **args):
    df = spark.createDataFrame(rows, "id long, lang string, text string").repartition(5)
    got = merkle.manifest(df, "lang", "id", merkle.leaf_hash(
        [F.col("id"), F.col("lang"), F.col("text")]), **args).collect()
    return sorted(((r.lang, r.id, r.leaf, r.subroot, r.root,
                    tuple((s.l, s.r) for s in r.proof)) for r in got), key=repr)


def test_query_matches_sql(spark, queries):
    from souk.llm.queries import ORACLE
    ok, msg, _, _ = compare(spark, duck(SF001), "op11_merkle", queries["op11_merkle"],
                            ORACLE["op11_merkle"], SF001)
    assert ok, msg


@pytest.mark.parametrize("bits", [2, 10])
def test_against_loops(spark, bits):
    """Several roll-ups, odd and even runs, groups of one, five groups."""
    rnd = random.Random(bits)
    rows = [(i, g, f"{rnd.random()} é") for g, n in
            ((None, 1), ("a", 37), ("é", 16), ("Z", 2), ("b", 3)) for i in range(n)]
    rnd.shuffle(rows)
    assert found(spark, rows, bits=bits) == expected(rows)


def test_single_rows(spark):
    for rows in ([(1, "a", "x")], [(1, "a", "x"), (1, "b", None)], [(None, None, None)]):
        assert found(spark, rows) == expected(rows)


def test_nulls_ties_repeated_and_long(spark):
    rows = [(None, "a", "x"), (None, "a", "y"), (3, "a", "same"), (3, "a", "same"),
            (3, "a", "other"), (4, "a", ""), (5, "a", None), (6, "a", "long " * 400_000),
            (7, None, "x")] + [(9, "a", "hot")] * 60
    assert found(spark, rows, bits=3) == expected(rows)


def test_empty_and_clashing(spark, odd):
    leaf = merkle.leaf_hash([F.col("doc_id"), F.col("text")])
    got = merkle.manifest(odd.withColumn("leaf", F.lit("old")), "lang", "doc_id", leaf,
                          keep=["score"])
    assert got.columns == ["lang", "doc_id", "score", "leaf", "subroot", "root", "proof"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.leaf != "old" for r in rows)
    assert merkle.manifest(odd.limit(0), "lang", "doc_id", leaf).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(odd.withColumn("root", F.lit(1)), "lang", "doc_id", leaf, keep=["root"])


def test_tampering_shows(spark):
    rows = [(i, "ab"[i % 2], str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, lang string, text string")

    def leaf(text):
        return merkle.leaf_hash([F.col("id"), text])

    claim = leaf(F.when(F.col("id") % 5 == 0, F.lit("forged")).otherwise(F.col("text")))
    got = merkle.manifest(df, "lang", "id", leaf(F.col("text")), keep=[claim.alias("claim")])
    ok = got.select("id", (merkle.folded("claim", "proof") == F.col("root")).alias("ok")).collect()
    assert {r.id for r in ok if not r.ok} == set(range(0, 50, 5))


def test_no_joins_while_emitting(spark):
    """Proofs come by unions, groupings and explodes; ranks alone look up the
    counts of the ranges before."""
    df = spark.range(3000).select("id", F.concat(F.lit("a"), F.col("id") % 2).alias("lang"))
    got = merkle.manifest(df, "lang", "id", merkle.leaf_hash([F.col("id")]), bits=4)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
