"""SimHash near-duplicates by vantage-point trees over Hamming distance.

Fingerprints: ASCII capitals are lowered, words are runs of non-blanks, and
each run of ``shingle`` words (the whole text if it has fewer) is hashed by
XXH64, seed 42. A bit of the fingerprint is set where over half the hashes
have it; a text without words has fingerprint zero.

Links join fingerprints at most ``max_bits`` apart, exactly:

1. Equal fingerprints collapse into one row (a combinable aggregate), so a
   group of copies of any size costs one row.
2. A vantage-point tree over a bounded sample cuts Hamming space into shards
   of about ``shard_rows`` fingerprints: a node sends a fingerprint inwards if
   it lies within the node's radius of its vantage point, else outwards.
3. Every fingerprint lives in one shard and asks every shard that the ball
   of ``max_bits`` around it overlaps: by the triangle inequality a branch
   whose border is farther away than that cannot hold a partner.
4. A shard's askers are dealt into blocks, so a popular shard is many tasks.
   Each block searches a local vantage-point tree with the same bounds.

A block returns a spanning forest of the links it found: as many connections,
but never all pairs of a dense group. Components come from repeated hops to
the smallest neighbouring fingerprint, checkpointed each round.

How the work grows: fingerprints of unrelated texts lie about 32 bits apart,
so a ball of 4 bits crosses most borders; a level of the tree doubles the
shards and multiplies the asked ones by about 1.7. The search thus takes about
the number of distinct fingerprints to the power 1.75, a small part of the
whole up to tens of millions of texts.

Results for odd input: a null text counts as empty. A component's id is the
smallest non-null id in it, null if there is none; rows without an id still
link. Repeated rows are copies. An empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, pinned, sample_fraction, short_batches, text_of

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAF = 256      # fingerprints in a leaf of a local tree
SAMPLE = 4096   # fingerprints that the tree over the shards is fitted on


# ------------------------------------------------------------ fingerprints ----
def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([h(b" ".join(words), 42)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = [0, *ends[:len(words) - shingle].tolist()]
    last = (ends[shingle - 1:] - 1).tolist()
    return np.fromiter((h(joined[a:b], 42) for a, b in zip(first, last, strict=True)),
                       np.uint64, len(first))


def fingerprint(text: str, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    h = shingle_hashes(text, shingle)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        part = np.ascontiguousarray(h[at:at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text_col: str = "text",
                 out_col: str = "fp") -> DataFrame:
    """Append the fingerprint as a signed long."""
    def start():
        def fn(texts):
            got = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            return [pa.array(got.view(np.int64))]
        return fn

    return map_columns(docs, [text_of(text_col)], start,
                       [T.StructField(out_col, T.LongType(), False)])


# -------------------------------------------------------------------- trees ----
def hamming(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def vantage_point(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """The candidate whose distances spread most, and their median."""
    tries = points[rng.integers(0, len(points), 8)]
    some = points[rng.integers(0, len(points), min(len(points), 256))]
    d = np.bitwise_count(tries[:, None] ^ some[None, :]).astype(np.int16)
    v = tries[int(np.argmax(d.var(axis=1)))]
    return v, int(np.median(hamming(points, v)))


class Tree:
    """A vantage-point tree. ``nodes`` lists (vantage point, radius, inner,
    outer); a child below zero is leaf number -child - 1."""

    def __init__(self, points: np.ndarray, depth: int, seed: int = 7, leaf: int = 1):
        self.nodes: list[list] = []
        self.leaves: list[np.ndarray] = []
        rng = np.random.default_rng(seed)

        def build(at: np.ndarray, left: int) -> int:
            if left == 0 or len(at) <= leaf:
                self.leaves.append(at)
                return -len(self.leaves)
            v, r = vantage_point(points[at], rng)
            d = hamming(points[at], v)
            if not (d > r).any():  # many at the median: the border goes below it
                r -= 1
            inside = d <= r
            if not inside.any() or inside.all():
                self.leaves.append(at)
                return -len(self.leaves)
            k = len(self.nodes)
            self.nodes.append([v, r, 0, 0])
            self.nodes[k][2] = build(at[inside], left - 1)
            self.nodes[k][3] = build(at[~inside], left - 1)
            return k
        self.root = build(np.arange(len(points)), depth)

    def visit(self, queries: np.ndarray, reach: int):
        """Yield (leaf, rows of queries) for every leaf that a ball of radius
        ``reach`` around a query overlaps."""
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            k, rows = todo.pop()
            if not len(rows):
                continue
            if k < 0:
                yield -k - 1, rows
                continue
            v, r, inner, outer = self.nodes[k]
            d = hamming(queries[rows], v)
            todo.append((inner, rows[d <= r + reach]))
            todo.append((outer, rows[d > r - reach]))


class Forest:
    """Union of numbered points, smallest number on top."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def near_links(points: np.ndarray, queries: np.ndarray, max_bits: int,
               all_pairs: bool = False) -> np.ndarray:
    """Rows (a, b) with a > b, a query or point each, linked by the search:
    every pair at most ``max_bits`` apart, or a spanning forest of them."""
    values, where = np.unique(np.concatenate([points, queries]), return_inverse=True)
    at_point, at_query = where[:len(points)], where[len(points):]
    tree = Tree(points, 40, leaf=LEAF)
    forest, out = Forest(len(values)), []
    for leaf, rows in tree.visit(queries, max_bits):
        mine = tree.leaves[leaf]
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            near = hamming(queries[part][:, None], points[mine][None, :]) <= max_bits
            for q, p in zip(*np.nonzero(near), strict=True):
                a, b = int(at_query[part[q]]), int(at_point[mine[p]])
                if a > b and (all_pairs or forest.join(a, b)):
                    out.append((a, b))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return values[pairs]


# ------------------------------------------------------------------- search ----
def links(fps: DataFrame, max_bits: int = 4, shard_rows: int = 1 << 17,
          block_rows: int = 1 << 18, all_pairs: bool = False) -> DataFrame:
    """Links (a, b), signed fingerprints, between the rows of ``fps`` (fp: long,
    distinct): all pairs, or per block a spanning forest of them."""
    spark = fps.sparkSession
    n = fps.count()
    shards = max(1, math.ceil(n / shard_rows))
    depth = math.ceil(math.log2(shards))
    picked = (fps.filter(sample_fraction(F.lit(min(1.0, SAMPLE / max(n, 1))), "fp"))
              .limit(2 * SAMPLE).collect())
    sample = np.array(sorted(r["fp"] for r in picked), np.int64).view(np.uint64)
    top = Tree(sample if len(sample) else np.zeros(1, np.uint64), depth)
    # askers of a shard: its own rows, times 1.7 for each level above it
    blocks = max(1, math.ceil(n / len(top.leaves) * 1.7 ** depth / block_rows))
    schema = "shard int, block int, home boolean, fp long"

    def deal(batches):
        """Each fingerprint once to its home shard, in every block of askers,
        and once to one block of each shard that it must ask."""
        for b in batches:
            signed = b.column(0).to_numpy()
            q = signed.view(np.uint64)
            out = [(leaf, rows, k, True) for leaf, rows in top.visit(q, 0)
                   for k in range(blocks)]
            mixed = q * np.uint64(0x9E3779B97F4A7C15)
            slot = ((mixed >> np.uint64(33)) % np.uint64(blocks)).astype(np.int32)
            out += [(leaf, rows, None, False) for leaf, rows in top.visit(q, max_bits)]
            for leaf, rows, k, home in out:
                m = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, leaf, np.int32)),
                     pa.array(slot[rows] if k is None else np.full(m, k, np.int32)),
                     pa.array(np.full(m, home)), pa.array(signed[rows])],
                    names=["shard", "block", "home", "fp"])

    def search(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        got = near_links(np.sort(fp[home]), np.sort(fp[~home]), max_bits, all_pairs) \
            if home.any() and not home.all() else np.zeros((0, 2), np.uint64)
        return pa.table({"a": got[:, 0].copy().view(np.int64),
                         "b": got[:, 1].copy().view(np.int64)})

    short_batches(spark, 10_000)
    dealt = fps.select("fp").mapInArrow(deal, schema)
    return dealt.groupBy("shard", "block").applyInArrow(search, "a long, b long")


def _signature(pairs: DataFrame) -> tuple:
    """Count and combined hash of a set of pairs."""
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is one node of its
    component. Each round links every node to the smallest node among itself
    and its neighbours, and its neighbours to that too; the number of rounds
    grows with the logarithm of the longest chain."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = pinned(pairs.filter("a <> b").distinct())
    seen = _signature(pairs)
    for _ in range(rounds):
        # large star: larger neighbours and the node itself go to the smallest
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")) \
            .select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.n).filter("b > a") \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and the node itself go to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(low, large.a == low.n) \
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("n").alias("a"), F.col("m").alias("b"))))
                    .alias("p")).select("p.a", "p.b").filter("a <> b").distinct()
        pairs, before = pinned(small), seen
        seen = _signature(pairs)
        if before == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))) \
        .distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, fp, component_id) per input row."""
    rows = pinned(fingerprints(docs.select(F.col(id_col).alias("id"),
                                           F.col(text_col).alias("text")),
                               shingle).select("id", "fp"))
    groups = pinned(rows.groupBy("fp").agg(F.min("id").alias("low")))
    found = components(links(groups.select("fp"), max_bits))
    named = found.join(groups, found.node == groups.fp).groupBy("root") \
        .agg(F.min("low").alias("of_root"))
    better = found.join(named, "root").select(F.col("node").alias("fp"), "of_root")
    of = groups.join(better, "fp", "left") \
        .select("fp", F.coalesce("of_root", "low").alias("component_id"))
    return rows.join(of, "fp").select("id", "fp", "component_id")
