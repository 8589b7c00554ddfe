"""Hard negatives by a multiway hyperplane tree (after Brin's GNAT).

Vectors become integers, so a score (inner product) is exact. Adding to every
row the coordinate sqrt(M - |v|^2), M the largest squared length, puts all rows
on one sphere; an anchor gets zero there. Its squared distance to a row is then
|a|^2 + M - 2 * score: a window of scores is an annulus around the anchor.

1. A tree over a bounded sample (``SAMPLE`` rows) deals all rows: a node has up
   to ``WAYS`` split points, far from each other, and a row goes to the nearest
   (a cell bounded by hyperplanes), level by level. A leaf is a shard; a shard
   with many rows is dealt into blocks, so that one vector repeated a million
   times is many tasks.
2. Every split point stores the range of its distances to the rows of each of
   its siblings' subtrees, over all rows (minima and maxima combined before the
   shuffle; the tree is bounded by the sample, so they are collected).
3. An anchor walks down the tree. At a node it measures its distance x to a
   split point; by the triangle inequality a sibling whose range is [lo, hi]
   holds only rows at distances within [max(lo - x, x - hi), x + hi]. A sibling
   whose interval misses every annulus of the anchor is eliminated. The anchor
   is sent to the shards that are left, to all their blocks.
4. A block builds a tree of its own the same way, its anchors walk it, and in
   the leaves all scores are computed and compared exactly.

There are two searches: each anchor's nearest rows of its label (the annulus
reaches outwards to the worst of the positives found so far), then for each
positive a window of scores. The sample, which is at hand while dealing, gives
each anchor its first bounds. Anchors x rows of the shards left is what the
search costs; in many dimensions without structure nothing can be eliminated
and each anchor meets each row, in blocks.

Results for odd input: rows with a null label, a null vector or a null or
non-finite component take no part. Shorter vectors count as if they ended in
zeros; the empty vector is one of zeros. Rows are told apart by their place, so
a repeated row is another row. Null ids are no anchors and come last among
equal scores (the largest long stands for them). Scores must fit a long:
vectors whose squared length does not raise an error. An empty table gives an
empty result. Only id, label and vector are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pinned, sample_fraction, short_batches

SAMPLE = 4096         # rows that the tree over the shards is fitted on
WAYS = 8              # split points of a node
SHARD_ROWS = 1 << 14
BLOCK_ROWS = 1 << 14
ANCHOR_ROWS = 1 << 13
LEAF = 512            # rows in a leaf of a block's tree
NO_ID = np.iinfo(np.int64).max


# ------------------------------------------------------------------ vectors ----
def to_integers(rows: DataFrame, id_col: str, label_col: str, vector_col: str,
                scale: int) -> tuple[DataFrame, str]:
    """(row, id, label, vec) and the kind of integer that ``vec`` holds: the
    smallest that has room for every floor(scale * x)."""
    v = F.col("v")
    fit = F.col("label").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = rows.select(F.col(id_col).cast("long").alias("id"),
                      F.col(label_col).cast("long").alias("label"),
                      F.col(vector_col).cast("array<double>").alias("v")).filter(fit)
    most = src.agg(F.max(F.greatest(F.abs(F.array_max(v)), F.abs(F.array_min(v))))).first()[0]
    most = (most or 0.0) * scale + 1
    if most >= 2.0 ** 31:
        raise ValueError("a vector is too long: its scores do not fit a long")
    kind = "<i2" if most < 1 << 15 else "<i4"
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column(2)
            x = np.floor(vecs.flatten().to_numpy(zero_copy_only=False) * float(scale))
            ends = np.concatenate([[0], np.cumsum(vecs.value_lengths().to_numpy())]) * width
            data = x.astype(kind).tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([data[a:e] for a, e in zip(ends[:-1], ends[1:], strict=True)],
                          pa.binary())], names=["id", "label", "vec"])

    short_batches(rows.sparkSession, 2048)
    got = pinned(src.mapInArrow(run, "id long, label long, vec binary"))
    return got.withColumn("row", F.monotonically_increasing_id()), kind


class Points:
    """Integer rows on the sphere of squared radius ``top``."""

    def __init__(self, vecs: np.ndarray, top: int):
        self.vecs, self.top = vecs, top
        self.real = vecs.astype(np.float64)
        self.norm = (self.real ** 2).sum(axis=1)
        self.lift = np.sqrt(np.maximum(top - self.norm, 0.0))

    def scores(self, mine: np.ndarray, others: Points, theirs: np.ndarray) -> np.ndarray:
        """Exact: sums of products below 2 ** 52 are so in doubles."""
        if self.top < 1 << 52:
            return (self.real[mine] @ others.real[theirs].T).astype(np.int64)
        return self.vecs[mine] @ others.vecs[theirs].T

    def distances(self, mine: np.ndarray, others: Points, theirs: np.ndarray) -> np.ndarray:
        """Distances on the sphere. From exact scores and element by element, so
        that a row has the same ones, and the same home, in any batch."""
        dot = self.scores(mine, others, theirs) + self.lift[mine][:, None] * others.lift[theirs]
        return np.sqrt(np.maximum(2.0 * self.top - 2.0 * dot, 0.0))

    def distances_asked(self, mine: np.ndarray, others: Points, theirs: np.ndarray) -> np.ndarray:
        """Distances of anchors, whose own last coordinate is zero."""
        s = self.scores(mine, others, theirs).astype(np.float64)
        return np.sqrt(np.maximum(self.norm[mine][:, None] + self.top - 2.0 * s, 0.0))


class Reader:
    """Vectors as points, shorter ones padded with zeros."""

    def __init__(self, kind: str, dims: int, top: int = 0):
        self.kind, self.dims, self.top = kind, dims, top

    def matrix(self, vecs: list[bytes]) -> np.ndarray:
        size = np.dtype(self.kind).itemsize * self.dims
        data = b"".join(v if len(v) == size else v.ljust(size, b"\0") for v in vecs)
        return np.frombuffer(data, self.kind).reshape(len(vecs), self.dims).astype(np.int64)

    def points(self, vecs: list[bytes]) -> Points:
        return Points(self.matrix(vecs), self.top)


# --------------------------------------------------------------------- tree ----
class Tree:
    """``nodes`` lists (split points, children, lo, hi): lo[i, j] and hi[i, j]
    bound the distances of split point i to the rows below child j. A child
    below zero is leaf number -child - 1."""

    def __init__(self, points: Points, leaf: int, ways: int = WAYS, depth: int = 40):
        self.nodes: list[list] = []
        self.leaves: list[np.ndarray] = []
        self.points = points
        rng = np.random.default_rng(11)

        def build(at: np.ndarray, left: int) -> int:
            split = self._split(at, ways, rng) if left and len(at) > leaf else []
            if len(split) < 2:
                self.leaves.append(at)
                return -len(self.leaves)
            d = points.distances(split, points, at)
            near = d.argmin(axis=0)
            k = len(self.nodes)
            inside = [d[:, near == j] for j in range(len(split))]
            self.nodes.append([split, [], np.array([x.min(axis=1) for x in inside]).T,
                               np.array([x.max(axis=1) for x in inside]).T])
            self.nodes[k][1] = [build(at[near == j], left - 1) for j in range(len(split))]
            return k

        self.root = build(np.arange(len(points.vecs)), depth)

    def _split(self, at: np.ndarray, ways: int, rng: np.random.Generator) -> np.ndarray:
        """Split points picked one after another, each farthest from those before."""
        some = at[rng.integers(0, len(at), 4 * ways)]
        chosen = [int(some[0])]
        far = self.points.distances(some[:1], self.points, some)[0]
        while len(chosen) < ways and far.max() > 1e-6 * math.sqrt(max(self.points.top, 1)):
            chosen.append(int(some[far.argmax()]))
            far = np.minimum(far, self.points.distances(np.array(chosen[-1:]), self.points,
                                                        some)[0])
        return np.array(chosen)

    def forget_ranges(self) -> None:
        for node in self.nodes:
            node[2] = np.full_like(node[2], np.inf)
            node[3] = np.full_like(node[3], -np.inf)

    def home(self, points: Points) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """The leaf of each row, and the ranges its node's split points have."""
        leaf, seen = np.zeros(len(points.vecs), np.int64), []
        todo = [(self.root, np.arange(len(points.vecs)))]
        while todo:
            k, rows = todo.pop()
            if not len(rows):
                continue
            if k < 0:
                leaf[rows] = -k - 1
                continue
            split, kids = self.nodes[k][:2]
            d = self.points.distances(split, points, rows)
            near = d.argmin(axis=0)
            lo = np.full((len(split), len(split)), np.inf)
            hi = -lo
            for j in range(len(split)):
                mine = near == j
                if mine.any():
                    lo[:, j], hi[:, j] = d[:, mine].min(axis=1), d[:, mine].max(axis=1)
                    todo.append((kids[j], rows[mine]))
            seen.append((k, lo, hi))
        return leaf, seen

    def visit(self, anchors: Points, near: np.ndarray, far: np.ndarray):
        """Yield (leaf, anchors) for the leaves that may hold rows in an annulus:
        ``near`` and ``far`` hold one per anchor and window. An annulus with near
        > far asks for nothing."""
        slack = 1e-5 * math.sqrt(max(self.points.top, 1))  # far above rounding
        todo = [(self.root, np.arange(len(anchors.vecs)))]
        while todo:
            k, rows = todo.pop()
            if not len(rows):
                continue
            if k < 0:
                yield -k - 1, rows
                continue
            split, kids, lo, hi = self.nodes[k]
            x = anchors.distances_asked(rows, self.points, split)
            least = np.maximum(lo[None] - x[:, :, None], x[:, :, None] - hi[None]).max(axis=1)
            most = (x[:, :, None] + hi[None]).min(axis=1)
            for j, kid in enumerate(kids):
                ok = ((near[rows] <= most[:, j, None] + slack)
                      & (far[rows] >= least[:, j, None] - slack)
                      & (near[rows] <= far[rows])).any(axis=1)
                todo.append((kid, rows[ok]))


# ------------------------------------------------------------- exact search ----
class Wanted:
    """Per anchor one or more windows of scores, and the best rows found in
    each: score descending, then id."""

    def __init__(self, anchors: Points, label: np.ndarray, row: np.ndarray,
                 low: np.ndarray, high: np.ndarray, keep: int, same: bool):
        self.anchors, self.label, self.row = anchors, label, row
        self.low, self.high, self.keep, self.same = low, high, keep, same
        self.bound = low.copy()  # no score below it can be among the best
        nothing = np.zeros(0, np.int64)
        self.found = [nothing] * 4  # anchor, window, score, place in ids
        self.ids = nothing

    def annuli(self) -> tuple[np.ndarray, np.ndarray]:
        base = self.anchors.norm[:, None] + self.anchors.top
        far = np.sqrt(np.maximum(base - 2.0 * self.bound, 0.0))
        near = np.sqrt(np.maximum(base - 2.0 * self.high.astype(np.float64), 0.0))
        empty = self.bound > self.high
        return np.where(empty, np.inf, near), np.where(empty, -np.inf, far)

    def offer(self, mine: np.ndarray, points: Points, label: np.ndarray, row: np.ndarray,
              ids: np.ndarray, at: np.ndarray) -> None:
        """Compare the rows ``at`` of ``points`` with the anchors ``mine``."""
        for a in range(0, len(mine), 512):
            part = mine[a:a + 512]
            s = self.anchors.scores(part, points, at)
            ok = label[at][None] == self.label[part][:, None]
            ok = (ok if self.same else ~ok) & (row[at][None] != self.row[part][:, None])
            new = []
            for w in range(self.low.shape[1]):
                hit = ok & (s >= self.bound[part, w][:, None]) & (s <= self.high[part, w][:, None])
                i, j = np.nonzero(hit)
                new.append([part[i], np.full(len(i), w), s[i, j], ids[at[j]]])
            self.take([np.concatenate(x) for x in zip(*new, strict=True)])

    def take(self, new: list[np.ndarray]) -> None:
        if not len(new[0]):
            return
        a, w, s, i = (np.concatenate(x) for x in zip(self.found, new, strict=True))
        order = np.lexsort((i, -s, w, a))
        group = a[order] * self.low.shape[1] + w[order]
        first = np.searchsorted(group, group, side="left")
        nth = np.arange(len(group)) - first
        kept = order[nth < self.keep]
        self.found = [a[kept], w[kept], s[kept], i[kept]]
        full = order[nth == self.keep - 1]
        self.bound[a[full], w[full]] = np.maximum(self.bound[a[full], w[full]], s[full])


def _square(points: Points) -> tuple[np.ndarray, np.ndarray]:
    """A window open on both sides for each anchor (scores are below 2 ** 62)."""
    n = len(points.vecs)
    return np.full((n, 1), -(1 << 62), np.int64), np.full((n, 1), 1 << 62, np.int64)


class Index:
    """Pinned rows, the tree over the shards and the blocks of each shard."""

    def __init__(self, rows: DataFrame, kind: str, shard_rows: int, block_rows: int,
                 sample: int):
        self.rows, self.block_rows = rows, block_rows
        n, size = rows.agg(F.count("*"), F.max(F.length("vec"))).first()
        self.reader = Reader(kind, (size or 0) // np.dtype(kind).itemsize)
        picked = rows.filter(sample_fraction(F.lit(min(1.0, sample / max(n, 1))), "row")) \
            .orderBy(F.xxhash64("row"), "row").limit(sample).collect()
        self.label = np.array([r["label"] for r in picked], np.int64)
        self.row = np.array([r["row"] for r in picked], np.int64)
        self.ids = np.array([NO_ID if r["id"] is None else r["id"] for r in picked], np.int64)
        self.reader.top = self._largest()
        self.tree = Tree(self.reader.points([bytes(r["vec"]) for r in picked]), leaf=1,
                         depth=max(0, math.ceil(math.log(max(1.0, n / shard_rows), WAYS))))
        self.tree.forget_ranges()
        self._measure()

    def _largest(self) -> int:
        """The largest squared length."""
        reader = self.reader

        def run(batches):
            for b in batches:
                v = reader.matrix(b.column(0).to_pylist())
                if len(v) and (v.astype(np.float64) ** 2).sum(axis=1).max() >= 2.0 ** 62:
                    raise ValueError("a vector is too long: its scores do not fit a long")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((v * v).sum(axis=1).max()) if len(v) else 0])], names=["m"])

        short_batches(self.rows.sparkSession, 4096)
        return self.rows.select("vec").mapInArrow(run, "m long").agg(F.max("m")).first()[0] or 0

    def _measure(self) -> None:
        """Ranges of distances over all rows, and the rows of each shard."""
        tree, reader = self.tree, self.reader

        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                leaf, seen = tree.home(reader.points(b.column(0).to_pylist()))
                out = [(-1, s, 0, float(c), 0.0) for s, c in enumerate(np.bincount(leaf)) if c]
                for k, lo, hi in seen:
                    out += [(k, i, j, lo[i, j], hi[i, j]) for i, j in np.argwhere(hi >= 0).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()),
                        strict=True)], names=["k", "i", "j", "lo", "hi"])

        short_batches(self.rows.sparkSession, 4096)
        got = self.rows.select("vec").mapInArrow(run, "k int, i int, j int, lo double, hi double") \
            .groupBy("k", "i", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                        F.sum("lo").alias("rows")).collect()
        sizes = np.zeros(len(tree.leaves), np.int64)
        for r in got:
            if r["k"] < 0:
                sizes[r["i"]] = int(r["rows"])
            else:
                tree.nodes[r["k"]][2][r["i"], r["j"]] = r["lo"]
                tree.nodes[r["k"]][3][r["i"], r["j"]] = r["hi"]
        self.blocks = np.maximum(1, -(-sizes // self.block_rows))

    def search(self, anchors: DataFrame, keep: int, same: bool, anchor_rows: int) -> DataFrame:
        """(row, w, score, id): for each anchor (row, label, vec, low, high: arrays
        of window bounds, null for one open window) the best ``keep`` rows of the
        same or of other labels in each window."""
        spark, reader, tree, blocks = self.rows.sparkSession, self.reader, self.tree, self.blocks
        sample = (self.label, self.row, self.ids)
        # the blocks of anchors: as many as if all of them asked one shard
        lots = max(1, -(-anchors.count() // anchor_rows))
        names = ["shard", "block", "lot", "home", "row", "id", "label", "vec", "low", "high"]
        wide = T.ArrayType(T.LongType())

        def wanted(vecs, label, row, low, high) -> Wanted:
            points = reader.points(vecs)
            if low[0] is None:
                lo, hi = _square(points)
            else:
                lo, hi = np.array(low, np.int64), np.array(high, np.int64)
            return Wanted(points, label, row, lo, hi, keep, same)

        def emit(shard, block, lot, home, b, rows):
            n, take = len(rows), pa.array(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(block, pa.int32()),
                 pa.array(lot, pa.int32()), pa.array(np.full(n, home)),
                 *[b.column(c).take(take) for c in range(6)]], names=names)

        def deal_rows(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                shard, _ = tree.home(reader.points(b.column(3).to_pylist()))
                block = _mixed(b.column(0).to_numpy()) % blocks[shard].astype(np.uint64)
                every = np.arange(b.num_rows)
                for lot in range(lots):
                    yield emit(shard, block.astype(np.int32), np.full(len(every), lot), True, b,
                               every)

        def deal_anchors(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                row, label = b.column(0).to_numpy(), b.column(2).to_numpy()
                want = wanted(b.column(3).to_pylist(), label, row, b.column(4).to_pylist(),
                              b.column(5).to_pylist())
                if len(sample[0]):  # bounds by rows that are at hand
                    want.offer(np.arange(len(row)), tree.points, *sample,
                               np.arange(len(sample[0])))
                lot = (_mixed(row) % np.uint64(lots)).astype(np.int32)
                for shard, mine in tree.visit(want.anchors, *want.annuli()):
                    for block in range(blocks[shard]):
                        yield emit(np.full(len(mine), shard), np.full(len(mine), block), lot[mine],
                                   False, b, mine)

        def block_search(table: pa.Table) -> pa.Table:
            home = table.column("home").to_numpy(zero_copy_only=False)
            at, ask = np.nonzero(home)[0], np.nonzero(~home)[0]
            out = [np.zeros(0, np.int64)] * 4
            if len(at) and len(ask):
                mine, theirs = table.take(at), table.take(ask)
                order = np.argsort(mine.column("row").to_numpy())
                mine = mine.take(order)
                points = reader.points(mine.column("vec").to_pylist())
                label, row = mine.column("label").to_numpy(), mine.column("row").to_numpy()
                ids = mine.column("id").fill_null(NO_ID).to_numpy()
                local = Tree(points, LEAF)
                arow = theirs.column("row").to_numpy()
                want = wanted(theirs.column("vec").to_pylist(), theirs.column("label").to_numpy(),
                              arow, theirs.column("low").to_pylist(),
                              theirs.column("high").to_pylist())
                for leaf, askers in local.visit(want.anchors, *want.annuli()):
                    want.offer(askers, points, label, row, ids, local.leaves[leaf])
                a, w, s, i = want.found
                out = [arow[a], w, s, i]
            return pa.table({"row": out[0], "w": out[1].astype(np.int32), "score": out[2],
                             "id": out[3]})

        schema = T.StructType([T.StructField(c, T.IntegerType()) for c in names[:3]] + [
            T.StructField("home", T.BooleanType()), T.StructField("row", T.LongType()),
            T.StructField("id", T.LongType()), T.StructField("label", T.LongType()),
            T.StructField("vec", T.BinaryType()), T.StructField("low", wide),
            T.StructField("high", wide)])
        short_batches(spark, 4096)
        none = F.lit(None).cast(wide)
        cols = ["row", "id", "label", "vec"]
        dealt = self.rows.select(*cols, none.alias("low"), none.alias("high")) \
            .mapInArrow(deal_rows, schema).unionByName(
                anchors.select(*cols, "low", "high").mapInArrow(deal_anchors, schema))
        found = dealt.groupBy("shard", "block", "lot").applyInArrow(
            block_search, "row long, w int, score long, id long")
        best = Window.partitionBy("row", "w").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)


def _mixed(rows: np.ndarray) -> np.ndarray:
    return (rows.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low_pct: int = 30, high_pct: int = 90, scale: int = 256,
                   id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
                   block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS,
                   sample: int = SAMPLE) -> DataFrame:
    """For each anchor (``is_anchor``, over the column ``id``) and each of its
    first ``positives`` rows of the same label the first ``negatives`` rows of
    another label whose score is between ``low_pct`` and ``high_pct`` percent of
    the positive's: (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). Percentages are at least 0."""
    index = Index(*to_integers(rows, id_col, label_col, vector_col, scale), shard_rows,
                  block_rows, sample)
    wide = "array<long>"
    anchors = pinned(index.rows.filter(is_anchor))
    near = index.search(anchors.withColumns({c: F.lit(None).cast(wide) for c in ("low", "high")}),
                        positives, True, anchor_rows)
    # at most ``positives`` elements a row; missing ones become empty windows
    p = F.sort_array(F.collect_list(F.struct("rank", "score", "id")))
    near = pinned(near.groupBy("row").agg(p.alias("p")))
    score = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)),
                        lambda i: F.get("p", i)["score"])
    # the least integer >= low_pct * s / 100 and the largest <= high_pct * s / 100;
    # a negative score leaves an empty window, and so does an absent positive

    def share(s: Column, pct: int, to: Callable[[Column], Column]) -> Column:
        return to(s.cast("decimal(19,0)") * pct / 100).cast("long")

    low = F.transform(score, lambda s: F.coalesce(share(s, low_pct, F.ceil), F.lit(0)))
    high = F.transform(score, lambda s: F.coalesce(share(s, high_pct, F.floor), F.lit(-1)))
    asked = pinned(anchors.join(near, "row").withColumns({"low": low, "high": high}))
    found = index.search(asked, negatives, False, anchor_rows)
    named = asked.select("row", F.col("id").alias("anchor_id"), "p")
    hit = found.join(named, "row").withColumn("of", F.get("p", F.col("w")))

    def shown(c: Column) -> Column:
        return F.when(c != int(NO_ID), c)

    return hit.select("anchor_id", shown(F.col("of.id")).alias("positive_id"),
                      F.col("rank").cast("int").alias("rank"), shown(F.col("id")).alias("negative_id"),
                      F.col("of.score").alias("positive_score"),
                      F.col("score").alias("negative_score"))
