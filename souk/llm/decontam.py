"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters is found wherever a stretch of a text is within
``floor(rate * m)`` edits of it. Cut into one piece more than that, at least
one piece stands unchanged in every such stretch: an Aho-Corasick automaton
over all items' pieces finds the exact piece hits, and Myers' bit-parallel
edit distance verifies the stretch around each. Overlapping stretches of an
item are verified as one, so a text costs at most its length per item hit.

Letters A-Z compare in lower case and each ASCII blank as a space, which keeps
offsets (code points). Distinct item texts are taken in blocks of bounded size,
each sent to the executors whole, and the ids of a text joined to its finds; every text meets every block. An item with fewer than
``min_chars`` characters is found as it is only, between word boundaries.

Results for odd input: null and empty texts hold nothing; items without text
and short ones of blanks only are not searched. Equal items each get their own row, repeated document
rows theirs. A null doc_id or item_id stays null. An empty table on either side
gives no row. Only the id and text columns are read, so other names don't clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, arrow_type, blocks_for, map_columns, short_batches, text_of

BLOCK_CHARS = 2_000_000  # characters of items that are searched in one pass
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def folded(text: str) -> str:
    return text.encode("utf-8", "replace").translate(_FOLD).decode("utf-8")


def budget(length: int, rate: float) -> int:
    return int(length * rate + 1e-9)


def myers(masks: dict[str, int], m: int, text: str, free_start: bool = True) -> tuple[int, int]:
    """Least edit distance of a pattern to a stretch of ``text`` and the first
    end where it is met; the stretch starts anywhere, or at 0 if not free."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full if free_start else ((ph << 1) | 1) & full
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score < best:
            best, at = score, j
    return best, at


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word goes on across either end of a stretch."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()
                   for at in (start, end))


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Searcher:
    """Automaton and patterns of one block of item texts."""

    def __init__(self, items: list[str], rate: float, min_chars: int = 0):
        import ahocorasick
        self.items = [(t, folded(t)) for t in items]
        self.short = [len(t) < min_chars for _, t in self.items]
        self.edits = [0 if s else budget(len(t), rate)
                      for s, (_, t) in zip(self.short, self.items, strict=True)]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t) in enumerate(self.items):
            parts = self.edits[n] + 1
            cuts = [len(t) * j // parts for j in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(t[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()
        self.masks: dict[int, tuple[dict, dict]] = {}

    def verify(self, n: int, text: str, lo: int, hi: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the best match within text[lo:hi]."""
        word, k = self.items[n][1], self.edits[n]
        at = text.find(word, lo, hi)
        while at >= 0 and self.short[n] and not whole_words(text, at, at + len(word)):
            at = text.find(word, at + 1, hi)
        if at >= 0:
            return 0, at, at + len(word)
        if not k:
            return None
        if n not in self.masks:
            self.masks[n] = masks_of(word), masks_of(word[::-1])
        there, back = self.masks[n]
        d, end = myers(there, len(word), text[lo:hi])
        if d > k:
            return None
        head = text[lo:lo + end][::-1][:len(word) + k]
        _, size = myers(back, len(word), head, free_start=False)
        return d, lo + end - size, lo + end

    def search(self, text: str) -> list[tuple]:
        """(item, distance, start, end): the best match of each item found."""
        text = folded(text)
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, offset in where:
                k, m = self.edits[n], len(self.items[n][1])
                lo = max(0, last + 1 - size - offset - k)
                hi = last + 1 - size - offset + m + k
                mine = windows.setdefault(n, [])
                if mine and mine[-1][0] <= lo <= mine[-1][1]:
                    mine[-1][1] = max(hi, mine[-1][1])
                elif mine and lo <= mine[-1][0] <= hi:
                    mine[-1] = [lo, max(hi, mine[-1][1])]
                else:
                    mine.append([lo, hi])
        out = []
        for n in sorted(windows):
            found = [v for v in (self.verify(n, text, lo, hi) for lo, hi in windows[n]) if v]
            if found:
                out.append((n, *min(found)))
        return out


_SEARCHERS: dict[tuple, Searcher] = {}


def item_blocks(items: DataFrame, text_col: str, min_chars: int) -> Iterator[list[str]]:
    """The distinct searchable texts, a block of bounded size at a time."""
    rows = items.select(text_of(text_col).alias("t")) \
        .filter((F.length("t") >= min_chars) | F.col("t").rlike(WORD)).distinct()
    chars = rows.agg(F.sum(F.length("t").cast("long"))).first()[0] or 0
    blocks = blocks_for(chars, BLOCK_CHARS)
    part = F.pmod(F.xxhash64("t"), F.lit(blocks))
    for b in range(blocks):
        got = rows.filter(part == b).collect()
        if got:
            yield sorted(r["t"] for r in got)


def _searcher(shared, key: str) -> Searcher:
    if key not in _SEARCHERS:
        _SEARCHERS.clear()  # one block's automaton at a time in a worker
        _SEARCHERS[key] = Searcher(*shared.value)
    return _SEARCHERS[key]


def find(docs: DataFrame, items: DataFrame, rate: float = 0.08, min_chars: int = 20,
         doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, distance,
    match_start, match_end (of the first best match)."""
    spark = docs.sparkSession
    short_batches(spark)
    ids, item_ids = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    schema = T.StructType([T.StructField("doc_id", ids), T.StructField("item_id", item_ids),
                           T.StructField("distance", T.IntegerType()),
                           T.StructField("match_start", T.LongType()),
                           T.StructField("match_end", T.LongType())])
    hit_schema = T.StructType([schema["doc_id"], T.StructField("t", T.StringType()), *schema[2:]])
    kinds = [arrow_type(f.dataType) for f in hit_schema]
    rows = docs.select(F.col(doc_id).alias("id"), text_of(doc_text).alias("t"))
    out = spark.createDataFrame([], hit_schema)
    for block in item_blocks(items, item_text, min_chars):
        shared, key = spark.sparkContext.broadcast((block, rate, min_chars)), uuid.uuid4().hex

        def run(batches, shared=shared, key=key):
            s = _searcher(shared, key)
            for b in batches:
                ids = b.column(0)
                got = [(i, *hit) for i, t in enumerate(b.column(1)) for hit in s.search(t.as_py())]
                at = pa.array([g[0] for g in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at).cast(kinds[0]),
                     pa.array([s.items[g[1]][0] for g in got], kinds[1])]
                    + [pa.array([g[j] for g in got], kinds[j]) for j in (2, 3, 4)],
                    names=hit_schema.names)

        out = out.unionByName(rows.mapInArrow(run, hit_schema))
    owners = items.select(F.col(item_id).alias("item_id"), text_of(item_text).alias("t"))
    return out.join(owners, "t").select(*schema.names)


def clean(docs: DataFrame, items: DataFrame, rate: float = 0.08, min_chars: int = 20,
          doc_text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    spark, names, flag = docs.sparkSession, docs.columns, "__holds_item__"
    for block in item_blocks(items, item_text, min_chars):
        shared, key = spark.sparkContext.broadcast((block, rate, min_chars)), uuid.uuid4().hex

        def start(shared=shared, key=key):
            s = _searcher(shared, key)
            return lambda texts: [np.array([bool(s.search(t.as_py())) for t in texts], bool)]

        docs = map_columns(docs, [text_of(doc_text)], start,
                           [T.StructField(flag, T.BooleanType(), False)]) \
            .filter(~F.col(flag)).select(*names)
    return docs
