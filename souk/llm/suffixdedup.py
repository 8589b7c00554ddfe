"""Exact substring dedup by common-prefix interval trees.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller id is removed (strings are bytes, never cross documents, and are
judged on the input). The work is dealt out by content:

1. Documents are packed into compressed blocks of about BLOCK bytes, each made
   from one input partition. One exchange of the blocks serves all passes.
2. Each window of ``length`` bytes has an anchor value: the smallest hash of
   the GRAM-byte grams in it. Equal windows have equal anchors, and neighbours
   mostly share one, so a block holds few values. Values go to their bucket;
   those met in one document only are dropped there.
3. Windows in a row with one repeated anchor make a segment. A block sends
   each distinct segment once, with the smallest id that has it, to the
   anchor's bucket. An anchor met very often (HOT) sends its windows one by
   one, dealt by their content, so that no bucket depends on one passage.
4. A bucket merges equal segments. Where an anchor has several, it builds an
   enhanced suffix array of their windows that two documents have (equal windows
   are found by hash and verified by their bytes) and scans the common-prefix
   intervals with a stack: each interval that is left-diverse (not all
   occurrences follow the same byte) is a maximal repeat group with all its
   occurrences; one that is not is part of a longer group to its left. Within a
   group every occurrence but those of the smallest id is covered.
5. Each block gets the verdicts on its segments and cuts its documents.

A passage that a third of all documents share costs each block one segment,
and so do copies. Blocks and buckets have bounded sizes; only one document is
never split.

Results for odd input: a null text is empty; texts shorter than ``length``
lose nothing. Rows with equal ids do not remove each other's text; a row with a
null id takes no part (it removes and loses nothing). An empty table gives an
empty table. Only the id (a whole number) and the text are read, so other names
don't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks_for, short_batches, text_of

BLOCK = 4 << 20          # bytes of text in a block
BUCKET_BYTES = 12 << 20  # bytes of text whose anchors share a bucket
GRAM = 16
HOT = 20_000             # runs of an anchor beyond which it is dealt by window
SLICE = 1 << 20          # window starts whose anchors are found at a time
NO_ID = np.iinfo(np.int64).max


# ------------------------------------------------------------------- formats ----
def _zip(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(r) for r in raw], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(raw))


def _unzip(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = 8 * len(kinds)
    ends = n + np.cumsum(np.frombuffer(raw[:n], np.int64))
    starts = [n, *ends[:-1].tolist()]
    return [np.frombuffer(raw, k, (int(e) - int(s)) // np.dtype(k).itemsize, int(s))
            for k, s, e in zip(kinds, starts, ends, strict=True)]


# ------------------------------------------------------------------- anchors ----
def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (w - size)], h[w - size:]) if size < w else h


def window_anchors(buf: np.ndarray, length: int) -> np.ndarray:
    """Anchor value (48 bits, even) of the window at each start."""
    n = len(buf) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    out = []
    for at in range(0, n, SLICE):
        k = min(SLICE, n - at) + length - GRAM  # grams in this slice
        words = np.ndarray((k + 8,), "<u8", buffer=padded.data, offset=at, strides=(1,))
        h = words[:k] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out.append(_window_min(h >> np.uint64(16), length - GRAM + 1) & ~np.uint64(1))
    return np.concatenate(out)


class Block:
    """Documents of a block and their runs: windows in a row, one anchor."""

    def __init__(self, ids: np.ndarray, lens: np.ndarray, data: np.ndarray, length: int):
        self.ids, self.lens, self.length, self.data = ids, lens, length, data
        self.starts = np.cumsum(lens) - lens
        ends = self.starts + lens
        values = window_anchors(data, length)
        valid = np.zeros(len(values) + 1, np.int32)
        use = (lens >= length) & (ids != NO_ID)
        np.add.at(valid, self.starts[use], 1)
        np.add.at(valid, ends[use] - length + 1, -1)
        at = np.nonzero(np.cumsum(valid[:-1]) > 0)[0]
        v = values[at]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (v[1:] != v[:-1])
        first = np.nonzero(new)[0]
        last = np.append(first[1:], len(at)) - 1
        self.first, self.last = at[first], at[last[:len(first)]]  # window starts
        self.value = v[first]
        self.doc = np.searchsorted(self.starts, self.first, side="right") - 1
        # empty documents share their start with the next: take the one with text
        self.hot = np.zeros(len(self.first), bool)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct values, runs of each, and whether two documents have it."""
        order = np.argsort(self.value, kind="stable")
        v, d = self.value[order], self.doc[order]
        at = np.nonzero(np.append(True, v[1:] != v[:-1]))[0] if len(v) else np.zeros(0, np.int64)
        if not len(at):
            return v, np.zeros(0, np.int64), np.zeros(0, bool)
        runs = np.diff(np.append(at, len(v)))
        return v[at], runs, np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)

    def keep_repeated(self, repeated: np.ndarray) -> None:
        """Keep the runs whose value is in the sorted list; its low bit is HOT."""
        if len(repeated):
            where = np.searchsorted(repeated, self.value)
            where[where == len(repeated)] = 0
            hit = repeated[where] & ~np.uint64(1) == self.value
            self.hot = (repeated[where] & np.uint64(1)).astype(bool)[hit]
        else:
            hit = np.zeros(len(self.value), bool)
            self.hot = hit[:0]
        self.first, self.last = self.first[hit], self.last[hit]
        self.value, self.doc = self.value[hit], self.doc[hit]

    def segments(self, buckets: int):
        """Distinct segments by bucket, in a fixed order, and all occurrences:
        ({bucket: [[bytes, anchor, smallest id]]}, [(doc, start, end, segment)])."""
        raw, n = self.data.tobytes(), self.length
        found: dict[bytes, list] = {}
        by_bucket: dict[int, list] = {}
        places = []
        doc_ids = self.ids[self.doc].tolist()
        for a, b, v, hot, d, i in zip(self.first.tolist(), self.last.tolist(),
                                      self.value.tolist(), self.hot.tolist(),
                                      self.doc.tolist(), doc_ids, strict=True):
            for s, e in ([(a, b + n)] if not hot else [(k, k + n) for k in range(a, b + 1)]):
                word = raw[s:e]
                seg = found.get(word)
                if seg is None:
                    key = xxhash.xxh64_intdigest(word) >> 16 | 1 if hot else v
                    seg = found[word] = [word, key, i]
                    by_bucket.setdefault((key >> 1) % buckets, []).append(seg)
                elif i < seg[2]:
                    seg[2] = i
                places.append((d, s, e, seg))
        return by_bucket, places


# ------------------------------------------------------- enhanced suffix array ----
def equal_windows(buf: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes at each of ``starts``."""
    words = np.ndarray((len(buf) - 7,), "<u8", buffer=buf.data, strides=(1,))
    h = np.zeros(len(starts), np.uint64)
    for at in [*range(0, length - 7, 8), max(length - 8, 0)]:
        h ^= words[starts + at]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0xD6E8FEB86659FD93)


def suffix_array(buf: np.ndarray, starts: np.ndarray, left: np.ndarray,
                 group: np.ndarray | None = None, depth: int = 0) -> np.ndarray:
    """Order of the suffixes at ``starts``, each ``left`` bytes long (numbers of
    ``starts``). Eight bytes are compared a round, and only suffixes that still
    tie with another go into the next. Stretches are parted by eight bytes
    0xFF, which UTF-8 never has, so a suffix that ends within a word ties with
    its equals only. One that ends with the word ties with longer ones too: it
    goes before them, so that they stay together. With ``group`` (ascending) the
    suffixes are known to fall into these groups, equal in ``depth`` bytes.
    """
    words = np.ndarray((len(buf) - 8,), ">u8", buffer=buf.data, strides=(1,))
    order = np.arange(len(starts))
    slots = order.copy()
    if group is None:
        group = np.zeros(len(starts), np.int64)
    while len(slots):
        of = order[slots]
        word = words[starts[of] + depth].astype(np.uint64)
        ended = left[of] == depth + 8
        by = np.lexsort((~ended, word, group) if ended.any() else (word, group))
        of, word = of[by], word[by]
        order[slots] = of
        new = np.ones(len(slots), bool)
        new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        at = np.nonzero(new)[0]
        size = np.diff(np.append(at, len(slots)))
        number = np.repeat(np.arange(len(at)), size)
        depth += 8
        go = (size[number] > 1) & (left[of] > depth)
        slots, group = slots[go], number[go]
    return order


def common_prefixes(buf: np.ndarray, order: np.ndarray, left: np.ndarray,
                    group: np.ndarray | None = None) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``;
    ``left`` holds the bytes up to the end of each suffix's stretch. With
    ``group``, 0 for the first of each group."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    most = np.minimum(left[1:], left[:-1])
    at = np.arange(len(order) - 1)
    if group is not None:
        at = at[group[1:] == group[:-1]]
    a, b = order[at], order[at + 1]
    got = np.zeros(len(order) - 1, np.int64)
    words = np.ndarray((len(buf) - 8,), ">u8", buffer=buf.data, strides=(1,))
    while len(at):
        diff = words[a].astype(np.uint64) ^ words[b].astype(np.uint64)
        same = diff == 0
        part = np.zeros(len(at), np.int64)
        for k in range(1, 8):
            part += diff >> np.uint64(64 - 8 * k) == 0
        got[at] += np.where(same, 8, part)
        go = same & (got[at] < most[at])
        at, a, b = at[go], a[go] + 8, b[go] + 8
    out[1:] = np.minimum(got, most)
    return out


def repeat_groups(lcp: np.ndarray, left: np.ndarray, least: int):
    """Maximal repeats: (length, first, last) ranges of the suffix array.

    ``lcp[i]`` is the common prefix of entries i - 1 and i; ``left`` the byte
    before each entry, 255 where none is known (that always counts as another).
    A stack holds the open common-prefix intervals as [length, first entry,
    left byte or -1 once two differ].
    """
    runs = np.nonzero(lcp >= least)[0]
    if not len(runs):
        return
    cuts = np.nonzero(np.diff(runs) > 1)[0] + 1
    for run in np.split(runs, cuts):
        a, b = int(run[0]) - 1, int(run[-1])
        values = lcp[a + 1:b + 1].tolist() + [0]
        bytes_ = [-1 if x == 255 else x for x in left[a:b + 1].tolist()]
        stack: list[list] = []
        for k, h in enumerate(values):
            # the entry a + k joins whatever stays open; its left byte is bytes_[k]
            start, seen = a + k, bytes_[k]
            while stack and stack[-1][0] > h:
                length, first, byte = stack.pop()
                byte = byte if byte == seen else -1
                if byte == -1:
                    yield length, first, a + k
                start, seen = first, byte
            if stack and stack[-1][0] == h:
                if stack[-1][2] != seen:
                    stack[-1][2] = -1
            elif h >= least:
                stack.append([h, start, seen])


def shared_windows(buf: np.ndarray, starts: np.ndarray, owners: np.ndarray,
                   length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows that two owners have, by class of equal windows: (numbers of
    ``starts``, class of each). A repeat of ``length`` bytes or more lies within
    one class, so all others stay out of the suffix array."""
    by = np.argsort(h := equal_windows(buf, starts, length), kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = h[by[1:]] != h[by[:-1]]
    at = np.nonzero(new)[0]
    if not len(at):
        return by, by
    own = owners[by]
    several = np.minimum.reduceat(own, at) != np.maximum.reduceat(own, at)
    number = np.cumsum(new) - 1
    keep = several[number]
    return by[keep], number[keep]


def covered(segments: list[bytes], owners: np.ndarray, length: int) -> list[list]:
    """For each segment, the stretches of it that some segment with a smaller
    owner has too: repeats of ``length`` bytes or more."""
    sizes = np.array([len(s) for s in segments], np.int64)
    gap = b"\xff" * 8
    buf = np.frombuffer(gap + gap.join(segments) + gap * 2, np.uint8)
    begin = 8 + np.cumsum(sizes + 8) - sizes - 8
    windows = sizes - length + 1
    seg = np.repeat(np.arange(len(segments)), windows)
    starts = np.repeat(begin, windows) + np.arange(len(seg)) \
        - np.repeat(np.cumsum(windows) - windows, windows)
    left = begin[seg] + sizes[seg] - starts
    out: list[list] = [[] for _ in segments]
    some, group = shared_windows(buf, starts, owners[seg], length)
    if not len(some):
        return out
    rank = some[suffix_array(buf, starts[some], left[some], group, (length - 1) // 8 * 8)]
    lcp = common_prefixes(buf, starts[rank], left[rank], group)
    if (lcp[1:][group[1:] == group[:-1]] < length).any():  # two windows, one hash
        rank = suffix_array(buf, starts, left)
        lcp = common_prefixes(buf, starts[rank], left[rank])
    order, of = starts[rank], seg[rank]
    reach = reaches(lcp, buf[order - 1], owners[of], length)
    hit = np.nonzero(reach)[0]
    if not len(hit):
        return out
    hit = hit[np.argsort(order[hit], kind="stable")]
    # segments lie apart in the buffer, so stretches of two never meet
    at, end = order[hit], np.maximum.accumulate(order[hit] + reach[hit])
    first = np.nonzero(np.append(True, at[1:] > end[:-1]))[0]
    last = np.append(first[1:], len(at)) - 1
    of = of[hit[first]]
    for s, a, b in zip(of.tolist(), (at[first] - begin[of]).tolist(),
                       (end[last] - begin[of]).tolist(), strict=True):
        out[s].append([a, b])
    return out


def reaches(lcp: np.ndarray, left: np.ndarray, own: np.ndarray, length: int) -> np.ndarray:
    """Bytes of each suffix that a smaller owner has too, by maximal repeats. A
    stretch of entries with one common prefix throughout is a tree of a single
    interval: those are judged together, the others by the stack scan."""
    at = np.nonzero(lcp < length)[0]
    number = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(lcp))))
    longest = np.maximum.reduceat(np.where(lcp < length, 0, lcp), at)
    shortest = np.minimum.reduceat(np.where(lcp < length, NO_ID, lcp), at)
    most, least = np.maximum.reduceat(left, at), np.minimum.reduceat(left, at)
    flat = longest == shortest
    use = flat & ((most == 255) | (most != least))
    low = np.minimum.reduceat(own, at)
    reach = np.where(use[number] & (own > low[number]), longest[number], 0)
    for size, a, b in repeat_groups(np.where(flat[number], 0, lcp), left, length):
        mine = own[a:b + 1]
        lowest = mine.min()
        if (mine > lowest).any():
            part = reach[a:b + 1]
            np.maximum(part, np.where(mine > lowest, size, 0), out=part)
    return reach


# ------------------------------------------------------------------ the passes ----
def _pack(batches, block_bytes: int):
    """Blocks of (block, ids, lens, data) from the documents of a partition."""
    from pyspark import TaskContext
    part, n = TaskContext.get().partitionId() << 32, 0
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0

    def block():
        lens = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        return pa.RecordBatch.from_arrays(
            [pa.array([part + n], pa.int64()),
             pa.array([_zip(np.array(ids, np.int64), lens, data)], pa.binary())],
            names=["block", "data"])

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            texts.append(t.as_py().encode("utf-8", "replace"))
            ids.append(NO_ID if i is None else i)
            size += len(texts[-1])
            if size >= block_bytes:
                yield block()
                ids, texts, size, n = [], [], 0, n + 1
    if texts:
        yield block()


def _block(data: bytes, length: int) -> Block:
    return Block(*_unzip(data, np.int64, np.int64, np.uint8), length)


def _repeated(pieces) -> np.ndarray:
    parts = [_unzip(p, np.uint64)[0] for p in pieces or []]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _frame(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
          text_col: str = "text", block_bytes: int = BLOCK,
          bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: id, n_bytes, spans (the removed runs, byte offsets)
    and kept (the remaining bytes)."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    buckets, parts = blocks_for(total, bucket_bytes), blocks_for(total, 4 * block_bytes)
    blocks = rows.mapInArrow(lambda batches: _pack(batches, block_bytes),
                             "block long, data binary").repartition(parts, "block")

    def send_anchors(batches):
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                v, runs, many = _block(data.as_py(), length).anchors()
                to = (v >> np.uint64(1)) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
                out = []
                for k in range(buckets):
                    at = order[cut[k]:cut[k + 1]]
                    if len(at):  # values ascend: send their gaps
                        out.append((k, block, _zip(
                            np.diff(v[at], prepend=np.uint64(0)),
                            np.minimum(runs[at], 65535).astype(np.uint16), many[at])))
                yield _frame(out, ["bucket", "block", "data"],
                             [pa.int32(), pa.int64(), pa.binary()])

    def find_repeated(table: pa.Table) -> pa.Table:
        got = [_unzip(d.as_py(), np.uint64, np.uint16, np.bool_) for d in table.column("data")]
        values = [np.cumsum(g[0], dtype=np.uint64) for g in got]
        v = np.concatenate(values)
        u, where, blocks_of = np.unique(v, return_inverse=True, return_counts=True)
        runs = np.bincount(where, np.concatenate([g[1] for g in got]), len(u))
        many = np.bincount(where, np.concatenate([g[2] for g in got]), len(u)) > 0
        ok = (blocks_of > 1) | many
        flag = u | (runs > hot).astype(np.uint64)
        out, at = [], 0
        for block, mine in zip(table.column("block").to_pylist(), values, strict=True):
            k = where[at:at + len(mine)]
            at += len(mine)
            k = k[ok[k]]
            if len(k):
                out.append((block, _zip(flag[k])))
        return pa.Table.from_batches([_frame(out, ["of", "piece"], [pa.int64(), pa.binary()])])

    repeated = blocks.mapInArrow(send_anchors, "bucket int, block long, data binary") \
        .groupBy("bucket").applyInArrow(find_repeated, "of long, piece binary") \
        .groupBy("of").agg(F.collect_list("piece").alias("pieces"))
    marked = blocks.join(repeated, blocks.block == repeated.of, "left") \
        .select("block", "data", "pieces")

    def send_segments(batches):
        for b in batches:
            for block, data, pieces in zip(b.column(0).to_pylist(), b.column(1),
                                           b.column(2), strict=True):
                got = _block(data.as_py(), length)
                got.keep_repeated(_repeated(pieces.as_py()))
                out = []
                for k, segs in got.segments(buckets)[0].items():
                    out.append((k, block, _zip(
                        np.array([len(s[0]) for s in segs], np.int64),
                        np.array([s[1] for s in segs], np.uint64),
                        np.array([s[2] for s in segs], np.int64),
                        np.frombuffer(b"".join(s[0] for s in segs), np.uint8))))
                yield _frame(out, ["bucket", "block", "data"],
                             [pa.int32(), pa.int64(), pa.binary()])

    def judge(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        keys: list[int] = []
        owners: list[int] = []
        uses = []
        for d in table.column("data"):
            lens, key, own, raw = _unzip(d.as_py(), np.int64, np.uint64, np.int64, np.uint8)
            raw, at, use = raw.tobytes(), 0, []
            for n, k, i in zip(lens.tolist(), key.tolist(), own.tolist(), strict=True):
                word = raw[at:at + n]
                at += n
                j = number.setdefault(word, len(owners))
                if j == len(owners):
                    keys.append(k)
                    owners.append(i)
                elif i < owners[j]:
                    owners[j] = i
                use.append(j)
            uses.append(use)
        words, own = list(number), np.array(owners, np.int64)
        _, where, times = np.unique(np.array(keys, np.uint64), return_inverse=True,
                                    return_counts=True)
        several = np.nonzero(times[where] > 1)[0]
        cover: dict[int, list] = {}
        if len(several):
            got = covered([words[j] for j in several.tolist()], own[several], length)
            cover = {j: c for j, c in zip(several.tolist(), got, strict=True) if c}
        bucket = table.column("bucket")[0].as_py()
        out = []
        for block, use in zip(table.column("block").to_pylist(), uses, strict=True):
            cuts = [cover.get(j, ()) for j in use]
            out.append((block, bucket, _zip(
                own[use], np.array([len(c) for c in cuts], np.int32),
                np.array([x for c in cuts for x in c], np.int32).reshape(-1))))
        return pa.Table.from_batches([_frame(out, ["of", "bucket", "verdict"],
                                             [pa.int64(), pa.int32(), pa.binary()])])

    verdicts = marked.mapInArrow(send_segments, "bucket int, block long, data binary") \
        .groupBy("bucket").applyInArrow(judge, "of long, bucket int, verdict binary") \
        .groupBy("of").agg(F.collect_list(F.struct("bucket", "verdict")).alias("verdicts"))
    judged = marked.join(verdicts, marked.block == verdicts.of, "left") \
        .select("block", "data", "pieces", "verdicts")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False),
                                     T.StructField("end", T.LongType(), False)]), False)
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType(), False),
        T.StructField("spans", span, False), T.StructField("kept", T.BinaryType(), False)])
    span_kind = pa.list_(pa.struct([pa.field("start", pa.int64(), False),
                                    pa.field("end", pa.int64(), False)]))

    def cut(batches):
        for b in batches:
            for data, pieces, said in zip(b.column(1), b.column(2), b.column(3), strict=True):
                got = _block(data.as_py(), length)
                got.keep_repeated(_repeated(pieces.as_py()))
                by_bucket, places = got.segments(buckets)
                for v in said.as_py() or []:
                    own, n, flat = _unzip(v["verdict"], np.int64, np.int32, np.int32)
                    ends = (2 * np.cumsum(n)).tolist()
                    for seg, o, k, e in zip(by_bucket[v["bucket"]], own.tolist(), n.tolist(),
                                            ends, strict=True):
                        seg.append(o)
                        seg.append(flat[e - 2 * k:e].tolist())
                yield _cut(got, places, schema.names, span_kind)

    return judged.mapInArrow(cut, schema)


def _cut(got: Block, places: list[tuple], names: list[str], span_kind) -> pa.RecordBatch:
    """The documents of a block without what the verdicts cover."""
    spans: list[list[list[int]]] = [[] for _ in got.ids]
    ids = got.ids.tolist()
    for d, s, e, seg in places:  # in order of place
        own, inner = seg[3], seg[4]
        if ids[d] > own:
            cuts = [(s, e)]
        else:
            cuts = [(s + inner[k], s + inner[k + 1]) for k in range(0, len(inner), 2)]
        mine = spans[d]
        for a, b in cuts:
            if mine and a <= mine[-1][1]:
                mine[-1][1] = max(b, mine[-1][1])
            else:
                mine.append([a, b])
    raw, kept, lists = got.data.tobytes(), [], []
    for at, n, mine in zip(got.starts.tolist(), got.lens.tolist(), spans, strict=True):
        edges = [at] + [x for ab in mine for x in ab] + [at + n]
        kept.append(b"".join(raw[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2)))
        lists.append([{"start": a - at, "end": b - at} for a, b in mine])
    return pa.RecordBatch.from_arrays(
        [pa.array([None if i == NO_ID else i for i in ids], pa.int64()),
         pa.array(got.lens), pa.array(lists, span_kind), pa.array(kept, pa.binary())],
        names=names)
