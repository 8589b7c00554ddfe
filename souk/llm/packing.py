"""Packing of token pieces into sequences by minimum bin slack.

A document is its token ids and an end id. Documents longer than a sequence
are cut into whole sequences, the first piece taking what is over. What is left
to choose is which pieces share a sequence, and for that only their lengths
count:

1. Texts become ids in one pass. Every piece notes its partition and how many
   pieces of its length the partition had before it; then the pieces are pinned.
2. The number of pieces of each length, at most ``capacity`` numbers however
   large the input is, goes to the driver. There bins are filled one by one:
   the largest piece left opens a bin, and a bitset subset-sum dynamic program
   over the lengths still there finds the fullest combination with it, which
   is removed, as often as the counts allow it unchanged (filling one bin after
   the other would find it again).
3. Pieces of one length are interchangeable. Their numbers, counted through all
   partitions, run through the bins that ask for their length; each piece looks
   its bin and its offset up in the broadcast list of combinations. A combination
   is dropped when some length has become too rare for it, and a length occurs at
   most ``capacity`` / length times in a bin, so the list has some ten thousand
   entries at most, whatever the input.

Texts are taken apart where the vocabulary's pattern does so, and each distinct
part is encoded by the ``tokenizers`` library's model, so the ids are those the
library gives to the whole text.

Results for odd input: a null text is empty, and an empty text is one piece with
the end id alone. Rows with null or equal ids and equal texts are pieces of
their own. Texts are encoded whole, whatever their length. An empty table gives
an empty result. Only the id column travels with the pieces, so other columns
cannot clash.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pinned, short_batches, text_of

CAPACITY = 2048
KEPT_MATCHES = 400_000   # encoded matches that a task remembers
KEPT_CHARS = 48          # longer ones are encoded each time
KNOWN = "\u0250"
_SPLIT = re.compile(r" (?=\S)")


# -------------------------------------------------------------------- tokens ----
def byte_letters() -> str:
    """The letters that byte-level vocabularies write bytes 0 to 255 with: visible
    Latin-1 characters stand for themselves, the others for those from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(rest)) for b in range(256))


def known_classes(pattern: str) -> str | None:
    """``pattern`` for texts of characters below ``KNOWN``, whose classes no Unicode
    version moves, with the classes written out; None if it has others."""
    kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(ord(KNOWN)))}
    letters, numbers = ("".join(c for c in kinds if kinds[c] == k) for k in "LN")
    blanks = r"\t\n\x0b\f\r \x85\xa0"
    for name, chars in ((r"\s", blanks), (r"\p{L}", letters), (r"\p{N}", numbers)):
        pattern = re.sub(r"(\[\^?[^\]]*)" + re.escape(name), lambda m, c=chars: m[1] + c, pattern)
        pattern = pattern.replace(name, f"[{chars}]")
    pattern = pattern.replace(r"\S", f"[^{blanks}]")
    return None if re.search(r"\\[pPdDwWsS]", pattern) else pattern


class Remembered(dict):
    """Results of ``make``, those of short keys kept until there are too many."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Token ids of texts as bytes, ``width`` each.

    With a byte-level vocabulary, texts are taken apart at the matches of its
    ``pattern``, and only distinct matches go to the library's model. A text with
    characters from ``KNOWN`` on, whose classes may differ between libraries, is
    first taken apart at blanks before anything but a blank (a match starts there
    whatever comes before), and the stretches that have such characters go to the
    library whole, as do texts for other vocabularies.
    """

    def __init__(self, path: str, pattern: str | None = None, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        self.model = self.library.model
        self.kind = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.kind).itemsize
        told = json.loads(self.library.to_str())
        split = told["pre_tokenizer"] or {}
        byte_level = (told["normalizer"] is None and told["truncation"] is None
                      and told["model"]["type"] == "BPE" and split.get("type") == "ByteLevel"
                      and not split["add_prefix_space"] and split["use_regex"])
        spelled = known_classes(pattern) if pattern and byte_level else None
        self.pattern = re.compile(spelled) if spelled else None
        self.special = [] if special_as_text else [t["content"] for t in told["added_tokens"]]
        self.letters = byte_letters()
        self.matches = Remembered(self.match, KEPT_MATCHES)

    def packed(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def match(self, text: str) -> bytes:
        spelled = text.encode().decode("latin-1").translate(self.letters)
        return array(self.kind, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def known(self, text: str) -> bool:
        return (text.isascii() or max(text) < KNOWN) and not any(t in text for t in self.special)

    def stretch(self, text: str) -> bytes:
        if not self.known(text):
            return self.whole(text)
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.pattern is None:
            return self.whole(text)
        if self.known(text):
            return self.stretch(text)
        first, *rest = _SPLIT.split(text)
        return b"".join([self.stretch(s) for s in [first, *(" " + w for w in rest)] if s])


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str | None, special_as_text: bool) -> Encoder:
    """One per Python worker, whose later tasks find its matches."""
    return Encoder(path, pattern, special_as_text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text", pattern: str | None = None,
           special_as_text: bool = True) -> DataFrame:
    """(id, piece, start, length, ids, part, nth): ``ids`` as the encoder packs
    them, ``nth`` counts the pieces of that length in that partition."""
    short_batches(docs.sparkSession, 256)
    src = docs.select(F.col(id_col), text_of(text_col).alias("__text__"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern, special_as_text)
        width, end = coder.width, coder.packed([end_id])
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            row, piece, start, length, ids, nth = [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                data = coder.encode(text) + end
                for k, (at, n) in enumerate(cut(len(data) // width, capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    ids.append(data[at * width:(at + n) * width])
                    nth.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary()),
                 pa.array(np.full(len(row), part, np.int32)), pa.array(nth, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids", "part", "nth"])

    schema = T.StructType([
        T.StructField(id_col, src.schema[0].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType())])
    return src.mapInArrow(run, schema)


# ---------------------------------------------------------- minimum bin slack ----
def fullest(counts: dict[int, int], room: int) -> Counter:
    """The lengths, largest first among equals, that fill ``room`` best: a bit
    per sum that the lengths so far can make, doubling the number of a length."""
    steps, sums, mask = [], 1, (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, sums))
            sums |= (sums << length * take) & mask
            left -= take
            take *= 2
        if sums >> room & 1:
            break
    best, chosen = sums.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] += take
            best -= length * take
    return chosen


def combinations(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """The bins as (lengths, how many such bins)."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        largest = max(left)
        left[largest] -= 1
        bin_ = fullest({k: v for k, v in left.items() if v}, capacity - largest)
        left[largest] += 1
        bin_[largest] += 1
        times = min(left[k] // m for k, m in bin_.items())
        out.append((bin_, times))
        for k, m in bin_.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
    return out


class Places:
    """Where the k-th piece of a length goes: arrays over the bins that use it."""

    def __init__(self, bins: list[tuple[Counter, int]]):
        used: dict[int, list[tuple[int, int, int, int]]] = {}
        first, upto = 0, Counter()
        for bin_, times in bins:
            at = 0
            for length in sorted(bin_, reverse=True):
                used.setdefault(length, []).append((upto[length], bin_[length], first, at))
                upto[length] += bin_[length] * times
                at += length * bin_[length]
            first += times
        self.used = {k: np.array(v, np.int64) for k, v in used.items()}

    def find(self, length: int, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces numbered ``k``."""
        rows = self.used[length]
        start, m, first, at = rows[np.searchsorted(rows[:, 0], k, side="right") - 1].T
        return first + (k - start) // m, at + (k - start) % m * length


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", pattern: str | None = None,
         special_as_text: bool = True,
         fill: Callable[[dict[int, int], int], list[tuple[Counter, int]]] = combinations
         ) -> DataFrame:
    """(id, piece, start, length, ids, sequence_id, offset) of every piece;
    ``ids`` holds little-endian unsigned 32-bit numbers."""
    spark = docs.sparkSession
    rows = pinned(pieces(docs, path, capacity, end_id, id_col, text_col, pattern,
                         special_as_text))
    runs = rows.groupBy("part", "length").agg(F.count("*").alias("m"))
    before = Window.partitionBy("length").orderBy("part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    runs = pinned(runs.withColumn("shift", F.coalesce(F.sum("m").over(before), F.lit(0))))
    counts = {r[0]: r[1] for r in runs.groupBy("length").agg(F.sum("m")).collect()}
    places = spark.sparkContext.broadcast(Places(fill(counts, capacity)))
    names = [id_col, "piece", "start", "length"]
    numbered = rows.join(runs.drop("m"), ["part", "length"]) \
        .select(*names, "ids", (F.col("nth") + F.col("shift")).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column(3).to_numpy(), b.column(5).to_numpy()
            seq, at = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                mine = np.nonzero(length == n)[0]
                seq[mine], at[mine] = places.value.find(n, number[mine])
            ids = [np.frombuffer(v, f"u{len(v) // n}").astype("<u4").tobytes()
                   for v, n in zip(b.column(4).to_pylist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(ids, pa.binary()), pa.array(seq), pa.array(at)],
                names=[*names, "ids", "sequence_id", "offset"])

    schema = T.StructType([*[numbered.schema[c] for c in [*names, "ids"]],
                           T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(place, schema)
