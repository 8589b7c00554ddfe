r"""Chat formatting over a prefix tree of conversations.

Conversations that share their first turns share a path of the tree. Sorted by
path, they come in depth-first order; each then adds only the turns that its
predecessor does not have, so every shared turn is written once. A written
turn (segment) has its place in the tree's token sequence (``start``,
``end``), the position id of its first token (its depth along the path, so
siblings reuse positions) and the intervals of the sequence that hold its
ancestors: a token attends to those and, causally, to its own segment.
Neighbouring intervals are merged. Tokens are code points here; a tokenizer
maps them one segment at a time.

Template: ``<turn ROLE>\nTEXT</turn>\n``. Inside texts and roles a backslash is
doubled and ``<`` becomes ``\l`` (in roles also ``>`` becomes ``\g``), so no
text can spell a mark and unescaping is exact. The loss mask covers the
escaped text of the assistant's segments.

Scale: conversations are gathered by id, then range-partitioned by path and
id. A tree whose conversations straddle partitions is cut there: each piece
repeats the one path it is cut at, which makes it a sequence that can be used
on its own. So neither a first turn shared by a third of all conversations nor
a conversation copied as often meets in one task. One conversation is one row.

Results for odd input: a null role or text counts as empty; equal or null turn
numbers order by role, then text, nulls first; a repeated row is a turn said
twice. Rows without a conversation id are conversations of one turn each, with
a null id. Copies of a conversation share all segments. An empty table gives an
empty table. Only the four columns are read, so other names don't clash.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, short_batches

HEAD, MID, TAIL = "<turn ", ">\n", "</turn>\n"
KEY = 16  # bytes of a path key per turn
_PARSE = re.compile(r"<turn ([^<>]*)>\n([^<]*)</turn>\n")
_UNESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: {"l": "<", "g": ">"}.get(m[1], m[1]), text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text stands in it."""
    head = HEAD + escape(role).replace(">", "\\g") + MID
    body = escape(text)
    return head + body + TAIL, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; fails if anything is left over."""
    turns, at = [], 0
    for m in _PARSE.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


def conversations(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: conv_id, turns (role, text) in order."""
    turn = F.struct(F.col("turn").alias("t"),
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    src = rows.select(F.col(id_col).alias("conv_id"), turn.alias("turn"))
    known = src.filter("conv_id is not null").groupBy("conv_id") \
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return known.unionByName(src.filter("conv_id is null")
                             .select("conv_id", F.array("turn").alias("turns")))


def _paths(convs: DataFrame) -> DataFrame:
    """Add ``path``: for each turn a key of all turns up to it."""
    def run(batches):
        for b in batches:
            out = []
            for turns in b.column(1):
                key, path = b"", []
                for t in turns.as_py():
                    role, text = t["role"].encode(), t["text"].encode()
                    key = hashlib.blake2b(b"%b%d %b%b" % (key, len(role), role, text),
                                          digest_size=KEY).digest()
                    path.append(key)
                out.append(b"".join(path))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                             names=["conv_id", "turns", "path"])

    schema = T.StructType([*convs.schema.fields, T.StructField("path", T.BinaryType())])
    return convs.mapInArrow(run, schema)


INTERVALS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False),
                                      T.StructField("end", T.LongType(), False)]), False)


def _merged(stack: list[tuple]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end, *_ in stack:
        if out and out[-1][1] == start:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def pack(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The tree sequences, in depth-first order within each partition.

    Rows with ``text`` are segments; a row with ``is_conversation`` names a
    conversation that ends there, ``intervals`` covering all its segments.
    """
    short_batches(rows.sparkSession)
    convs = _paths(conversations(rows, id_col))
    ordered = convs.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    id_type = convs.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("piece", T.IntegerType()), T.StructField("tree", T.StringType()),
        T.StructField("row_no", T.LongType()), T.StructField("is_conversation", T.BooleanType()),
        T.StructField("conv_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("position", T.LongType()),
        T.StructField("text", T.StringType()), T.StructField("loss_start", T.LongType()),
        T.StructField("loss_end", T.LongType()), T.StructField("intervals", INTERVALS)])
    kinds = [arrow_type(f.dataType) for f in schema]

    def run(batches):
        from pyspark import TaskContext
        piece = TaskContext.get().partitionId()
        before, stack, size, n = b"", [], 0, 0
        for b in batches:
            out = []
            for conv, turns, path in zip(b.column("conv_id").to_pylist(), b.column("turns"),
                                         b.column("path").to_pylist(), strict=True):
                shared = 0
                while shared < len(stack) and \
                        path[shared * KEY:(shared + 1) * KEY] == before[shared * KEY:
                                                                       (shared + 1) * KEY]:
                    shared += 1
                if not shared:
                    size = 0  # another tree
                tree = path[:KEY].hex()
                del stack[shared:]
                for t in turns.as_py()[shared:]:
                    text, lo, hi = segment(t["role"], t["text"])
                    position = stack[-1][2] if stack else 0
                    loss = (size + lo, size + hi) if t["role"] == "assistant" else (None, None)
                    out.append((piece, tree, n, False, None, size, size + len(text), position,
                                text, *loss, _merged(stack)))
                    stack.append((size, size + len(text), position + len(text)))
                    size, n = size + len(text), n + 1
                whole = _merged(stack)
                out.append((piece, tree, n, True, conv, stack[0][0], stack[-1][1], 0, None,
                            None, None, whole))
                n, before = n + 1, path
            cols = list(zip(*out)) or [()] * len(kinds)
            cols[-1] = [[{"start": s, "end": e} for s, e in v] for v in cols[-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

    return ordered.mapInArrow(run, schema)


def read_back(packed: DataFrame, in_order: bool = True) -> DataFrame:
    """Per conversation, what the packed rows say: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars. ``in_order`` is for
    a frame straight from ``pack``; a stored one is put in order first."""
    if not in_order:
        packed = packed.repartition("piece").sortWithinPartitions("piece", "row_no")
    schema = T.StructType([
        packed.schema["conv_id"], T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType())])
    kinds = [arrow_type(f.dataType) for f in schema]
    use = ["piece", "tree", "is_conversation", "conv_id", "start", "end", "position", "text",
           "loss_start", "loss_end", "intervals"]

    def run(batches):
        stack: list[tuple] = []  # segments on the current path
        of = None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if of != (r["piece"], r["tree"]):
                    of, stack = (r["piece"], r["tree"]), []
                if not r["is_conversation"]:
                    while stack and stack[-1]["position"] + len(stack[-1]["text"]) > r["position"]:
                        stack.pop()
                    stack.append(r)
                    continue
                mine = [s for s in stack if any(v["start"] <= s["start"] and s["end"] <= v["end"]
                                                for v in r["intervals"])]
                text = "".join(s["text"] for s in mine)
                turns = parse(text)
                loss = "".join(unescape(s["text"][s["loss_start"] - s["start"]:
                                                  s["loss_end"] - s["start"]])
                               for s in mine if s["loss_start"] is not None)
                said = "".join(f"{role}\n{t}\n" for role, t in turns)
                out.append((r["conv_id"], len(turns), _sha(said), len(loss), _sha(loss),
                            len(text)))
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

    return packed.select(*use).mapInArrow(run, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
