"""Byte-level BPE by a lazily determinised finite-state transducer.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly if
every token encodes itself and every neighbouring pair encodes to that pair:
the first merge that would cross a boundary involves two neighbours only. So
each prefix of a piece has one encoding, and the encoding of a longer prefix
ends in a token whose start is a prefix already known. The transducer reads
bytes and keeps the prefixes from which a vocabulary entry may still be
growing (at most the longest entry's length back: the bounded lookahead).
States and arcs are made when first met, at every depth of a piece, and kept in
tables of bounded size that start afresh when full.

Pieces of up to SHORT bytes, less than the lookahead, settle at their end. New
ones of a group of texts run through the states together, byte by byte
(``Together``): a state is the set of (trie node, token before it) of the live
prefixes, and each is labelled with the token that closes there, so that the
labels read backwards give the tokens. Longer pieces run alone
(``Transducer``): a state also holds the unsettled tokens, and those that all
live prefixes share are emitted at once.

Decoding. Token bytes run through an incremental UTF-8 state machine whose
state is the unfinished sequence (three bytes at most), some tokens at a time.
A malformed byte decodes to U+FFFD.

Results for odd input: a null text encodes as the empty text (no ids), null
ids decode to the empty text, repeated rows give repeated results, an empty
table gives an empty table, other columns pass through, and a column named
like an output is replaced by it. Texts are taken whole; a task holds one
Arrow batch.
"""

from __future__ import annotations

import base64
import codecs
import gc
import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, text_of

ARC_LIMIT = 20_000     # arcs of long pieces kept before the tables start afresh
TABLE_BYTES = 32 << 20  # states and arcs of short pieces, estimated, likewise
PAIR_LIMIT = 100_000   # neighbour checks remembered per worker
SLOTS = 1 << 19        # slots of the tables of neighbour checks, newest kept
SHORT = 64             # bytes of a piece that runs together with others
TOGETHER = 1 << 13     # pieces that run together
STRETCHES = 50_000     # stretches between blanks that are split at a time
GROUP = 2 << 20        # bytes of texts whose new pieces are gathered
NEVER = 1 << 60
FEW = 1              # entries below a trie node that are tried one by one
KEY = 64               # bytes of a string that is remembered
PROBES = 32            # slots tried for a string
PIECE_LIMIT = 200_000  # finished pieces in each of two generations per worker


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b)
            for a, b in (line.split() for line in data.splitlines() if line.strip())}


class Transducer:
    """Encodes one piece of bytes; see the module text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        # trie over the vocabulary: node -> {byte: node}, and the token at a node
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for word, rank in ranks.items():
            node = 0
            for byte in word:
                child = self.next[node].get(byte)
                if child is None:
                    child = len(self.next)
                    self.next[node][byte] = child
                    self.next.append({})
                    self.token.append(-1)
                node = child
            self.token[node] = rank
        self.split: dict[int, tuple[int, int] | None] = {}
        self.spines: dict[tuple[int, int], list] = {}
        self.fits: dict[int, bool] = {}
        self.below: dict[int, tuple[int, ...] | None] = {}
        self.open: dict[int, bool] = {}
        self.ordered = True
        # entries that no merges lead to never end a prefix
        self.entry = [t if t >= 0 and self.halves(t) is not None else -1
                      for t in self.token]
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, tuple] = {}
        self.n_arcs = 0
        self.start = self.state(((0, ()),))  # the empty prefix, nothing unsettled

    def state(self, live: tuple) -> tuple:
        """(live prefixes, arcs by byte)"""
        got = self.number.get(live)
        if got is None:
            got = self.number[live] = (live, {})
        return got

    def tokens_below(self, node: int) -> tuple[int, ...] | None:
        """Tokens at or below a trie node; None if there are many."""
        got = self.below.get(node, 0)
        if got == 0:
            found, todo = [], [node]
            while todo and len(found) <= FEW:
                at = todo.pop()
                if self.entry[at] >= 0:
                    found.append(self.entry[at])
                todo.extend(self.next[at].values())
            got = self.below[node] = None if len(found) > FEW or todo else tuple(found)
        return got

    def may_close(self, node: int, last: int) -> bool:
        """Whether some entry growing at ``node`` may still follow ``last``."""
        key = node << 20 | last
        got = self.open.get(key)
        if got is None:
            if len(self.open) > PAIR_LIMIT:
                self.open.clear()
            below = self.tokens_below(node)
            got = self.open[key] = below is None or any(
                self.fit(last, t) for t in below)
        return got

    def merged(self, word: bytes, until: int = 1) -> list[bytes]:
        """Parts of ``word`` after merging the lowest-ranked pair, leftmost
        first, while more than ``until`` parts are left."""
        parts = [word[i:i + 1] for i in range(len(word))]
        ranks = [self.ranks.get(parts[i] + parts[i + 1], NEVER) for i in range(len(parts) - 1)]
        while len(parts) > until and ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], NEVER)
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; () for a single byte and
        None if its bytes do not merge to it."""
        got = self.split.get(token, 0)
        if got == 0:
            word = self.bytes_of[token]
            got = ()
            if len(word) > 1:
                parts = self.merged(word, 2)
                got = None
                if len(parts) == 2 and self.ranks.get(parts[0] + parts[1]) == token:
                    got = (self.ranks[parts[0]], self.ranks[parts[1]])
                    if any(len(p) > 1 and self.ranks[p] > token for p in parts):
                        self.ordered = False  # a merge made of later merges
            self.split[token] = got
        return got

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank at which it is merged away) along one edge of the merge
        tree of ``token``, from the whole down to one byte."""
        key = (token, side)
        got = self.spines.get(key)
        if got is None:
            got, end, at = [], NEVER, token
            while True:
                got.append((self.bytes_of[at], end))
                end, parts = at, self.halves(at)
                if not parts:
                    break
                at = parts[side]
            got.reverse()
            self.spines[key] = got
        return got

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes together encode to the two tokens.

        Where every merge ranks after the merges it is made of, merges happen
        in rank order, so it is enough to walk the two merge-tree edges at the
        boundary in that order and look for a merge across it that comes first
        (on equal ranks the left one does).
        """
        key = left << 20 | right
        ok = self.fits.get(key)
        if ok is not None:
            return ok
        if len(self.fits) > PAIR_LIMIT:
            self.fits.clear()
        a, b = self.spine(left, 1), self.spine(right, 0)
        ok, i, j, get = True, 0, 0, self.ranks.get
        while ok:
            (x, x_end), (y, y_end) = a[i], b[j]
            cross = get(x + y, NEVER)
            if cross < x_end and cross <= y_end:
                ok = False
            elif x_end == NEVER and y_end == NEVER:
                break
            elif x_end <= y_end:
                i += 1
                j += x_end == y_end
            else:
                j += 1
        if not self.ordered:
            ok = [self.ranks[p] for p in self.merged(self.bytes_of[left] + self.bytes_of[right])] \
                == [left, right]
        self.fits[key] = ok
        return ok

    def step(self, live: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """Live prefixes after one more byte, and the ids settled by it.

        A live prefix is (trie node of the bytes read since its end, tokens not
        settled yet); the tokens are led by the last settled one, since the
        next neighbour must fit it. The newest prefix comes last.
        """
        grown, closed, shared = [], None, 99
        nexts, entry, opens, fits = self.next, self.entry, self.open, self.fits
        for one in live:
            node, path = one
            child = nexts[node].get(byte)
            if child is None:
                continue
            last = path[-1] if path else -1
            if closed is None and (tok := entry[child]) >= 0:
                ok = last < 0 or fits.get(last << 20 | tok)
                if ok is None:
                    ok = self.fit(last, tok)
                if ok:
                    closed = path + (tok,)
            if nexts[child]:
                ok = last < 0 or opens.get(child << 20 | last)
                if ok is None:
                    ok = self.may_close(child, last)
                if ok:
                    grown.append((child, path))
                    if len(path) < shared:
                        shared = len(path)
        if closed is None:
            raise ValueError(f"no token for byte {byte}")
        # what all histories share, but for the last shared token, is settled
        shared = min(shared, len(closed)) - 1
        if shared > 0:
            for _, p in grown:
                while shared > 0 and p[:shared + 1] != closed[:shared + 1]:
                    shared -= 1
        grown.append((0, closed))
        if shared <= 0:
            return tuple(grown), ()
        return tuple([(n, p[shared:]) for n, p in grown]), closed[:shared]

    def arc(self, state: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """Make the arc of ``state`` under ``byte``."""
        live, out = self.step(state[0], byte)
        made = state[1][byte] = (self.state(live), out)
        self.n_arcs += 1
        return made

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:  # an entry of the vocabulary stands for itself
            return (whole,)
        state, out = self.start, []
        for byte in piece:
            made = state[1].get(byte)
            if made is None:
                if self.n_arcs >= ARC_LIMIT:
                    self.reset()  # the state at hand stays usable
                made = self.arc(state, byte)
            state = made[0]
            if made[1]:
                out.extend(made[1])
        out.extend(state[0][-1][1])
        return tuple(out)


class Slots:
    """Answers to pairs of numbers, one slot a hash: a newer pair takes the slot."""

    def __init__(self, ask):
        self.ask = ask
        self.keys, self.said = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        slot = (key * 0x9E3779B97F4A7C1 >> 30) % SLOTS
        out = self.said[slot]
        miss = np.nonzero(self.keys[slot] != key)[0]
        if len(miss):
            new, where = np.unique(key[miss], return_inverse=True)
            got = np.array([self.ask(k >> 20, k & 0xFFFFF) for k in new.tolist()], bool)
            out[miss] = got[where]
            # where two pairs want a slot, key and answer are of the same one
            slot, last = np.unique(slot[miss][::-1], return_index=True)
            self.keys[slot], self.said[slot] = key[miss][::-1][last], out[miss][::-1][last]
        return out


class Together:
    """Runs many short pieces through shared states; see the module text."""

    def __init__(self, machine: Transducer):
        self.machine = machine
        edges = [(node << 8 | byte, child) for node, below in enumerate(machine.next)
                 for byte, child in below.items()]
        edges.sort()
        self.edge = np.array([e[0] for e in edges], np.int64)
        self.child = np.array([e[1] for e in edges], np.int64)
        self.entry = np.array(machine.entry, np.int64)
        self.inner = np.array([bool(below) for below in machine.next])
        self.size = np.zeros(max(machine.bytes_of, default=0) + 1, np.int64)
        for token, word in machine.bytes_of.items():
            self.size[token] = len(word)
        self.fits, self.opens = Slots(machine.fit), Slots(machine.may_close)
        self.reset()

    def reset(self) -> None:
        # live prefixes of all states in a row: (node << 32 | token before it + 1)
        self.cells, self.used = np.zeros(1 << 12, np.int64), 1
        self.at, self.count = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)
        self.label = np.zeros(1 << 10, np.int64)
        self.count[0] = 1  # state 0: the empty prefix, nothing before it
        self.number: dict[bytes, int] = {self.cells[:1].tobytes(): 0}
        self.arcs: dict[int, int] = {}

    def full(self) -> bool:
        return 130 * len(self.arcs) + 250 * len(self.number) + 16 * self.used > TABLE_BYTES

    def step(self, keys: np.ndarray) -> np.ndarray:
        """Make the arcs (state << 8 | byte): the states they lead to."""
        state, byte = keys >> 8, keys & 255
        n = self.count[state]
        row = np.repeat(np.arange(len(keys)), n)
        cell = self.cells[np.arange(len(row)) + np.repeat(self.at[state] - np.cumsum(n) + n, n)]
        edge = (cell >> 32) << 8 | byte[row]
        where = np.searchsorted(self.edge, edge)
        where[where == len(self.edge)] = 0
        go = self.edge[where] == edge
        row, child, before = row[go], self.child[where[go]], (cell[go] & 0xFFFFFFFF) - 1
        token = self.entry[child]
        closed = np.full(len(keys), -1, np.int64)
        ends = np.nonzero(token >= 0)[0]
        while len(ends):  # one token closes here: the longest are asked first
            ask = ends[np.append(True, row[ends[1:]] != row[ends[:-1]])]
            fit = before[ask] < 0
            rest = ask[~fit]
            fit[~fit] = self.fits.get(before[rest], token[rest])
            closed[row[ask[fit]]] = token[ask[fit]]
            ends = ends[(closed[row[ends]] < 0) & ~np.isin(ends, ask, assume_unique=True)]
        if (closed < 0).any():
            raise ValueError(f"no token for byte {byte[closed < 0][0]}")
        grow = np.nonzero(self.inner[child])[0]
        ok = before[grow] < 0
        rest = grow[~ok]
        ok[~ok] = self.opens.get(child[rest], before[rest])
        grow = grow[ok]
        # the grown prefixes in their order, then the one that ends here
        n = np.bincount(row[grow], minlength=len(keys)) + 1
        end = np.cumsum(n)
        cells = np.empty(end[-1], np.int64)
        cells[end - 1] = closed + 1
        cells[np.arange(len(grow)) + row[grow]] = child[grow] << 32 | before[grow] + 1
        return self.states(cells, end - n, n, closed)

    def states(self, cells: np.ndarray, first: np.ndarray, n: np.ndarray,
               closed: np.ndarray) -> np.ndarray:
        raw, number = cells.tobytes(), self.number
        out, new, made = [], [], len(number)
        for k, (a, c) in enumerate(zip((8 * first).tolist(), (8 * n).tolist(), strict=True)):
            live = raw[a:a + c]
            got = number.get(live)
            if got is None:
                got = number[live] = made + len(new)
                new.append(k)
            out.append(got)
        if new:
            at = np.array(new)
            keep = np.zeros(len(n), bool)
            keep[at] = True
            add = cells[np.repeat(keep, n)]
            self.cells = _room(self.cells, self.used + len(add))
            self.cells[self.used:self.used + len(add)] = add
            end = made + len(new)
            for name in ("at", "count", "label"):
                setattr(self, name, _room(getattr(self, name), end))
            self.count[made:end] = n[at]
            self.at[made:end] = self.used + np.cumsum(n[at]) - n[at]
            self.label[made:end] = closed[at]
            self.used += len(add)
        return np.array(out, np.int64)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (of one byte or more), as little-endian 32-bit
        numbers; pieces in ascending order share the most."""
        if self.full():
            self.reset()
        size = np.array([len(p) for p in pieces], np.int64)
        flat, start = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size
        state = np.zeros(len(pieces), np.int64)
        seen = np.zeros((int(size.max()), len(pieces)), np.int32)
        get = self.arcs.get
        for depth in range(len(seen)):
            on = np.nonzero(size > depth)[0]
            key = state[on] << 8 | flat[start[on] + depth]
            new = np.append(True, key[1:] != key[:-1])
            ask = key[new]
            to = np.array([get(k, -1) for k in ask.tolist()], np.int64)
            miss = np.nonzero(to < 0)[0]
            if len(miss):
                made, where = np.unique(ask[miss], return_inverse=True)
                got = self.step(made)
                self.arcs.update(zip(made.tolist(), got.tolist(), strict=True))
                to[miss] = got[where]
            state[on] = to[np.cumsum(new) - 1]
            seen[depth, on] = self.label[state[on]]
        found = np.full((len(pieces), len(seen)), -1, np.int32)
        on, end = np.arange(len(pieces)), size.copy()
        while len(on):
            token = seen[end[on] - 1, on]
            end[on] -= self.size[token]
            found[on, end[on]] = token
            on = on[end[on] > 0]
        real = found >= 0
        raw = found[real].astype("<i4").tobytes()
        ends = (4 * np.cumsum(real.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


class Generation:
    """Strings of up to KEY bytes and their ids, in arrays: about 60 bytes an
    entry. A string is found by a 64-bit hash and told by its bytes."""

    def __init__(self, limit: int):
        self.limit, self.n = limit, 0
        self.slots = np.full(1 << max(4, (2 * limit - 1).bit_length()), -1, np.int32)
        self.hash = np.zeros(16, np.uint64)
        self.key_at, self.id_at = np.zeros(17, np.int64), np.zeros(17, np.int64)
        self.keys, self.ids = np.zeros(64, np.uint8), np.zeros(64, np.int32)

    def find(self, hashes: np.ndarray, flat: np.ndarray, start: np.ndarray,
             size: np.ndarray) -> np.ndarray:
        """The entry of each string, -1 for those not here."""
        out, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        place = hashes.astype(np.int64) & len(self.slots) - 1
        for probe in range(PROBES):
            at = self.slots[place[left] + probe & len(self.slots) - 1]
            left, at = left[at >= 0], at[at >= 0]
            same = self.hash[at] == hashes[left]
            out[left[same]] = at[same]
            left = left[~same]
            if not len(left):
                break
        hit = np.nonzero(out >= 0)[0]
        hit = np.delete(hit, np.nonzero(self.key_at[out[hit] + 1] - self.key_at[out[hit]]
                                        != size[hit])[0])
        equal = self.keys[_spans(self.key_at[out[hit]], size[hit])] \
            == flat[_spans(start[hit], size[hit])]
        true = np.full(len(out), -1, np.int64)
        if len(hit):
            hit = hit[np.logical_and.reduceat(equal, np.cumsum(size[hit]) - size[hit])]
            true[hit] = out[hit]
        return true

    def add(self, hashes: np.ndarray, keys: np.ndarray, key_size: np.ndarray,
            ids: np.ndarray, id_size: np.ndarray) -> None:
        """Append strings that are not here, up to the limit."""
        m, n = min(len(hashes), self.limit - self.n), self.n
        hashes, key_size, id_size = hashes[:m], key_size[:m], id_size[:m]
        key_end = self.key_at[n] + np.cumsum(key_size)
        id_end = self.id_at[n] + np.cumsum(id_size)
        for name, at, values in (("hash", n, hashes), ("key_at", n + 1, key_end),
                                 ("id_at", n + 1, id_end),
                                 ("keys", int(self.key_at[n]), keys[:key_size.sum()]),
                                 ("ids", int(self.id_at[n]), ids[:id_size.sum()])):
            array = _room(getattr(self, name), at + len(values))
            array[at:at + len(values)] = values
            setattr(self, name, array)
        todo, place = np.arange(m), hashes.astype(np.int64) & len(self.slots) - 1
        for probe in range(PROBES):  # what finds no slot is not remembered
            slot = place[todo] + probe & len(self.slots) - 1
            free = np.nonzero(self.slots[slot] < 0)[0]
            slot, first = np.unique(slot[free], return_index=True)
            self.slots[slot] = n + todo[free[first]]
            todo = np.delete(todo, free[first])
            if not len(todo):
                break
        self.n += m


class Memory:
    """What was encoded lately, in two generations of bounded size."""

    def __init__(self, limit: int):
        self.limit = limit
        self.new, self.old = Generation(limit), Generation(0)
        self.code = np.random.default_rng(1).integers(0, 1 << 64, (KEY, 256), np.uint64)

    def ids(self, keys: pa.Array, make) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each of some different strings, in a row, and how many
        each has; ``make`` gives the ids of those not remembered."""
        raw = keys.cast(pa.large_binary())
        ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        flat = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        start, size = ends[:-1], np.diff(ends)
        short = np.nonzero((size > 0) & (size <= KEY))[0]
        start, size = start[short], size[short]
        depth = _spans(np.zeros(len(short), np.int64), size)
        code = self.code[depth, flat[_spans(start, size)]]
        hashes = np.bitwise_xor.reduceat(code, np.cumsum(size) - size) if len(short) \
            else np.zeros(0, np.uint64)
        new = self.new.find(hashes, flat, start, size)
        old = np.full(len(short), -1, np.int64)
        rest = np.nonzero(new < 0)[0]
        old[rest] = self.old.find(hashes[rest], flat, start[rest], size[rest])
        known = np.zeros(len(keys), bool)
        known[short] = (new >= 0) | (old >= 0)
        fresh = np.nonzero(~known)[0]
        made, made_size = _rows(make(keys.take(pa.array(fresh)).to_pylist()))

        parts, sizes, order = [made], [made_size], [fresh]
        for gen, entry in ((self.new, new), (self.old, old)):
            hit = np.nonzero(entry >= 0)[0]
            at = entry[hit]
            sizes.append(gen.id_at[at + 1] - gen.id_at[at])
            parts.append(gen.ids[_spans(gen.id_at[at], sizes[-1])])
            order.append(short[hit])
        found, length, order = map(np.concatenate, (parts, sizes, order))
        out, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        out[order], first[order] = length, np.cumsum(length) - length
        found = found[_spans(first, out)]

        put = np.nonzero(new < 0)[0]  # what was not met again goes first
        if self.new.n + len(put) > self.limit:
            self.old, self.new = self.new, Generation(self.limit)
            put = np.arange(len(short))
        where = short[put]
        self.new.add(hashes[put], flat[_spans(start[put], size[put])], size[put],
                     found[_spans((np.cumsum(out) - out)[where], out[where])], out[where])
        return found, out


class Encoder:
    """Splits a text by the pattern and encodes each match on its own.

    With ``cut`` a text is first cut before each blank (U+0020) that follows
    other than white space; each different stretch of a group of texts is looked
    up once, and those met before are not split again. That
    holds for patterns that never match across such a place.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut: bool = False):
        import regex
        self.split = regex.compile(pattern).findall
        self.machine = Transducer(ranks)
        self.together = Together(self.machine)
        self.pieces, self.stretches = Memory(PIECE_LIMIT), Memory(PIECE_LIMIT)
        self.cut = cut

    def plain(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each whole text."""
        return self.joined([self.split(t) for t in texts])

    def joined(self, splits: Sequence[list[str]]) -> list[bytes]:
        """The ids of each list of pieces, some distinct pieces at a time."""
        out, at = [], 0
        while at < len(splits):
            ids, to = {}, at
            while to < len(splits) and len(ids) < STRETCHES >= len(splits[to]):
                ids.update(dict.fromkeys(splits[to], b""))
                to += 1
            self.learn(ids)
            out += [b"".join([ids[p] for p in pieces]) for pieces in splits[at:to]]
            if to < len(splits) and len(splits[to]) > STRETCHES:
                out.append(b"".join([self.joined([splits[to][k:k + STRETCHES]])[0]
                                     for k in range(0, len(splits[to]), STRETCHES)]))
                to += 1
            at = to
        return out

    def learn(self, ids: dict[str, bytes]) -> None:
        """Fill in the ids of the pieces."""
        flat, size = self.pieces.ids(pa.array(list(ids), pa.string()), self.made)
        raw, ends = flat.astype("<i4", copy=False).tobytes(), (4 * np.cumsum(size)).tolist()
        ids.update(zip(list(ids), [raw[a:b] for a, b in zip([0, *ends], ends)], strict=True))

    def made(self, pieces: Sequence[str]) -> list[bytes]:
        short = self.short(pieces)
        out = []
        for piece in pieces:
            ids = short.get(piece)
            if ids is None:
                got = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
                ids = struct.pack(f"<{len(got)}i", *got)
            out.append(ids)
        return out

    def learned(self, parts: Sequence[str]) -> list[bytes]:
        """The ids of different stretches, each with the blank before it."""
        split = [self.split(" " + part) for part in parts]
        out = self.made([p[0] for p in split if len(p) == 1])
        more = self.joined([p for p in split if len(p) != 1])
        one, many = iter(out), iter(more)
        return [next(one if len(p) == 1 else many) for p in split]

    def short(self, pieces: Sequence[str]) -> dict[str, bytes]:
        """The ids of those of ``pieces`` that are short and no entries."""
        ranks, new = self.machine.ranks, []
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if len(raw) <= SHORT and raw not in ranks:
                new.append((raw, piece))
        new.sort()
        out: dict[str, bytes] = {}
        for at in range(0, len(new), TOGETHER):
            part = new[at:at + TOGETHER]
            ids = self.together.encode([raw for raw, _ in part])
            out.update(zip([piece for _, piece in part], ids, strict=True))
        return out

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (without nulls) in a row, and how many each has."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        parts, at = [], 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + GROUP, side="right")))
            group = texts.slice(at, to - at)
            parts.append(self._cut(group) if self.cut else
                         _rows(self.plain(group.to_pylist())))
            at = to
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        which, keys = words.indices.to_numpy(), words.dictionary
        n = np.diff(split.offsets.to_numpy())
        first = np.cumsum(n) - n
        # a text with a run of white space before a blank is not cut
        blank = _ends_blank(keys)
        whole = np.logical_or.reduceat(blank[which], first)
        use = np.repeat(~whole, n)
        use[first] = False
        need = np.unique(which[use])
        got = [self.stretches.ids(keys.take(pa.array(need[at:at + STRETCHES])), self.learned)
               for at in range(0, len(need), STRETCHES)]
        lone = keys.take(pa.array(which[first])).to_pylist()
        for k in np.nonzero(whole)[0].tolist():
            lone[k] = texts[k].as_py()
        got.append(_rows(self.plain(lone)))
        flat, size = map(np.concatenate, zip(*got, strict=True))
        entry = np.zeros(len(keys), np.int64)
        entry[need] = np.arange(len(need))
        place = entry[which]
        place[first] = len(need) + np.arange(len(n))
        use[first] = True
        place, text = place[use], np.repeat(np.arange(len(n)), n)[use]
        long, start = size[place], (np.cumsum(size) - size)[place]
        return flat[_spans(start, long)], np.bincount(text, long, len(n)).astype(np.int64)

    def encode(self, text: str) -> list[int]:
        return self.many(pa.array([text], pa.string()))[0].tolist()


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one span after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, grown by half where it has less than ``size`` places."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, len(array) * 3 // 2) - len(array),
                                           array.dtype)])


def _ends_blank(keys: pa.Array) -> np.ndarray:
    """Whether each string is empty or ends in white space."""
    out = pc.equal(pc.binary_length(keys), 0).to_numpy(zero_copy_only=False).copy()
    last = pc.utf8_slice_codeunits(keys, start=-1).dictionary_encode()
    blank = np.array([c.isspace() for c in last.dictionary.to_pylist()], bool)
    if len(blank):
        out |= blank[last.indices.to_numpy()]
    return out


def _rows(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(ids), "<i4"),
            np.array([len(i) // 4 for i in ids], np.int64))


class StreamDecoder:
    """Incremental UTF-8 over tokens; ``feed`` may be called piece by piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.words = [b""] * (max(ranks.values(), default=-1) + 1)
        for word, i in ranks.items():
            self.words[i] = word
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Sequence[int]) -> str:
        """Text complete so far; an unfinished sequence waits in the machine."""
        return self.machine.decode(b"".join(map(self.words.__getitem__, ids)))

    def finish(self) -> str:
        rest = self.machine.decode(b"", True)
        self.machine.reset()
        return rest

    def decode(self, ids: Sequence[int], step: int = 1 << 16) -> str:
        return "".join(self.feed(ids[i:i + step]) for i in range(0, len(ids), step)) \
            + self.finish()


# One machine per worker and vocabulary, so that tasks share its tables.
_MACHINES: dict[tuple, object] = {}


def _machine(kind: str, key: str, make):
    if (kind, key) not in _MACHINES:
        _MACHINES[kind, key] = make()
        # the tables hold no cycles: spare the collector walking them
        gc.freeze()
        gc.set_threshold(200_000, 20, 100)
    return _MACHINES[kind, key]


def shared_ranks(spark: SparkSession, path: str):
    """The rank file, read once on the driver (its size is the vocabulary's)
    and sent to the executors, which need not have the file."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           out_col: str = "token_ids", cut: bool = False) -> DataFrame:
    """Append ``out_col`` (array<int>): the token ids of each whole text.
    ``cut``: see ``Encoder``; it saves time and changes no id."""
    data = shared_ranks(df.sparkSession, ranks_path)

    def start():
        enc = _machine("encode", f"{ranks_path} {cut} {pattern}",
                       lambda: Encoder(parse_ranks(data.value), pattern, cut))

        def fn(texts):
            flat, sizes = enc.many(texts)
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
        return fn

    kind = T.ArrayType(T.IntegerType(), False)
    return map_columns(df, [text_of(text_col)], start, [T.StructField(out_col, kind, False)])


def decode(df: DataFrame, ranks_path: str, ids_col: str = "token_ids",
           out_col: str = "decoded") -> DataFrame:
    """Append ``out_col`` (string): the text that the ids stand for."""
    data = shared_ranks(df.sparkSession, ranks_path)

    def start():
        dec = _machine("decode", ranks_path,
                       lambda: StreamDecoder(parse_ranks(data.value)))

        def fn(lists):
            at, flat = lists.offsets.to_pylist(), lists.values.to_numpy(zero_copy_only=False)
            return [[dec.decode(flat[a:b].tolist()) for a, b in zip(at, at[1:])]]
        return fn

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return map_columns(df, [ids], start, [T.StructField(out_col, T.StringType(), False)])
