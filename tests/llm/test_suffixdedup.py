import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from souk.llm import suffixdedup
from tests.conftest import SF0001


def slow(rows, length):
    """[(id, text)] -> (n_bytes, spans, kept) of each row, window by window."""
    owner = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1 if i is not None else 0):
            w = b[k:k + length]
            owner[w] = min(i, owner.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1 if i is not None else 0):
            if owner[b[k:k + length]] < i:
                mask[k:k + length] = b"\1" * length
        out.append((i, len(b), [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(mask))],
                    bytes(c for c, f in zip(b, mask) if not f)))
    return out


def shape(r):
    return r.id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)


def test_query(spark, queries, texts):
    got = {r.doc_id: r for r in queries["op10_suffixdedup"](spark, SF0001).collect()}
    want = slow(sorted(texts.items()), 50)
    assert len(got) == len(want)
    for i, n, spans, kept in want:
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == \
            (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot", [1, 1000])
def test_random_documents_over_blocks_and_buckets(spark, hot):
    rng = random.Random(hot)
    phrases = ["".join(rng.choice("abcd é") for _ in range(rng.randint(10, 150)))
               for _ in range(30)] + ["ab" * 60, "x" * 90]
    rows = [(rng.randint(0, 150), "".join(rng.choice(phrases) for _ in range(rng.randint(0, 8))))
            for _ in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffixdedup.dedup(df, 50, block_bytes=4000, bucket_bytes=9000, hot=hot).collect()
    key = repr
    assert sorted(map(shape, got), key=key) == sorted(slow(rows, 50), key=key)


def test_repeat_groups_against_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        words = [bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 14))) for _ in range(4)]
        gap = b"\xff" * 8
        buf = np.frombuffer(gap + gap.join(words) + gap * 2, np.uint8)
        begin = np.cumsum([8] + [len(w) + 8 for w in words[:-1]])
        starts = np.concatenate([np.arange(b, b + len(w)) for b, w in zip(begin, words)])
        left = np.concatenate([np.arange(len(w), 0, -1) for w in words])
        rank = suffixdedup.suffix_array(buf, starts, left)
        order, left = starts[rank], left[rank]
        lcp = suffixdedup.common_prefixes(buf, order, left)
        got = {(n, frozenset(order[a:b + 1].tolist()))
               for n, a, b in suffixdedup.repeat_groups(lcp, buf[order - 1], 4)}
        raw, want = buf.tobytes(), set()
        for s in {raw[p:p + n] for p, m in zip(order.tolist(), left.tolist())
                  for n in range(4, m + 1)}:
            at = [p for p, m in zip(order.tolist(), left.tolist())
                  if m >= len(s) and raw[p:p + len(s)] == s]
            before = [raw[p - 1] for p in at]
            after = [raw[p + len(s)] if m > len(s) else -p for p, m in
                     ((p, dict(zip(order.tolist(), left.tolist()))[p]) for p in at)]
            if len(at) > 1 and len(set(after)) > 1 and (255 in before or len(set(before)) > 1):
                want.add((len(s), frozenset(at)))
        assert got == want


def checked_covered(segments, owners, length):
    got = suffixdedup.covered(segments, np.array(owners, np.int64), length)
    rows = [(o, s.decode()) for o, s in zip(owners, segments, strict=True)]
    assert [[tuple(c) for c in cuts] for cuts in got] == [r[2] for r in slow(rows, length)]


@pytest.mark.parametrize("size", [56, 57, 64, 72, 80])
def test_segment_that_ends_where_longer_ones_go_on(size):
    """X and Y share more than E, which ends between them, in all orders."""
    p = ("".join(chr(97 + k * k % 23) for k in range(size))).encode()
    three = [(p + b"aaaax", 1), (p, 2), (p + b"aaaay", 3)]
    for order in itertools.permutations(three):
        checked_covered([s for s, _ in order], [o for _, o in order], 50)


def test_covered_against_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.choice([8, 9, 16, 24])))
                for _ in range(3)]
        words = list({b"".join(rng.choices(base, k=rng.randint(1, 4))) for _ in range(8)})
        checked_covered(words, rng.sample(range(20), len(words)), 8)


@pytest.mark.parametrize("hash_bits", [64, 1])
def test_covered_at_full_length_also_when_hashes_collide(monkeypatch, hash_bits):
    """Equal windows are verified, so colliding hashes change nothing."""
    right = suffixdedup.equal_windows
    if hash_bits == 1:
        monkeypatch.setattr(suffixdedup, "equal_windows",
                            lambda *a: right(*a) & np.uint64(1))
    rng = random.Random(6)
    for length in (16, 17, 24, 50):
        for _ in range(60):
            base = ["".join(rng.choice("ab") for _ in range(rng.randint(length, 3 * length)))
                    for _ in range(3)]
            words = {("".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))
                      + (w := rng.choice(base))[rng.randint(0, 5):len(w) - rng.randint(0, 8)]
                      + "x" * length).encode() for _ in range(12)}
            words = sorted(words)
            checked_covered(words, [rng.randint(0, 5) for _ in words], length)


def test_odd_input(odd):
    src = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(map(shape, suffixdedup.dedup(odd).collect()), key=repr)
    assert got == sorted(slow(src, 50), key=repr)
    assert suffixdedup.dedup(odd.limit(0)).count() == 0
