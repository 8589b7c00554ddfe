import collections
import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from souk.llm import packing
from tests.conftest import SF0001

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def coder():
    return packing.Encoder(PATH, P.PATTERN)


def check(rows, ids_of, capacity, crc):
    """Pieces are the documents' ids in order, and sequences have no gaps."""
    seqs = collections.defaultdict(list)
    by = collections.defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        by[r["doc_id"]].append(r)
    assert set(by) == set(ids_of)
    for doc, got in by.items():
        ids, at = ids_of[doc], 0
        for i, r in enumerate(sorted(got, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            assert i == 0 or r["length"] == capacity
            assert crc(r, ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids) and len(got) == max(1, -(-len(ids) // capacity))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_query(spark, queries, texts, library):
    rows = [r.asDict() for r in queries["op13_packing"](spark, SF0001).collect()]
    ids = {k: [*library(v or ""), 0] for k, v in texts.items()}
    used = check(rows, ids, 2048, lambda r, part: r["ids_crc32"] == zlib.crc32(
        np.array(part, "<u4").tobytes()))
    assert used <= -(-sum(map(len, ids.values())) // 2048) + 1


@given(st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 'sdtmrelv"), st.characters(codec="utf-8")),
    max_size=40))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_librarys(coder, library, text):
    assert np.frombuffer(coder.encode(text), "u2").tolist() == library(text)


def test_other_vocabularies_and_special_strings(library):
    from tokenizers import Tokenizer
    text = "Hello  WORLD<|endoftext|> it's 12 o'clock\n\n fine"
    assert np.frombuffer(packing.Encoder(PATH).encode(text), "u2").tolist() == library(text)
    other = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = packing.Encoder(P.path("word_bpe_49k.json"), P.PATTERN, False).encode(text)
    assert np.frombuffer(got, "u2").tolist() == other.encode(text, add_special_tokens=False).ids
    plain = Tokenizer.from_file(PATH)
    got = packing.Encoder(PATH, P.PATTERN, special_as_text=False).encode(text)
    assert np.frombuffer(got, "u2").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert 50256 in np.frombuffer(got, "u2")


def test_fullest_is_the_best_of_all_subsets():
    rnd = random.Random(5)
    for _ in range(200):
        items = [rnd.randint(1, 30) for _ in range(rnd.randint(0, 9))]
        room = rnd.randint(0, 60)
        got = packing.fullest(collections.Counter(items), room)
        assert not got - collections.Counter(items)
        best = max(sum(c) for n in range(len(items) + 1)
                   for c in itertools.combinations(items, n) if sum(c) <= room)
        assert sum(k * m for k, m in got.items()) == best


def one_by_one(counts, capacity):
    """The same rule, every bin on its own."""
    left, bins = collections.Counter(counts), 0
    while +left:
        top = max(+left)
        left[top] -= 1
        left -= packing.fullest(dict(+left), capacity - top)
        bins += 1
    return bins


def test_combinations_use_every_piece_once():
    rnd = random.Random(6)
    for _ in range(30):
        counts = {rnd.randint(1, 64): rnd.randint(1, 300) for _ in range(rnd.randint(1, 20))}
        bins = packing.combinations(counts, 64)
        used = collections.Counter()
        for b, times in bins:
            assert sum(k * m for k, m in b.items()) <= 64
            for k, m in b.items():
                used[k] += m * times
        assert used == counts
        n = sum(t for _, t in bins)
        assert n >= -(-sum(k * m for k, m in counts.items()) // 64)
        assert n <= one_by_one(counts, 64) + 1
    huge = packing.combinations({k: 10 ** 12 + k for k in range(1, 2049)}, 2048)
    assert len(huge) < 10_000  # the list does not grow with the counts


def test_places_are_a_bijection():
    counts = {5: 40, 3: 17, 2: 9, 1: 1}
    bins = packing.combinations(counts, 10)
    places, taken = packing.Places(bins), set()
    for length, n in counts.items():
        seq, at = places.find(length, np.arange(n))
        for s, a in zip(seq.tolist(), at.tolist()):
            cells = {(s, a + i) for i in range(length)}
            assert not cells & taken and a + length <= 10
            taken |= cells
    assert len(taken) == sum(k * m for k, m in counts.items())


def test_odd_input(spark, odd, library):
    rows = packing.pack(odd, PATH, 50, 0, pattern=P.PATTERN).collect()
    src = odd.select("doc_id", "text").collect()
    want = collections.Counter()
    for d in src:
        ids = [*library(d.text or ""), 0]
        for start, n in packing.cut(len(ids), 50):
            want[d.doc_id, start, tuple(ids[start:start + n])] += 1
    assert want == collections.Counter(
        (r.doc_id, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows)
    cells = collections.Counter((r.sequence_id, r.offset + i) for r in rows
                                for i in range(r.length))
    assert max(cells.values()) == 1 and all(c[1] < 50 for c in cells)
    empty = packing.pack(odd.limit(0), PATH, 50, pattern=P.PATTERN)
    assert empty.count() == 0 and empty.columns == [
        "doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
