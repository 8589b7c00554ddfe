import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from souk.llm import bpe
from tests.conftest import SF0001

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def tk(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("cut", [False, True])
def test_as_the_library_on_random_text(ranks, tk, cut):
    enc, dec = bpe.Encoder(ranks, P.PATTERN, cut), bpe.StreamDecoder(ranks)
    rng = random.Random(5)
    for alphabet in ("ab", "aAbB0 _-", "日本語テスト 한국어", "  \n\t a1!😀é  ", " =-*#'sdt",
                     "abcdefghijklmnop "):
        for n in (0, 1, 2, 7, 40, 300):
            for _ in range(25):
                s = "".join(rng.choice(alphabet) for _ in range(n))
                ids = enc.encode(s)
                assert ids == tk.encode_ordinary(s), s
                assert dec.decode(ids) == s


def test_long_piece_and_full_tables(ranks, tk, monkeypatch):
    monkeypatch.setattr(bpe, "ARC_LIMIT", 50)
    monkeypatch.setattr(bpe, "PAIR_LIMIT", 50)
    enc = bpe.Encoder(ranks, P.PATTERN, True)
    enc.pieces.limit = enc.stretches.limit = 5
    for s in ("a" * 5000, " " * 3000, "ab" * 3000, "theheaon" * 50 + " and theheaon" * 20):
        assert enc.encode(s) == tk.encode_ordinary(s)


def test_many_texts_together_with_small_tables(ranks, tk, monkeypatch):
    """Groups of texts, states that start afresh, slots taken over by newer pairs."""
    monkeypatch.setattr(bpe, "TABLE_BYTES", 20_000)
    monkeypatch.setattr(bpe, "TOGETHER", 7)
    monkeypatch.setattr(bpe, "STRETCHES", 11)
    monkeypatch.setattr(bpe, "GROUP", 900)
    monkeypatch.setattr(bpe, "SLOTS", 64)
    enc = bpe.Encoder(ranks, P.PATTERN, True)
    enc.pieces.limit = enc.stretches.limit = 9
    rng = random.Random(8)
    texts = ["", " ", "x ", "a\n b", "long" * 30 + " " + "é" * 33 + " end"]
    for _ in range(120):
        texts.append(" ".join("".join(rng.choice("abcdeéß日1,.") for _ in range(rng.randint(1, 20)))
                              for _ in range(rng.randint(1, 30))))
    flat, sizes = enc.many(pa.array(texts))
    ends = sizes.cumsum().tolist()
    for text, n, end in zip(texts, sizes.tolist(), ends, strict=True):
        assert flat[end - n:end].tolist() == tk.encode_ordinary(text), text
    assert [len(x) for x in enc.many(pa.array([], pa.string()))] == [0, 0]


def test_short_and_long_pieces_agree(ranks):
    """Pieces run together give the ids of the same pieces run alone."""
    machine = bpe.Transducer(ranks)
    rng = random.Random(2)
    pieces = sorted({bytes(rng.choices(b"aeinrst\xc3\xa9\xff", k=rng.randint(1, 64)))
                     for _ in range(400)})
    for piece, ids in zip(pieces, bpe.Together(machine).encode(pieces), strict=True):
        got = [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]
        if piece not in ranks:
            assert tuple(got) == machine.encode(piece)
        assert b"".join(machine.bytes_of[i] for i in got) == piece


def test_streaming_decode_keeps_unfinished_bytes(ranks):
    dec = bpe.StreamDecoder(ranks)
    by = [ranks[bytes([b])] for b in "é😀".encode()]
    assert [dec.feed([i]) for i in by] == ["", "é", "", "", "", "😀"]
    assert dec.feed(by[2:4]) == "" and dec.finish() == "�"


def test_vocabulary_out_of_merge_order():
    """Entries whose parts rank later, and entries no merge reaches."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"ab": 258, b"xyz": 259}
    tk = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    enc = bpe.Encoder(ranks, r"\S+|\s+")
    rng = random.Random(1)
    for _ in range(400):
        s = "".join(rng.choice("abcxyz") for _ in range(rng.randint(1, 12)))
        assert enc.encode(s) == tk.encode_ordinary(s), s


def test_query(spark, queries, texts, tk):
    got = {r.doc_id: r for r in queries["op9_bpe"](spark, SF0001).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        ids = tk.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_odd_input(odd, tk):
    back = bpe.decode(bpe.encode(odd, PATH, P.PATTERN, cut=True), PATH)
    rows = back.collect()
    assert len(rows) == odd.count() and set(back.columns) == set(odd.columns)
    for r in rows:
        assert r.token_ids == tk.encode_ordinary(r.text or "") and r.decoded == (r.text or "")
    assert bpe.decode(bpe.encode(odd.limit(0), PATH, P.PATTERN), PATH).count() == 0
