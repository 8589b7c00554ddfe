import re

import numpy as np
import xxhash

from souk.llm import simhash
from tests.conftest import SF0001


def slow_fingerprint(t, k=4):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def slow_components(fps, bits=4):
    """fps: list of (id, fp) -> component id per entry, by brute force."""
    up = list(range(len(fps)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= bits:
                up[max(top(a), top(b))] = min(top(a), top(b))
    ids = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            ids[top(i)] = min(d, ids.get(top(i), d))
    return [ids.get(top(i)) for i in range(len(fps))]


def test_query(spark, queries, texts):
    got = {r.doc_id: r for r in queries["op6_simhash"](spark, SF0001).collect()}
    fps = [(i, slow_fingerprint(t)) for i, t in sorted(texts.items())]
    assert {i: "%016x" % f for i, f in fps} == {i: r.fingerprint for i, r in got.items()}
    assert dict(zip([i for i, _ in fps], slow_components(fps))) == \
        {i: r.component_id for i, r in got.items()}


def planted(n=3000, seed=3):
    """Random fingerprints, some with chains of neighbours 1 to 6 bits away."""
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 1 << 63, n, dtype=np.uint64).tolist()
    for f in out[:300]:
        for _ in range(int(rng.integers(1, 4))):
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                f ^= 1 << int(b)
            out.append(f)
    return sorted(set(out))


def test_all_pairs_over_shards_and_blocks(spark):
    fps = planted()
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = simhash.links(df, 4, shard_rows=400, block_rows=300, all_pairs=True).distinct().collect()
    a = np.array(fps, np.uint64)
    want = set()
    for i in range(len(a)):
        for j in np.nonzero(np.bitwise_count(a[:i] ^ a[i]) <= 4)[0]:
            want.add(frozenset((fps[i], fps[j])))
    mask = (1 << 64) - 1
    assert want and {frozenset((r.a & mask, r.b & mask)) for r in got} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a long, b long")
    rows = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len(rows) == 303 and {rows[i] for i in range(301)} == {0} and rows[901] == 900
    assert simhash.components(edges.limit(0)).count() == 0


def test_dense_group_gives_a_forest():
    base = np.uint64(0x0123456789ABCDEF)
    near = np.array([base ^ np.uint64(1 << i) for i in range(64)] + [base], np.uint64)
    assert len(simhash.near_links(near, near, 4)) == 64
    assert len(simhash.near_links(near, near, 4, all_pairs=True)) == 65 * 64 // 2


def test_odd_input(odd):
    rows = simhash.near_duplicates(odd).collect()
    src = [(r.doc_id, slow_fingerprint(r.text)) for r in odd.collect()]
    comp = slow_components(src)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for _, f in src]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.id, r.fp, r.component_id) for r in rows), key=key) == \
        sorted(zip([i for i, _ in src], signed, comp), key=key)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
