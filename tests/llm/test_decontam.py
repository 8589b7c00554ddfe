import random

from souk.llm import decontam
from tests.conftest import SF0001


def slow_distance(word, text):
    """Least edits of word to a stretch of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(word, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, word, k):
    s = list(word)
    for _ in range(k):
        at, op = rng.randrange(len(s)), rng.randrange(3)
        if op == 0:
            s[at] = rng.choice("xyzq")
        elif op == 1:
            s.insert(at, rng.choice("xyzq"))
        else:
            del s[at]
    return "".join(s)


def test_myers_as_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert decontam.myers(decontam.masks_of(word), len(word), text)[0] == \
            slow_distance(word, text)


def test_finds_all_within_budget(spark):
    rng = random.Random(4)
    letters = "abcdefgh "
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(20, 90))))
             for i in range(25)]
    docs = []
    for n in range(120):
        noise = ["".join(rng.choice(letters) for _ in range(60)) for _ in range(2)]
        i, word = rng.choice(items)
        docs.append((n, noise[0] + edited(rng, word, rng.randint(0, 9)).upper() + noise[1]))
    got = {(r.doc_id, r.item_id): r for r in decontam.find(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    for n, text in docs:
        low = decontam.folded(text)
        for i, word in items:
            d = slow_distance(word, low)
            assert ((n, i) in got) == (d <= decontam.budget(len(word), 0.08)), (n, i, d)
            if (n, i) in got:
                r = got[n, i]
                assert r.distance == d == slow_distance(word, low[r.match_start:r.match_end])


def test_query_and_planted(spark, queries, texts):
    rows = queries["op5_decontam"](spark, SF0001).collect()
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in texts.items() for i, w in items.items()
             if decontam.folded(w) in decontam.folded(t or "")}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        stretch = decontam.folded(texts[r.doc_id])[r.match_start:r.match_end]
        assert slow_distance(decontam.folded(items[r.item_id]), stretch) == r.distance


def test_blocks_of_items(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    want = {(r.doc_id, r.item_id) for r in decontam.find(docs, items).collect()}
    left = decontam.clean(docs, items).select("doc_id").collect()
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2500)
    assert {(r.doc_id, r.item_id) for r in decontam.find(docs, items).collect()} == want
    assert {r.doc_id for r in left} == {r.doc_id for r in docs.select("doc_id").collect()} \
        - {d for d, _ in want}


def test_short_items_stand_as_whole_words(spark):
    docs = spark.createDataFrame([(1, "xOne two.y, one\ttwo!"), (2, "one twofold, bone two"),
                                  (3, "one twa"), (4, "= 42;"), (5, "142")],
                                 "doc_id int, text string")
    items = spark.createDataFrame([(1, "one two"), (2, "42"), (3, "  ")],
                                  "item_id int, text string")
    got = sorted(tuple(r) for r in decontam.find(docs, items).collect())
    assert got == [(1, 1, 0, 12, 19), (4, 2, 0, 2, 4)]
    assert sorted(r.doc_id for r in decontam.clean(docs, items).collect()) == [2, 3, 5]


def test_copies_of_an_item_are_searched_once(spark, monkeypatch):
    text = "a benchmark item that stands in the table many times"
    items = spark.createDataFrame([(k % 3 or None, text) for k in range(60)],
                                  "item_id int, text string")
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    assert list(decontam.item_blocks(items, "text", 20)) == [[text]]
    docs = spark.createDataFrame([(7, "So " + text)], "doc_id int, text string")
    got = sorted((r.item_id or 0, r.distance) for r in decontam.find(docs, items).collect())
    assert got == [(k, 0) for k in (0, 1, 2) for _ in range(20)]


def test_odd_input(spark, odd):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "short"), (None, "A text without an id, long enough"),
         (5, "a text WITHOUT an id, long\nenough"), (6, "brown fox number 17 jumps. The quick")],
        "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontam.find(odd, items).collect()), key=repr)
    assert got == sorted([(None, None), (None, 5), (6, 6), (7, 6)], key=repr)
    kept = decontam.clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert decontam.find(odd.limit(0), items).count() == 0
    assert decontam.find(odd, items.limit(0)).count() == 0
    assert decontam.clean(odd, items.limit(0)).count() == odd.count()
