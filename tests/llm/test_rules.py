import collections
import re

from souk.llm import rules
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times, cover = collections.Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            cover.update(range(i, i + 8))
    n = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover))
    return (*n, n[0] < 20 or 100 * n[4] > 30 * n[0])


def test_query(spark, queries):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = queries["op3_rules"](spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == slow(docs[r.doc_id])
        assert not (r.base_failed and r.kept)
    judged = [r for r in rows if not r.base_failed and r.doc_id in label]
    good = [r.kept for r in judged if label[r.doc_id] == 1]
    bad = [r.kept for r in judged if label[r.doc_id] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) < 0.5 * len(bad)


def test_covering_finds_planted_rules():
    rows = []
    for i in range(1200):
        r = {f: 0.1 for f in rules.FEATURES}
        r["symbol_share"], r["capital_share"] = (i * 37 % 100) / 100, (i * 61 % 97) / 97
        r["bad"] = r["symbol_share"] > 0.8 or (r["capital_share"] > 0.9 and r["symbol_share"] < 0.3)
        r["mix"] = i * 7919 % 1200
        rows.append(r)
    found = rules.learn_list(rows)
    wrong = [r for r in rows if any(rules.covers(x, r) for x in found) != r["bad"]]
    assert len(found) >= 2 and len(wrong) < 0.02 * len(rows)


def test_odd_input(spark, odd):
    out = rules.apply(odd, [(rules.Test("symbol_share", True, 0.1),)])
    assert set(odd.columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == slow(r.text)
    assert rules.apply(odd.limit(0), []).count() == 0


def test_labels_null_missing_conflicting(spark, odd):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 0), (6, 1)],
                                   "doc_id long, quality int")
    assert isinstance(rules.learn(odd, labels), list)
    assert rules.learn(odd, labels.limit(0)) == []
