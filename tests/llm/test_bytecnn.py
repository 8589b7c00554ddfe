import numpy as np
from pyspark.sql import functions as F

from souk.llm import bytecnn
from tests.conftest import SF0001, SF001


def test_held_out_quality(spark, queries):
    got = queries["op7_bytecnn"](spark, SF001)
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert len(good) > 30 and len(bad) > 5
    wins = sum(a.score > b.score for a in good for b in bad)
    assert wins >= 0.97 * len(good) * len(bad)
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.collect())


def slow_score(net, text):
    """The network read off its definition."""
    b = bytecnn.to_bytes(text)
    n = len(b) - bytecnn.WIDTH + 1
    z = np.array([sum(net.conv[j][b[t + j]] for j in range(bytecnn.WIDTH)) for t in range(n)])
    halves = max(1, -(-n // bytecnn.HALF))
    chunks = [z[k * bytecnn.HALF:(k + 2) * bytecnn.HALF].max(axis=0) + net.bias
              for k in range(max(1, halves - 1))]
    a = np.maximum(chunks, 0)
    x = net.mean @ a.mean(axis=0) + net.peak @ a.max(axis=0) + net.const
    return 1 / (1 + np.exp(-x))


def test_scoring_as_defined(texts, monkeypatch):
    some = [texts[i] for i in sorted(texts)[:30]]
    net = bytecnn.train(some, [i % 2 for i in range(30)], 0.5, epochs=1)
    whole = [net.score(t) for t in some]
    assert np.allclose(whole, [slow_score(net, t) for t in some], atol=1e-4)
    monkeypatch.setattr(bytecnn, "SEGMENT", 3 * bytecnn.HALF)  # long texts go in segments
    assert np.allclose(whole, [net.score(t) for t in some], atol=1e-5)


def test_gradient_step_lowers_loss(texts):
    good = [t for t in texts.values() if t][:60]
    bad = [t.upper() for t in good]
    net = bytecnn.train(good + bad, [1] * 60 + [0] * 60, 0.5, epochs=3)
    assert np.mean([net.score(t) > 0.5 for t in good]) > 0.95
    assert np.mean([net.score(t) < 0.5 for t in bad]) > 0.95


def test_odd_input(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (None, 1), (6, None), (7, 5)],
                                   "doc_id long, quality int")
    net = bytecnn.fit(odd, labels, F.lit(True))
    out = bytecnn.predict(odd, net)
    rows = out.collect()
    assert len(rows) == odd.count() and set(out.columns) == set(odd.columns)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    for few in (labels.limit(0), labels.filter("quality = 1")):
        flat = bytecnn.predict(odd, bytecnn.fit(odd, few, F.lit(True)))
        assert len({r.score for r in flat.collect()}) == 1
    assert bytecnn.predict(odd.limit(0), net).count() == 0


def test_never_learns_from_the_held_out_part(spark, docs):
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    learn = F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = bytecnn.fit(docs, labels, learn), bytecnn.fit(docs, flipped, learn)
    assert np.array_equal(a.conv, b.conv) and a.const == b.const
