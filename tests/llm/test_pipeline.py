import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from souk.llm import bpe, decontam, secrets
from tests.conftest import SF0001
from tests.llm.test_simhash import slow_components, slow_fingerprint


def stage(n):
    return corpus_pipeline.STAGES[n][1]


def test_each_stage_against_brute_force(spark, docs):
    columns = docs.columns
    first = stage(0)(spark, docs, SF0001).cache()
    assert first.columns == columns
    ids = {r.doc_id for r in first.collect()}
    assert ids == {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}

    second = stage(1)(spark, first, SF0001).cache()
    rows = sorted((r.doc_id, slow_fingerprint(r.text)) for r in first.collect())
    assert sorted(r.doc_id for r in second.collect()) == sorted(set(slow_components(rows)))

    third = stage(2)(spark, second, SF0001).cache()
    items = [decontam.folded(r.text) for r in
             spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    left = {r.doc_id for r in second.collect()
            if not any(w in decontam.folded(r.text) for w in items)}
    assert {r.doc_id for r in third.collect()} == left and third.count() < second.count()

    fourth = stage(3)(spark, third, SF0001).cache()
    assert fourth.columns == columns
    before = {r.doc_id: r for r in third.collect()}
    for r in fourth.collect():
        assert r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
    assert fourth.count() == third.count()
    again = fourth.select(secrets.base_spans(F.col("text")).alias("b")).filter("size(b) > 0")
    assert again.count() == 0

    last = stage(4)(spark, fourth, SF0001)
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        tk = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()),
                               special_tokens={})
    texts = {r.doc_id: r.text for r in fourth.collect()}
    got = last.collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.token_ids == tk.encode_ordinary(texts[r.doc_id]) and r.round_trip
        assert r.n_tokens == len(r.token_ids)


def test_first_stage_rejects_doubtful_languages(spark, docs):
    rejected = ["12345 67890 !!! a 999 ### 0000", "Съешь же ещё этих мягких французских булок",
                "日本語の文章はここにあります", "=== 1 == 22 === x1 {{{ }}} 345 ;;; 90210"]
    clean = [r.text for r in docs.orderBy("doc_id").limit(20).collect()
             if any(map(str.isalpha, r.text or ""))]
    rows = [(-1 - k, t) for k, t in enumerate(rejected)] + \
        [(-100 - k, t) for k, t in enumerate(clean)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    out = stage(0)(spark, docs.unionByName(extra, allowMissingColumns=True), SF0001)
    assert sorted(r.doc_id for r in out.filter("doc_id < 0").collect()) == \
        sorted(-100 - k for k in range(len(clean)))


def test_run_equals_the_stages(spark, queries):
    a = queries["pipeline"](spark, SF0001).select("doc_id", "n_tokens").collect()
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF0001)
    assert sorted(a) == sorted(docs.select("doc_id", "n_tokens").collect())


def test_odd_input(spark, odd):
    """Each stage on nulls, copies, long texts, clashing columns; and no rows."""
    for n in range(4):
        out = stage(n)(spark, odd, SF0001)
        assert out.columns == odd.columns
        assert 0 < out.count() <= odd.count()
        assert stage(n)(spark, odd.limit(0), SF0001).count() == 0
    kept = [r.doc_id for r in stage(1)(spark, odd, SF0001).collect()]
    assert kept.count(2) == 0 and kept.count(1) == 1 and 3 in kept and 4 not in kept
    assert stage(3)(spark, odd, SF0001).filter("text is null").count() == 2
    rows = stage(4)(spark, odd, SF0001).collect()
    assert len(rows) == odd.count() and all(r.round_trip for r in rows)
