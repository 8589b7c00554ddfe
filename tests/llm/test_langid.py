from pyspark.sql import functions as F

from souk.llm import langid
from souk.llm.common import id_remainder
from tests.conftest import SF001


def test_held_out_accuracy(spark, queries):
    got = queries["op8_langid"](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_learns_from_its_part_only(docs):
    """Labels of the held-out part, and of null ids, change nothing."""
    learn = F.coalesce(id_remainder(4) != 2, F.lit(False))
    other = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise(F.lit("xx")))
    assert "xx" not in sum(langid.fit(other, learn).groups.values(), [])


def test_odd_input(odd, docs):
    model = langid.fit(docs, F.lit(True))
    out = langid.predict(odd, model)
    rows = out.collect()
    assert len(rows) == odd.count() and set(out.columns) == set(odd.columns)
    for r in rows:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters)
        assert r.score == 0 if not letters else 0 < r.score <= 1
    assert langid.predict(odd.limit(0), model).count() == 0


def test_nothing_to_learn(odd):
    model = langid.fit(odd, F.lit(False))
    assert {(r.lang_pred, r.score) for r in langid.predict(odd, model).collect()} == {("und", 0.0)}


def test_one_language_alone(odd):
    model = langid.fit(odd, F.lit(True))
    rows = langid.predict(odd, model).collect()
    assert {r.lang_pred for r in rows} == {"en", "und"}


def test_family_first():
    assert langid.family_of("en") == langid.family_of("de") != langid.family_of("fr")
    assert langid.family_of("zz") == "only zz"
