"""Key index of appended batches, retention and clean-up of the load pipeline."""

import os
import random

import pytest
from pyspark.sql import functions as F

from souk.operators import key_index as K
from souk.plans import pipeline as P
from souk.plans import quality as Q
from souk.sources.proxies import Retail
from tests.conftest import SF0001
from tests.test_pipeline_units import TS


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "k string")


def index_of(spark, batches, key=("k",)):
    parts = [K.build(df, key, df.count()).withColumn("batch", F.lit(b))
             for b, df in batches.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_no_key_is_missed_and_few_are_wrong(spark):
    rnd = random.Random(1)
    ids = [f"{rnd.getrandbits(64):x}" for _ in range(40_000)]
    batches = {1: ids[:25_000], 2: ids[25_000:25_010], 3: ids[25_010:30_000]}
    index = index_of(spark, {b: frame(spark, v) for b, v in batches.items()})
    assert index.filter("batch = 1").count() == K.slots_for(25_000) == 16
    asked = ids[:200] + batches[2] + ids[29_000:29_100] + ids[30_000:]
    got = {(r.batch, r.k) for r in K.may_hold(frame(spark, asked), ("k",), index).collect()}
    true = {(b, k) for b, v in batches.items() for k in set(v) & set(asked)}
    assert true <= got
    assert len(got - true) < 0.02 * 3 * len(asked)


def test_ranges_rule_batches_out_before_bits_do(spark):
    index = index_of(spark, {b: frame(spark, [f"{b}{i:05d}" for i in range(500)])
                             for b in range(1, 7)})
    got = K.may_hold(frame(spark, ["300007", "300501", "0", "zzz", None]), ("k",), index)
    assert [tuple(r) for r in got.collect()] == [(3, "300007")]


def test_keys_of_two_columns_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None), (1, "a")],
                               "x long, k string")
    index = index_of(spark, {5: df}, ("x", "k"))
    asked = spark.createDataFrame([(1, "a"), (1, "c"), (None, "a"), (2, None)],
                                  "x long, k string")
    assert [tuple(r) for r in K.may_hold(asked, ("x", "k"), index).collect()] == [(5, 1, "a")]
    assert K.may_hold(asked.limit(0), ("x", "k"), index).count() == 0
    assert K.may_hold(asked, ("x", "k"), index.limit(0)).count() == 0


def load(spark, zones, rows, **args):
    return P.run_pipeline(spark, rows, Q.PRODUCTS, zones, load_ts=TS, incremental=True, **args)


@pytest.fixture()
def raw(spark):
    return Retail(spark, SF0001).raw_products


def third(raw, n):
    return raw.filter(F.floor(F.col("product_id").cast("long") / 40) % 5 == n)


def test_loads_read_only_batches_that_may_hold_a_key(spark, tmp_dir, raw, monkeypatch):
    zones, read = os.path.join(tmp_dir, "z"), []
    inner = P._read_batches
    monkeypatch.setattr(P, "_read_batches",
                        lambda s, r, z, t, batches: (read.append(batches), inner(
                            s, r, z, t, batches))[1])
    for n in range(4):
        load(spark, zones, third(raw, n))
    assert read == [[], [], []]     # history is not opened, however long it is
    out = load(spark, zones, third(raw, 2).unionByName(third(raw, 4)))
    assert read[3] == [3] and out["rows_skipped"] > 0
    # the same rows as a load that compares with all of history
    clean = P.read_published(spark, zones, "clean", "products", all_batches=True)
    ids = [r.product_id for r in clean.select("product_id").collect()]
    whole = os.path.join(tmp_dir, "whole")
    P.run_pipeline(spark, raw.filter(F.col("product_id").isNotNull()), Q.PRODUCTS, whole,
                   load_ts=TS)
    want = [r.product_id for r in P.read_published(spark, whole, "clean", "products")
            .select("product_id").collect()]
    assert sorted(ids) == sorted(want)


def test_batches_without_an_index_are_read_and_unpublished_ones_are_not(spark, tmp_dir, raw):
    zones = os.path.join(tmp_dir, "z")
    P.run_pipeline(spark, third(raw, 0), Q.PRODUCTS, zones, load_ts=TS)      # no index
    assert P.batches_holding(spark, zones, "products", third(raw, 1), ("product_id",)) == [1]
    again = load(spark, zones, third(raw, 0))
    assert again["rows_loaded"] == 0 and again["rows_skipped"] > 0
    load(spark, zones, third(raw, 1))
    # an index and rows of a run that did not get as far as its audit row
    K.build(third(raw, 2), ("product_id",), 40).write.parquet(
        P.zone_path(zones, "index", "products", 9))
    got = P.batches_holding(spark, zones, "products",
                            third(raw, 1).unionByName(third(raw, 2)), ("product_id",))
    assert got == [1, 3]
    held = P.keys_published(spark, zones, "products", third(raw, 1), ("product_id",))
    assert {r.batch for r in held.collect()} == {3}
    none = P.keys_published(spark, os.path.join(tmp_dir, "none"), "products", raw,
                            ("product_id",))
    assert none.count() == 0


def folders(zones, zone):
    path = os.path.join(zones, zone, "products")
    return sorted(x for x in os.listdir(path) if x.startswith("batch=")) \
        if os.path.isdir(path) else []


def test_a_failing_clean_up_does_not_undo_a_published_batch(spark, tmp_dir, raw, monkeypatch):
    zones = os.path.join(tmp_dir, "z")

    def broken(spark, path):
        raise OSError("folder is busy")
    monkeypatch.setattr(P, "_drop_folder", broken)
    out = P.run_pipeline(spark, raw, Q.PRODUCTS, zones, load_ts=TS)
    assert out["rows_loaded"] > 0
    assert [r.status for r in P.read_audit(spark, zones).collect()] == ["SUCCESS"]
    monkeypatch.undo()
    bad = raw.withColumn("product_weight_g", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        P.run_pipeline(spark, bad, Q.PRODUCTS, zones, load_ts=TS)
    assert folders(zones, "checked") == ["batch=1"]        # the failed run left none


def test_retention_with_a_full_refresh(spark, tmp_dir, raw):
    zones = os.path.join(tmp_dir, "z")
    for keep in (None, None, 2, 1):
        P.run_pipeline(spark, raw, Q.PRODUCTS, zones, load_ts=TS, keep=keep)
        kept = [f"batch={b}" for b in range(1, 5)]
        n = P.newest_batch(spark, zones, "products")
        want = kept[:n] if keep is None else kept[n - keep:n]
        assert all(folders(zones, z) == want for z in ("stg", "error", "clean")), keep
        assert folders(zones, "checked") == []
    assert P.read_audit(spark, zones).count() == 4
    assert P.read_published(spark, zones, "clean", "products").count() > 0
    with pytest.raises(ValueError):
        P.run_pipeline(spark, raw, Q.PRODUCTS, zones, load_ts=TS, incremental=True, keep=1)
    assert P.keep_newest(spark, os.path.join(tmp_dir, "none"), "products") == 0
