"""Rules, duplicate flagging and the publish protocol."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from souk.operators.dedupe import flag_duplicates
from souk.plans import pipeline as P
from souk.plans import quality as Q
from souk.sources.files import read_raw
from souk.sources.proxies import Retail
from tests.conftest import SF0001, SF001

RAW = ("product_id string, product_category_name string, product_name_lenght int, "
       "product_description_lenght int, product_photos_qty int, product_weight_g int, "
       "product_length_cm int, product_height_cm int, product_width_cm int")
TS = dt.datetime(2024, 1, 1)


def raw(spark, rows, tmp_dir):
    """Hand-made raw rows written as Parquet: validation expects a stable scan."""
    path = os.path.join(tmp_dir, "raw")
    spark.createDataFrame(rows, RAW).write.parquet(path)
    return spark.read.parquet(path)


def test_empty_audit_gives_batch_one(spark, tmp_dir):
    assert P.next_batch_id(P.read_audit(spark, tmp_dir)) == 1


def test_several_faults_in_rule_order(spark, tmp_dir):
    rows = [("p1", None, 5, 5, 1, -1, 1, 1, 1), ("p1", None, 5, 5, 1, -1, 1, 1, 1),
            ("p2", "A", 5, 5, 1, 10, 1, 1, 1)]
    v = P.validate_staged(P.stage(raw(spark, rows, tmp_dir), Q.PRODUCTS, 1, TS), Q.PRODUCTS)
    msgs = sorted((r.product_id, r.error_flags) for r in v.collect())
    assert msgs == [
        ("p1", "Product category name is null; Product weight is negative; "),
        ("p1", "Product category name is null; Product weight is negative; "
               "Duplicate product; "),
        ("p2", None)]


def test_zero_null_weight_and_blank_category(spark, tmp_dir):
    rows = [("a", "X", 1, 1, 1, 0, 1, 1, 1), ("b", "X", 1, 1, 1, None, 1, 1, 1),
            ("c", "   ", 1, 1, 1, 5, 1, 1, 1)]
    src = raw(spark, rows, tmp_dir)
    a = {r.product_id: r.error_flags for r in
         P.validate_staged(P.stage(src, Q.PRODUCTS, 1, TS), Q.PRODUCTS).collect()}
    assert a == {"a": None, "b": None, "c": None}          # profile A: all valid
    b = P.validate_raw(src, Q.PRODUCTS)
    assert {r.product_id: r.is_valid for r in b.collect()} == \
        {"a": False, "b": False, "c": True}
    clean = P.transform(b, Q.PRODUCTS).collect()
    assert [(r.product_id, r.product_category_name, r.product_weight_g) for r in clean] \
        == [("c", "", 5.0)]


def test_null_ids_and_copies_flag_all_but_one(spark, tmp_dir):
    rows = [(None, "A", 1, 1, 1, 1, 1, 1, 1)] * 50 + [(None, "B", 1, 1, 1, 1, 1, 1, 1)] * 3 \
        + [("k", "A", 1, 1, 1, 1, 1, 1, 1)] * 7 + [("u", "A", 1, 1, 1, 1, 1, 1, 1)]
    df = flag_duplicates(raw(spark, rows, tmp_dir), ["product_id"], "dup")
    got = {(r.product_id, r.product_category_name, r.dup): r.n for r in
           df.groupBy("product_id", "product_category_name", "dup").count()
           .withColumnRenamed("count", "n").collect()}
    # the first NULL-id row is the smallest by all columns: category "A"
    assert got == {(None, "A", False): 1, (None, "A", True): 49, (None, "B", True): 3,
                   ("k", "A", False): 1, ("k", "A", True): 6, ("u", "A", False): 1}


def test_split_is_a_disjoint_partition(spark):
    r = Retail(spark, SF001)
    v = P.validate_staged(P.stage(r.raw_products, Q.PRODUCTS, 1, TS), Q.PRODUCTS)
    err, clean = P.error_rows(v, Q.PRODUCTS), P.clean_rows(v, Q.PRODUCTS)
    assert err.count() + clean.count() == v.count() == 2038
    assert (err.count(), clean.count()) == (245, 1793)
    b = P.validate_raw(r.raw_products, Q.PRODUCTS)
    assert b.filter(~F.col("is_valid")).count() == 314


def test_publish_and_failed_run_keeps_previous_batch(spark, tmp_dir):
    r = Retail(spark, SF0001)
    zones = os.path.join(tmp_dir, "zones")
    out = P.run_pipeline(spark, r.raw_products, Q.PRODUCTS, zones, load_ts=TS)
    assert out == {"batch_id": 1, "rows_loaded": 177, "rows_rejected": 27, "rows_skipped": 0}
    bad = r.raw_products.withColumn(
        "product_weight_g", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception):
        P.run_pipeline(spark, bad, Q.PRODUCTS, zones, profile="flags", load_ts=TS)
    audit = P.read_audit(spark, zones).orderBy("run_id").collect()
    assert [(a.run_id, a.status, a.rows_loaded) for a in audit] == \
        [(1, "SUCCESS", 177), (2, "FAILED", -1)]
    assert "boom" in audit[1].error_message and len(audit[1].error_message) <= 500
    assert P.read_published(spark, zones, "clean", "products").count() == 177
    with pytest.raises(Exception):
        P.run_pipeline(spark, bad, Q.PRODUCTS, zones, load_ts=TS)
    last = P.read_audit(spark, zones).orderBy("run_id").collect()[-1]
    assert (last.run_id, last.status, last.rows_loaded, last.rows_rejected) == \
        (3, "FAILED", 0, 0)
    out3 = P.run_pipeline(spark, r.raw_products, Q.PRODUCTS, zones, profile="flags",
                          load_ts=TS)
    assert out3["batch_id"] == 4 and out3["rows_rejected"] == 35
    assert P.read_published(spark, zones, "clean", "products").count() == \
        out3["rows_loaded"]


def test_translation_csv_with_bom(spark, tmp_dir):
    path = os.path.join(tmp_dir, "translation.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("product_category_name,product_category_name_english\n"
                "beleza_saude,health_beauty\npcs,computers\n")
    df = read_raw(spark, path, "product_category_name_translation")
    assert df.columns[0] == "product_category_name"
    assert sorted(tuple(r) for r in df.collect()) == \
        [("beleza_saude", "health_beauty"), ("pcs", "computers")]


def test_incremental_rows(spark):
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "product_id string")
    old = spark.createDataFrame([("b",)], "product_id string")
    assert sorted(r[0] for r in P.incremental_rows(new, old, ("product_id",)).collect()) \
        == ["a", "c"]


def test_empty_clone_and_table_listing(spark):
    from souk.sources.tables import list_tables, register_views
    r = Retail(spark, SF0001)
    e = P.empty_clone(r.raw_products)
    assert e.schema == r.raw_products.schema and e.count() == 0
    register_views(spark, SF0001, ("nation", "region"))
    names = [row.table_name for row in list_tables(spark).collect()]
    assert {"nation", "region"} <= set(names) and names == sorted(names)


def test_cluster_conf_scales_with_input():
    from souk.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, cores=8000)      # 100 TB, 1000 x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 102_400
    mid = cluster_conf(20 * 1024 ** 4, cores=8000)       # 20 TB
    assert int(mid["spark.sql.shuffle.partitions"]) == 20 * 1024
    small = cluster_conf(10 * 1024 ** 2, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_flag_duplicates_on_shuffled_input_with_checkpoint(spark, tmp_dir):
    rows = [("k", "A", 1, 1, 1, 1, 1, 1, 1)] * 5 + [(None, "B", 1, 1, 1, 1, 1, 1, 1)] * 3
    shuffled = raw(spark, rows, tmp_dir).repartition(4, "product_category_name")
    df = flag_duplicates(shuffled, ["product_id"], "dup", stable=True)
    got = sorted((r.product_id or "", r.dup) for r in df.collect())
    assert got == [("", False)] + [("", True)] * 2 + [("k", False)] + [("k", True)] * 4


def test_append_refuses_a_second_profile(spark, tmp_dir):
    r = Retail(spark, SF0001)
    zones = os.path.join(tmp_dir, "zones")
    P.run_pipeline(spark, r.raw_products, Q.PRODUCTS, zones, load_ts=TS, incremental=True)
    with pytest.raises(ValueError, match="another rule profile"):
        P.run_pipeline(spark, r.raw_products, Q.PRODUCTS, zones, profile="flags",
                       load_ts=TS, incremental=True)
    audit = P.read_audit(spark, zones).orderBy("run_id").collect()
    assert [(a.status, a.profile) for a in audit] == [("SUCCESS", "message"),
                                                      ("FAILED", "flags")]
