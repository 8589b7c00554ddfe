"""Incremental loads through Structured Streaming."""

import os

from pyspark.sql import functions as F

from souk.plans import pipeline as P
from souk.plans import quality as Q
from souk.streaming import load_micro_batch, start_incremental_load

HEADER = ("product_id,product_category_name,product_name_lenght,product_description_lenght,"
          "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,"
          "product_width_cm\n")


def _write(path, rows):
    with open(path, "w") as f:
        f.write(HEADER)
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_two_drops_append_only_new_keys(spark, tmp_dir):
    src, zones = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "zones")
    ckpt = os.path.join(tmp_dir, "ckpt")
    os.makedirs(src)
    _write(os.path.join(src, "a.csv"), [("p1", "A", 1, 1, 1, 5, 1, 1, 1),
                                        ("p2", None, 1, 1, 1, 5, 1, 1, 1),
                                        ("p3", "B", 1, 1, 1, -1, 1, 1, 1)])
    q = start_incremental_load(spark, src, zones, ckpt)
    q.awaitTermination(120)
    clean = P.read_published(spark, zones, "clean", "products", all_batches=True)
    assert sorted(r.product_id for r in clean.collect()) == ["p1"]
    # second drop: p1 again (already published) and a new valid p4
    _write(os.path.join(src, "b.csv"), [("p1", "A", 1, 1, 1, 5, 1, 1, 1),
                                        ("p4", "C", 2, 2, 2, 7, 2, 2, 2)])
    q = start_incremental_load(spark, src, zones, ckpt)
    q.awaitTermination(120)
    clean = P.read_published(spark, zones, "clean", "products", all_batches=True)
    assert sorted(r.product_id for r in clean.collect()) == ["p1", "p4"]
    audit = P.read_audit(spark, zones).filter(F.col("status") == "SUCCESS").count()
    assert audit == 2


def test_replayed_epoch_is_not_published_twice(spark, tmp_dir):
    zones = os.path.join(tmp_dir, "zones")
    path = os.path.join(tmp_dir, "raw.csv")
    _write(path, [("x1", "A", 1, 1, 1, 5, 1, 1, 1)])
    from souk.sources.files import read_raw
    batch = read_raw(spark, path, "products")
    first = load_micro_batch(spark, batch, 7, spec=Q.PRODUCTS, root=zones, stream_id="s")
    again = load_micro_batch(spark, batch, 7, spec=Q.PRODUCTS, root=zones, stream_id="s")
    assert first["rows_loaded"] == 1 and again is None
    audit = {r.status: r.rows_loaded for r in P.read_audit(spark, zones).collect()}
    assert audit == {"SUCCESS": 1, "SKIPPED": 0}
    # the same epoch of another stream is another micro-batch
    _write(path, [("x2", "A", 1, 1, 1, 5, 1, 1, 1)])
    other = load_micro_batch(spark, read_raw(spark, path, "products"), 7, spec=Q.PRODUCTS,
                             root=zones, stream_id="t")
    assert (other["rows_loaded"], other["rows_rejected"], other["rows_skipped"]) == (1, 0, 0)


def test_second_source_with_a_new_checkpoint_loads(spark, tmp_dir):
    zones = os.path.join(tmp_dir, "zones")
    for name, rows in (("one", [("p1", "A", 1, 1, 1, 5, 1, 1, 1)]),
                       ("two", [("p9", "A", 1, 1, 1, 5, 1, 1, 1),
                                ("p1", "A", 1, 1, 1, 5, 1, 1, 1),
                                ("p8", None, 1, 1, 1, 5, 1, 1, 1)])):
        src = os.path.join(tmp_dir, name)
        os.makedirs(src)
        _write(os.path.join(src, "a.csv"), rows)
        start_incremental_load(spark, src, zones, os.path.join(tmp_dir, f"ckpt-{name}")) \
            .awaitTermination(120)
    clean = P.read_published(spark, zones, "clean", "products", all_batches=True)
    assert sorted(r.product_id for r in clean.collect()) == ["p1", "p9"]
    last = P.read_audit(spark, zones).orderBy(F.desc("run_id")).first()
    assert (last.rows_loaded, last.rows_rejected, last.rows_skipped) == (1, 1, 1)


def test_malformed_cells_go_to_the_error_zone(spark, tmp_dir):
    rows = [("p1", "A", 1, 1, 1, 5, 1, 1, 1), ("p2", "B", 1, 1, 1, "abc", 1, 1, 1)]
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(os.path.join(src, "a.csv"), rows)
    zones = os.path.join(tmp_dir, "stream")
    start_incremental_load(spark, src, zones, os.path.join(tmp_dir, "ckpt")).awaitTermination(120)
    from souk.sources.files import CORRUPT, read_raw
    batch_zones = os.path.join(tmp_dir, "batch")
    out = P.run_pipeline(spark, read_raw(spark, os.path.join(src, "a.csv"), "products", True),
                         Q.PRODUCTS, batch_zones)
    assert (out["rows_loaded"], out["rows_rejected"], out["rows_skipped"]) == (1, 1, 0)
    for z in (zones, batch_zones):
        bad = P.read_published(spark, z, "malformed", "products").collect()
        assert [r[CORRUPT] for r in bad] == ["p2,B,1,1,1,abc,1,1,1"]
        clean = P.read_published(spark, z, "clean", "products").collect()
        assert [r.product_id for r in clean] == ["p1"]


def test_one_run_two_micro_batches(spark, tmp_dir):
    src, zones = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "zones")
    os.makedirs(src)
    _write(os.path.join(src, "a.csv"), [("p1", "A", 1, 1, 1, 5, 1, 1, 1)])
    _write(os.path.join(src, "b.csv"), [("p1", "A", 1, 1, 1, 5, 1, 1, 1),
                                        ("p2", "B", 1, 1, 1, 5, 1, 1, 1)])
    q = start_incremental_load(spark, src, zones, os.path.join(tmp_dir, "ckpt"),
                               max_files_per_trigger=1)
    q.awaitTermination(120)
    audit = P.read_audit(spark, zones).filter(F.col("status") == "SUCCESS") \
        .orderBy("run_id").collect()
    assert [a.run_id for a in audit] == [1, 2]                 # one batch per file
    assert len({a.source_file for a in audit}) == 2            # distinct epoch tags
    clean = P.read_published(spark, zones, "clean", "products", all_batches=True)
    assert sorted(r.product_id for r in clean.collect()) == ["p1", "p2"]
