"""Reports and pipeline on the raw CSV layout of the public data set."""

import os

import pytest

from souk.plans import customers, pipeline, quality, revenue
from souk.plans.insights import operations as OP
from souk.sources.retail_files import RetailFiles

CSV = {
    "customers.csv": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01310,sao paulo,SP
c2,u1,01310,sao paulo,SP
c3,u2,20040,rio de janeiro,RJ
""",
    "geolocation.csv": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01310,-23.5,-46.6,sao paulo,SP
01310,-23.5,-46.6,sao paulo,SP
20040,-22.9,-43.2,rio de janeiro,RJ
""",
    "orders.csv": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00
o2,c2,delivered,2017-11-05 08:00:00,2017-11-05 09:00:00,2017-11-06 10:00:00,2017-11-09 10:00:00,2017-11-20 00:00:00
o3,c3,canceled,2017-11-07 08:00:00,,,,2017-11-30 00:00:00
""",
    "order_items.csv": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,4244733e06e7ecb4970a6e2683c13e61,s1,2017-10-06 11:07:15,29.99,8.72
o2,1,p2,s2,2017-11-08 00:00:00,100.00,10.00
o2,2,4244733e06e7ecb4970a6e2683c13e61,s1,2017-11-08 00:00:00,29.99,8.72
o3,1,p3,s2,2017-11-09 00:00:00,50.00,5.00
""",
    "order_payments.csv": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,1,38.71
o2,1,boleto,1,148.71
o3,1,credit_card,3,55.00
""",
    "order_reviews.csv": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,4,,,2017-10-11 00:00:00,2017-10-12 03:43:48
r2,o2,5,,"ok, fast",2017-11-10 00:00:00,2017-11-11 00:00:00
r3,o3,1,"a ""bad"" one","two
lines, ""quoted"" too",2017-11-12 00:00:00,2017-11-13 00:00:00
""",
    "products.csv": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
4244733e06e7ecb4970a6e2683c13e61,perfumaria,40,287,1,225,16,10,14
p2,informatica_acessorios,44,276,1,1000,30,18,20
p3,,46,250,1,-5,16,10,14
""",
    "sellers.csv": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,13023,campinas,SP
s2,80000,curitiba,PR
""",
    "product_category_name_translation.csv": """﻿product_category_name,product_category_name_english
perfumaria,perfumery
informatica_acessorios,computers_accessories
""",
}


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("rawfiles")
    for name, text in CSV.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    return RetailFiles(spark, str(folder))


def test_reports_run_on_the_raw_files(files):
    r = files
    trend = [(x.month_label, x.total_revenue, x.running_total_revenue)
             for x in revenue.monthly_revenue_trend(r.orders, r.order_items).collect()]
    assert trend == [("2017-10", 29.99, 29.99), ("2017-11", 179.99, 209.98)]
    cats = {x.product_category_name: (x.total_revenue, x.number_of_orders) for x in
            revenue.category_revenue(r.order_items, r.products, r.category_name).collect()}
    assert cats == {"perfumery": (59.98, 2), "computers_accessories": (100.0, 1)}
    states = {x.customer_state: (x.total_customers, x.repeat_customers) for x in
              customers.repeat_by_state(r.orders, r.customers).collect()}
    assert states == {"SP": (1, 1), "RJ": (1, 0)}
    city = {x.customer_city: (x.total_customers, x.repeat_customers) for x in
            customers.repeat_by_city(r.orders, r.customers, r.geolocation,
                                     min_customers=0).collect()}
    assert city == {"sao paulo": (1, 1), "rio de janeiro": (1, 0)}   # 2 geo rows -> 4 > 1
    regions = {x.seller_region: x.revenue for x in
               OP.region_performance(r.orders, r.order_items, r.sellers).collect()}
    assert regions == {"Sudeste": 59.98, "Sul": 150.0}


def test_pipeline_runs_on_the_raw_products(spark, files, tmp_path):
    from pyspark.sql import functions as F
    raw = files.raw_products
    raw = raw.unionByName(raw.filter(F.col("product_id") == "4244733e06e7ecb4970a6e2683c13e61"))   # one exact copy
    out = pipeline.run_pipeline(spark, raw, quality.PRODUCTS, str(tmp_path / "zones"))
    assert (out["rows_loaded"], out["rows_rejected"]) == (2, 2)


def test_text_over_lines_and_doubled_quotes(files):
    rows = {r.review_id: r for r in files.table("order_reviews").collect()}
    assert len(rows) == 3 and rows["r3"].review_score == 1
    assert rows["r3"].review_comment_title == 'a "bad" one'
    assert rows["r3"].review_comment_message == 'two\nlines, "quoted" too'
    assert files.order_reviews.count() == 3


def test_swapped_headers_are_refused(spark, tmp_path):
    from souk.sources.files import read_raw
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\ns1,c,1,SP\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(path), "sellers").collect()


def test_every_report_runs_on_the_raw_files(files):
    """Each registered report and analysis on text ids; none may fail."""
    from souk import catalog
    skip = catalog.WRITING_KEYS | {"etl_customers", "etl_orders"}
    ran = 0
    original = catalog.retail
    catalog.retail = lambda spark, root, kind=None: files
    try:
        for key, query in catalog.QUERIES.items():
            if key in skip or key.startswith(("etl_", "dq_")) or key.endswith("_dirty"):
                continue
            query(files.spark, "").collect()
            ran += 1
    finally:
        catalog.retail = original
    assert ran > 50


def test_recommend_and_elasticity_on_text_ids(files):
    from souk.plans.insights import segments as SG
    rec = SG.recommend(files.order_items, files.products).collect()
    assert {r.top_product_id for r in rec} <= {"4244733e06e7ecb4970a6e2683c13e61", "p2", "p3"}
    el = {r.product_category_name: r.items for r in
          SG.price_elasticity(files.order_items, files.products, files.orders).collect()}
    assert el == {"perfumaria": 2, "informatica_acessorios": 1, "Misc": 1}


def test_no_break_space_is_stripped(spark):
    from pyspark.sql import functions as F
    from souk.functions import strip_ws
    df = spark.createDataFrame([("\u00a0 x\u2003y \u3000\n",)], "s string")
    assert df.select(strip_ws(F.col("s"))).first()[0] == "x\u2003y"


def test_large_files_are_read_in_splits(spark, tmp_path):
    """Only reviews, whose texts may span lines, are one task a file."""
    from souk.sources.files import read_raw
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        path = tmp_path / "sellers.csv"
        path.write_text("﻿seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "".join(
            f's{i},0{i},"a, ""quoted"" city",SP\n' for i in range(20_000)), encoding="utf-8")
        sellers = read_raw(spark, str(path), "sellers")
        assert sellers.rdd.getNumPartitions() > 4
        assert sellers.count() == sellers.distinct().count() == 20_000
        assert sellers.first().seller_city == 'a, "quoted" city'
        path = tmp_path / "reviews.csv"
        path.write_text(
            "review_id,order_id,review_score,review_comment_title,review_comment_message,"
            "review_creation_date,review_answer_timestamp\n" + "".join(
                f'r{i},o{i},5,,"two\nlines",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
                for i in range(3_000)))
        reviews = read_raw(spark, str(path), "order_reviews")
        assert reviews.rdd.getNumPartitions() == 1
        assert reviews.filter("review_comment_message = 'two\\nlines'").count() == 3_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
