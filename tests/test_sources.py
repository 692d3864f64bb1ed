"""CSV loads: the bad-row matrix, the file registry, required inputs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from ordermill.sources import files
from ordermill.sources.csv_load import load_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("qty", T.LongType())])

BAD_MATRIX = (
    "﻿id,name,qty\r\n"
    '1,"alpha",3\r\n'
    '2,"be""ta",4\r\n'          # doubled quote inside quotes
    '3,"multi\nline",5\r\n'     # embedded newline
    "4,short\r\n"               # too few fields
    "5,long,6,extra\r\n"        # too many fields
    "6,typed,notanumber\r\n"    # mistyped value
    '7,"",8\r\n'                # quoted empty: empty string
    "8,,9\r\n"                  # unquoted empty: NULL
)


def _write(tmp, name, text):
    path = os.path.join(tmp, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_bad_row_matrix(spark, tmp):
    path = _write(tmp, "a.csv", BAD_MATRIX)
    parts = load_csv(spark, path, SCHEMA)
    good = {r["id"]: (r["name"], r["qty"]) for r in parts.good.collect()}
    assert good == {1: ("alpha", 3), 2: ('be"ta', 4), 3: ("multi\nline", 5),
                    7: ("", 8), 8: (None, 9)}
    bad = sorted(r["_corrupt_record"] for r in parts.rejected.collect())
    assert bad == ["4,short", "5,long,6,extra", "6,typed,notanumber"]


def test_rejects_do_not_depend_on_projection(spark, tmp):
    # The mistyped value sits in a column the caller does not look at.
    path = _write(tmp, "b.csv", "id,name,qty\n1,a,1\n2,b,x\n")
    parts = load_csv(spark, path, SCHEMA)
    assert [r["id"] for r in parts.good.select("id").collect()] == [1]
    assert parts.rejected.count() == 1


def test_load_files_report_and_missing_inputs(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    lookup = "﻿product_category_name,product_category_name_english\r\nbeleza_saude,health_beauty\r\nbroken\r\n"
    _write(src, "product_category_name_translation.csv", lookup)
    _write(src, "olist_sellers_dataset.csv",
           "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
           '"s1","01001","sao paulo","SP"\n')
    report = files.load_files(spark, src, os.path.join(tmp, "tables"), os.path.join(tmp, "bad"))
    rows = {r["table_name"]: (r["rows_loaded"], r["rows_rejected"]) for r in report.collect()}
    assert rows == {"raw_product_category_name_translation": (1, 1), "raw_sellers": (1, 0)}
    # The parsed copy sits in one fixed place per table and is replaced by the next load.
    assert os.path.isdir(os.path.join(tmp, "bad", "_parsed", "raw_sellers"))
    files.load_files(spark, src, os.path.join(tmp, "tables"), os.path.join(tmp, "bad"))
    assert spark.read.parquet(os.path.join(tmp, "bad", "_parsed", "raw_sellers")).count() == 1
    sellers = spark.read.parquet(os.path.join(tmp, "tables", "raw_sellers")).collect()
    assert sellers[0]["seller_zip_code_prefix"] == "01001"   # ids stay text
    missing = sorted(r["file_name"] for r in files.missing_inputs(spark, src).collect())
    assert missing == ["olist_customers_dataset.csv", "olist_orders_dataset.csv",
                       "olist_products_dataset.csv"]
    with pytest.raises(FileNotFoundError, match="olist_orders_dataset.csv"):
        files.require_inputs(spark, src)
    files.require_inputs(spark, src, ["olist_sellers_dataset.csv"])


def test_missing_folder_lists_everything(spark, tmp):
    assert files.missing_inputs(spark, os.path.join(tmp, "nope")).count() == 4


def test_landing_table_created_once_then_fed_by_the_stream(spark, tmp):
    import json
    from ordermill.streaming import ingest
    path = os.path.join(tmp, "landing")
    files.ensure_landing_table(spark, path)
    files.ensure_landing_table(spark, path)
    df = ingest.read_landing(spark, path)
    assert df.count() == 0 and "insert_timestamp" in df.columns
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"order_id": "o", "customer_id": "c", "product_id": "p",
                            "seller_id": "s", "quantity": 1, "price": 1.0,
                            "timestamp": "2024-01-01T00:00:00"}) + "\n")
    sink = ingest.LandingSink(path, os.path.join(tmp, "bad"), os.path.join(tmp, "ck"))
    sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    assert ingest.read_landing(spark, path).count() == 1


def test_save_table_and_view(spark, tmp):
    df = spark.range(5).withColumnRenamed("id", "k")
    files.save(df, os.path.join(tmp, "t"))
    assert spark.read.parquet(os.path.join(tmp, "t")).count() == 5
    files.save(df.where("k > 2"), "ordermill_test_view", kind="view")
    assert spark.table("ordermill_test_view").count() == 2
    with pytest.raises(ValueError):
        files.save(df, "x", kind="index")


def test_raw_orders_timestamps_and_bad_dates(spark, tmp):
    from ordermill.sources.schemas import RAW_ORDERS
    head = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
            "order_delivered_carrier_date,order_delivered_customer_date,"
            "order_estimated_delivery_date\r\n")
    body = ('"o1","c1","delivered",2017-10-02 10:56:33,2017-10-02 11:07:15,'
            "2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00\r\n"
            '"o2","c2","shipped",2018-07-24 20:41:37,,,,2018-08-13 00:00:00\r\n'
            '"o3","c3","delivered",not-a-date,,,,2018-08-13 00:00:00\r\n')
    path = _write(tmp, "orders.csv", "﻿" + head + body)
    parts = load_csv(spark, path, RAW_ORDERS)
    good = {r["order_id"]: r for r in parts.good.collect()}
    import datetime as dt
    assert good["o1"]["order_purchase_timestamp"] == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert good["o2"]["order_approved_at"] is None        # empty field -> NULL
    assert set(good) == {"o1", "o2"}
    assert [r["order_id"] for r in parts.rejected.collect()] == ["o3"]


def test_header_only_file_loads_zero_rows(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    _write(src, "olist_sellers_dataset.csv",
           "seller_id,seller_zip_code_prefix,seller_city,seller_state\r\n")
    report = files.load_files(spark, src, os.path.join(tmp, "t"), os.path.join(tmp, "q")).collect()
    assert [(r["rows_loaded"], r["rows_rejected"]) for r in report] == [(0, 0)]
    assert spark.read.parquet(os.path.join(tmp, "t", "raw_sellers")).count() == 0


def test_one_line_files_split_and_folders_load(spark, tmp):
    from ordermill.sources.csv_load import read_csv
    src = os.path.join(tmp, "raw")
    folder = os.path.join(src, "olist_sellers_dataset.csv")
    os.makedirs(folder)
    head = "seller_id,seller_zip_code_prefix,seller_city,seller_state\r\n"
    for part in range(2):
        rows = "".join(f's{part}_{i},"01001","sao ""x"", paulo",SP\r\n' for i in range(5000))
        _write(folder, f"part-{part}.csv", "\ufeff" + head + rows + "short\r\n")
    schema = files.RAW_FILES["olist_sellers_dataset.csv"][1]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        assert read_csv(spark, folder, schema, multi_line=False).rdd.getNumPartitions() > 2
        report = files.load_files(spark, src, os.path.join(tmp, "t"), os.path.join(tmp, "q")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["rows_loaded"], r["rows_rejected"]) for r in report] == [(10000, 2)]
    cities = spark.read.parquet(os.path.join(tmp, "t", "raw_sellers")).select("seller_city").distinct().collect()
    assert [r[0] for r in cities] == ['sao "x", paulo']


def test_quoted_line_ends_only_where_declared(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    text = "a,b\n1,\"x\ny\"\n"
    layout = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    _write(src, "m.csv", text)
    load = lambda multi: [(r["rows_loaded"], r["rows_rejected"]) for r in files.load_files(
        spark, src, os.path.join(tmp, "t"), os.path.join(tmp, "q"), {"m.csv": ("m", layout)}, multi).collect()]
    assert load(("m.csv",)) == [(1, 0)]
    assert load(())[0][1] > 0            # never loaded in part without a trace


def test_a_failing_file_is_named_and_the_others_load(spark, tmp):
    src, tables = os.path.join(tmp, "raw"), os.path.join(tmp, "t")
    os.makedirs(src)
    names = ("a.csv", "b.csv.gz", "c.csv", "absent.csv", "d.csv")
    for name in ("a.csv", "c.csv", "d.csv"):
        _write(src, name, f"id,name,qty\n1,{name},2\n2,x,y\n")
    _write(src, "b.csv.gz", "this is not a compressed file")
    wanted = {name: (f"raw_{name[0]}" if name != "absent.csv" else "raw_absent", SCHEMA) for name in names}
    with pytest.raises(RuntimeError, match=r"files not loaded: b\.csv\.gz: "):
        files.load_files(spark, src, tables, os.path.join(tmp, "q"), wanted, multi_line=(), at_once=2)
    for name in ("a", "c", "d"):
        assert [r["name"] for r in spark.read.parquet(os.path.join(tables, f"raw_{name}")).collect()] == [f"{name}.csv"]
    assert not os.path.exists(os.path.join(tables, "raw_b"))
    report = files.load_files(spark, src, tables, os.path.join(tmp, "q"), {n: w for n, w in wanted.items() if n != "b.csv.gz"},
                              multi_line=())
    assert [tuple(r) for r in report.collect()] == [(f"{n}.csv", f"raw_{n}", 1, 1) for n in "acd"]
