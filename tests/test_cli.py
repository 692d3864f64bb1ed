"""The spark-submit entry points, run in-process on the test session."""

from __future__ import annotations

import json
import os

from ordermill.__main__ import main
from ordermill.sources import fixtures as fx


def test_daily_job_from_parquet_staging(spark, sf_dir, tmp, capsys):
    stg_dir = os.path.join(tmp, "stg")
    for name, df in fx.staging(spark, sf_dir).items():
        df.write.parquet(os.path.join(stg_dir, name))
    assert main(["--local", "daily", stg_dir, os.path.join(tmp, "dwh")]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    counts = {r["table_name"]: r["row_count"] for r in lines if "table_name" in r}
    assert set(counts) == {"dim_customers", "dim_products", "dim_sellers", "fact_orders"}
    assert os.path.isdir(os.path.join(tmp, "dwh", "fact_orders"))


def test_ingest_monitor_and_compact_jobs(spark, tmp, capsys):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    msg = {"order_id": "ORDER_1", "customer_id": "CUST_1", "product_id": '"p"',
           "seller_id": '"s"', "quantity": 2, "price": 9.5, "timestamp": "2024-01-01T10:00:00"}
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps(msg) + "\n{bad\n")
    land, bad, ckpt = (os.path.join(tmp, d) for d in ("land", "bad", "ckpt"))
    assert main(["--local", "ingest", land, bad, ckpt, "--text-dir", src, "--available-now"]) == 0
    assert spark.read.parquet(land).count() == 1 and spark.read.parquet(bad).count() == 1
    # Just landed, so the monitor sees a fresh insert.
    assert main(["--local", "monitor", land]) == 0
    status = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert status["recent_orders"] == 1
    hourly_out = os.path.join(tmp, "hourly")
    assert main(["--local", "hourly", land, hourly_out, os.path.join(tmp, "hck"),
                 "--available-now"]) == 0
    assert spark.read.parquet(hourly_out).first()["orders_count"] == 1
    table = os.path.join(tmp, "by_date")
    assert main(["--local", "compact", land, table, "2024-01-01", "2024-01-01"]) == 0
    assert spark.read.parquet(table).count() == 1
    for orders in (land, table):
        capsys.readouterr()
        assert main(["--local", "dashboard", orders, "--period", "today", "--as-of", "2024-01-01 10:30:00"]) == 0
        lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
        assert {"panel": "kpi", "item": "", "measure": "orders_count", "value": 1.0} in lines
        assert {"panel": "top_sellers", "item": "s", "measure": "revenue", "value": 19.0} in lines
        assert {"panel": "heatmap", "item": "Mon 10", "measure": "order_count", "value": 1.0} in lines


def test_load_job_requires_inputs(spark, tmp, capsys):
    raw = os.path.join(tmp, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "olist_sellers_dataset.csv"), "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01001,sp,SP\n")
    assert main(["--local", "load", raw, os.path.join(tmp, "t"), os.path.join(tmp, "q")]) == 0
    report = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert report == [{"file_name": "olist_sellers_dataset.csv", "table_name": "raw_sellers",
                       "rows_loaded": 1, "rows_rejected": 0}]
    try:
        main(["--local", "load", raw, os.path.join(tmp, "t2"), os.path.join(tmp, "q2"), "--require"])
    except FileNotFoundError as e:
        assert "olist_orders_dataset.csv" in str(e)
    else:
        raise AssertionError("missing required files must fail the load")
