"""The example job configs, chained through the command-line entry point."""

import os

from quarry.__main__ import main

JOBS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs")
SF = "/root/testdata/sf0.001"


def run_cli(name, warehouse, *extra):
    return main([os.path.join(JOBS, name), "--set", f"data_dir={SF}", "--set", f"warehouse={warehouse}", *extra])


def test_job_chain(spark, workdir, capsys):
    assert run_cli("silver_orders.json", workdir) == 0
    assert run_cli("silver_customers.json", workdir) == 0
    assert spark.table("silver.orders").count() == spark.read.parquet(f"{SF}/orders.parquet").count()

    # over the stored silver table the report's filters reach the scan
    capsys.readouterr()
    assert run_cli("gold_top_user.json", workdir, "--explain") == 0
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(updated_at), IsNotNull(created_at), IsNotNull(status)" in plan
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan

    assert run_cli("gold_top_user.json", workdir) == 0
    out = capsys.readouterr().out
    assert '"run_dates": ["1998-06-01", "1998-06-02", "1998-06-03"]' in out
    assert spark.table("gold.top_user").count() == 30  # ten per backfill date

    assert run_cli("gold_bottom_user.json", workdir, "--run-date", "1998-06-01") == 0
    assert spark.table("gold.bottom_user").count() == 10

    assert run_cli("bronze_order_details.json", workdir) == 0
    assert spark.table("bronze.superstore_order_details").count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()

    # upserting the same extract twice leaves the table as after once
    assert run_cli("bronze_orders_upsert.json", workdir) == 0
    once = sorted(map(tuple, spark.table("bronze.superstore_orders").collect()))
    assert run_cli("bronze_orders_upsert.json", workdir) == 0
    twice = sorted(map(tuple, spark.table("bronze.superstore_orders").collect()))
    assert once == twice and len(once) == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_missing_variables_are_reported(spark, workdir):
    import pytest

    with pytest.raises(ValueError, match="warehouse"):
        main([os.path.join(JOBS, "silver_orders.json"), "--set", f"data_dir={SF}"])


def test_explain_prints_plans_and_writes_nothing(spark, workdir, capsys):
    assert run_cli("silver_orders.json", f"{workdir}/explained", "--explain") == 0
    out = capsys.readouterr().out
    assert "== orders ==" in out and "Physical Plan" in out and "ReadSchema" in out
    assert not os.path.exists(f"{workdir}/explained/silver/orders")


def test_bucketed_upsert_job(spark, workdir):
    assert run_cli("bronze_orders_upsert_bucketed.json", workdir) == 0
    once = sorted(map(tuple, spark.table("bronze.superstore_orders_bucketed").collect()))
    assert run_cli("bronze_orders_upsert_bucketed.json", workdir) == 0
    twice = sorted(map(tuple, spark.table("bronze.superstore_orders_bucketed").collect()))
    assert once == twice and len(once) == spark.read.parquet(f"{SF}/orders.parquet").count()
    meta = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED bronze.superstore_orders_bucketed").collect()}
    assert meta["Num Buckets"] == "8" and meta["Bucket Columns"] == "[`order_id`]"
