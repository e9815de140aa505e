"""Physical-plan checks: shuffles, broadcasts, push-down."""

from quarry.operators.steps import apply_steps
from quarry.plans import reports
from quarry.plans.catalogue import QUERIES, table

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_user_has_one_shuffle_and_one_bounded_broadcast(spark, workdir):
    # The report over a stored silver table: exactly one shuffle (the
    # count per customer) and one broadcast (the k rows).
    silver = reports.silver_orders(table(spark, SF, "orders"), table(spark, SF, "lineitem"))
    silver.write.parquet(f"{workdir}/silver")
    customers = reports.customers_view(table(spark, SF, "customer"))
    df = reports.top_users(customers, spark.read.parquet(f"{workdir}/silver"), "1998-06-01")
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastExchange") == 1
    assert "TakeOrderedAndProject(limit=10" in text
    assert "PushedFilters: [IsNotNull(updated_at), IsNotNull(created_at), IsNotNull(status)" in text


def test_parquet_scan_prunes_and_pushes(spark):
    df = QUERIES["parquet_scan"](spark, SF)
    schema = "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>"
    assert schema in plan(df)
    text = plan(df.filter("l_shipdate >= timestamp_ntz'1998-06-01'"))
    assert "GreaterThanOrEqual(l_shipdate,1998-06-01T00:00)" in text and schema in text


def test_report_filters_reach_the_order_scan(spark):
    """The status word is tested on the stored code."""
    text = plan(QUERIES["top_user"](spark, SF))
    pushed = [x.split("ReadSchema")[0] for x in text.split("PushedFilters: [")[1:]]
    assert any("In(o_orderstatus, [" in x and "o_orderdate" in x for x in pushed)


def test_report_date_reaches_the_line_item_scan(spark):
    """Lines from before the run date are neither aggregated nor shuffled."""
    for name in ("top_user", "bottom_user_sql"):
        scans = plan(QUERIES[name](spark, SF)).split("FileScan parquet")[1:]
        lines = [x for x in scans if "ReadSchema: struct<l_orderkey" in x]
        assert len(lines) == 1 and "GreaterThanOrEqual(l_shipdate,1998-06-01T00:00)" in lines[0]


def test_since_leaves_the_report_as_it_is(spark):
    orders, lines = table(spark, SF, "orders"), table(spark, SF, "lineitem")
    for date in ("1995-01-01", "1998-06-01", "2001-08-02"):
        whole = reports.order_counts(reports.silver_orders(orders, lines), date)
        some = reports.order_counts(reports.silver_orders(orders, lines, reports.COMPLETED, date), date)
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, some.collect()))


def test_per_date_top_k_limits_before_the_shuffle(spark):
    df = QUERIES["backfill_top_user"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


def test_backfill_spine_has_no_join(spark):
    df = QUERIES["backfill_date_spine"](spark, SF)
    text = plan(df)
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Generate explode" in text


def test_backfill_expands_dates_after_the_last_shuffle(spark, workdir):
    # Over a stored silver table: change points are partially aggregated
    # before the first shuffle; the per-date rows are only generated above
    # the last one.
    silver = reports.silver_orders(table(spark, SF, "orders"), table(spark, SF, "lineitem"))
    silver.write.parquet(f"{workdir}/silver_bf")
    df = reports.order_counts_by_date(spark.read.parquet(f"{workdir}/silver_bf"), "1995-01-01", "2001-12-31", 7)
    text = plan(df)
    above, _, below = text.partition("Exchange hashpartitioning")
    assert "explode(sequence" in above and "explode(sequence" not in below
    assert "partial_sum" in below


def test_sql_window_step_limits_groups_before_the_shuffle(spark):
    step = {"op": "sql", "args": {"view_name": "orders_w3", "query":
        "SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders_w3) WHERE rn <= 3"}}
    text = plan(apply_steps(spark, {"orders": table(spark, SF, "orders")}, {"orders": [step]})["orders"])
    head, _, tail = text.partition("Exchange hashpartitioning(o_custkey")
    assert "WindowGroupLimit" in head and "Partial" in tail and "WindowGroupLimit" in tail


def test_per_date_top_k_ranks_only_rows_past_the_threshold(spark):
    df = QUERIES["backfill_top_user"](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert "threshold" in optimized and "WindowGroupLimit" in optimized
    physical = plan(df)
    # thresholds (one row per date) are broadcast; nothing is paired up
    assert physical.count("BroadcastExchange") >= 2
    assert "NestedLoopJoin" not in physical and "CartesianProduct" not in physical
