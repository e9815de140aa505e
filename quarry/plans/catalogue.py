"""The registered queries: each runs one feature end to end over the given
tables (whole tables, no row caps) and returns a DataFrame; ``ORACLE`` holds
the same result as plain SQL for an independent engine.

Queries that write go through the real sinks into a fresh folder under the
session's shared scratch root and return the table read back.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.rundate import date_range, int_spine
from quarry.operators.steps import apply_steps
from quarry.plans import reports
from quarry.plans.job import run, run_dates, run_job
from quarry.session import new_work_dir
from quarry.sinks import write_output
from quarry.sinks.events import JSON_OPTIONS
from quarry.sources import read_files, read_table

RUN_DATE = "1998-06-01"
# Weekly backfill over the whole order history.
BACKFILL_START, BACKFILL_END, BACKFILL_STEP = "1995-01-01", "2001-12-31", 7
# Looped backfill: four weekly runs from the run date.
LOOP_START, LOOP_END, LOOP_STEP = "1998-06-01", "1998-06-22", 7

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def _inputs(spark, sf_dir, since=None):
    customers = reports.customers_view(table(spark, sf_dir, "customer"))
    # The reports on it count completed orders only, of one run date or later.
    orders = reports.silver_orders(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), reports.COMPLETED, since)
    return customers, orders


# ---------------------------------------------------------------- oracle SQL
# Shared SQL pieces for the oracle (the silver stand-in and run date).
_SILVER = """
silver AS (
    SELECT o.o_orderkey AS id, o.o_custkey AS customer_id,
           CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open'
                WHEN 'P' THEN 'Pending' ELSE o.o_orderstatus END AS status,
           o.o_orderdate AS created_at, l.updated_at
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS updated_at FROM lineitem GROUP BY l_orderkey) l
           ON l.l_orderkey = o.o_orderkey
),
customers AS (
    SELECT c_custkey AS id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
),
counts AS (
    SELECT customer_id, count(*) AS order_count FROM silver
    WHERE updated_at >= TIMESTAMP '1998-06-01' AND created_at < TIMESTAMP '1998-06-01'
      AND status = 'Completed'
    GROUP BY customer_id
)"""

_TOP = f"""
WITH {_SILVER},
top AS (SELECT customer_id FROM counts ORDER BY order_count DESC, customer_id LIMIT 10)
SELECT c.* FROM customers c JOIN top t ON c.id = t.customer_id"""

_BOTTOM = f"""
WITH {_SILVER},
low AS (SELECT customer_id FROM counts ORDER BY order_count, customer_id LIMIT 10)
SELECT c.* FROM customers c JOIN low t ON c.id = t.customer_id"""

# Recomputed order state: status from the line statuses (all F -> F, all
# O -> O, mixed -> P, no lines -> NULL); total price moved by one.
_RECOMPUTED = """
line_status AS (
    SELECT l_orderkey,
           CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS st
    FROM lineitem GROUP BY l_orderkey
),
src AS (
    SELECT o.o_orderkey, o.o_custkey, ls.st AS o_orderstatus, o.o_totalprice + 1.0 AS o_totalprice,
           o.o_orderdate, o.o_orderpriority
    FROM orders o LEFT JOIN line_status ls ON ls.l_orderkey = o.o_orderkey
)"""


def _upsert_oracle(changed: str) -> str:
    return f"""
WITH {_RECOMPUTED},
tgt AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'
)
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL AND coalesce({changed}, false)
            THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       t.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM tgt t LEFT JOIN src s ON t.o_orderkey = s.o_orderkey
UNION ALL
SELECT s.* FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_orderkey = s.o_orderkey)"""


# ------------------------------------------------------------------ reports
@query("top_user", _TOP)
def q_top_user(spark, sf_dir):
    """Filter -> count per customer -> top 10 -> broadcast join -> a.*"""
    customers, orders = _inputs(spark, sf_dir, RUN_DATE)
    return reports.top_users(customers, orders, RUN_DATE)


@query("bottom_user_sql", _BOTTOM)
def q_bottom_user_sql(spark, sf_dir):
    """The SQL-file twin (ascending), run as a SQL transform."""
    customers, orders = _inputs(spark, sf_dir, RUN_DATE)
    from quarry.plans.job import sql_transform

    return sql_transform(spark, {"customers": customers, "orders": orders}, reports.BOTTOM_USER_SQL, RUN_DATE)["result"]


@query(
    "multi_output_job",
    f"""
SELECT 'top_user' AS report, * FROM ({_TOP}) a
UNION ALL
SELECT 'bottom_user' AS report, * FROM ({_BOTTOM}) b""",
)
def q_multi_output_job(spark, sf_dir):
    """Two sources, a Python transform with two outputs,
    two table loads; both tables read back, tagged."""
    work = new_work_dir(spark, "multi_output")
    _inputs(spark, sf_dir, RUN_DATE)[1].createOrReplaceTempView("silver_orders")
    reports.customers_view(table(spark, sf_dir, "customer")).createOrReplaceTempView("gold_customers")
    conf = {
        "run_mode": {"name": "default"},
        "extract": {
            "customers": {"reader": "TableReader", "table": "gold_customers"},
            # Derived from orders and line items and read by both outputs:
            # computed once, kept as Parquet in the shared folder.
            "orders": {"reader": "TableReader", "table": "silver_orders", "checkpoint": True},
        },
        "transform": {"transformer": "PyTransformer", "transformation": "top_and_bottom_users"},
        "load": {
            "top_user": {"writer": "ParquetWriter", "mode": "overwrite", "table_name": "gold.top_user",
                         "path": f"{work}/top_user", "database_location": f"{work}/gold.db", "first": True},
            "bottom_user": {"writer": "ParquetWriter", "mode": "overwrite", "table_name": "gold.bottom_user",
                            "path": f"{work}/bottom_user", "database_location": f"{work}/gold.db", "first": True},
        },
    }
    run_job(spark, conf, RUN_DATE)
    top = spark.read.parquet(f"{work}/top_user").select(F.lit("top_user").alias("report"), "*")
    bottom = spark.read.parquet(f"{work}/bottom_user").select(F.lit("bottom_user").alias("report"), "*")
    return top.unionByName(bottom)


_BY_DATE = f"""
WITH {_SILVER},
spine AS (
    SELECT CAST(d AS DATE) AS run_date
    FROM generate_series(TIMESTAMP '{BACKFILL_START}', TIMESTAMP '{BACKFILL_END}', INTERVAL {BACKFILL_STEP} DAY) g(d)
),
by_date AS (
    SELECT s.run_date, o.customer_id, count(*) AS order_count
    FROM spine s JOIN silver o
      ON o.updated_at >= CAST(s.run_date AS TIMESTAMP) AND o.created_at < CAST(s.run_date AS TIMESTAMP)
    WHERE o.status = 'Completed'
    GROUP BY s.run_date, o.customer_id
)"""


@query("backfill_date_spine", _BY_DATE + "\nSELECT * FROM by_date")
def q_backfill_date_spine(spark, sf_dir):
    """R2 as one set-based job: per-customer counts for every weekly run
    date of the whole history."""
    _, orders = _inputs(spark, sf_dir, BACKFILL_START)
    return reports.order_counts_by_date(orders, BACKFILL_START, BACKFILL_END, BACKFILL_STEP)


@query(
    "backfill_intervals",
    _BY_DATE
    + f""",
numbered AS (
    SELECT *, CAST(date_diff('day', DATE '{BACKFILL_START}', run_date) // {BACKFILL_STEP} AS BIGINT) AS i FROM by_date
),
islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY customer_id, order_count ORDER BY i) AS g FROM numbered
)
SELECT customer_id, min(run_date) AS from_date, max(run_date) AS to_date, order_count
FROM islands GROUP BY customer_id, order_count, g""",
)
def q_backfill_intervals(spark, sf_dir):
    """R2 in the interval form: one row per customer and stretch of run
    dates with the same count, so it grows with the changes of the counts
    and not with customers times dates."""
    _, orders = _inputs(spark, sf_dir, BACKFILL_START)
    return reports.order_count_intervals(orders, BACKFILL_START, BACKFILL_END, BACKFILL_STEP)


@query(
    "backfill_top_user",
    _BY_DATE
    + """,
ranked AS (
    SELECT run_date, customer_id,
           CAST(row_number() OVER (PARTITION BY run_date ORDER BY order_count DESC, customer_id) AS INTEGER) AS rank
    FROM by_date
)
SELECT r.run_date, r.rank, c.* FROM ranked r JOIN customers c ON c.id = r.customer_id WHERE r.rank <= 10""",
)
def q_backfill_top_user(spark, sf_dir):
    """R2 + R7: the top-user report for every weekly date, in one job."""
    customers, orders = _inputs(spark, sf_dir, BACKFILL_START)
    return reports.top_users_by_date(customers, orders, BACKFILL_START, BACKFILL_END, BACKFILL_STEP)


@query(
    "backfill_loop",
    f"""
WITH {_SILVER},
spine AS (
    SELECT CAST(d AS DATE) AS run_date
    FROM generate_series(TIMESTAMP '{LOOP_START}', TIMESTAMP '{LOOP_END}', INTERVAL {LOOP_STEP} DAY) g(d)
)
SELECT s.run_date, o.customer_id, count(*) AS order_count
FROM spine s JOIN silver o
  ON o.updated_at >= CAST(s.run_date AS TIMESTAMP) AND o.created_at < CAST(s.run_date AS TIMESTAMP)
WHERE o.status = 'Completed'
GROUP BY s.run_date, o.customer_id""",
)
def q_backfill_loop(spark, sf_dir):
    """R1-R4 loop form: a back_fill job config, one complete job per date,
    each appending its date's counts to one table."""
    work = new_work_dir(spark, "backfill_loop")
    _inputs(spark, sf_dir, LOOP_START)[1].createOrReplaceTempView("silver_orders")
    conf = {
        "run_mode": {"name": "back_fill", "start": LOOP_START, "end": LOOP_END, "step": LOOP_STEP},
        # derived from two tables and independent of the run date: computed
        # once for the whole loop
        "extract": {"orders": {"reader": "TableReader", "table": "silver_orders", "checkpoint": True}},
        "transform": {"transformer": "PyTransformer", "transformation": "daily_order_counts"},
        "load": {
            # Each run writes one date: one partition folder, so the
            # rebalancing shuffle would buy nothing.
            "daily_order_counts": {"writer": "ParquetWriter", "mode": "overwrite_partition",
                                   "path": f"{work}/daily_order_counts", "partition_by": ["run_date"],
                                   "rebalance": False}
        },
    }
    dates = run(spark, conf)
    assert dates == date_range(LOOP_START, LOOP_END, LOOP_STEP)
    return spark.read.parquet(f"{work}/daily_order_counts").select(
        F.col("run_date").cast("date").alias("run_date"), "customer_id", "order_count"
    )


@query("backfill_set_job", _BY_DATE + "\nSELECT * FROM by_date")
def q_backfill_set_job(spark, sf_dir):
    """R2 through the job runner, set-based: the kind of back_fill config
    that ``backfill_loop`` runs date by date, over the whole history with
    ``set_based``; the runner uses the transform's range form, so all the
    dates are one job and one write."""
    work = new_work_dir(spark, "backfill_set")
    _inputs(spark, sf_dir, BACKFILL_START)[1].createOrReplaceTempView("silver_orders")
    conf = {
        "run_mode": {"name": "back_fill", "start": BACKFILL_START, "end": BACKFILL_END, "step": BACKFILL_STEP,
                     "set_based": True},
        "extract": {"orders": {"reader": "TableReader", "table": "silver_orders"}},
        "transform": {"transformer": "PyTransformer", "transformation": "daily_order_counts"},
        "load": {
            # the loop's sink config; the set-based run rebalances anyway
            "daily_order_counts": {"writer": "ParquetWriter", "mode": "overwrite_partition",
                                   "path": f"{work}/daily_order_counts", "partition_by": ["run_date"],
                                   "rebalance": False}
        },
    }
    run(spark, conf)
    return spark.read.parquet(f"{work}/daily_order_counts").select(
        F.col("run_date").cast("date").alias("run_date"), "customer_id", "order_count"
    )


@query("default_run_counts", ORACLE["backfill_loop"].replace(f"TIMESTAMP '{LOOP_END}'", f"TIMESTAMP '{LOOP_START}'"))
def q_default_run_counts(spark, sf_dir):
    """A default run takes yesterday as its run date; ``today`` is given
    here, so the result does not change with the day it is run."""
    _, orders = _inputs(spark, sf_dir, LOOP_START)
    today = dt.date.fromisoformat(RUN_DATE) + dt.timedelta(days=1)
    (run_date,) = run_dates({"run_mode": {"name": "default"}}, today=today)
    counts = reports.order_counts(orders, run_date)
    return counts.select(F.lit(run_date).cast("date").alias("run_date"), "customer_id", "order_count")


@query(
    "backfill_int_spine",
    """
SELECT k.run_key, count(p.p_partkey) AS n_parts, max(p.p_retailprice) AS max_price
FROM generate_series(1, 50) k(run_key)
LEFT JOIN part p ON p.p_size = k.run_key
GROUP BY k.run_key""",
)
def q_backfill_int_spine(spark, sf_dir):
    """R3 as a set: one row per integer run key 1..50 (every part size),
    parts aggregated per size first, then joined to the key spine, whose
    size (end - start + 1) is known before it is built."""
    per_size = (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size").between(1, 50))  # the spine's range: at most 50 groups
        .groupBy("p_size")
        .agg(F.count("p_partkey").alias("n_parts"), F.max("p_retailprice").alias("max_price"))
    )
    spine = int_spine(spark, 1, 50)
    return (
        spine.join(F.broadcast(per_size), F.col("run_key") == F.col("p_size"), "left")
        .select(
            "run_key",
            F.coalesce("n_parts", F.lit(0)).cast("long").alias("n_parts"),
            "max_price",
        )
    )


# -------------------------------------------------------------------- sinks
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def recomputed_orders(spark, sf_dir) -> DataFrame:
    """Every order with its status re-derived from its line items (all F ->
    F, all O -> O, mixed -> P, no lines -> NULL) and a moved total price:
    the incoming side of the sink queries."""
    line_status = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_linestatus").alias("lo"), F.max("l_linestatus").alias("hi"))
        .select("l_orderkey", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit("P")).alias("st"))
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(line_status, orders["o_orderkey"] == line_status["l_orderkey"], "left").select(
        "o_orderkey", "o_custkey", F.col("st").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"), "o_orderdate", "o_orderpriority",
    )


def _before_run_date(df: DataFrame) -> DataFrame:
    return df.filter(F.col("o_orderdate") < F.lit(RUN_DATE).cast("timestamp_ntz"))


def _from_run_date(df: DataFrame) -> DataFrame:
    return df.filter(F.col("o_orderdate") >= F.lit(RUN_DATE).cast("timestamp_ntz"))


def _sink(work: str, name: str, mode: str, **extra) -> dict:
    return {"writer": "ParquetWriter", "mode": mode, "table_name": f"bronze.{name}",
            "path": f"{work}/{name}", "database_location": f"{work}/bronze.db", **extra}


def _upsert(spark, sf_dir, null_safe: bool, tag: str) -> DataFrame:
    """K8: the order table as of the run date, upserted with the
    recomputed state of every order; status is the tracked column."""
    work = new_work_dir(spark, tag)
    snapshot = _before_run_date(table(spark, sf_dir, "orders")).select(*_ORDER_COLS)
    write_output(spark, snapshot, _sink(work, tag, "overwrite", first=True))
    upsert = _sink(work, tag, "upsert", primary_key=["o_orderkey"],
                   change_tracking_column=["o_orderstatus"], null_safe=null_safe)
    write_output(spark, recomputed_orders(spark, sf_dir), upsert)
    return spark.table(f"bronze.{tag}")


@query("upsert_change_tracking", _upsert_oracle("t.o_orderstatus <> s.o_orderstatus"))
def q_upsert_change_tracking(spark, sf_dir):
    return _upsert(spark, sf_dir, False, "upsert_change_tracking")


@query("upsert_null_safe", _upsert_oracle("t.o_orderstatus IS DISTINCT FROM s.o_orderstatus"))
def q_upsert_null_safe(spark, sf_dir):
    return _upsert(spark, sf_dir, True, "upsert_null_safe")


@query("upsert_bucketed", _upsert_oracle("t.o_orderstatus <> s.o_orderstatus"))
def q_upsert_bucketed(spark, sf_dir):
    """K8 on a table bucketed by its key: the target is read bucket by
    bucket and never shuffled; only the source is. ``broadcast_bytes`` 0
    withholds the sink's own broadcast of the source, as for a source too
    large to broadcast; Spark's size statistics still decide the join
    (test_sinks checks the plan with them off)."""
    work = new_work_dir(spark, "upsert_bucketed")
    buckets = {"columns": ["o_orderkey"], "buckets": 8}
    snapshot = _before_run_date(table(spark, sf_dir, "orders")).select(*_ORDER_COLS)
    write_output(spark, snapshot, _sink(work, "orders_bucketed", "overwrite", bucket_by=buckets))
    upsert = _sink(work, "orders_bucketed", "upsert", primary_key=["o_orderkey"],
                   change_tracking_column=["o_orderstatus"], bucket_by=buckets, broadcast_bytes=0)
    write_output(spark, recomputed_orders(spark, sf_dir), upsert)
    return spark.table("bronze.orders_bucketed")


@query(
    "upsert_partitioned",
    f"""
WITH {_RECOMPUTED},
tgt AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CAST(year(o_orderdate) AS INTEGER) AS o_year
    FROM orders
),
s AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM src WHERE o_orderstatus = 'P' OR year(o_orderdate) % 2 = 0)
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL AND coalesce(t.o_orderstatus <> s.o_orderstatus, false)
            THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       t.o_totalprice, t.o_orderdate, t.o_orderpriority, t.o_year
FROM tgt t LEFT JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_year = s.o_year
UNION ALL
SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_orderkey = s.o_orderkey AND t.o_year = s.o_year)""",
)
def q_upsert_partitioned(spark, sf_dir):
    """K8 on a year-partitioned table keyed by (order, year): the whole
    order table is the target; recomputed orders arrive for some of every
    year and all of the even ones. Only the touched partitions are read and
    rewritten (dynamic partition overwrite)."""
    work = new_work_dir(spark, "upsert_partitioned")
    year = F.year("o_orderdate").alias("o_year")
    sink = _sink(work, "orders_keyed_by_year", "overwrite", partition_by=["o_year"], first=True)
    write_output(spark, table(spark, sf_dir, "orders").select(*_ORDER_COLS, year), sink)
    fresh = recomputed_orders(spark, sf_dir).select("*", year).filter("o_orderstatus = 'P' OR o_year % 2 = 0")
    upsert = {**sink, "mode": "upsert", "first": False, "primary_key": ["o_orderkey", "o_year"],
              "change_tracking_column": ["o_orderstatus"]}
    write_output(spark, fresh, upsert)
    return spark.table("bronze.orders_keyed_by_year")


@query(
    "upsert_then_append_first",
    _upsert_oracle("t.o_orderstatus <> s.o_orderstatus") + """
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'""",
)
def q_upsert_then_append_first(spark, sf_dir):
    """Append with ``first``, upsert, append with ``first``
    again: the second append lands in the upserted version."""
    work = new_work_dir(spark, "upsert_append")
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    append = _sink(work, "orders_first", "append", first=True)
    write_output(spark, _before_run_date(orders), append)
    write_output(spark, recomputed_orders(spark, sf_dir), {**append, "mode": "upsert", "primary_key": ["o_orderkey"],
                                                           "change_tracking_column": ["o_orderstatus"]})
    write_output(spark, _from_run_date(orders), append)
    return spark.table("bronze.orders_first")


@query("upsert_without_catalog_entry", _upsert_oracle("t.o_orderstatus <> s.o_orderstatus"))
def q_upsert_without_catalog_entry(spark, sf_dir):
    """K8 in a session whose catalog knows nothing of the table, as after
    each run of a session without a metastore: the table on storage is the
    target, once as plain files and once as the version of an upsert."""
    work = new_work_dir(spark, "upsert_no_entry")
    target = _before_run_date(table(spark, sf_dir, "orders")).select(*_ORDER_COLS)
    write_output(spark, target, _sink(work, "orders_no_entry", "append"))
    upsert = _sink(work, "orders_no_entry", "upsert", primary_key=["o_orderkey"], change_tracking_column=["o_orderstatus"])
    fresh = recomputed_orders(spark, sf_dir)
    for part in (fresh.filter("o_orderkey % 2 = 0"), fresh.filter("o_orderkey % 2 <> 0")):
        spark.sql("DROP TABLE IF EXISTS bronze.orders_no_entry")  # external: the files stay
        write_output(spark, part, upsert)
    return spark.table("bronze.orders_no_entry")


@query(
    "append_fewer_columns",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate < TIMESTAMP '1998-06-01'
UNION ALL
SELECT o_orderkey, o_custkey, NULL, NULL, o_orderdate, NULL FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'""",
)
def q_append_fewer_columns(spark, sf_dir):
    """K5: an append that lacks columns of the table leaves them NULL."""
    work = new_work_dir(spark, "append_fewer")
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    sink = _sink(work, "orders_fewer", "append", first=True)
    write_output(spark, _before_run_date(orders), sink)
    write_output(spark, _from_run_date(orders).select("o_orderdate", "o_orderkey", "o_custkey"), sink)
    return spark.table("bronze.orders_fewer")


@query("create_if_missing", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_create_if_missing(spark, sf_dir):
    """K9: an empty frame creates the table with its columns and types; a
    second one changes nothing; then the rows arrive."""
    work = new_work_dir(spark, "create_if_missing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sink = _sink(work, "orders_created", "append")
    for rows in (orders.limit(0), orders.limit(0), orders):
        write_output(spark, rows, sink)
    return spark.table("bronze.orders_created")


@query(
    "overwrite_partition",
    f"""
WITH {_RECOMPUTED}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders WHERE year(o_orderdate) <> 1998
UNION ALL
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM src WHERE year(o_orderdate) = 1998""",
)
def q_overwrite_partition(spark, sf_dir):
    """Orders partitioned by year; the run date's year is written
    again from recomputed data with a partition overwrite, other years
    stay as they were."""
    work = new_work_dir(spark, "overwrite_partition")
    year = F.year("o_orderdate").alias("o_year")
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLS, year)
    sink = _sink(work, "orders_by_year", "overwrite", partition_by=["o_year"], first=True)
    write_output(spark, orders, sink)
    fresh = recomputed_orders(spark, sf_dir).select("*", year).filter(F.col("o_year") == int(RUN_DATE[:4]))
    write_output(spark, fresh, {**sink, "mode": "overwrite_partition", "first": False})
    return spark.table("bronze.orders_by_year")


@query(
    "overwrite_full",
    f"""
WITH {_RECOMPUTED}
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM src
WHERE o_orderdate >= TIMESTAMP '1998-06-01'""",
)
def q_overwrite_full(spark, sf_dir):
    """A full overwrite of a partitioned table drops every old
    partition, including those the new data does not touch."""
    work = new_work_dir(spark, "overwrite_full")
    year = F.year("o_orderdate").alias("o_year")
    sink = _sink(work, "orders_full", "overwrite", partition_by=["o_year"], first=True)
    write_output(spark, table(spark, sf_dir, "orders").select(*_ORDER_COLS, year), sink)
    fresh = _from_run_date(recomputed_orders(spark, sf_dir)).select("*", year)
    write_output(spark, fresh, {**sink, "first": False})
    return spark.table("bronze.orders_full")


@query("append_table", "SELECT * FROM orders")
def q_append_table(spark, sf_dir):
    """Two appends (before / from the run date) to a catalog
    table registered over its path."""
    work = new_work_dir(spark, "append_table")
    orders = table(spark, sf_dir, "orders")
    write_output(spark, _before_run_date(orders), _sink(work, "orders_appended", "append", first=True))
    write_output(spark, _from_run_date(orders), _sink(work, "orders_appended", "append"))
    return spark.table("bronze.orders_appended")


@query(
    "schema_merge_append",
    """
SELECT o.*, NULL::BIGINT AS n_lines FROM orders o WHERE o_orderdate < TIMESTAMP '1998-06-01'
UNION ALL
SELECT o.*, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS n_lines
FROM orders o WHERE o_orderdate >= TIMESTAMP '1998-06-01'""",
)
def q_schema_merge_append(spark, sf_dir):
    """The second append brings a new column; the table is read with
    schema merging, older rows show NULL."""
    work = new_work_dir(spark, "schema_merge")
    orders = table(spark, sf_dir, "orders")
    sink = _sink(work, "orders_evolving", "append", merge_schema=True)
    write_output(spark, _before_run_date(orders), {**sink, "first": True})
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    newer = (
        _from_run_date(orders)
        .join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        .select(*orders.columns, F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))
    )
    write_output(spark, newer, sink)
    return spark.table("bronze.orders_evolving")


# ------------------------------------------------------------------- ingest
# Bronze ingest projections. The sources are stand-ins with the columns of
# the source database (what the given tables lack is a typed NULL); the
# queries rename them to the bronze names (fixed values).
def _source_tables(spark, sf_dir) -> dict[str, DataFrame]:
    t = {n: table(spark, sf_dir, n) for n in ("region", "nation", "customer", "part", "orders", "lineitem")}
    cities = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    words = F.split("p_type", " ")
    code = F.concat(F.lit("P"), F.col("p_partkey"))
    return {
        "branches": cities.select(
            F.col("n_nationkey").alias("branch_id"), F.col("r_name").alias("region"), F.col("n_name").alias("city"),
            none("string", "town"), F.concat_ws("/", "r_name", "n_name").alias("branch_town"), none("double", "lat"), none("double", "lon"),
        ),
        "categories": t["part"].select(
            F.col("p_partkey").alias("itemid"),
            F.get(words, F.lit(0)).alias("category1"), F.col("p_size").alias("category1_id"),
            F.get(words, F.lit(1)).alias("category2"), none("int", "category2_id"),
            F.get(words, F.lit(2)).alias("category3"), none("int", "category3_id"),
            none("string", "category4"), none("int", "category4_id"),
            F.col("p_brand").alias("brand"), code.alias("itemcode"), F.col("p_name").alias("itemname"),
        ),
        "customers": t["customer"].join(cities, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("userid"), F.lower("c_name").alias("username_"), F.col("c_name").alias("namesurname"),
            F.col("c_mktsegment").alias("status_"), none("string", "usergender"), none("date", "userbirthdate"),
            F.col("r_name").alias("region"), F.col("n_name").alias("city"), none("string", "town"), none("string", "district"),
            none("string", "addresstext"),
        ),
        "orders": t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left").select(
            F.col("o_orderkey").alias("orderid"), F.col("c_nationkey").alias("branch_id"), F.col("o_orderdate").alias("date_"),
            F.col("o_custkey").alias("userid"), F.col("c_name").alias("namesurname"), F.col("o_totalprice").alias("totalbasket"),
        ),
        "order_details": t["lineitem"].select(
            F.col("l_orderkey").alias("orderid"), F.col("l_linenumber").alias("orderdetailid"), F.col("l_quantity").alias("amount"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unitprice"), F.col("l_extendedprice").alias("totalprice"),
            F.col("l_partkey").alias("itemid"), F.concat(F.lit("P"), F.col("l_partkey")).alias("itemcode"),
        ),
    }


INGEST = {
    "branches": "SELECT branch_id, region, city, town, branch_town, lat, lon FROM src_branches",
    "categories": """SELECT itemid AS item_id, category1 AS category_1, category1_id AS category_1_id,
                     category2 AS category_2, category2_id AS category_2_id, category3 AS category_3,
                     category3_id AS category_3_id, category4 AS category_4, category4_id AS category_4_id,
                     brand, itemcode AS item_code, itemname AS item_name FROM src_categories""",
    "customers": """SELECT userid AS user_id, username_ AS username, namesurname AS name_surname, status_ AS status,
                    usergender AS user_gender, userbirthdate AS user_birth_date, region, city, town, district,
                    addresstext AS address_text FROM src_customers""",
    "orders": """SELECT orderid AS order_id, branch_id, date_ AS order_date, userid AS user_id,
                 namesurname AS name_surname, totalbasket AS total_basket FROM src_orders""",
    "order_details": """SELECT orderid AS order_id, orderdetailid AS order_detail_id, amount, unitprice AS unit_price,
                        totalprice AS total_price, itemid AS item_id, itemcode AS item_code FROM src_order_details""",
}
# What must come out, straight from the given tables.
INGEST_ORACLE = {
    "branches": """SELECT n_nationkey AS branch_id, r_name AS region, n_name AS city, CAST(NULL AS VARCHAR) AS town,
                   r_name || '/' || n_name AS branch_town, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon
                   FROM nation, region WHERE n_regionkey = r_regionkey""",
    "categories": """SELECT p_partkey AS item_id, nullif(split_part(p_type, ' ', 1), '') AS category_1, p_size AS category_1_id,
                     nullif(split_part(p_type, ' ', 2), '') AS category_2, CAST(NULL AS INTEGER) AS category_2_id,
                     nullif(split_part(p_type, ' ', 3), '') AS category_3, CAST(NULL AS INTEGER) AS category_3_id,
                     CAST(NULL AS VARCHAR) AS category_4, CAST(NULL AS INTEGER) AS category_4_id,
                     p_brand AS brand, 'P' || p_partkey AS item_code, p_name AS item_name FROM part""",
    "customers": """SELECT c_custkey AS user_id, lower(c_name) AS username, c_name AS name_surname, c_mktsegment AS status,
                    CAST(NULL AS VARCHAR) AS user_gender, CAST(NULL AS DATE) AS user_birth_date,
                    (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = c_nationkey) AS region,
                    (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS city, CAST(NULL AS VARCHAR) AS town,
                    CAST(NULL AS VARCHAR) AS district, CAST(NULL AS VARCHAR) AS address_text FROM customer""",
    "orders": """SELECT o_orderkey AS order_id, (SELECT c_nationkey FROM customer WHERE c_custkey = o_custkey) AS branch_id,
                 o_orderdate AS order_date, o_custkey AS user_id,
                 (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS name_surname, o_totalprice AS total_basket FROM orders""",
    "order_details": """SELECT l_orderkey AS order_id, l_linenumber AS order_detail_id, l_quantity AS amount,
                        l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_price,
                        l_partkey AS item_id, 'P' || l_partkey AS item_code FROM lineitem""",
}


def _ingest(name: str):
    def run_ingest(spark, sf_dir):
        """F7-F11 + S6 + K6 + K11: an ingest job config (query source,
        empty step list, overwrite into a registered bronze table)."""
        work = new_work_dir(spark, f"ingest_{name}")
        _source_tables(spark, sf_dir)[name].createOrReplaceTempView(f"src_{name}")
        conf = {
            "run_mode": {"name": "default"},
            "extract": {name: {"reader": "TableReader", "query": INGEST[name]}},
            "transform": {"transformer": "ConfigTransformer", "transformation": {name: []}},
            "load": {name: _sink(work, f"superstore_{name}", "overwrite", first=True)},
        }
        run_job(spark, conf, RUN_DATE)
        return spark.table(f"bronze.superstore_{name}")

    return run_ingest


for _name in INGEST:
    query(f"ingest_{_name}", INGEST_ORACLE[_name])(_ingest(_name))


# -------------------------------------------------------------------- scans
@query(
    "table_scan_run_date",
    "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'",
)
def q_table_scan_run_date(spark, sf_dir):
    """A query source with a run-date placeholder, bound as a
    parameter (reaches the Parquet scan as a pushed filter)."""
    register_views(spark, sf_dir, ("orders",))
    cfg = {"query": "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders "
                    "WHERE o_orderdate >= to_timestamp_ntz('${run_date}')"}
    return read_table(spark, cfg, RUN_DATE)


@query(
    "table_scan_quoted_date",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'",
)
def q_table_scan_quoted_date(spark, sf_dir):
    """The placeholder in double quotes is the date as well."""
    register_views(spark, sf_dir, ("orders",))
    cfg = {"query": 'SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= to_timestamp_ntz("${run_date}")'}
    return read_table(spark, cfg, RUN_DATE)


@query("table_scan", "SELECT * FROM customer")
def q_table_scan(spark, sf_dir):
    """A catalog table registered over Parquet files, read by name."""
    from quarry.sinks import register_table

    work = new_work_dir(spark, "table_scan")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bronze LOCATION '{work}/bronze.db'")
    register_table(spark, "bronze.customer_files", "parquet", f"{sf_dir}/customer.parquet", [], force=True)
    return read_table(spark, {"table": "bronze.customer_files"})


@query("parquet_scan", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem")
def q_parquet_scan(spark, sf_dir):
    """A Parquet folder by bucket and prefix, in whatever store the
    tables are; the projection reaches the scan."""
    store = re.match(r"(\w+)://([^/]*)/(.*)", sf_dir)
    scheme, bucket, prefix = store.groups() if store else ("file", "", sf_dir)
    conf = {"bucket": bucket or "/", "scheme": scheme, "prefix": f"{prefix.lstrip('/')}/lineitem.parquet"}
    return read_files(spark, conf).select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


# -------------------------------------------------------------------- steps
def _steps(spark, sf_dir, name: str, steps: list[dict], extra: dict | None = None) -> DataFrame:
    dfs = {name: table(spark, sf_dir, name)}
    for other, df in (extra or {}).items():
        dfs[other] = df
    return apply_steps(spark, dfs, {name: steps}, RUN_DATE)[name]


@query(
    "step_filter",
    "SELECT * FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'F'",
)
def q_step_filter(spark, sf_dir):
    """C5 with both argument spellings: SQL text and an F. expression."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "filter", "args": {"condition": "o_totalprice > 200000"}},
        {"op": "where", "args": {"condition": "F.col('o_orderstatus') == F.lit('F')"}},
    ])


@query(
    "step_with_column",
    "SELECT *, l_extendedprice * (1 - l_discount) AS net_price, upper(l_returnflag) AS flag FROM lineitem",
)
def q_step_with_column(spark, sf_dir):
    """New columns from an F. expression and from {"expr": ...}."""
    return _steps(spark, sf_dir, "lineitem", [
        {"op": "withColumn", "args": {"colName": "net_price",
                                      "col": "F.col('l_extendedprice') * (1 - F.col('l_discount'))"}},
        {"op": "withColumn", "args": {"colName": "flag", "col": {"expr": "upper(l_returnflag)"}}},
    ])


@query(
    "step_rename",
    "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
)
def q_step_rename(spark, sf_dir):
    """Single and mapped renames."""
    return _steps(spark, sf_dir, "customer", [
        {"op": "withColumnRenamed", "args": {"existing": "c_custkey", "new": "customer_id"}},
        {"op": "withColumnsRenamed", "args": {"colsMap": {"c_name": "name", "c_acctbal": "balance"}}},
    ])


@query("step_drop", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def q_step_drop(spark, sf_dir):
    """C2."""
    return _steps(spark, sf_dir, "orders", [{"op": "drop", "args": {"cols": ["o_totalprice", "o_orderpriority"]}}])


@query("step_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def q_step_distinct(spark, sf_dir):
    """C9 after a select step."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "select", "args": {"cols": ["o_custkey", "o_orderstatus"]}},
        {"op": "distinct", "args": {}},
    ])


@query("step_dedup", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def q_step_dedup(spark, sf_dir):
    """Which row of a duplicate group survives is unspecified, so only
    the subset columns are compared."""
    df = _steps(spark, sf_dir, "orders", [
        {"op": "dropDuplicates", "args": {"subset": ["o_custkey", "o_orderpriority"]}},
    ])
    return df.select("o_custkey", "o_orderpriority")


@query(
    "step_replace",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
            ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def q_step_replace(spark, sf_dir):
    """C12."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "replace", "args": {"to_replace": {"1-URGENT": "urgent", "2-HIGH": "high"},
                                   "subset": ["o_orderpriority"]}},
    ])


_LINE_COUNTS = """
WITH lc AS (SELECT l_orderkey, count(*) AS n_lines, max(l_quantity) AS max_qty FROM lineitem GROUP BY l_orderkey)
"""


def _orders_with_line_counts(spark, sf_dir) -> dict:
    lc = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("l_quantity").alias("max_qty")
    )
    lc.createOrReplaceTempView("line_counts")
    return {"line_counts": lc}


_WITH_LINES = [
    {"op": "sql", "args": {"view_name": "orders_in", "query":
        "SELECT o.o_orderkey, o.o_custkey, lc.n_lines, lc.max_qty FROM orders_in o "
        "LEFT JOIN line_counts lc ON lc.l_orderkey = o.o_orderkey"}},
]


@query(
    "step_fillna",
    _LINE_COUNTS + """SELECT o.o_orderkey, o.o_custkey, coalesce(lc.n_lines, 0) AS n_lines,
       coalesce(lc.max_qty, 0.0) AS max_qty FROM orders o LEFT JOIN lc ON lc.l_orderkey = o.o_orderkey""",
)
def q_step_fillna(spark, sf_dir):
    """C1 (cross-table SQL step) then C11 on the NULLs the left join made."""
    extra = _orders_with_line_counts(spark, sf_dir)
    return _steps(spark, sf_dir, "orders", _WITH_LINES + [
        {"op": "fillna", "args": {"value": {"n_lines": 0, "max_qty": 0.0}}},
    ], extra)


@query(
    "step_dropna",
    _LINE_COUNTS + """SELECT o.o_orderkey, o.o_custkey, lc.n_lines, lc.max_qty
       FROM orders o JOIN lc ON lc.l_orderkey = o.o_orderkey""",
)
def q_step_dropna(spark, sf_dir):
    """C10."""
    extra = _orders_with_line_counts(spark, sf_dir)
    return _steps(spark, sf_dir, "orders", _WITH_LINES + [
        {"op": "dropna", "args": {"how": "any", "subset": ["n_lines"]}},
    ], extra)


@query(
    "step_crosstab",
    """SELECT o_orderstatus AS "o_orderstatus_o_orderpriority",
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "1-URGENT",
       count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS "2-HIGH",
       count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
       count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
       count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS "5-LOW"
       FROM orders GROUP BY o_orderstatus""",
)
def q_step_crosstab(spark, sf_dir):
    """C16 (a contingency table; for low-cardinality columns)."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "crosstab", "args": {"col1": "o_orderstatus", "col2": "o_orderpriority"}},
    ])


@query(
    "step_unpivot",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""",
)
def q_step_unpivot(spark, sf_dir):
    """C15."""
    return _steps(spark, sf_dir, "lineitem", [
        {"op": "unpivot", "args": {"ids": ["l_orderkey", "l_linenumber"],
                                   "values": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                                   "variableColumnName": "measure", "valueColumnName": "amount"}},
    ])


@query(
    "step_sql_join",
    """SELECT c.c_mktsegment, o.o_orderstatus, count(*) AS n_orders, max(o.o_totalprice) AS max_price,
              min(o.o_orderdate) AS first_order
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
       GROUP BY c.c_mktsegment, o.o_orderstatus""",
)
def q_step_sql_join(spark, sf_dir):
    """C1 across tables: the customer step registers its view, the orders
    step joins it and aggregates."""
    dfs = {"customer": table(spark, sf_dir, "customer"), "orders": table(spark, sf_dir, "orders")}
    steps = {
        "customer": [{"op": "sql", "args": {"view_name": "customer_v", "query": "SELECT * FROM customer_v"}}],
        "orders": [{"op": "sql", "args": {"view_name": "orders_v", "query":
            "SELECT c.c_mktsegment, o.o_orderstatus, count(*) AS n_orders, max(o.o_totalprice) AS max_price, "
            "min(o.o_orderdate) AS first_order FROM orders_v o JOIN customer_v c ON c.c_custkey = o.o_custkey "
            "GROUP BY c.c_mktsegment, o.o_orderstatus"}}],
    }
    return apply_steps(spark, dfs, steps, RUN_DATE)["orders"]


@query(
    "step_aggregate",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines, max(l_extendedprice) AS max_price,
              min(l_shipdate) AS first_ship
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def q_step_aggregate(spark, sf_dir):
    """Table step: group and aggregate (partial aggregation map-side)."""
    return _steps(spark, sf_dir, "lineitem", [
        {"op": "aggregate", "args": {"group_by": ["l_returnflag", "l_linestatus"], "aggs": {
            "n_lines": "count(*)", "max_price": "max(l_extendedprice)", "first_ship": "F.min('l_shipdate')"}}},
    ])


@query(
    "step_limit",
    "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def q_step_limit(spark, sf_dir):
    """C13 after a sort step: the 100 largest orders (the limit is the
    feature; sort + limit plans as one bounded top-k)."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "sort", "args": {"cols": ["o_totalprice", "o_orderkey"], "ascending": [False, True]}},
        {"op": "limit", "args": {"num": 100}},
    ])


@query(
    "step_summary",
    """SELECT 'count' AS summary, CAST(count(o_orderkey) AS VARCHAR) AS o_orderkey,
              CAST(count(o_custkey) AS VARCHAR) AS o_custkey FROM orders
       UNION ALL SELECT 'min', CAST(min(o_orderkey) AS VARCHAR), CAST(min(o_custkey) AS VARCHAR) FROM orders
       UNION ALL SELECT 'max', CAST(max(o_orderkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders""",
)
def q_step_summary(spark, sf_dir):
    """Summary statistics (one aggregation pass)."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "select", "args": {"cols": ["o_orderkey", "o_custkey"]}},
        {"op": "summary", "args": {"statistics": ["count", "min", "max"]}},
    ])


@query(
    "step_join_anti",
    """SELECT c.* FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""",
)
def q_step_join_anti(spark, sf_dir):
    """Join table step (anti): customers without an urgent order. The
    other side is broadcast only if a count shows it under the limit."""
    dfs = {"customer": table(spark, sf_dir, "customer"), "orders": table(spark, sf_dir, "orders")}
    steps = {
        "orders": [{"op": "filter", "args": {"condition": "o_orderpriority = '1-URGENT'"}},
                   {"op": "select", "args": {"cols": ["o_custkey"]}}],
        "customer": [{"op": "join", "args": {"other": "orders", "on": {"expr": "c_custkey = o_custkey"},
                                             "how": "left_anti", "broadcast": 100000}}],
    }
    return apply_steps(spark, dfs, steps, RUN_DATE)["customer"]


@query(
    "step_join_semi",
    """SELECT p.* FROM part p WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey
       AND l.l_returnflag = 'R' AND l.l_quantity >= 49)""",
)
def q_step_join_semi(spark, sf_dir):
    """Join table step (semi): parts with a large returned line."""
    dfs = {"part": table(spark, sf_dir, "part"), "lineitem": table(spark, sf_dir, "lineitem")}
    steps = {
        "lineitem": [{"op": "where", "args": {"condition": "l_returnflag = 'R' AND l_quantity >= 49"}},
                     {"op": "select", "args": {"cols": ["l_partkey"]}}],
        "part": [{"op": "join", "args": {"other": "lineitem", "on": {"expr": "p_partkey = l_partkey"},
                                         "how": "left_semi"}}],
    }
    return apply_steps(spark, dfs, steps, RUN_DATE)["part"]


@query(
    "step_sql_window",
    """SELECT o_custkey, o_orderkey, o_orderdate,
              CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rn
       FROM orders""",
)
def q_step_sql_window(spark, sf_dir):
    """T3 through a SQL step: every order with its rank in its customer's
    history."""
    return _steps(spark, sf_dir, "orders", [{"op": "sql", "args": {"view_name": "orders_w", "query":
        "SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER ("
        " PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders_w"}}])


_ROLLUP = """SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS max_price
       FROM {t} GROUP BY ROLLUP (o_orderstatus, o_orderpriority) HAVING count(*) > 0.05 * (SELECT count(*) FROM {t})"""


@query("step_sql_rollup", _ROLLUP.format(t="orders"))
def q_step_sql_rollup(spark, sf_dir):
    """A3 through a SQL step: rollup with HAVING, by a share of all rows."""
    return _steps(spark, sf_dir, "orders", [{"op": "sql", "args": {"view_name": "orders_r", "query": _ROLLUP.format(t="orders_r")}}])


@query(
    "step_sql_set_ops",
    """(SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
        INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
       EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def q_step_sql_set_ops(spark, sf_dir):
    """T4 through SQL steps over two tables: intersect and except. Each
    side is reduced to distinct keys first (partial aggregation map-side):
    Spark plans INTERSECT as a semi join that de-duplicates only after the
    join, so a customer holding a third of the orders would otherwise
    reach one join task whole."""
    dfs = {"customer": table(spark, sf_dir, "customer"), "orders": table(spark, sf_dir, "orders")}
    steps = {
        "customer": [{"op": "sql", "args": {"view_name": "customer_s", "query": "SELECT * FROM customer_s"}}],
        "orders": [{"op": "sql", "args": {"view_name": "orders_s", "query":
            "(SELECT DISTINCT o_custkey AS custkey FROM orders_s WHERE o_orderstatus = 'F' "
            " INTERSECT SELECT DISTINCT o_custkey FROM orders_s WHERE o_orderpriority = '1-URGENT') "
            "EXCEPT SELECT c_custkey FROM customer_s WHERE c_mktsegment = 'BUILDING'"}}],
    }
    return apply_steps(spark, dfs, steps, RUN_DATE)["orders"]


@query("step_sample", "SELECT count(*) AS n_orders, true AS subset, true AS repeatable, true AS near_share FROM orders")
def q_step_sample(spark, sf_dir):
    """C14: a seeded Bernoulli sample (the sampling is the feature). No
    oracle can reproduce Spark's random stream, so the query states what any
    such sample must satisfy: it holds rows of the table only, the seed
    gives it again, and its size is near the share asked for."""
    orders = table(spark, sf_dir, "orders")
    step = [{"op": "sample", "args": {"fraction": 0.1, "seed": 42}}]
    one, two = (_steps(spark, sf_dir, "orders", step) for _ in range(2))
    total = orders.agg(F.count(F.lit(1)).alias("n_orders"))
    sample = one.agg(F.count(F.lit(1)).alias("n"))
    strange = one.exceptAll(orders).agg(F.count(F.lit(1)).alias("strange"))
    differ = one.exceptAll(two).union(two.exceptAll(one)).agg(F.count(F.lit(1)).alias("differ"))
    spread = 5 * F.sqrt(F.col("n_orders") * 0.1 * 0.9)  # five standard deviations
    all_four = total.join(sample).join(strange).join(differ)  # one row each
    return all_four.select(
        "n_orders", (F.col("strange") == 0).alias("subset"), (F.col("differ") == 0).alias("repeatable"),
        (F.abs(F.col("n") - F.col("n_orders") * 0.1) <= spread).alias("near_share"),
    )


@query(
    "step_describe",
    """SELECT u.summary, round(u.p, 2) AS o_totalprice, round(u.k, 2) AS o_custkey
       FROM (SELECT count(o_totalprice) AS c1, avg(o_totalprice) AS a1, stddev_samp(o_totalprice) AS s1, min(o_totalprice) AS l1,
                    max(o_totalprice) AS h1, count(o_custkey) AS c2, avg(o_custkey) AS a2, stddev_samp(o_custkey) AS s2,
                    min(o_custkey) AS l2, max(o_custkey) AS h2 FROM orders),
            LATERAL (VALUES ('count', CAST(c1 AS DOUBLE), CAST(c2 AS DOUBLE)), ('mean', a1, a2), ('stddev', s1, s2),
                            ('min', l1, CAST(l2 AS DOUBLE)), ('max', h1, CAST(h2 AS DOUBLE))) AS u(summary, p, k)""",
)
def q_step_describe(spark, sf_dir):
    """The default statistics (Spark returns them as text; compared
    here as rounded numbers)."""
    got = _steps(spark, sf_dir, "orders", [{"op": "describe", "args": {"cols": ["o_totalprice", "o_custkey"]}}])
    return got.select("summary", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in ("o_totalprice", "o_custkey")])


@query("step_summary_default", "SELECT unnest(['count', 'mean', 'stddev', 'min', '25%', '50%', '75%', 'max']) AS summary, count(*) AS n_rows, true AS ordered FROM orders")
def q_step_summary_default(spark, sf_dir):
    """``summary`` without arguments gives eight statistics; the
    quartiles are approximate, so they are only checked to lie in order."""
    got = _steps(spark, sf_dir, "orders", [{"op": "select", "args": {"cols": ["o_totalprice"]}}, {"op": "summary", "args": {}}])
    value = lambda name: F.max(F.when(F.col("summary") == name, F.col("o_totalprice").cast("double")))
    marks = ["min", "25%", "50%", "75%", "max"]
    row = got.agg(value("count").cast("long").alias("n_rows"), *[value(m).alias(m) for m in marks])
    ordered = [F.col(f"`{a}`") <= F.col(f"`{b}`") for a, b in zip(marks, marks[1:])]
    return got.select("summary").join(row).select("summary", "n_rows", (ordered[0] & ordered[1] & ordered[2] & ordered[3]).alias("ordered"))


@query("step_to_schema", "SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderkey FROM orders")
def q_step_to_schema(spark, sf_dir):
    """C20: alias, column metadata, then a target schema (columns by name,
    cast and reordered)."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "alias", "args": {"alias": "o"}},
        {"op": "withMetadata", "args": {"columnName": "o_orderkey", "metadata": {"key": True}}},
        {"op": "to", "args": {"schema": "o_custkey string, o_orderkey bigint"}},
    ])


@query("step_layout", "SELECT * FROM orders")
def q_step_layout(spark, sf_dir):
    """Layout, caching, checkpoint and watermark steps leave the
    rows of a batch as they are."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "hint", "args": {"name": "rebalance"}},
        {"op": "repartition", "args": {"numPartitions": 6}},
        {"op": "coalesce", "args": {"numPartitions": 3}},
        {"op": "checkpoint", "args": {}},
        {"op": "persist", "args": {"storageLevel": "DISK_ONLY"}},
        {"op": "unpersist", "args": {}},
        {"op": "withColumn", "args": {"colName": "seen", "col": "F.col('o_orderdate').cast('timestamp')"}},
        {"op": "withWatermark", "args": {"eventTime": "seen", "delayThreshold": "1 day"}},
        {"op": "drop", "args": {"cols": ["seen"]}},
    ])


@query(
    "step_join_full",
    """SELECT c.c_custkey, s.s_suppkey, c.c_nationkey, s.s_nationkey FROM
       (SELECT * FROM customer WHERE c_acctbal < 0) c FULL JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s
       ON c.c_custkey = s.s_suppkey""",
)
def q_step_join_full(spark, sf_dir):
    """J4 full: rows without a partner on either side stay."""
    dfs = {"customer": table(spark, sf_dir, "customer"), "supplier": table(spark, sf_dir, "supplier")}
    steps = {
        "supplier": [{"op": "filter", "args": {"condition": "s_acctbal > 0"}}],
        "customer": [
            {"op": "filter", "args": {"condition": "c_acctbal < 0"}},
            {"op": "join", "args": {"other": "supplier", "on": {"expr": "c_custkey = s_suppkey"}, "how": "full"}},
            {"op": "select", "args": {"cols": ["c_custkey", "s_suppkey", "c_nationkey", "s_nationkey"]}},
        ],
    }
    return apply_steps(spark, dfs, steps, RUN_DATE)["customer"]


@query(
    "step_join_right",
    """SELECT n.n_name, c.c_custkey FROM nation n RIGHT JOIN customer c ON n.n_nationkey = c.c_nationkey AND c.c_acctbal > 0""",
)
def q_step_join_right(spark, sf_dir):
    """J4 right: every customer, with the nation of those in credit."""
    dfs = {"nation": table(spark, sf_dir, "nation"), "customer": table(spark, sf_dir, "customer")}
    steps = {"nation": [
        {"op": "join", "args": {"other": "customer", "on": {"expr": "n_nationkey = c_nationkey AND c_acctbal > 0"}, "how": "right"}},
        {"op": "select", "args": {"cols": ["n_name", "c_custkey"]}},
    ]}
    return apply_steps(spark, dfs, steps, RUN_DATE)["nation"]


@query(
    "step_join_range",
    """SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_shipdate FROM orders o JOIN lineitem l
       ON o.o_orderkey = l.l_orderkey AND l.l_shipdate >= o.o_orderdate
       AND l.l_shipdate < o.o_orderdate + INTERVAL 30 DAY""",
)
def q_step_join_range(spark, sf_dir):
    """J4 range: lines shipped within 30 days of their order. The equal key
    deals the rows, the range is checked inside each key."""
    dfs = {"orders": table(spark, sf_dir, "orders"), "lineitem": table(spark, sf_dir, "lineitem")}
    steps = {"orders": [
        {"op": "join", "args": {"other": "lineitem", "how": "inner", "on": {"expr":
            "o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 30 DAY"}}},
        {"op": "select", "args": {"cols": ["o_orderkey", "o_custkey", "l_linenumber", "l_shipdate"]}},
    ]}
    return apply_steps(spark, dfs, steps, RUN_DATE)["orders"]


@query("step_union", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def q_step_union(spark, sf_dir):
    """T4: union of two tables by column name."""
    dfs = {"customer": table(spark, sf_dir, "customer"), "supplier": table(spark, sf_dir, "supplier")}
    steps = {
        "supplier": [{"op": "select", "args": {"cols": ["s_name AS name", "s_suppkey AS k"]}}],
        "customer": [{"op": "select", "args": {"cols": ["c_custkey AS k", "c_name AS name"]}}, {"op": "union", "args": {"other": "supplier"}}],
    }
    return apply_steps(spark, dfs, steps, RUN_DATE)["customer"]


@query("step_offset", "SELECT * FROM customer ORDER BY c_acctbal, c_custkey LIMIT 50 OFFSET 20")
def q_step_offset(spark, sf_dir):
    """C13 with an offset: a page of a report (the limit is the feature)."""
    return _steps(spark, sf_dir, "customer", [
        {"op": "sort", "args": {"cols": ["c_acctbal", "c_custkey"]}},
        {"op": "limit", "args": {"num": 70}},
        {"op": "offset", "args": {"num": 20}},
    ])


@query(
    "step_sql_cube",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS grouped
       FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def q_step_sql_cube(spark, sf_dir):
    """A3 through a SQL step: cube with the grouping of each row."""
    return _steps(spark, sf_dir, "lineitem", [{"op": "sql", "args": {"view_name": "lines_c", "query":
        "SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS grouped "
        "FROM lines_c GROUP BY CUBE (l_returnflag, l_linestatus)"}}])


@query(
    "step_freq_items",
    """SELECT list_sort(list(DISTINCT o_orderstatus)) AS o_orderstatus_freqItems,
              list_sort(list(DISTINCT o_orderpriority)) AS o_orderpriority_freqItems FROM orders""",
)
def q_step_freq_items(spark, sf_dir):
    """C17: frequent items in one distributed pass. Spark keeps 1/support
    counters per column; these columns have no more distinct values than
    that (3 and 5 for support 0.2), so no counter is ever evicted and the
    answer is exact: every value of the column. The arrays are sorted so
    that the result is deterministic."""
    return _steps(spark, sf_dir, "orders", [
        {"op": "freqItems", "args": {"cols": ["o_orderstatus", "o_orderpriority"], "support": 0.2}},
        {"op": "select", "args": {"cols": [
            {"expr": "array_sort(o_orderstatus_freqItems) AS o_orderstatus_freqItems"},
            {"expr": "array_sort(o_orderpriority_freqItems) AS o_orderpriority_freqItems"},
        ]}},
    ])


# ------------------------------------------------------------------- events
@query(
    "json_event_payload",
    "SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, event_type, value, props FROM events",
)
def q_json_event_payload(spark, sf_dir):
    """Rows as keyed JSON events written as JSON lines, read back
    and parsed (JSON text itself differs between engines)."""
    work = new_work_dir(spark, "events")
    events = table(spark, sf_dir, "events")
    write_output(spark, events, {"writer": "JsonWriter", "mode": "overwrite", "path": f"{work}/events",
                                 "key_columns": ["user_id"],
                                 "value_columns": ["event_id", "ts", "event_type", "value", "props"]})
    back = spark.read.schema("key string, value string").json(f"{work}/events")
    # Parsed once per row, not once per field.
    parsed = F.from_json("value", "event_id long, ts timestamp_ntz, event_type string, value double, props string", JSON_OPTIONS)
    return back.select("key", parsed.alias("v")).select("key", "v.*")
