"""Queries of what tables must survive and may become: unregistered files,
readers of versions, re-run backfills, upserts by files and of hot keys,
widened and nested schemas, replace by condition, appends done once."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans import catalogue as base
from quarry.plans.catalogue import ORACLE, RUN_DATE, query, table
from quarry.plans.job import run
from quarry.session import new_work_dir
from quarry.sinks import write_output
from quarry.sources import read_files, read_table

_CHANGED = base._upsert_oracle("t.o_orderstatus <> s.o_orderstatus")


def _unregistered(spark, sf_dir, tag: str, scope: str):
    """A partitioned table with files that its entry does not list, as after
    an append whose registration failed; then an upsert into it."""
    work = new_work_dir(spark, tag)
    year = F.year("o_orderdate").alias("o_year")
    orders = table(spark, sf_dir, "orders").select(*base._ORDER_COLS, year)
    sink = base._sink(work, tag, "append", partition_by=["o_year"], first=True)
    write_output(spark, base._before_run_date(orders), sink)
    # The same files as the sink's, written past the catalog.
    write_output(spark, base._from_run_date(orders), {k: v for k, v in sink.items() if k != "table_name"})
    fresh = base.recomputed_orders(spark, sf_dir).select("*", year).filter("o_orderstatus = 'P' OR o_year % 2 = 0")
    write_output(spark, fresh, {**sink, "mode": "upsert", "primary_key": ["o_orderkey", "o_year"], "change_tracking_column": ["o_orderstatus"], "upsert_scope": scope})
    return read_table(spark, {"table": f"bronze.{tag}"})


@query("upsert_unregistered_partitions", ORACLE["upsert_partitioned"])
def q_upsert_unregistered_partitions(spark, sf_dir):
    return _unregistered(spark, sf_dir, "unregistered_partitions", "partitions")


@query("upsert_unregistered_table", ORACLE["upsert_partitioned"])
def q_upsert_unregistered_table(spark, sf_dir):
    return _unregistered(spark, sf_dir, "unregistered_table", "table")


def _upserted(spark, sf_dir, tag: str) -> str:
    work = new_work_dir(spark, tag)
    snapshot = base._before_run_date(table(spark, sf_dir, "orders")).select(*base._ORDER_COLS)
    write_output(spark, snapshot, base._sink(work, tag, "append"))
    sink = base._sink(work, tag, "upsert", primary_key=["o_orderkey"], change_tracking_column=["o_orderstatus"])
    write_output(spark, base.recomputed_orders(spark, sf_dir), sink)
    return sink["path"]


@query("read_upserted_by_path", _CHANGED)
def q_read_upserted_by_path(spark, sf_dir):
    """A reader by path gets the rows of the current version."""
    return read_files(spark, {"path": _upserted(spark, sf_dir, "read_by_path")})


@query("read_upserted_by_name", _CHANGED)
def q_read_upserted_by_name(spark, sf_dir):
    """So does a reader by name in a session whose catalog has no entry."""
    path = _upserted(spark, sf_dir, "read_by_name")
    spark.sql("DROP TABLE bronze.read_by_name")  # external: the files stay
    return read_table(spark, {"table": "bronze.read_by_name", "path": path})


@query(
    "backfill_set_rerun",
    ORACLE["backfill_loop"].replace("WHERE o.status", "WHERE o.created_at >= TIMESTAMP '1998-06-05' AND o.status"),
)
def q_backfill_set_rerun(spark, sf_dir):
    """R2 K7: a set-based backfill run again over a source that has lost
    orders in between. Dates that have none now are cleared, as the loop
    form does."""
    work = new_work_dir(spark, "backfill_rerun")
    conf = {
        "run_mode": {"name": "back_fill", "start": base.LOOP_START, "end": base.LOOP_END, "step": base.LOOP_STEP, "set_based": True},
        "extract": {"orders": {"reader": "TableReader", "table": "rerun_orders"}},
        "transform": {"transformer": "PyTransformer", "transformation": "daily_order_counts"},
        "load": {"daily_order_counts": base._sink(work, "rerun_counts", "overwrite_partition", partition_by=["run_date"])},
    }
    orders = base._inputs(spark, sf_dir)[1]
    for source in (orders, orders.where(F.col("created_at") >= F.lit("1998-06-05").cast("timestamp_ntz"))):
        source.createOrReplaceTempView("rerun_orders")
        run(spark, conf)
    return spark.table("bronze.rerun_counts").select("run_date", "customer_id", "order_count")


@query(
    "replace_where_range",
    f"""
WITH {base._RECOMPUTED}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders WHERE year(o_orderdate) NOT BETWEEN 1997 AND 1999
UNION ALL
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM src WHERE year(o_orderdate) IN (1997, 1999)""",
)
def q_replace_where_range(spark, sf_dir):
    """K7: the years 1997 to 1999 replaced by rows of two of them; 1998,
    without new rows, is cleared."""
    work = new_work_dir(spark, "replace_where")
    year = F.year("o_orderdate").alias("o_year")
    sink = base._sink(work, "orders_replaced", "overwrite", partition_by=["o_year"])
    write_output(spark, table(spark, sf_dir, "orders").select(*base._ORDER_COLS, year), sink)
    fresh = base.recomputed_orders(spark, sf_dir).select("*", year).where("o_year IN (1997, 1999)")
    write_output(spark, fresh, {**sink, "mode": "overwrite_partition", "replace_where": {"column": "o_year", "from": 1997, "to": 1999}})
    return spark.table("bronze.orders_replaced")


@query(
    "upsert_by_files",
    f"""
WITH {base._RECOMPUTED},
s AS (SELECT * FROM src WHERE o_orderkey < 100 OR o_orderkey % 5000 = 4999)
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL AND coalesce(t.o_orderstatus <> s.o_orderstatus, false) THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       t.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM orders t LEFT JOIN s ON t.o_orderkey = s.o_orderkey WHERE t.o_orderkey % 5000 <> 4999
UNION ALL
SELECT * FROM s WHERE o_orderkey % 5000 = 4999""",
)
def q_upsert_by_files(spark, sf_dir):
    """K8: changes to a range of keys and some new ones, upserted into a
    table of many files in key order; only the files that hold a matched key
    are written again."""
    work = new_work_dir(spark, "upsert_by_files")
    orders = table(spark, sf_dir, "orders").select(*base._ORDER_COLS).where("o_orderkey % 5000 <> 4999")
    sink = base._sink(work, "orders_by_files", "overwrite")
    write_output(spark, orders.repartitionByRange(16, "o_orderkey"), sink)
    upsert = {**sink, "mode": "upsert", "upsert_scope": "files", "primary_key": ["o_orderkey"], "change_tracking_column": ["o_orderstatus"]}
    fresh = base.recomputed_orders(spark, sf_dir)
    for part in ("o_orderkey < 100", "o_orderkey % 5000 = 4999"):
        write_output(spark, fresh.where(part), upsert)
    return spark.table("bronze.orders_by_files")


@query(
    "upsert_hot_key",
    """
WITH tgt AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, event_type FROM events),
s AS (SELECT c_custkey AS user_id, CAST(NULL AS BIGINT) AS event_id, c_mktsegment AS event_type FROM customer)
SELECT t.event_id, t.user_id, CASE WHEN s.user_id IS NOT NULL AND t.event_type <> s.event_type THEN s.event_type ELSE t.event_type END AS event_type
FROM tgt t LEFT JOIN s ON t.user_id = s.user_id
UNION ALL
SELECT event_id, user_id, event_type FROM s WHERE user_id NOT IN (SELECT user_id FROM tgt WHERE user_id IS NOT NULL)""",
)
def q_upsert_hot_key(spark, sf_dir):
    """A target with a third of its rows on one key and a source too
    large to broadcast (by its limit here): one pass, the hot key split."""
    work = new_work_dir(spark, "upsert_hot_key")
    user = F.when(F.col("event_id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("user_id")).alias("user_id")
    sink = base._sink(work, "events_by_user", "overwrite")
    write_output(spark, table(spark, sf_dir, "events").select("event_id", user, "event_type"), sink)
    source = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"))
    write_output(spark, source, {**sink, "mode": "upsert", "primary_key": ["user_id"], "change_tracking_column": ["event_type"], "broadcast_bytes": 0, "skew_bytes": 0})
    return spark.table("bronze.events_by_user")


@query(
    "schema_widening_append",
    """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(CAST(o_totalprice AS DECIMAL(10, 1)) AS DECIMAL(14, 2)) AS price,
       o_orderstatus AS status, NULL AS priority, CAST(year(o_orderdate) AS BIGINT) AS y
FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'
UNION ALL
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14, 2)), o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS BIGINT)
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'""",
)
def q_schema_widening_append(spark, sf_dir):
    """A second append with wider types (int to long, a larger decimal,
    also inside a struct) and a new field of the struct; the first append's
    files are read under the wider schema as they are."""
    work = new_work_dir(spark, "schema_widening")
    orders = table(spark, sf_dir, "orders")
    sink = base._sink(work, "orders_widened", "append", merge_schema=True, widen_types=True)
    year = F.year("o_orderdate")
    old = base._before_run_date(orders).select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), F.col("o_totalprice").cast("decimal(10,1)").alias("price"),
        F.struct(F.col("o_orderstatus").alias("status"), year.alias("y")).alias("state"),
    )
    new = base._from_run_date(orders).select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
        F.struct(F.col("o_orderpriority").alias("priority"), year.cast("long").alias("y"), F.col("o_orderstatus").alias("status")).alias("state"),
    )
    write_output(spark, old, sink)
    write_output(spark, new, sink)
    return spark.table("bronze.orders_widened").select("o_orderkey", "o_custkey", "price", "state.status", "state.priority", "state.y")


@query("append_batch_twice", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def q_append_batch_twice(spark, sf_dir):
    """K5: an append that is tried again under its batch id adds nothing."""
    work = new_work_dir(spark, "append_batch")
    orders = table(spark, sf_dir, "orders").select(*base._ORDER_COLS)
    sink = base._sink(work, "orders_batched", "append", batch_id="orders of ${run_date}")
    write_output(spark, base._before_run_date(orders), sink, RUN_DATE)
    for _ in range(2):
        write_output(spark, base._from_run_date(orders), sink, "2001-12-31")
    return spark.table("bronze.orders_batched")
