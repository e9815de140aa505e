"""The gold "top users" report, its SQL twin, backfills of it, and the
silver / customer inputs it reads.

Stand-ins over the TPC-H-like tables (see FIXTURES.md):

* ``customers``: ``customer`` with ``id = c_custkey``;
* silver ``orders``: one row per order, ``customer_id = o_custkey``,
  ``status`` spelled out from ``o_orderstatus``, ``created_at =
  o_orderdate``, ``updated_at`` = last ship date of its line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.rundate import _as_date, _check_step, date_range, run_date_literal
from quarry.operators.sizing import DEFAULT_BROADCAST_BYTES, row_width
from quarry.operators.topk import top_k, top_k_per_group
from quarry.plans.job import PyTransform, sql_transform, transform_function
from quarry.session import materialize

# Order status codes and the words the silver table uses (fixed values).
STATUS_WORDS = {"F": "Completed", "O": "Open", "P": "Pending"}
COMPLETED = "Completed"
BOTTOM_USER_SQL = "quarry.plans.sql:bottom_user.sql"


def customers_view(customer: DataFrame) -> DataFrame:
    return customer.withColumnRenamed("c_custkey", "id")


def silver_orders(orders: DataFrame, lineitem: DataFrame, only: str | None = None, since=None) -> DataFrame:
    """Orders with their status word and last ship date; ``only`` those of
    one status, tested on the stored code, so the test reaches the scan.
    ``since``: for readers that take only orders updated on that date or
    later. An order has a last ship date from then on exactly if it has a
    line from then on, so earlier lines are left out in the scan, before they
    are aggregated and shuffled; orders with no other have no updated_at.
    Line items are reduced to one row per order before the join (partial
    aggregation map-side); the aggregate comes out hash-partitioned on the
    order key, so the join shuffles only ``orders``."""
    if since is not None:
        lineitem = lineitem.filter(F.col("l_shipdate") >= run_date_literal(since, lineitem.schema["l_shipdate"].dataType))
    last_ship = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("updated_at"))
    if only is not None:
        codes = [code for code, word in STATUS_WORDS.items() if word == only]
        orders = orders.filter(F.col("o_orderstatus").isin([*codes, only]))
    status = F.col("o_orderstatus")
    for code, word in STATUS_WORDS.items():
        status = F.when(F.col("o_orderstatus") == code, F.lit(word)).otherwise(status)
    return orders.join(last_ship, orders["o_orderkey"] == last_ship["l_orderkey"], "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("updated_at"),
    )


def straddling_completed(orders: DataFrame, run_date) -> DataFrame:
    """Completed orders created before the run date and touched on or
    after it (midnight of the run date, in the columns' own type)."""
    try:
        _as_date(run_date)
    except (TypeError, ValueError):
        raise ValueError(f"the report takes a date run date (YYYY-MM-DD), got {run_date!r}") from None
    d = run_date_literal(run_date, orders.schema["updated_at"].dataType)
    return orders.filter(
        (F.col("updated_at") >= d) & (F.col("created_at") < d) & (F.col("status") == COMPLETED)
    )


def order_counts(orders: DataFrame, run_date) -> DataFrame:
    return straddling_completed(orders, run_date).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count")
    )


def top_users(customers: DataFrame, orders: DataFrame, run_date, k: int = 10, ascending: bool = False) -> DataFrame:
    """Customer rows of the k customers with the most (``ascending``:
    fewest) straddling completed orders. The k ids are broadcast: their
    number is bounded by k, not by the data."""
    ids = top_k(order_counts(orders, run_date), "order_count", k, ascending, tie_break=["customer_id"])
    ids = F.broadcast(ids.select(F.col("customer_id").alias("id")))
    return customers.join(ids, "id", "left_semi").select(*customers.columns)


@transform_function("top_user", outputs=("top_user",))
def top_user_transform(spark: SparkSession, dfs: dict, run_date) -> dict:
    return {"top_user": top_users(dfs["customers"], dfs["orders"], run_date)}


class TopUserTransform(PyTransform):
    """The top-user report in class form (``PyTransformer`` with
    ``"transformation": "quarry.plans.reports.TopUserTransform"``)."""

    def transform(self) -> dict:
        return {"top_user": top_users(self.dfs["customers"], self.dfs["orders"], self.run_data_date)}


@transform_function("silver_orders", outputs=("orders",))
def silver_orders_transform(spark: SparkSession, dfs: dict, run_date) -> dict:
    """bronze orders + line items -> silver orders."""
    return {"orders": silver_orders(dfs["orders"], dfs["lineitem"])}


@transform_function("top_and_bottom_users", outputs=("top_user", "bottom_user"))
def top_and_bottom_transform(spark: SparkSession, dfs: dict, run_date) -> dict:
    """Two outputs from one read of the inputs."""
    bottom = sql_transform(spark, {"customers": dfs["customers"], "orders": dfs["orders"]}, BOTTOM_USER_SQL, run_date)
    return {"top_user": top_users(dfs["customers"], dfs["orders"], run_date), "bottom_user": bottom["result"]}


def _daily_counts_range(spark: SparkSession, dfs: dict, start, end, step) -> dict:
    return {"daily_order_counts": order_counts_by_date(dfs["orders"], start, end, step)}


@transform_function("daily_order_counts", outputs=("daily_order_counts",), range_form=_daily_counts_range)
def daily_counts_transform(spark: SparkSession, dfs: dict, run_date) -> dict:
    """Per-customer counts for one run date, tagged with the date: the
    unit of work of a looped backfill."""
    counts = order_counts(dfs["orders"], run_date).select(
        F.lit(_as_date(run_date)).alias("run_date"), "customer_id", "order_count"
    )
    return {"daily_order_counts": counts}


def _segments(orders: DataFrame, start, end, step=None) -> DataFrame:
    """(customer_id, i, next_i, order_count): ``order_counts`` over a
    backfill range, as stretches i <= index < next_i of equal counts.

    An order straddles date d (midnight) exactly when
    ``to_date(created_at) < d <= to_date(updated_at)``, i.e. it covers a
    contiguous run ``lo..hi`` of range indices, computed arithmetically.
    The counts are built from change points rather than by listing every
    date of every order: each order contributes +1 at ``lo`` and -1 at
    ``hi + 1``; these are summed per (customer, index) with map-side
    partial aggregation, then a running sum over a customer's change
    points (at most ``dates + 1`` rows per customer, however many orders
    it has, so a hot customer stays small) gives the count of each
    segment between consecutive change points. Nothing is compared
    pairwise and no date spine is joined.
    """
    step = _check_step(step)
    first, last = _as_date(start), _as_date(end)
    n_dates = (last - first).days // step + 1
    start_lit = F.lit(first)
    lo_days = F.datediff(F.date_add(F.to_date("created_at"), 1), start_lit)
    hi_days = F.datediff(F.to_date("updated_at"), start_lit)
    lo = F.greatest(F.lit(0), F.ceil(lo_days / F.lit(step)).cast("int"))
    hi = F.least(F.lit(n_dates - 1), F.floor(hi_days / F.lit(step)).cast("int"))
    # NULL timestamps straddle nothing (and greatest/least would skip them).
    completed = orders.filter(
        (F.col("status") == COMPLETED) & F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()
    )
    changes = (
        completed.select("customer_id", lo.alias("lo"), hi.alias("hi"))
        .filter(F.col("lo") <= F.col("hi"))
        .select(
            "customer_id",
            F.explode(
                F.array(
                    F.struct(F.col("lo").alias("i"), F.lit(1).alias("d")),
                    F.struct((F.col("hi") + 1).alias("i"), F.lit(-1).alias("d")),
                )
            ).alias("c"),
        )
        .groupBy("customer_id", F.col("c.i").alias("i"))
        .agg(F.sum("c.d").alias("d"))
        .filter(F.col("d") != 0)
    )
    w = Window.partitionBy("customer_id").orderBy("i")
    return changes.select(
        "customer_id",
        "i",
        F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("order_count"),
        F.lead("i").over(w).alias("next_i"),
    ).filter(F.col("order_count") > 0)


def _date_at(first, step: int, i) -> Column:
    return F.date_add(F.lit(first), (i * step).cast("int"))


def order_counts_by_date(orders: DataFrame, start, end, step=None) -> DataFrame:
    """``order_counts`` for every date of a backfill range in one pass: the
    segments of ``_segments``, expanded to dates after the last shuffle. It
    has a row per customer and date with a count; where intervals will do,
    take ``order_count_intervals``."""
    return _by_date(_segments(orders, start, end, step), start, step)


def _by_date(segments: DataFrame, start, step) -> DataFrame:
    first, step = _as_date(start), _check_step(step)
    # Every +1 has its -1 at most at index n_dates, so a positive segment
    # always has a next change point.
    return segments.select(
        F.explode(F.sequence("i", F.col("next_i") - 1)).alias("i"),
        "customer_id",
        F.col("order_count").cast("long").alias("order_count"),
    ).select(_date_at(first, step, F.col("i")).alias("run_date"), "customer_id", "order_count")


def order_count_intervals(orders: DataFrame, start, end, step=None) -> DataFrame:
    """(customer_id, from_date, to_date, order_count): the stretches of run
    dates over which a customer's count stays the same and is not zero."""
    first, step = _as_date(start), _check_step(step)
    return _segments(orders, start, end, step).select(
        "customer_id", _date_at(first, step, F.col("i")).alias("from_date"),
        _date_at(first, step, F.col("next_i") - 1).alias("to_date"), F.col("order_count").cast("long").alias("order_count"),
    )


def top_users_by_date(customers: DataFrame, orders: DataFrame, start, end, step=None, k: int = 10) -> DataFrame:
    """The top-user report for every date of a backfill range.

    Ranking every (date, customer) row would sort them all. Instead each
    date's threshold is found first: the k-th largest count, from a
    histogram of (date, count) -> customers. Only rows at or above their
    date's threshold (the top k and ties with the k-th) are ranked; at
    sf0.1 that is 0.3 % of the rows. The histogram is partially aggregated
    before its shuffle. A date has at most sqrt(2 x its orders) distinct
    counts (counts 1..m already need m^2/2 orders), so no task holds a
    large group. The thresholds (one row per date, known from the range)
    are broadcast.

    Per-date top-k then uses ``row_number() <= k`` with a partial
    ``WindowGroupLimit`` before the shuffle. The result has at most k x
    dates rows; it is broadcast to the customer join when that bound fits
    the broadcast limit, else the join is left to the planner.
    """
    # Written once: the histogram and the ranking both expand the segments.
    segments = materialize(orders.sparkSession, _segments(orders, start, end, step), "segments")
    counts = _by_date(segments, start, step)
    n_dates = len(date_range(start, end, step))
    at_least = Window.partitionBy("run_date").orderBy(F.col("order_count").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    thresholds = (
        counts.groupBy("run_date", "order_count")
        .agg(F.count(F.lit(1)).alias("customers"))
        .select("run_date", "order_count", F.sum("customers").over(at_least).alias("at_least"))
        .groupBy("run_date")
        .agg(
            # the k-th largest count; with fewer than k customers, the smallest
            F.coalesce(
                F.max(F.when(F.col("at_least") >= k, F.col("order_count"))), F.min("order_count")
            ).alias("threshold")
        )
    )
    if n_dates * row_width(thresholds.schema) <= DEFAULT_BROADCAST_BYTES:
        thresholds = F.broadcast(thresholds)
    candidates = (
        counts.join(thresholds, "run_date")
        .filter(F.col("order_count") >= F.col("threshold"))
        .drop("threshold")
    )
    top = top_k_per_group(candidates, ["run_date"], "order_count", k, tie_break=["customer_id"], rank_col="rank")
    if k * n_dates * row_width(top.schema) <= DEFAULT_BROADCAST_BYTES:
        top = F.broadcast(top)
    return (
        customers.alias("a")
        .join(top.alias("b"), F.col("a.id") == F.col("b.customer_id"), "inner")
        .select("b.run_date", "b.rank", "a.*")
    )
