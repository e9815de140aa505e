"""Queries of the operators that work along a key's order or by value:
as-of and interval joins, running values, sessions, heavy hitters, exact
quantiles, mergeable distinct counts and JSON payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import distinct, payload
from quarry.operators.asof import asof_join
from quarry.operators.frequent import heavy_hitters
from quarry.operators.intervals import interval_join
from quarry.operators.ordered import Running, chunked, running
from quarry.operators.quantiles import exact_quantiles
from quarry.operators.sessions import sessions
from quarry.plans.catalogue import query, table
from quarry.session import materialize


@query(
    "asof_last_order",
    """
SELECT e.event_id, e.user_id, o.o_orderkey AS last_order, o.o_orderdate AS ordered_at
FROM events e
ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) o
  ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate""",
)
def q_asof_last_order(spark, sf_dir):
    """Every event with its user's latest order that is not later."""
    return asof_join(
        spark, table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), table(spark, sf_dir, "orders"),
        on=[("user_id", "o_custkey")], times=("ts", "o_orderdate"),
        take={"last_order": "o_orderkey", "ordered_at": "o_orderdate"}, tie=["o_orderkey"],
    ).drop("ts")


@query(
    "asof_previous_order",
    """
SELECT a.o_orderkey, a.o_custkey, p.o_orderkey AS previous_order, date_diff('day', p.o_orderdate, a.o_orderdate) AS days_since
FROM orders a
ASOF JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) p
  ON a.o_custkey = p.o_custkey AND a.o_orderdate > p.o_orderdate""",
)
def q_asof_previous_order(spark, sf_dir):
    """Every order with its customer's latest order of an earlier date;
    first orders have none and are left out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = asof_join(
        spark, orders, orders, on=[("o_custkey", "o_custkey")], times=("o_orderdate", "o_orderdate"),
        take={"previous_order": "o_orderkey", "before": "o_orderdate"}, tie=["o_orderkey"], strict=True, how="inner",
    )
    days = F.datediff(F.to_date("o_orderdate"), F.to_date("before")).cast("long")
    return out.select("o_orderkey", "o_custkey", "previous_order", days.alias("days_since"))


_RANGES = {"week": "7 days", "quarter": "3 months", "year": "1 year"}


@query(
    "interval_open_orders",
    """
WITH ranges AS (
    """
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{g}' AS grain, date_trunc('{g}', o_orderdate)::TIMESTAMP AS from_time, date_trunc('{g}', o_orderdate)::TIMESTAMP + INTERVAL '{w}' AS to_time FROM orders"
        for g, w in _RANGES.items()
    )
    + """
), open AS (
    SELECT o_orderkey, o_orderdate, max(l_shipdate) AS shipped FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
)
SELECT grain, from_time, count(*) AS n_orders, min(o_orderkey) AS first_order, max(o_orderkey) AS last_order
FROM ranges JOIN open ON o_orderdate < to_time AND from_time < shipped AND o_orderdate < shipped
GROUP BY grain, from_time""",
)
def q_interval_open_orders(spark, sf_dir):
    """Orders that are open (ordered, not yet wholly shipped) at some moment
    of each week, quarter and year: intervals against ranges, no equal key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    open_ = orders.join(shipped, orders["o_orderkey"] == shipped["l_orderkey"]).select("o_orderkey", "o_orderdate", "shipped")
    ranges = None
    for grain, width in _RANGES.items():
        start = F.date_trunc(grain, F.col("o_orderdate").cast("timestamp")).cast(orders.schema["o_orderdate"].dataType)
        one = orders.select(F.lit(grain).alias("grain"), start.alias("from_time")).distinct().withColumn("to_time", F.col("from_time") + F.expr(f"INTERVAL {width}"))
        ranges = one if ranges is None else ranges.union(one)
    met = interval_join(ranges, open_, ("from_time", "to_time"), ("o_orderdate", "shipped"))
    return met.groupBy("left.grain", "left.from_time").agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("right.o_orderkey").alias("first_order"), F.max("right.o_orderkey").alias("last_order")
    )


@query(
    "running_total_by_type",
    """
SELECT event_id, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents, count(*) OVER w AS n,
       max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most_before
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def q_running_total_by_type(spark, sf_dir):
    """Running values of every event within its type: five keys hold all
    rows, so each is cut into chunks."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    c = chunked(spark, events, ["event_type"], ["ts", "event_id"])
    out = running(c, {
        "cents": Running("sum", F.round(F.col("value") * 100).cast("long")),
        "n": Running("count", F.lit(1)),
        "most_before": Running("max", F.col("value"), before=True),
    })
    return out.select("event_id", "event_type", "cents", "n", "most_before")


@query(
    "sessions_by_user",
    """
WITH marked AS (
    SELECT user_id, ts, event_id, event_type, CASE WHEN ts > lag(ts) OVER w + INTERVAL '8 hours' OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS starts
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), numbered AS (
    SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM marked
)
SELECT user_id, session, min(ts) AS started, max(ts) AS ended, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases
FROM numbered GROUP BY user_id, session""",
)
def q_sessions_by_user(spark, sf_dir):
    measures = {"n_events": F.count(F.lit(1)), "n_purchases": F.count_if(F.col("event_type") == "purchase")}
    return sessions(spark, table(spark, sf_dir, "events"), ["user_id"], "ts", "8 hours", measures, tie=["event_id"])


@query(
    "sessions_of_all",
    """
WITH marked AS (
    SELECT ts, event_id, CASE WHEN ts > lag(ts) OVER w + INTERVAL '10 minutes' OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS starts
    FROM events WINDOW w AS (ORDER BY ts, event_id)
), numbered AS (
    SELECT *, CAST(sum(starts) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM marked
)
SELECT session, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM numbered GROUP BY session""",
)
def q_sessions_of_all(spark, sf_dir):
    """Sessions of the whole stream: one sequence without a key."""
    return sessions(spark, table(spark, sf_dir, "events"), [], "ts", "10 minutes", {"n_events": F.count(F.lit(1))}, tie=["event_id"])


@query(
    "heavy_hitters",
    r"""
WITH words AS (
    SELECT lang, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM documents
)
SELECT 'word' AS "column", word AS value, count(*) AS n FROM words GROUP BY word HAVING count(*) >= 0.002 * (SELECT count(*) FROM words)
UNION ALL
SELECT 'lang', lang, count(*) FROM words GROUP BY lang HAVING count(*) >= 0.002 * (SELECT count(*) FROM words)""",
)
def q_heavy_hitters(spark, sf_dir):
    """Words and languages that hold at least 0.2 % of all words: far more
    words than counters."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word"))
    return heavy_hitters(words, ["word", "lang"], 0.002)


@query(
    "exact_quantiles",
    "\nUNION ALL\n".join(
        f"SELECT l_returnflag, CAST({q} AS DOUBLE) AS q, quantile_disc(l_extendedprice, {q}) AS value FROM lineitem GROUP BY l_returnflag" for q in (0.01, 0.25, 0.5, 0.75, 0.999)
    ),
)
def q_exact_quantiles(spark, sf_dir):
    return exact_quantiles(spark, table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.01, 0.25, 0.5, 0.75, 0.999])


@query(
    "exact_median_by_customer",
    "SELECT o_custkey, CAST(0.5 AS DOUBLE) AS q, quantile_disc(o_totalprice, 0.5) AS value FROM orders GROUP BY o_custkey",
)
def q_exact_median_by_customer(spark, sf_dir):
    """Many small groups beside the few large ones of ``exact_quantiles``."""
    return exact_quantiles(spark, table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", [0.5])


@query(
    "distinct_users_by_range",
    """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT d AS "range", count(DISTINCT user_id) AS n
FROM days JOIN events ON CAST(ts AS DATE) BETWEEN d - 6 AND d GROUP BY d""",
)
def q_distinct_users_by_range(spark, sf_dir):
    """Distinct users of the seven days up to each date, from states that
    are stored once per date."""
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), "user_id")
    states = materialize(spark, distinct.bitmap_states(events, "date", "user_id"), "user-states")
    first, last = distinct.trailing(F.col("date"), 7)
    ranges = states.select("date").distinct().select(F.col("date").alias("range"), first.alias("from_date"), last.alias("to_date"))
    return distinct.distinct_in_ranges(states, ranges)


@query(
    "payload_by_path",
    "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events",
)
def q_payload_by_path(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return payload.extract(events, "props", {"k": ("$.k", "bigint"), "missing": ("$.missing", "string")}).drop("props")


@query(
    "payload_schema",
    "SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY event_type",
)
def q_payload_schema(spark, sf_dir):
    """Payload fields found by an aggregate over all payloads, then used as
    columns."""
    flat = payload.flattened(table(spark, sf_dir, "events").select("event_type", "props"), "props")
    return flat.groupBy("event_type").agg(F.sum("k").cast("long").alias("k"), F.count(F.lit(1)).alias("n"))
