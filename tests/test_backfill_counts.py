"""The set-based backfill counts against a per-date brute force."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.functions.rundate import date_range
from quarry.plans import reports

SCHEMA = "customer_id long, status string, created_at timestamp_ntz, updated_at timestamp_ntz"
BASE = dt.datetime(2024, 1, 1)


def brute_force(rows, start, end, step):
    out = {}
    for d in date_range(start, end, step):
        day = dt.datetime.strptime(d, "%Y-%m-%d")
        for cust, status, created, updated in rows:
            if status == "Completed" and created is not None and updated is not None:
                if updated >= day and created < day:
                    out[(d, cust)] = out.get((d, cust), 0) + 1
    return out


def spark_counts(spark, rows, start, end, step):
    df = spark.createDataFrame(rows, SCHEMA)
    res = reports.order_counts_by_date(df, start, end, step).collect()
    return {(r["run_date"].isoformat(), r["customer_id"]): r["order_count"] for r in res}


moment = st.one_of(
    st.none(),
    st.integers(-5 * 24, 40 * 24).map(lambda h: BASE + dt.timedelta(hours=h)),
)
order = st.tuples(
    st.sampled_from([1, 2, 3]),  # few customers: many overlaps per customer
    st.sampled_from(["Completed", "Completed", "Open"]),
    moment,
    moment,
)


@settings(max_examples=25, deadline=None)
@given(rows=st.lists(order, max_size=30), step=st.sampled_from([None, 1, 3, 7]), span=st.integers(0, 30))
def test_matches_brute_force(spark, rows, step, span):
    start = "2024-01-03"
    end = (dt.date(2024, 1, 3) + dt.timedelta(days=span)).isoformat()
    assert spark_counts(spark, rows, start, end, step) == brute_force(rows, start, end, step)


def test_hot_customer_and_edges(spark):
    # One customer with many identical and nested intervals; an order
    # touched exactly at midnight of a run date counts, one created at it
    # does not.
    rows = [(7, "Completed", BASE, BASE + dt.timedelta(days=10))] * 50
    rows += [(7, "Completed", BASE + dt.timedelta(days=2, hours=5), BASE + dt.timedelta(days=4))]
    rows += [(8, "Completed", BASE + dt.timedelta(days=3), BASE + dt.timedelta(days=6))]
    got = spark_counts(spark, rows, "2024-01-01", "2024-01-15", 1)
    assert got == brute_force(rows, "2024-01-01", "2024-01-15", 1)
    assert got[("2024-01-04", 7)] == 51 and ("2024-01-04", 8) not in got and got[("2024-01-05", 8)] == 1


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(order, max_size=40), k=st.sampled_from([1, 2, 3]))
def test_per_date_top_k_matches_brute_force(spark, rows, k):
    # Few customers and small counts: ties at the k-th count and dates with
    # fewer than k customers are common, so the thresholds are exercised.
    start, end, step = "2024-01-03", "2024-01-20", 2
    customers = spark.createDataFrame([(c, f"name{c}") for c in (1, 2, 3)], "id long, name string")
    got = reports.top_users_by_date(customers, spark.createDataFrame(rows, SCHEMA), start, end, step, k=k).collect()
    got = sorted((r["run_date"].isoformat(), r["rank"], r["id"]) for r in got)
    want = []
    by_date = {}
    for (d, cust), n in brute_force(rows, start, end, step).items():
        by_date.setdefault(d, []).append((-n, cust))
    for d, entries in by_date.items():
        for rank, (_, cust) in enumerate(sorted(entries)[:k], start=1):
            want.append((d, rank, cust))
    assert got == sorted(want)
