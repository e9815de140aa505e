"""As-of and interval joins, sessions, heavy hitters, quantiles, distinct
states and payloads on small tables, against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import distinct, payload
from quarry.operators.asof import asof_join
from quarry.operators.frequent import candidates, heavy_hitters
from quarry.operators.intervals import interval_join
from quarry.operators.ordered import CHUNK, chunked
from quarry.operators.quantiles import exact_quantiles
from quarry.operators.sessions import sessions, with_sessions

HOT = 7


def key(r):
    """A third of the rows on one key, some without a key."""
    x = r.random()
    return HOT if x < 0.34 else None if x < 0.4 else r.randrange(20)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("strict", [False, True])
def test_asof_equals_brute_force(spark, strict):
    r = random.Random(1)
    left = [(i, key(r), r.choice([None, *range(300)])) for i in range(600)]
    right = [(key(r), r.choice([None, *range(300)]), i, r.choice([None, i])) for i in range(400)]
    a = spark.createDataFrame(left, "id long, k long, t long")
    b = spark.createDataFrame(right, "k2 long, t2 long, x long, y long")
    got = asof_join(spark, a, b, [("k", "k2")], ("t", "t2"), {"x": "x", "y": "y"}, tie=["x"], strict=strict, partitions=9)
    want = []
    for i, k, t in left:
        fit = [(t2, x, y) for k2, t2, x, y in right if None not in (k, t, k2, t2) and k2 == k and (t2 < t if strict else t2 <= t)]
        _, x, y = max(fit, key=lambda f: f[:2]) if fit else (None, None, None)
        want.append((i, k, t, x, y))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    inner = asof_join(spark, a, b, [("k", "k2")], ("t", "t2"), {"x": "x"}, tie=["x"], strict=strict, how="inner")
    assert inner.count() == sum(w[3] is not None for w in want)
    # One sequence per key: no pair of rows is compared by a range.
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_asof_edges(spark):
    a = spark.createDataFrame([], "id long, k long, t long")
    b = spark.createDataFrame([(1, 1, 1)], "k long, t long, x long")
    assert asof_join(spark, a, b, [("k", "k")], ("t", "t"), {"x": "x"}).collect() == []
    assert [r.x for r in asof_join(spark, b.drop("x"), b.limit(0), [("k", "k")], ("t", "t"), {"x": "x"}).collect()] == [None]
    with pytest.raises(ValueError):
        asof_join(spark, a, b, [("k", "k")], ("t", "t"), {"ID": "x"})


@pytest.mark.parametrize("closed", [False, True])
def test_interval_join_equals_brute_force(spark, closed):
    r = random.Random(2)

    def some(n):
        # Lengths from none to very long, and negative, empty and NULL ones.
        out = []
        for i in range(n):
            lo = r.choice([None, *range(-500, 500)]) if r.random() < 0.1 else r.randrange(-500, 500)
            length = r.choice([-1, 0, 1, 3, 10, 60, 400, 10**9])
            out.append((i, lo, None if lo is None or r.random() < 0.05 else lo + length))
        return out

    left, right = some(150), some(200)
    a, b = spark.createDataFrame(left, "id long, lo long, hi long"), spark.createDataFrame(right, "id long, lo long, hi long")
    joined = interval_join(a, b, ("lo", "hi"), ("lo", "hi"), closed)
    got = sorted((x.left.id, x.right.id) for x in joined.collect())
    last = 0 if closed else 1
    ok = lambda s: None not in s and s[1] <= s[2] - last
    want = sorted((s[0], t[0]) for s in left for t in right if ok(s) and ok(t) and s[1] <= t[2] - last and t[1] <= s[2] - last)
    assert got == want
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


def test_long_intervals_are_listed_twice_a_level(spark):
    from quarry.operators import intervals

    side = intervals._levelled(spark.createDataFrame([(0, 10**15), (5, 6), (7, 10**6)], "lo long, hi long"), ("lo", "hi"), False)
    levels = intervals._levels(side)
    rows = intervals._listed(side, levels, "l")
    assert rows.groupBy("at", "l_lo", "l_hi").count().agg(F.max("count")).first()[0] <= 2


def test_interval_join_of_dates_and_of_nothing(spark):
    d = spark.sql("SELECT DATE'2024-01-01' AS lo, DATE'2024-01-03' AS hi")
    t = spark.sql("SELECT TIMESTAMP'2024-01-02 23:00:00' AS a, TIMESTAMP'2024-01-05 00:00:00' AS b")
    assert interval_join(d, t, ("lo", "hi"), ("a", "b")).count() == 1
    assert interval_join(d, t.where("a > b"), ("lo", "hi"), ("a", "b")).count() == 0
    with pytest.raises(ValueError):
        interval_join(d.select(F.lit("x").alias("lo"), "hi"), t, ("lo", "hi"), ("a", "b"))


def test_sessions_equal_brute_force(spark):
    r = random.Random(3)
    rows = [(i, key(r), None if r.random() < 0.02 else r.randrange(4000)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, k long, s long").withColumn("t", F.timestamp_seconds("s")).drop("s")
    got = sessions(spark, df, ["k"], "t", "30 seconds", {"n": F.count(F.lit(1))}, tie=["id"], partitions=9)
    want = []
    for k in {k for _, k, _ in rows}:
        times = sorted(s for _, k2, s in rows if k2 == k and s is not None)
        parts = []
        for s in times:
            if parts and s - parts[-1][-1] <= 30:
                parts[-1].append(s)
            else:
                parts.append([s])
        want += [(k, i + 1, p[0], p[-1], len(p)) for i, p in enumerate(parts)]
    found = got.select("k", "session", F.unix_seconds("started"), F.unix_seconds("ended"), "n").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    all_rows = with_sessions(spark, df, ["k"], "t", "30 seconds", ["id"])
    assert all_rows.count() == len(rows) and all_rows.where("(t is null) <> (session is null)").count() == 0


def test_one_session_over_many_chunks(spark):
    # All rows in one session of one key: every border between chunks merges.
    df = spark.range(5000).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("t"), "id")
    assert chunked(spark, df, ["k"], ["t"], 8).rows.select(CHUNK).distinct().count() == 8
    got = sessions(spark, df, ["k"], "t", "1 second", {"n": F.count(F.lit(1))}, partitions=8).collect()
    assert [(r.session, r.n) for r in got] == [(1, 5000)]


def test_heavy_hitters_equal_counting(spark):
    r = random.Random(4)
    # 5,000 values and 200 counters; NULL and NaN are values.
    rows = [(r.choice([None, "a", "b", f"v{r.randrange(5000)}", f"v{r.randrange(5000)}"]), r.choice([math.nan, None, 1.0, r.random()])) for _ in range(8000)]
    df = spark.createDataFrame(rows, "s string, d double").repartition(7)
    assert len(candidates(df, ["s"], 0.01)["s"]) <= 200
    got = sorted(map(tuple, heavy_hitters(df, ["s", "d"], 0.01).collect()), key=repr)
    s, d = Counter(x for x, _ in rows), Counter("NaN" if y is not None and y != y else None if y is None else str(y) for _, y in rows)
    want = [("s", v, n) for v, n in s.items() if n >= 80] + [("d", v, n) for v, n in d.items() if n >= 80]
    assert got == sorted(want, key=repr)


def test_heavy_hitters_at_the_share_exactly(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(i,) for i in range(100, 190)], "x int")
    assert [tuple(r) for r in heavy_hitters(df, ["x"], 0.1).collect()] == [("x", "1", 10)]
    assert heavy_hitters(df.limit(0), ["x"], 0.1).collect() == []


@pytest.mark.parametrize("groups", [3, 2500])
def test_quantiles_equal_sorting(spark, groups):
    r = random.Random(5)
    rows = []
    for i in range(9000):
        k = 1 if r.random() < 0.34 else None if r.random() < 0.05 else r.randrange(groups)
        # Heavy tails, ties, a constant stretch, NULL and NaN.
        v = r.choice([None, math.nan, 5.0, r.lognormvariate(0, 6), -r.random(), float(r.randrange(10))])
        rows.append((k, v))
    rows += [(10**6, None)]
    qs = [0.0, 0.001, 0.1, 0.5, 0.9, 1.0]
    got = exact_quantiles(spark, spark.createDataFrame(rows, "k long, v double").repartition(6), ["k"], "v", qs, accuracy=100)
    want = []
    for k in {k for k, _ in rows}:
        vs = sorted((v for k2, v in rows if k2 == k and v is not None), key=lambda v: (v != v, v))
        for q in qs:
            at = max(1, math.ceil(round(q * len(vs), 9))) - 1
            want.append((k, q, repr(vs[at]) if vs else "None"))
    assert sorted(((x.k, x.q, repr(x.value)) for x in got.collect()), key=repr) == sorted(want, key=repr)


def test_distinct_states(spark):
    df = spark.range(40_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("d"), (F.xxhash64("id") % 9000).alias("u"))
    df = df.union(spark.sql("SELECT DATE'2024-01-03', CAST(NULL AS BIGINT)"))
    ranges = spark.sql("SELECT id AS range, DATE'2024-01-01' AS from_date, date_add(DATE'2024-01-01', CAST(id AS INT)) AS to_date FROM range(20)")
    ranges = ranges.union(spark.sql("SELECT 99, DATE'2024-02-01', DATE'2024-01-01'"))
    want = {i: df.where(F.col("d") <= F.date_add(F.lit("2024-01-01").cast("date"), i)).select("u").na.drop().distinct().count() for i in (0, 7, 19)}
    exact = {r.range: r.n for r in distinct.distinct_in_ranges(distinct.bitmap_states(df, "d", "u"), ranges).collect()}
    nearly = {r.range: r.n for r in distinct.distinct_in_ranges_nearly(distinct.sketch_states(df, "d", "u"), ranges).collect()}
    assert set(exact) == set(range(20))
    for i, n in want.items():
        assert exact[i] == n
        assert abs(nearly[i] - n) <= 4 * distinct.relative_error() * n


def test_payloads(spark):
    rows = [(1, '{"a": 1, "b": {"c": [10, 20]}}'), (2, '{"a": 2.5, "z y": "t"}'), (3, "no json"), (4, None), (5, "[1]")]
    df = spark.createDataFrame(rows, "id long, props string")
    got = payload.extract(df, "props", {"a": ("$.a", "double"), "c": ("$.b.c[1]", "int"), "z": ("$['z y']", "string")}).drop("props")
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 1.0, 20, None), (2, 2.5, None, "t"), (3, None, None, None), (4, None, None, None), (5, None, None, None)]
    flat = payload.flattened(df.where("id < 3"), "props")
    assert flat.columns == ["id", "props", "a", "b", "z y"]
    assert [float(r.a) for r in flat.orderBy("id").collect()] == [1.0, 2.5]
    assert payload.flattened(df.where("id = 4"), "props").columns == ["id", "props"]
    with pytest.raises(ValueError):
        payload.extract(df, "props", {"a": ("a; drop", "int")})
    with pytest.raises(ValueError):
        payload.flattened(df.where("id < 3").withColumn("A", F.lit(1)), "props")
