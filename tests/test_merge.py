"""Keyed upsert semantics (FIXTURES.md section 5), both join strategies."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.merge import DuplicateSourceKeyError, merge_changes, plan_merge

SCHEMA = "k int, v string"


def merged(spark, target, source, tracked=("v",), null_safe=False, schema=SCHEMA, broadcast=None):
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame(source, schema)
    if broadcast is None:
        out = plan_merge(t, s, ["k"], list(tracked), null_safe)
    else:
        out = merge_changes(t, s, ["k"], list(tracked), null_safe, broadcast_source=broadcast)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("broadcast", [None, True, False])
@pytest.mark.parametrize(
    "target,source,default,null_safe",
    [
        ([(1, "a")], [(1, "b")], [(1, "b")], [(1, "b")]),                       # update
        ([(1, "a")], [(1, "a")], [(1, "a")], [(1, "a")]),                       # no change
        ([(1, "a")], [(1, None)], [(1, "a")], [(1, None)]),                     # to NULL
        ([(1, None)], [(1, "b")], [(1, None)], [(1, "b")]),                     # from NULL
        ([], [(2, "x")], [(2, "x")], [(2, "x")]),                               # insert
        ([(None, "a")], [(None, "b")], [(None, "a"), (None, "b")], [(None, "a"), (None, "b")]),  # NULL key
        ([(1, "a"), (1, "a")], [(1, "b")], [(1, "b"), (1, "b")], [(1, "b"), (1, "b")]),  # duplicate target
        ([], [(3, "b"), (3, "c")], [(3, "b"), (3, "c")], [(3, "b"), (3, "c")]),  # duplicate source, unmatched
        ([(1, "a")], [], [(1, "a")], [(1, "a")]),                               # empty source
    ],
)
def test_cases(spark, broadcast, target, source, default, null_safe):
    assert merged(spark, target, source, broadcast=broadcast) == sorted(default, key=repr)
    assert merged(spark, target, source, null_safe=True, broadcast=broadcast) == sorted(null_safe, key=repr)


@pytest.mark.parametrize("source", [[(1, "b"), (1, "c")], [(1, "a"), (1, "b")]])
def test_duplicate_source_rows_matching_a_target_row_fail(spark, source):
    with pytest.raises(DuplicateSourceKeyError):
        merged(spark, [(1, "a")], source)


def test_untracked_column_keeps_target_value(spark):
    schema = "k int, v string, n int"
    assert merged(spark, [(1, "a", 10)], [(1, "b", 20)], schema=schema) == [(1, "b", 10)]


def test_two_tracked_columns(spark):
    schema = "k int, v string, w string"
    assert merged(spark, [(1, "a", "p")], [(1, "a", "q")], ("v", "w"), schema=schema) == [(1, "a", "q")]
    # a NULL on one tracked column does not block the other from triggering
    assert merged(spark, [(1, "a", None)], [(1, "b", "q")], ("v", "w"), schema=schema) == [(1, "b", "q")]


def test_source_may_lack_target_columns(spark):
    t = spark.createDataFrame([(1, "a", 5)], "k int, v string, n int")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    out = sorted(tuple(r) for r in plan_merge(t, s, ["k"], ["v"]).collect())
    assert out == [(1, "b", 5), (2, "c", None)]


def test_source_columns_unknown_to_target_fail(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "a", 1)], "k int, v string, z int")
    with pytest.raises(ValueError):
        merge_changes(t, s, ["k"], ["v"])


rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c"])), max_size=8)


@settings(max_examples=15, deadline=None)
@given(target=rows, source=rows)
def test_applying_the_same_source_twice_equals_once(spark, target, source):
    source = list({k: (k, v) for k, v in source}.values())  # unique source keys
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    once = plan_merge(t, s, ["k"], ["v"])
    twice = plan_merge(once, s, ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("broadcast_bytes", [64 * 1024 * 1024, 1])  # broadcast dups / de-duplicated target keys
def test_duplicate_check_both_strategies(spark, broadcast_bytes):
    from quarry.operators.merge import check_duplicate_matches, profile_source

    hot_target = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], SCHEMA)
    clash = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], SCHEMA)
    apart = spark.createDataFrame([(3, "x"), (3, "y"), (1, "z")], SCHEMA)
    prof = profile_source(clash, ["k"])
    assert (prof.rows, prof.max_rows_per_key, prof.dup_keys) == (3, 2, 1)
    with pytest.raises(DuplicateSourceKeyError):
        check_duplicate_matches(hot_target, clash, ["k"], prof.dup_keys, broadcast_bytes)
    check_duplicate_matches(hot_target, apart, ["k"], 1, broadcast_bytes)  # repeated key 3 matches nothing


def test_hot_target_key_is_split(spark):
    """A third of the target on one key: its rows are dealt over salts, and
    the result is that of the plain joins. Also a source key that shares no
    row with the target, NULL keys and a hot key the source lacks."""
    target = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(8)).when(F.col("id") % 40 == 2, None).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("v"),
        F.col("id").alias("w"),
    ).repartition(6)
    source = spark.createDataFrame([(7, 100), (9, 101), (50000, 1), (None, 5), (None, 5)], "k long, v long").union(spark.range(60000, 63000).select("id", "id"))
    from quarry.operators import merge

    hot = merge.hot_keys(target, ["k"], 8)
    assert [tuple(r) for r in hot.collect()] == [(7, 3)]
    for safe in (False, True):
        plain = merge.merge_changes(target, source, ["k"], ["v"], safe)
        split = merge.merge_changes(target, source, ["k"], ["v"], safe, unique_source=True, hot_parts=40)
        assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    t, _ = merge._salted(target, source, ["k"], merge.hot_keys(target, ["k"], 40))
    assert t.where("k is not null").groupBy("k", "__salt").count().agg(F.max("count")).first()[0] <= 200
    assert merge.hot_keys(target.where("k > 100"), ["k"], 100) is None
