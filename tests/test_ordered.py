"""Running values over chunks against the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.ordered import CHUNK, Running, chunked, running

KINDS = ["sum", "count", "min", "max", "bit_xor", "last"]


def plain(df, keys, order, kind, before):
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    w = w.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    return F.last("v", ignorenulls=True).over(w) if kind == "last" else getattr(F, kind)("v").over(w)


@pytest.mark.parametrize("keys", [["k"], ["k", "k2"], []])
def test_equals_the_plain_window(spark, keys):
    # A third of the rows on one key, NULL keys, NULL values, equal orders.
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 31 == 0, None).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 2 == 0, "a").alias("k2"),
        F.when(F.col("id") % 97 == 0, None).otherwise((F.col("id") * 7919) % 1000).alias("o"),
        F.col("id").alias("id"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.xxhash64("id") % 1000).alias("v"),
    )
    c = chunked(spark, df, keys, ["o", "id"], 9)
    assert c.rows.select(CHUNK).distinct().count() >= 8
    got = running(c, {f"{k}_{b}": Running(k, F.col("v"), b) for k in KINDS for b in (False, True)}).drop(CHUNK)
    want = df.select("*", *[plain(df, keys, ["o", "id"], k, b).alias(f"{k}_{b}") for k in KINDS for b in (False, True)])
    # A count over no rows is 0 in the plain window and may be so here.
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_no_task_holds_a_hot_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    c = chunked(spark, df, ["k"], ["o"], 10)
    assert c.cut_keys().count() <= 9
    assert c.rows.groupBy("k", CHUNK).count().agg(F.max("count")).first()[0] < 3500


def test_empty(spark):
    df = spark.createDataFrame([], "k long, o long, v long")
    assert running(chunked(spark, df, ["k"], ["o"], 4), {"s": Running("sum", F.col("v"))}).columns == ["k", "o", "v", CHUNK, "s"]
    assert running(chunked(spark, df, ["k"], ["o"], 4), {"s": Running("sum", F.col("v"))}).count() == 0
