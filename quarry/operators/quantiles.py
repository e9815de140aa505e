"""Exact quantiles per group, without sorting the values.

1. One pass over the data keeps a quantile sketch of bounded size per group
   (``approx_percentile``, merged across tasks) and gives, for every quantile,
   a lower and an upper value between which it surely lies.
2. A second pass counts the rows below each lower value and the rows per
   value inside the brackets; about 4 / ACCURACY of the rows have one. The
   counts are combined before the shuffle.
3. A running count over the values of a bracket, chunked (see ``ordered``),
   finds the value that holds the rank.

No group's values meet in one task, and no value comes to the driver.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ordered import Running, chunked, running
from quarry.session import materialize

BIG = 1000  # groups whose brackets may be broadcast
ACCURACY = 10_000  # a sketch is off by at most 1 / ACCURACY of a group's rows


def exact_quantiles(spark: SparkSession, df: DataFrame, keys: list[str], column: str, quantiles: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """(keys, q, value): for each group and each of ``quantiles`` (at most
    ten decimals) the smallest value with at least that share of the group's
    values at or below it (the discrete quantile). NULL values do not count;
    a group of nothing else has NULL. NaN is greater than any other value.
    NULL keys are one group."""
    if not keys or any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError(f"quantiles between 0 and 1 of groups by at least one key, got {quantiles} by {keys}")
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{column}`").alias("v"))
    off = 2 / accuracy  # twice the bound, on either side
    at = [x for q in quantiles for x in (max(0.0, q - off), min(1.0, q + off))]
    real = isinstance(rows.schema["v"].dataType, (T.DoubleType, T.FloatType))
    # The sketch orders NaN nowhere: it takes it for infinity, and a bracket
    # that ends there goes on to NaN, the greatest value.
    seen = F.nanvl("v", F.lit(math.inf).cast(rows.schema["v"].dataType)) if real else F.col("v")
    sketch = rows.groupBy(*names).agg(F.count("v").alias("n"), F.percentile_approx(seen, at, accuracy).alias("s"), F.min("v").alias("least"), F.max("v").alias("most"))
    sketch = materialize(spark, sketch, "quantile-sketches")
    up = lambda c: F.when(c == math.inf, F.lit(math.nan)).otherwise(c) if real else c
    wanted = []
    for i, q in enumerate(quantiles):
        share = F.lit(Decimal(repr(float(q)))).cast("decimal(12,10)") * F.col("n").cast("decimal(19,0)")
        wanted.append(
            F.struct(
                F.lit(i).alias("i"),
                F.lit(float(q)).alias("q"),
                F.greatest(F.lit(1), F.ceil(share)).cast("long").alias("rank"),
                # Near its ends a group's least and greatest values are the bracket.
                (F.col("least") if q <= off else F.get("s", F.lit(2 * i))).alias("lo"),
                (F.col("most") if q >= 1 - off else up(F.get("s", F.lit(2 * i + 1)))).alias("hi"),
            )
        )
    brackets = sketch.select(*names, "n", F.array(*wanted).alias("bs"))
    size = sketch.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).first()
    rows = rows.where("v is not null")
    # At most BIG groups hold a BIG-th of the rows each: their brackets are
    # broadcast, so the rows of a hot group are not brought together.
    big = F.col("n") * BIG >= int(size.rows or 0)
    if size.groups <= BIG:
        met = _met(rows, F.broadcast(brackets), names)
    else:
        met = _met(rows, F.broadcast(brackets.where(big)), names).union(_met(rows, brackets.where(~big), names))
    counted = met.groupBy(*names, F.col("p.i").alias("i"), F.col("p.at").alias("at")).agg(F.count(F.lit(1)).alias("c"))
    # NULL, which stands for all values below the bracket, sorts first.
    upto = running(chunked(spark, counted, [*names, "i"], ["at"]), {"upto": Running("sum", F.col("c"))})
    ranks = brackets.select(*names, F.explode("bs").alias("b")).select(*names, "b.i", "b.q", "b.rank")
    joined = ranks.alias("a").join(upto.alias("b"), [*_same(names), F.col("a.i") == F.col("b.i")], "left")
    # One row, whose count goes over the rank, or the one of a group without values.
    hit = F.col("upto").isNull() | ((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
    return joined.where(hit).select(*[F.col(f"a.{n}").alias(k) for n, k in zip(names, keys)], "a.q", F.col("b.at").alias("value"))


def _same(names: list[str]) -> list[Column]:
    return [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]


def _met(rows: DataFrame, brackets: DataFrame, names: list[str]) -> DataFrame:
    """For every row an entry per bracket it is not above: the bracket's
    number and the value, or NULL in place of a value below it, of which
    only the number counts."""
    here = lambda b: F.struct(b.i.alias("i"), F.when(F.col("a.v") >= b.lo, F.col("a.v")).alias("at"), (F.col("a.v") <= b.hi).alias("ok"))
    joined = rows.alias("a").join(brackets.alias("b"), _same(names))
    return joined.select(*[F.col(f"a.{n}").alias(n) for n in names], F.explode(F.filter(F.transform("b.bs", here), lambda x: x.ok)).alias("p"))
