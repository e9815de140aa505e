"""Exact heavy hitters: values that hold at least a share of all rows.

Spark's ``freqItems`` keeps 1/share counters per column and misses no value
above the share, but also gives values below it and no counts. Its result is
taken as the candidates only (at most 1/share per column, a size known before
the data is read), and a second pass counts them exactly. No value outside
the candidates is ever shuffled.
"""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CANDIDATES = 100_000


def candidates(df: DataFrame, columns: list[str], share: float) -> dict[str, list]:
    """Per column the values that may hold more than ``share`` of the rows;
    none that does is missing."""
    if not 1 / MAX_CANDIDATES <= share <= 1:
        raise ValueError(f"a share lies between {1 / MAX_CANDIDATES} and 1, got {share}")
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    # Counters for half the share: at it exactly, a value might lose its counter.
    row = plain.stat.freqItems([f"c{i}" for i in range(len(columns))], max(share / 2, 1e-6)).first()
    return {c: list(row[f"c{i}_freqItems"] or []) for i, c in enumerate(columns)}


def _is_one_of(column: Column, kind: T.DataType, values: list) -> Column:
    plain = [v for v in values if v is not None and v == v]
    tests = [column.isin(plain)] if plain else []
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        tests.append(F.isnan(column))
    return reduce(Column.__or__, [*tests, column.isNull()])


def candidate_counts(df: DataFrame, columns: list[str], share: float) -> tuple[DataFrame, int]:
    """(column, value as a string, n) of all candidates, counted exactly, and
    the number of rows that makes a share."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    found = candidates(df, columns, share)
    least = max(1, math.ceil(Decimal(repr(share)) * df.count()))
    # A row gives an entry per column whose value is a candidate.
    entries = []
    for c in columns:
        entry = F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        entries.append(F.when(_is_one_of(F.col(f"`{c}`"), kinds[c.lower()], found[c]), entry))
    counted = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e.column", "e.value").agg(F.count(F.lit(1)).alias("n"))
    return counted, least


def heavy_hitters(df: DataFrame, columns: list[str], share: float) -> DataFrame:
    """(column, value as a string, n) for every value of ``columns`` in at
    least ``share`` of the rows, counted exactly. NULL is a value like any
    other. An empty table has none. ``df`` is read three times: for the
    candidates, the number of rows and the counts."""
    counted, least = candidate_counts(df, columns, share)
    return counted.where(F.col("n") >= least)
