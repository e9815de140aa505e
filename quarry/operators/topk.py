"""Top-k and bottom-k, overall and per group.

Ties at rank k are broken on the tie columns, so results are
deterministic. Overall top-k plans as ``TakeOrderedAndProject``: each
partition keeps k rows and one task merges k x partitions rows. Per-group
top-k uses ``row_number() <= k``, which Catalyst plans with a partial
``WindowGroupLimit`` before the shuffle, so at most k rows per group and
map partition travel and no task holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(by: str, ascending: bool, tie_break: list[str]) -> list[Column]:
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return [first] + [F.col(c).asc_nulls_last() for c in tie_break]


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, tie_break: list[str] | None = None) -> DataFrame:
    return df.orderBy(*_order(by, ascending, tie_break or [])).limit(k)


def top_k_per_group(
    df: DataFrame,
    group: list[str],
    by: str,
    k: int,
    ascending: bool = False,
    tie_break: list[str] | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*_order(by, ascending, tie_break or []))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
