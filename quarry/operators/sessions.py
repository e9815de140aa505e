"""Sessions: runs of a key's rows with no gap longer than a limit.

Gaps and islands in two running values: the time of the row before tells
whether a session starts, and a running sum of the starts numbers it. Both
run over chunks (see ``ordered``), so the borders of a session that goes
over a chunk's end are merged by the offsets, and a key with a third of all
rows, or a single session of that size, is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordered import CHUNK, Chunked, Running, chunked, running


def with_sessions(
    spark: SparkSession, df: DataFrame, keys: list[str], time: str, gap: str, tie: list[str] = (), name: str = "session", partitions: int | None = None
) -> DataFrame:
    """``df`` with the number of each row's session within its key, from 1.

    A row starts a session if it is the key's first or more than ``gap`` (an
    interval such as ``"30 minutes"``) after the one before. Rows without a
    time belong to no session (NULL). NULL keys are one key. ``tie`` orders
    rows of one time; the sessions do not depend on it.
    """
    c = chunked(spark, df.where(F.col(f"`{time}`").isNotNull()), keys, [time, *tie], partitions)
    late = F.col(f"`{time}`") > F.col("_before") + F.expr(f"INTERVAL {gap}")
    starts = F.when(F.col("_before").isNull() | late, F.lit(1)).otherwise(F.lit(0))
    marked = running(c, {"_before": Running("last", F.col(f"`{time}`"), before=True)}).withColumn("_starts", starts)
    numbered = running(Chunked(marked, c.keys, c.order), {name: Running("sum", F.col("_starts"))})
    out = numbered.drop("_before", "_starts", CHUNK)
    timeless = df.where(F.col(f"`{time}`").isNull())
    return out.unionByName(timeless.withColumn(name, F.lit(None).cast("long")))


def sessions(
    spark: SparkSession, df: DataFrame, keys: list[str], time: str, gap: str, measures: dict[str, Column], tie: list[str] = (), partitions: int | None = None
) -> DataFrame:
    """One row per session: the keys, session, started, ended and the
    ``measures`` (aggregates over its rows, combined before the shuffle)."""
    rows = with_sessions(spark, df, keys, time, gap, tie, "session", partitions).where("session is not null")
    aggregates = {"started": F.min(f"`{time}`"), "ended": F.max(f"`{time}`"), **measures}
    return rows.groupBy(*[F.col(f"`{k}`") for k in keys], "session").agg(*[a.alias(n) for n, a in aggregates.items()])
