"""Interval-overlap join without an equal key.

Written as an inequality alone, Spark would compare every row of one side
with every row of the other. Here time is cut into bins, an interval is
listed under the bins it touches, and sides meet by an equality on the bin.

The width of a bin follows the interval: an interval of length L goes to the
level whose bins are at least L wide, so it touches two of them at most,
however long it is. Two intervals meet at the coarser of their two levels:
each side also lists its intervals under the bins of the coarser levels that
the other side has. A row is listed at most twice per level that exists. A
pair that shares two bins is kept in the first of them only, so nothing is
found twice and nothing has to be made distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = 2  # levels are this many bits apart: bins get four times as wide


def _number(df: DataFrame, column: str) -> Column:
    """A bound as a long."""
    kind = {f.name.lower(): f.dataType for f in df.schema.fields}[column.lower()]
    c = F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), "UTC"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("long")
    raise ValueError(f"{column} is {kind.simpleString()}: bounds are dates, timestamps or integers")


def _levelled(df: DataFrame, bounds: tuple[str, str], closed: bool) -> DataFrame:
    """The rows as one struct, with their bounds and level. Intervals with a
    NULL bound and empty ones overlap nothing and go."""
    lo, hi = _number(df, bounds[0]), _number(df, bounds[1])
    hi = hi if closed else hi - 1  # the last moment inside
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    bits = F.when(F.col("hi") > F.col("lo"), F.length(F.bin(F.col("hi") - F.col("lo")))).otherwise(F.lit(0))
    return out.withColumn("level", (F.ceil(bits / STEP) * STEP).cast("int"))


def _levels(*sides: DataFrame) -> list[int]:
    """The levels that exist: 32 at most, whatever the data."""
    found = sides[0].select("level")
    for s in sides[1:]:
        found = found.union(s.select("level"))
    return sorted(r.level for r in found.distinct().collect())


def _listed(side: DataFrame, levels: list[int], name: str) -> DataFrame:
    """A row per bin that an interval touches at its own level and at each
    coarser one."""
    above = F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: x >= F.col("level"))
    at = side.select("*", F.explode(above).alias("at"))
    bin_ = lambda c: F.expr(f"shiftright({c}, at)")
    at = at.select("*", F.explode(F.array_distinct(F.array(bin_("lo"), bin_("hi")))).alias("bin"))
    return at.select("at", "bin", *[F.col(c).alias(f"{name}_{c}") for c in ("row", "lo", "hi", "level")])


def interval_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], closed: bool = False) -> DataFrame:
    """(left: struct, right: struct) for every pair of rows whose intervals
    share a moment. Intervals are half-open, [from, to), or ``closed``.
    Bounds are dates, timestamps (a date is its midnight, UTC) or integers.
    An interval with a NULL bound, or one that holds no moment, overlaps
    nothing. Repeated rows each make their pairs."""
    a, b = _levelled(left, left_bounds, closed), _levelled(right, right_bounds, closed)
    levels = _levels(a, b)
    if not levels:
        levels = [0]
    met = _listed(a, levels, "l").join(_listed(b, levels, "r"), ["at", "bin"])
    meets = (F.col("l_lo") <= F.col("r_hi")) & (F.col("r_lo") <= F.col("l_hi"))
    # They meet at the coarser level, in the first bin they share.
    once = (F.col("at") == F.greatest("l_level", "r_level")) & (F.col("bin") == F.expr("shiftright(greatest(l_lo, r_lo), at)"))
    return met.where(meets & once).select(F.col("l_row").alias("left"), F.col("r_row").alias("right"))
