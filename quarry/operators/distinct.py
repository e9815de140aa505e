"""Distinct counts over any range of dates from states stored once per date.

``count(DISTINCT)`` cannot be added up over dates, so a backfill would read
all days of a range again. Here a day is reduced once to a state that can be
merged:

* integers, exactly: bitmaps of 32,768 bits by bucket, merged by OR;
* any type, nearly: a HyperLogLog sketch, merged by union. Its relative
  standard error is 1.04 / sqrt(2**LG), about 1.6 % for the 12 here.

Both are Spark aggregates that combine before the shuffle; a range is an
aggregation over the states of its dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 12  # log2 of a sketch's registers


def bitmap_states(df: DataFrame, date: str, value: str) -> DataFrame:
    """(date, bucket, bits): the distinct integers of each date. NULLs do
    not count, as in ``count(DISTINCT)``."""
    v = F.col(f"`{value}`").cast("long")
    rows = df.where(v.isNotNull()).select(F.col(f"`{date}`").alias("date"), F.bitmap_bucket_number(v).alias("bucket"), F.bitmap_bit_position(v).alias("bit"))
    return rows.groupBy("date", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def sketch_states(df: DataFrame, date: str, value: str, lg: int = LG) -> DataFrame:
    """(date, sketch): a sketch of each date's values."""
    return df.where(F.col(f"`{value}`").isNotNull()).groupBy(F.col(f"`{date}`").alias("date")).agg(F.hll_sketch_agg(F.col(f"`{value}`"), F.lit(lg)).alias("sketch"))


def _of_ranges(states: DataFrame, ranges: DataFrame) -> DataFrame:
    """The states by range: a range lists its dates, so the join is an
    equality on the date. ``ranges`` is (range, from_date, to_date), both
    dates included; one that ends before it starts has no dates."""
    days = ranges.where("from_date <= to_date").select("range", F.explode(F.sequence("from_date", "to_date")).alias("date"))
    return days.join(states, "date")


def distinct_in_ranges(states: DataFrame, ranges: DataFrame) -> DataFrame:
    """(range, n): exact distinct counts from ``bitmap_states``. A range
    without values is not there."""
    merged = _of_ranges(states, ranges).groupBy("range", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("range").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def distinct_in_ranges_nearly(states: DataFrame, ranges: DataFrame) -> DataFrame:
    """(range, n): estimates from ``sketch_states``."""
    return _of_ranges(states, ranges).groupBy("range").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def relative_error(lg: int = LG) -> float:
    """A sketch's relative standard error."""
    return 1.04 / (1 << lg) ** 0.5


def trailing(dates: Column, days: int) -> tuple[Column, Column]:
    """The first and last date of the ``days`` that end at a date."""
    return F.date_sub(dates, days - 1), dates
