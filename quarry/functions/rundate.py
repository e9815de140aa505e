"""Run dates: default date, backfill ranges and date spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "%Y-%m-%d"


def default_run_date(today: dt.date | None = None) -> str:
    """Yesterday, as ``YYYY-MM-DD`` (the run date of a default run)."""
    today = today or dt.date.today()
    return (today - dt.timedelta(days=1)).strftime(DATE_FORMAT)


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(str(value), DATE_FORMAT).date()


def _check_step(step) -> int:
    step = int(step or 1)  # 0 or missing means one day
    if step < 0:
        raise ValueError(f"backfill step must not be negative, got {step}")
    return step


def date_range(start, end, step=None) -> list[str]:
    """Dates from ``start`` to ``end`` inclusive, ``step`` days apart."""
    first, step = _as_date(start), _check_step(step)
    steps = (_as_date(end) - first).days // step
    return [(first + dt.timedelta(days=i * step)).strftime(DATE_FORMAT) for i in range(steps + 1)]


def int_range(start: int, end: int) -> list[int]:
    """Integers from ``start`` to ``end`` inclusive (an integer backfill)."""
    return list(range(int(start), int(end) + 1))


def date_spine(spark: SparkSession, start, end, step=None, name: str = "run_date") -> DataFrame:
    """The backfill dates as a one-column DataFrame of DATE, built by Spark.

    Its size is (end - start) / step rows, known before it is built, which
    is what lets callers broadcast it.
    """
    step = _check_step(step)
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(_as_date(start)),
                F.lit(_as_date(end)),
                F.expr(f"INTERVAL {step} DAYS"),
            )
        ).alias(name)
    )


def int_spine(spark: SparkSession, start: int, end: int, name: str = "run_key") -> DataFrame:
    """The integer backfill keys as a DataFrame."""
    return spark.range(int(start), int(end) + 1).select(F.col("id").alias(name))


def run_date_literal(run_date, data_type: T.DataType | None = None) -> Column:
    """The run date as a literal of the column type it is compared with.

    A ``YYYY-MM-DD`` string becomes midnight of that day for timestamp
    columns (with or without time zone), a DATE for date columns.
    """
    lit = F.lit(str(run_date))
    if data_type is None or isinstance(data_type, T.StringType):
        return lit
    return lit.cast(data_type)
