"""Size checks that gate every data-dependent broadcast.

A side is broadcast only when its estimated size is known to be under a
byte limit. The estimate is rows x a per-row width taken from the schema;
strings and nested values are taken wide on purpose, so the check errs
towards not broadcasting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WIDTH = {T.StringType: 64, T.BinaryType: 64, T.DecimalType: 16}
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def row_width(schema: T.StructType) -> int:
    """Bytes assumed per row of ``schema``."""
    width = 0
    for field in schema.fields:
        dtype = type(field.dataType)
        if dtype in _WIDTH:
            width += _WIDTH[dtype]
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width += 256
        else:
            width += 8
    return width


def plan_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size (file sizes, for a scan)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES, max_rows: int | None = None) -> bool:
    """Whether ``df`` is under ``max_bytes`` (and ``max_rows``, if given).

    One count, combined in each task, so no task holds the rows.
    """
    bound = max_bytes // max(row_width(df.schema), 1)
    if max_rows is not None:
        bound = min(bound, int(max_rows))
    return df.count() <= bound
