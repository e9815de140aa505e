"""As-of join: each left row with the latest right row of its key that is
not later.

Both sides become one sequence per key in the order of time, and the latest
right row is carried forward to the left rows behind it. No left row is ever
compared with more than the one right row it gets. The sequence is cut into
chunks (see ``ordered``), so a key with a third of all rows is many tasks,
each handed the last right row of the chunks before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordered import Running, chunked, running


def asof_join(
    spark: SparkSession,
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    times: tuple[str, str],
    take: dict[str, str],
    tie: list[str] = (),
    strict: bool = False,
    how: str = "left",
    partitions: int | None = None,
) -> DataFrame:
    """``left`` with columns of the right row of the same key whose time is
    the latest one not after the left row's (``strict``: before it).

    ``on``: (left, right) key columns; ``times``: the left and right time
    column; ``take``: {new column: right column}; ``tie``: right columns
    that decide between right rows of one time (the greatest stays, NULL
    being the least). Without a right row the new columns are NULL, or the
    left row goes (``how="inner"``). NULL keys and NULL times match nothing;
    such right rows are ignored, such left rows have no right row.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"an as-of join is 'left' or 'inner', not {how!r}")
    clash = {c.lower() for c in left.columns} & {c.lower() for c in take}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are already in the left table")
    keys = [f"_k{i}" for i in range(len(on))]
    # At equal times the right rows come first, unless only earlier ones count.
    of_left, of_right = (0, 1) if strict else (1, 0)
    ties = [f"_tie{i}" for i in range(len(tie))]
    kind = {f.name.lower(): f.dataType for f in right.schema.fields}
    found = F.struct(*[F.col(f"`{c}`").alias(n) for n, c in take.items()])
    complete = [F.col(f"`{c}`").isNotNull() for c in [r for _, r in on] + [times[1]]]
    sought = right.where(reduce(Column.__and__, complete)).select(
        *[F.col(f"`{r}`").alias(k) for k, (_, r) in zip(keys, on)],
        F.col(f"`{times[1]}`").alias("_t"),
        F.lit(of_right).alias("_side"),
        *[F.col(f"`{c}`").alias(t) for t, c in zip(ties, tie)],
        found.alias("_found"),
    )
    asking = left.select(
        *[F.col(f"`{a}`").alias(k) for k, (a, _) in zip(keys, on)],
        F.col(f"`{times[0]}`").alias("_t"),
        F.lit(of_left).alias("_side"),
        *[F.lit(None).cast(kind[c.lower()]).alias(t) for t, c in zip(ties, tie)],
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"),
    )
    both = asking.unionByName(sought, allowMissingColumns=True)
    c = chunked(spark, both, keys, ["_t", "_side", *ties], partitions)
    out = running(c, {"_last": Running("last", F.col("_found"))}).where("_row is not null")
    # A NULL time sorts first, so nothing is carried to it; a NULL key has no right rows.
    if how == "inner":
        out = out.where("_last is not null")
    return out.select("_row.*", *[F.col(f"_last.`{n}`").alias(n) for n in take])
