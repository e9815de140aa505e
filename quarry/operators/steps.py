"""Declarative transform steps (the ``ConfigTransformer`` of a job).

A job gives, per table, an ordered list of ``{"op": name, "args": {...}}``.
``apply_steps`` returns a new dict of DataFrames and never mutates the
config. Steps:

* ``sql``: register the table as ``view_name`` and replace it with the
  result of ``query``. Views of earlier steps stay visible, so joins, set
  operations, windows, rollups across tables all go through here.
* ``drop``: ``cols``.
* ``select``, ``sort``, ``aggregate``, ``join``, ``union``: table steps
  for what DataFrame methods take as varargs or a second DataFrame.
* any DataFrame method in ``DATAFRAME_METHODS`` called with keyword
  arguments, e.g. ``filter``, ``withColumn``, ``dropDuplicates``,
  ``fillna``, ``unpivot``, ``crosstab``.

Arguments that are ``F.`` strings or ``{"expr": ...}`` become Columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.expressions import as_column, bind_run_date, config_value
from quarry.operators.sizing import DEFAULT_BROADCAST_BYTES, fits_broadcast
from quarry.session import scratch_root

# DataFrame methods a step may call by name with keyword arguments.
DATAFRAME_METHODS = frozenset(
    {
        "filter", "where", "withColumn", "withColumnRenamed", "withColumnsRenamed",
        "dropDuplicates", "drop_duplicates", "dropDuplicatesWithinWatermark", "distinct",
        "dropna", "fillna", "replace", "limit", "offset", "sample", "sampleBy",
        "unpivot", "melt", "crosstab", "freqItems",
        "alias", "to", "withMetadata", "repartition", "repartitionByRange",
        "coalesce", "hint", "cache", "persist", "unpersist", "checkpoint",
        "localCheckpoint", "withWatermark",
    }
)


class StepError(ValueError):
    pass


def _step_sql(spark, dfs, name, args, run_date):
    dfs[name].createOrReplaceTempView(args["view_name"])
    text, params = bind_run_date(args["query"], run_date)
    return spark.sql(text, args=params or None)


def _step_drop(spark, dfs, name, args, run_date):
    return dfs[name].drop(*args["cols"])


def _step_select(spark, dfs, name, args, run_date):
    return dfs[name].select(*[as_column(c) for c in args["cols"]])


def _step_sort(spark, dfs, name, args, run_date):
    cols = [as_column(c) for c in args["cols"]]
    ascending = args.get("ascending", True)
    if isinstance(ascending, bool):
        ascending = [ascending] * len(cols)
    ordered = [c.asc_nulls_first() if a else c.desc_nulls_last() for c, a in zip(cols, ascending)]
    return dfs[name].orderBy(*ordered)


def _step_aggregate(spark, dfs, name, args, run_date):
    keys = [as_column(k) for k in args.get("group_by", [])]
    aggs = [as_column(expr).alias(alias) for alias, expr in args["aggs"].items()]
    return dfs[name].groupBy(*keys).agg(*aggs)


def _existence_side(other: DataFrame, on) -> DataFrame:
    """The other side of a semi / anti join, where only existence matters:
    reduced to distinct join values, de-duplicated map-side, so a hot key
    there shrinks to one row per partition before the shuffle. With column
    names it is projected to them; with a condition it is de-duplicated
    only when the condition mentions all of its columns (project it with
    a ``select`` step first), since a wide row rarely repeats."""
    if isinstance(on, str) and not on.startswith("F."):
        on = [on]
    if isinstance(on, (list, tuple)) and all(isinstance(c, str) for c in on):
        return other.select(*on).distinct()
    words = {w.lower() for w in re.findall(r"[A-Za-z_][A-Za-z0-9_]*", str(on))}
    if all(c.lower() in words for c in other.columns):
        return other.distinct()
    return other


def _step_join(spark, dfs, name, args, run_date):
    other = dfs[args["other"]]
    on = args.get("on")  # column name(s), an F. expression or {"expr": ...}
    if isinstance(on, dict) or (isinstance(on, str) and on.startswith("F.")):
        on = as_column(on)
    how = args.get("how", "inner")
    if how.replace("_", "").lower() in ("semi", "leftsemi", "anti", "leftanti"):
        other = _existence_side(other, on)
    limit = args.get("broadcast")
    if limit:
        # Broadcast only after sizing the other side: ``true`` checks the
        # estimated bytes against ``broadcast_bytes``, a number also caps
        # its rows. Over the limit the join is left to the planner / AQE.
        max_bytes = int(args.get("broadcast_bytes", DEFAULT_BROADCAST_BYTES))
        if fits_broadcast(other, max_bytes, None if limit is True else int(limit)):
            other = F.broadcast(other)
    return dfs[name].join(other, on=on, how=how)


def _step_union(spark, dfs, name, args, run_date):
    other = dfs[args["other"]]
    if args.get("by_name", True):
        return dfs[name].unionByName(other, allowMissingColumns=args.get("allow_missing", False))
    return dfs[name].union(other)


def _step_summary(spark, dfs, name, args, run_date):
    # Statistics are varargs of DataFrame.summary; none means the default set.
    return dfs[name].summary(*args.get("statistics", []))


def _step_describe(spark, dfs, name, args, run_date):
    return dfs[name].describe(*args.get("cols", []))


def _step_checkpoint(df: DataFrame, spark: SparkSession, args: dict) -> DataFrame:
    # Reliable checkpoint into the shared folder; a local checkpoint would
    # be lost with the executor that holds it.
    scratch_root(spark)
    return df.checkpoint(eager=args.get("eager", True))


STEPS: dict[str, Callable] = {
    "sql": _step_sql,
    "drop": _step_drop,
    "select": _step_select,
    "sort": _step_sort,
    "orderBy": _step_sort,
    "aggregate": _step_aggregate,
    "join": _step_join,
    "union": _step_union,
    "summary": _step_summary,
    "describe": _step_describe,
}


def _call_method(spark, df: DataFrame, op: str, args: dict) -> DataFrame:
    if op not in DATAFRAME_METHODS:
        raise StepError(f"unknown step {op!r}")
    kwargs = {k: config_value(v) for k, v in args.items()}
    if op in ("checkpoint", "localCheckpoint"):
        return _step_checkpoint(df, spark, kwargs)
    if op == "persist" and isinstance(kwargs.get("storageLevel"), str):
        kwargs["storageLevel"] = getattr(StorageLevel, kwargs["storageLevel"])
    if op == "to" and isinstance(kwargs.get("schema"), str):
        kwargs["schema"] = spark.createDataFrame([], kwargs["schema"]).schema
    return getattr(df, op)(**kwargs)


def apply_steps(
    spark: SparkSession,
    dfs: dict[str, DataFrame],
    steps_by_table: dict[str, list[dict]],
    run_date=None,
) -> dict[str, DataFrame]:
    """Apply each table's steps in order; returns a new dict."""
    out = dict(dfs)
    for name, steps in steps_by_table.items():
        if name not in out:
            raise StepError(f"steps given for unknown table {name!r}")
        for step in steps or []:
            op, args = step["op"], dict(step.get("args") or {})
            if op in STEPS:
                out[name] = STEPS[op](spark, out, name, args, run_date)
            else:
                out[name] = _call_method(spark, out[name], op, args)
    return out
