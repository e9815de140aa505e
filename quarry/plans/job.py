"""Jobs: extract -> transform -> load, for one run date or a backfill.

A job config (JSON) has four sections::

    {"run_mode":  {"name": "default"} |
                  {"name": "back_fill", "start": "2024-01-01", "end": "2024-01-31", "step": 1} |
                  {"name": "back_fill", "start": 1, "end": 12},
     "extract":   {name: {"reader": ..., ...}},
     "transform": {"transformer": "ConfigTransformer" | "SQLTransformer" | "PyTransformer",
                   "transformation": steps | sql file/text | registered name},
     "load":      {name: {"writer": ..., "mode": ..., ...}}}

Everything is checked before the first read (``validate_job``), and the
outputs named in ``load`` are checked to exist before the first write, so
a bad config never leaves half-written tables.
"""

from __future__ import annotations

import contextlib
import importlib
import importlib.resources
import io
import json
import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.expressions import bind_run_date
from quarry.functions.rundate import date_range, default_run_date, int_range
from quarry.operators.steps import DATAFRAME_METHODS, STEPS
from quarry.sinks import MODES, WRITERS, write_output
from quarry.sources import READERS, extract

Transform = Callable[[SparkSession, dict, object], dict]

# Python transforms by name: f(spark, dfs, run_date) -> dict of outputs.
TRANSFORMS: dict[str, Transform] = {}
TRANSFORM_OUTPUTS: dict[str, tuple[str, ...]] = {}


# Range forms: f(spark, dfs, start, end, step) -> dict of outputs carrying a
# run_date column; lets a date backfill run as one job (see ``run``).
RANGE_TRANSFORMS: dict[str, Callable] = {}


def transform_function(*names: str, outputs: tuple[str, ...] = (), range_form: Callable | None = None):
    """Register a Python transform under one or more names, optionally with
    a set-based form over a whole date range."""

    def wrap(fn: Transform) -> Transform:
        for name in names or (fn.__name__,):
            TRANSFORMS[name] = fn
            TRANSFORM_OUTPUTS[name] = tuple(outputs)
            if range_form is not None:
                RANGE_TRANSFORMS[name] = range_form
        return fn

    return wrap


class PyTransform:
    """Class form of a Python transform, for jobs written against the
    ``(spark, config, dfs, run_data_date)`` constructor + ``transform()``
    contract: subclass, implement ``transform`` returning a dict of
    DataFrames, and name the class by dotted path in the job."""

    def __init__(self, spark: SparkSession, config, dfs: dict, run_data_date):
        self.spark = spark
        self.config = config
        self.dfs = dfs
        self.run_data_date = run_data_date

    def transform(self) -> dict:
        raise NotImplementedError


def _resolve_python_transform(name: str) -> Transform:
    if name in TRANSFORMS:
        return TRANSFORMS[name]
    module, _, attr = name.rpartition(".")
    if not module:
        raise ValueError(f"unknown Python transform {name!r}")
    target = getattr(importlib.import_module(module), attr)
    if isinstance(target, type):
        # A transform class: built per run with the job's transformation
        # name as its config, then asked for its outputs.
        return lambda spark, dfs, run_date: target(spark, name, dfs, run_date).transform()
    return target


def read_sql_text(ref: str, spark: SparkSession | None = None) -> str:
    """SQL of a SQL-file transform: a path, one on shared storage
    (``s3a://...``, read through Spark), ``package:file.sql`` for SQL
    shipped inside a package, or the statement itself."""
    if spark is not None and re.fullmatch(r"[a-z][a-z0-9+.-]*://\S+\.sql", ref):
        return spark.read.text(ref, wholetext=True).first()[0]
    if ref.endswith(".sql") and ":" in ref and not os.path.exists(ref):
        package, _, filename = ref.partition(":")
        return importlib.resources.files(package).joinpath(filename).read_text()
    if ref.endswith(".sql"):
        with open(ref) as f:
            return f.read()
    return ref


def sql_transform(spark: SparkSession, dfs: dict[str, DataFrame], sql_ref: str, run_date=None) -> dict:
    """Every input becomes a temp view of its own name; one statement;
    the output is called ``result``."""
    for name, df in dfs.items():
        df.createOrReplaceTempView(name)
    text, args = bind_run_date(read_sql_text(sql_ref, spark), run_date)
    return {"result": spark.sql(text, args=args or None)}


def transform(spark: SparkSession, config: dict, dfs: dict[str, DataFrame], run_date=None) -> dict:
    kind, spec = config.get("transformer"), config.get("transformation")
    if kind == "ConfigTransformer":
        from quarry.operators.steps import apply_steps

        return apply_steps(spark, dfs, spec or {}, run_date)
    if kind == "SQLTransformer":
        return sql_transform(spark, dfs, spec, run_date)
    if kind == "PyTransformer":
        return _resolve_python_transform(spec)(spark, dict(dfs), run_date)
    raise ValueError(f"unknown transformer {kind!r}")


def _expected_outputs(conf: dict) -> set[str] | None:
    t = conf.get("transform") or {}
    kind = t.get("transformer")
    if kind == "ConfigTransformer":
        return set(conf.get("extract", {}))
    if kind == "SQLTransformer":
        return {"result"}
    if kind == "PyTransformer" and TRANSFORM_OUTPUTS.get(t.get("transformation")):
        return set(TRANSFORM_OUTPUTS[t["transformation"]])
    return None  # known only after the transform ran


def validate_job(conf: dict) -> None:
    """Raise ValueError listing every problem of a job config."""
    errors = []
    mode = (conf.get("run_mode") or {"name": "default"}).get("name")
    if mode not in ("default", "back_fill"):
        errors.append(f"run_mode {mode!r} is neither 'default' nor 'back_fill'")
    if mode == "back_fill":
        rm = conf["run_mode"]
        if rm.get("start") is None or rm.get("end") is None:
            errors.append("back_fill needs 'start' and 'end'")
        elif isinstance(rm["start"], int) != isinstance(rm["end"], int):
            errors.append("back_fill 'start' and 'end' must both be dates or both integers")
        if rm.get("step") is not None and int(rm["step"]) < 0:
            errors.append("back_fill 'step' must not be negative")
    sources = conf.get("extract") or {}
    if not sources:
        errors.append("'extract' names no source")
    for name, src in sources.items():
        if src.get("reader") not in READERS:
            errors.append(f"source {name!r}: unknown reader {src.get('reader')!r}")
        if src.get("predicates") and src.get("partition_column"):
            errors.append(f"source {name!r}: give 'predicates' or 'partition_column', not both")
    t = conf.get("transform") or {}
    if t.get("transformer") not in ("ConfigTransformer", "SQLTransformer", "PyTransformer"):
        errors.append(f"unknown transformer {t.get('transformer')!r}")
    if t.get("transformer") == "ConfigTransformer":
        for table, steps in (t.get("transformation") or {}).items():
            if table not in sources:
                errors.append(f"steps for {table!r}, which is not extracted")
            for step in steps or []:
                if step.get("op") not in STEPS and step.get("op") not in DATAFRAME_METHODS:
                    errors.append(f"{table!r}: unknown step {step.get('op')!r}")
    outputs = _expected_outputs(conf)
    for name, sink in (conf.get("load") or {}).items():
        if sink.get("writer") not in WRITERS:
            errors.append(f"load {name!r}: unknown writer {sink.get('writer')!r}")
        if sink.get("mode") not in MODES:
            errors.append(f"load {name!r}: unknown mode {sink.get('mode')!r}")
        if sink.get("mode") == "upsert" and not sink.get("primary_key"):
            errors.append(f"load {name!r}: upsert needs 'primary_key'")
        if sink.get("writer") in ("JsonWriter", "KafkaWriter"):
            if sink.get("topic") and not sink.get("bootstrap_servers"):
                errors.append(f"load {name!r}: a Kafka topic needs 'bootstrap_servers'")
            if not sink.get("topic") and not sink.get("path"):
                errors.append(f"load {name!r}: an event sink needs 'path' or 'topic'")
        if sink.get("bucket_by") and not {"columns", "buckets"} <= set(sink["bucket_by"]):
            errors.append(f"load {name!r}: 'bucket_by' needs 'columns' and 'buckets'")
        if outputs is not None and name not in outputs:
            errors.append(f"load {name!r} is not an output of the transform ({sorted(outputs)})")
    if errors:
        raise ValueError("invalid job config:\n  " + "\n  ".join(errors))


def run_job(spark: SparkSession, conf: dict, run_date=None, prepared: dict | None = None) -> dict[str, DataFrame]:
    """One extract -> transform -> load; returns the transform outputs.
    ``prepared``: sources already extracted (shared by a backfill loop)."""
    validate_job(conf)
    prepared = prepared or {}
    fresh = extract(spark, {n: c for n, c in conf["extract"].items() if n not in prepared}, run_date)
    dfs = {n: prepared[n] if n in prepared else fresh[n] for n in conf["extract"]}
    outputs = transform(spark, conf["transform"], dfs, run_date)
    missing = [n for n in conf.get("load", {}) if n not in outputs]
    if missing:
        raise ValueError(f"transform produced no output named {missing}")
    for name, sink in conf.get("load", {}).items():
        write_output(spark, outputs[name], sink, run_date)
    return outputs


def explain_job(spark: SparkSession, conf: dict, run_date=None, mode: str = "formatted") -> dict[str, str]:
    """The physical plan of every output a job would write, without
    writing (pushed filters, read schemas, exchanges, broadcasts). Sources
    are only planned, except a source marked ``checkpoint``, which is
    materialised as in a run."""
    validate_job(conf)
    dfs = extract(spark, conf["extract"], run_date)
    outputs = transform(spark, conf["transform"], dfs, run_date)
    plans = {}
    for name in conf.get("load", {}):
        if name not in outputs:
            raise ValueError(f"transform produced no output named {name!r}")
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            outputs[name].explain(mode=mode)
        plans[name] = text.getvalue()
    return plans


def run_dates(conf: dict, today=None) -> list:
    """The run dates (or integer keys) a job config asks for."""
    rm = conf.get("run_mode") or {"name": "default"}
    if rm["name"] == "default":
        return [rm.get("run_date") or default_run_date(today)]
    if rm["name"] == "back_fill":
        if isinstance(rm["start"], int):
            return int_range(rm["start"], rm["end"])
        return date_range(rm["start"], rm["end"], rm.get("step"))
    raise ValueError(f"unknown run_mode {rm['name']!r}")


def _set_based(conf: dict) -> bool:
    rm, t = conf.get("run_mode") or {}, conf.get("transform") or {}
    return (
        rm.get("name") == "back_fill"
        and bool(rm.get("set_based"))
        and not isinstance(rm.get("start"), int)
        and t.get("transformer") == "PyTransformer"
        and t.get("transformation") in RANGE_TRANSFORMS
    )


def run_range(spark: SparkSession, conf: dict) -> dict[str, DataFrame]:
    """A date backfill as one job: sources read once (no run date), the
    transform's range form computes every date in one plan, each output is
    written once. With ``overwrite_partition`` on ``run_date``, a re-run
    replaces all dates of the range, those without rows now included."""
    validate_job(conf)
    rm = conf["run_mode"]
    dfs = extract(spark, conf["extract"], None)
    fn = RANGE_TRANSFORMS[conf["transform"]["transformation"]]
    outputs = fn(spark, dict(dfs), rm["start"], rm["end"], rm.get("step"))
    missing = [n for n in conf.get("load", {}) if n not in outputs]
    if missing:
        raise ValueError(f"transform produced no output named {missing}")
    for name, sink in conf.get("load", {}).items():
        column = sink.get("run_date_column", "run_date")
        if sink.get("mode") == "overwrite_partition" and sink.get("partition_by") == [column] and not sink.get("bucket_by"):
            # The dates of the range are replaced, also by nothing, as the
            # loop does date by date.
            sink = {**sink, "replace_where": {"column": column, "values": [str(d) for d in run_dates(conf)]}}
        if sink.get("partition_by"):
            # One write holds every date of the range: lay it out per
            # partition value even if the per-date loop needs no rebalance.
            sink = {**sink, "rebalance": True}
        write_output(spark, outputs[name], sink, None)
    return outputs


def run(spark: SparkSession, conf: dict, run_date=None, resume_from=None) -> list:
    """Run a job for its run mode. Each backfill date is its own complete
    job, written before the next starts, so a failed backfill is resumed
    with ``resume_from`` = the failed date (earlier dates are skipped).
    With ``overwrite_partition`` on the run date column, re-running a date
    replaces its output instead of adding to it."""
    validate_job(conf)
    dates = [run_date] if run_date is not None else run_dates(conf)
    if run_date is None and resume_from is None and _set_based(conf):
        run_range(spark, conf)
        return dates
    if resume_from is not None:
        if resume_from not in dates and str(resume_from) not in map(str, dates):
            raise ValueError(f"resume_from {resume_from!r} is not one of the run dates")
        dates = dates[list(map(str, dates)).index(str(resume_from)):]
    # Sources marked "checkpoint" that do not depend on the run date are
    # materialised once for the whole loop instead of once per date.
    shared = {n: c for n, c in conf["extract"].items() if c.get("checkpoint") and not _uses_run_date(c)}
    prepared = extract(spark, shared, None) if shared and len(dates) > 1 else None
    for d in dates:
        run_job(spark, conf, d, prepared)
    return dates


def _uses_run_date(source: dict) -> bool:
    text = json.dumps(source, default=str)
    return any(p in text for p in ("${run_date}", "{$run_date}", ":run_date"))
