"""File sources: Parquet (default), ORC, JSON, CSV by path.

Config: ``path`` or ``bucket`` + ``prefix`` (object store, ``s3a://`` by
default), ``format``, ``options``, optional ``schema`` (DDL text; skips
inference), ``merge_schema`` for Parquet folders written with evolving
schemas. A folder that holds a table with versions is read at its current
one. ``view_name`` also registers the result as a temp view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.expressions import substitute_run_date
from quarry.sinks import versions


def object_store_path(bucket: str, prefix: str, scheme: str = "s3a") -> str:
    return f"{scheme}://{bucket.strip('/')}/{prefix.lstrip('/')}"


def read_files(spark: SparkSession, config: dict, run_date=None) -> DataFrame:
    if config.get("path"):
        path = config["path"]
    elif config.get("bucket"):
        path = object_store_path(config["bucket"], config.get("prefix", ""), config.get("scheme", "s3a"))
    else:
        raise ValueError("a file source needs 'path' or 'bucket'")
    path = substitute_run_date(path, run_date)
    reader = spark.read.format(config.get("format", "parquet"))
    if config.get("schema"):
        reader = reader.schema(config["schema"])
    if config.get("merge_schema"):
        reader = reader.option("mergeSchema", "true")
    for key, value in (config.get("options") or {}).items():
        reader = reader.option(key, value)
    named = None if set(path) & set("*?[{") else versions.state(spark, path)
    if named is not None:
        # The folder of a table with versions: its rows are the current ones.
        if named.schema is not None and not config.get("schema"):
            reader = reader.schema(named.schema)
        df = versions.read(spark, named, reader)
    else:
        df = reader.load(path)
    if config.get("view_name"):
        df.createOrReplaceTempView(config["view_name"])
    return df
