"""JDBC sources (Postgres, Oracle, any driver on the classpath).

Config keys: ``url``; ``table`` (a table name or a parenthesised subquery,
``${run_date}`` and ``{$run_date}`` substituted as text) or ``query`` (source-side SQL, not
substituted); ``properties`` passed through as reader options (``user``,
``driver``, ``fetchsize`` (default 10,000 rows), ...).

Parallel reads: a JDBC scan without partition options is one task for the
whole table. Give ``partition_column`` (numeric, date or timestamp) and
``num_partitions``; the bounds are taken from the config or, when absent,
fetched with one ``min``/``max`` query that the source database answers.
Or give ``predicates``, a list of non-overlapping WHERE clauses, one task
each, when the column's values cluster and equal strides would be uneven.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.expressions import substitute_run_date


DEFAULT_FETCH_SIZE = 10_000


def jdbc_options(config: dict, run_date=None) -> dict[str, str]:
    """The reader options for one JDBC source config (no I/O)."""
    table, query = config.get("table"), config.get("query")
    if table and query:
        raise ValueError("a JDBC source takes either 'table' or 'query', not both")
    if not table and not query:
        raise ValueError("a JDBC source needs 'table' or 'query'")
    opts = {"url": config["url"]}
    if table:
        opts["dbtable"] = substitute_run_date(table, run_date)
    else:
        opts["query"] = query
    for key, value in (config.get("properties") or {}).items():
        opts[key] = str(value)
    if not any(k.lower() == "fetchsize" for k in opts):
        # Rows per round trip. Without it the Postgres driver holds a
        # partition's whole result in executor memory and Oracle's fetches
        # ten rows at a time.
        opts["fetchsize"] = str(DEFAULT_FETCH_SIZE)
    if config.get("partition_column"):
        opts["partitionColumn"] = config["partition_column"]
        opts["numPartitions"] = str(config.get("num_partitions", 8))
        if "lower_bound" in config and "upper_bound" in config:
            opts["lowerBound"] = str(config["lower_bound"])
            opts["upperBound"] = str(config["upper_bound"])
    return opts


def bounds_query(opts: dict[str, str]) -> str:
    """Source-side SQL for the min/max of the partition column, so the
    database computes the bounds (the JDBC source does not push
    aggregates down; reading the column through Spark would be one task
    over the whole table)."""
    col = opts["partitionColumn"]
    source = opts["dbtable"] if "dbtable" in opts else f"({opts['query']}) q"
    return f"SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {source}"


def _bounds(spark: SparkSession, opts: dict[str, str]) -> tuple[str, str] | None:
    """Smallest and largest value; None for a source without any."""
    probe = {k: v for k, v in opts.items()
             if k not in ("partitionColumn", "numPartitions", "dbtable", "query")}
    probe["query"] = bounds_query(opts)
    row = spark.read.format("jdbc").options(**probe).load().first()
    return None if row is None or row[0] is None else (str(row[0]), str(row[1]))


def read_jdbc(spark: SparkSession, config: dict, run_date=None) -> DataFrame:
    opts = jdbc_options(config, run_date)
    if config.get("predicates"):
        # One partition per WHERE clause: for a partition column whose
        # values cluster, so equal strides between min and max would give
        # a few huge partitions. Clauses should not overlap.
        table = opts.pop("dbtable", None) or f"({opts.pop('query')}) q"
        url = opts.pop("url")
        preds = [substitute_run_date(p, run_date) for p in config["predicates"]]
        return spark.read.jdbc(url, table, predicates=preds, properties=opts)
    if "partitionColumn" in opts:
        if "query" in opts:
            # Spark forbids partitionColumn together with 'query'; wrap it.
            opts["dbtable"] = f"({opts.pop('query')}) q"
        if "lowerBound" not in opts:
            found = _bounds(spark, opts)
            if found is None:  # nothing to split: an empty slice, or only NULLs
                del opts["partitionColumn"], opts["numPartitions"]
            else:
                opts["lowerBound"], opts["upperBound"] = found
    return spark.read.format("jdbc").options(**opts).load()
