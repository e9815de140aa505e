"""Readers, chosen by name from a job's ``extract`` section.

Every reader is ``read(spark, config, run_date) -> DataFrame`` and lazy: no
rows move until a sink runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.session import materialize

from quarry.sources.files import object_store_path, read_files  # noqa: F401
from quarry.sources.jdbc import jdbc_options, read_jdbc  # noqa: F401
from quarry.sources.tables import read_table  # noqa: F401

Reader = Callable[[SparkSession, dict, object], DataFrame]

# Reader names a job config may use. Delta and Iceberg tables are read
# through the catalog the same way as any other table.
READERS: dict[str, Reader] = {
    "JDBCReader": read_jdbc,
    "DeltaReader": read_table,
    "IcebergReader": read_table,
    "TableReader": read_table,
    "ParquetReader": read_files,
    "FileReader": read_files,
}


def register_reader(name: str, reader: Reader) -> None:
    READERS[name] = reader


def read_source(spark: SparkSession, config: dict, run_date=None) -> DataFrame:
    name = config.get("reader")
    if name not in READERS:
        raise ValueError(f"unknown reader {name!r}; known: {sorted(READERS)}")
    return READERS[name](spark, config, run_date)


def extract(spark: SparkSession, sources: dict[str, dict], run_date=None) -> dict[str, DataFrame]:
    """All sources of a job, by logical name.

    A source with ``"checkpoint": true`` is written once as a Parquet table
    in the shared folder and read back. Every output of the job then reads
    that copy instead of recomputing the source (a derived view, a
    database), with column pruning and filter push-down into the copy, and
    a lost executor's part is read back from files. It costs a full copy
    and forgoes push-down into the original source, so it pays only when
    the source is expensive to read and read more than once.
    """
    out = {}
    for name, cfg in sources.items():
        df = read_source(spark, cfg, run_date)
        if cfg.get("checkpoint"):
            df = materialize(spark, df, f"source_{name}")
        out[name] = df
    return out
