"""Writers, chosen by name from a job's ``load`` section, and the mode
(``append``, ``overwrite``, ``overwrite_partition``, ``upsert``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.sinks.events import EventSink, json_events  # noqa: F401
from quarry.sinks.tables import (  # noqa: F401
    ConsoleSink,
    TableSink,
    register_table,
    split_table_name,
    table_location,
)

WRITERS = {
    "ConsoleWriter": ConsoleSink,
    "DeltaWriter": TableSink,
    "IcebergWriter": TableSink,
    "ParquetWriter": TableSink,
    "TableWriter": TableSink,
    "JsonWriter": EventSink,
    "KafkaWriter": EventSink,
}
MODES = ("append", "overwrite", "overwrite_partition", "upsert")


def register_writer(name: str, cls) -> None:
    WRITERS[name] = cls


def write_output(spark: SparkSession, df: DataFrame, config: dict, run_date=None) -> None:
    writer, mode = config.get("writer"), config.get("mode")
    if writer not in WRITERS:
        raise ValueError(f"unknown writer {writer!r}; known: {sorted(WRITERS)}")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; known: {MODES}")
    sink = WRITERS[writer](spark, config, run_date, writer)
    getattr(sink, mode)(df)
