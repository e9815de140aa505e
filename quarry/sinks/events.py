"""Keyed JSON events and JSON documents as table outputs.

``json_events`` turns rows into ``(key, value)`` pairs, ``value`` being the
row as JSON text, built per row by Spark (``to_json``), never on the
driver. ``EventSink`` writes them to Kafka when a ``topic`` is given and
the Kafka source is installed, else as JSON lines under ``path``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed text formats so the JSON round-trips at full precision.
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "dateFormat": "yyyy-MM-dd",
}


def json_events(df: DataFrame, key_cols: list[str], value_cols: list[str] | None = None) -> DataFrame:
    """``key`` is the key column as text, NULL for NULL; of several columns
    it is a JSON array of their texts, so that different values, NULLs and
    values with separators among them, never give the same key."""
    key_parts = [F.col(c).cast("string") for c in key_cols]
    key = key_parts[0] if len(key_parts) == 1 else F.to_json(F.array(*key_parts))
    value_cols = value_cols or df.columns
    return df.select(
        key.alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in value_cols]), JSON_OPTIONS).alias("value"),
    )


class EventSink:
    def __init__(self, spark: SparkSession, config: dict, run_date=None, writer: str | None = None):
        self.spark = spark
        self.config = config

    def _events(self, df: DataFrame) -> DataFrame:
        keys = self.config.get("key_columns")
        if keys:
            return json_events(df, keys, self.config.get("value_columns"))
        return df

    def _write(self, df: DataFrame, mode: str) -> None:
        out = self._events(df)
        if self.config.get("topic"):
            (
                out.write.format("kafka")
                .option("kafka.bootstrap.servers", self.config["bootstrap_servers"])
                .option("topic", self.config["topic"])
                .save()
            )
            return
        out.write.mode(mode).options(**JSON_OPTIONS).json(self.config["path"])

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    def overwrite(self, df: DataFrame) -> None:
        self._write(df, "overwrite")

    overwrite_partition = overwrite

    def upsert(self, df: DataFrame) -> None:
        raise NotImplementedError("event sinks are append-only")
