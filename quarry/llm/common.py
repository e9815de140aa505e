"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that the contracts strip and split at (ASCII
# space and the controls 9 to 13), and the ASCII letters that are folded.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A word is a run of anything else; the byte form works on UTF-8, where all
#: of these are single bytes that occur in no longer sequence.
WORD_BYTES = rb"[^\x20\x09-\x0D]+"

ROWS_PER_BATCH = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Arrow batches of few rows, so a batch of long texts stays small in a
    Python worker (Spark also bounds a batch by bytes where it can)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(col, UPPER, UPPER.lower())


def hash128(*cols: Column) -> list[Column]:
    """Two 64-bit hashes, for keys that must not collide at 1e12 rows."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns under fixed names: other columns, whatever
    they are called, cannot clash with what an operator adds."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def without(df: DataFrame, names) -> list[Column]:
    """The columns of ``df`` except ``names`` (compared like Spark does)."""
    gone = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]
