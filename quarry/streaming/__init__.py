"""Micro-batch use of the sinks.

The batch jobs have no streaming operators of their own. When a source
arrives as a stream, each micro-batch is written with the same sink config
(``foreachBatch``); an ``upsert`` sink makes re-delivered batches
idempotent, since applying the same rows twice leaves the table as once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from quarry.sinks import write_output


def batch_writer(sink: dict) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes every micro-batch to
    ``sink`` (a job ``load`` entry)."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        write_output(batch.sparkSession, batch, sink, None)

    return write
