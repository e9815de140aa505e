"""Running values along an order within a key, safe for a hot key.

A plain window sorts all rows of a key in one task, so a key that holds a
third of a table is one task with a third of the table. Here the rows are
dealt by ranges of (key, order), so a hot key is cut into consecutive
chunks, and what a chunk needs of the earlier ones is one row:

1. ``chunked`` deals the rows by range and writes them with the number of
   their chunk (numbers rise along the order);
2. ``running`` finds the keys that go over a chunk's end (each end cuts at
   most one key), totals just those per chunk, and turns the totals into an
   offset per (key, chunk) by a window over at most two rows a chunk;
3. the local windows run per (key, chunk), and the offset is added. The
   offsets are broadcast: there are at most two per chunk.

Orders are ascending, NULLs first, and frames are ROWS frames: give enough
order columns that no two rows of a key tie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import materialize

CHUNK = "_chunk"
_KEY, _OFF = "_chunk_key", "_chunk_off_"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` of ``value`` from the key's first row to
    the current one, or (``before``) to the one before it.

    Kinds: sum, count (of non-NULLs), min, max, bit_xor, last (the latest
    value that is not NULL, carried forward).
    """

    kind: str
    value: Column
    before: bool = False

    def over(self, frame) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(frame)
        return getattr(F, self.kind)(self.value).over(frame)

    def total(self, order: tuple[str, ...]) -> Column:
        """The same of a whole chunk, as an aggregate."""
        if self.kind == "last":
            place = F.when(self.value.isNotNull(), F.struct(*[F.col(f"`{o}`") for o in order]))
            return F.max_by(self.value, place)
        return getattr(F, self.kind)(self.value)

    def add(self, local: Column, offset: Column) -> Column:
        """The value over both parts, ``offset`` being of the earlier one;
        a part without rows is NULL."""
        if self.kind in ("sum", "count"):
            return F.coalesce(local + offset, local, offset)
        if self.kind == "bit_xor":
            return F.coalesce(local.bitwiseXOR(offset), local, offset)
        if self.kind in ("min", "max"):
            return (F.least if self.kind == "min" else F.greatest)(local, offset)  # both skip NULLs
        return F.coalesce(local, offset)


@dataclass(frozen=True)
class Chunked:
    """Rows in consecutive chunks of (keys, order); see ``chunked``."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def key(self) -> Column:
        return F.struct(*[F.col(f"`{k}`") for k in self.keys]) if self.keys else F.struct(F.lit(True).alias("all"))

    def cut_keys(self) -> DataFrame:
        """Keys with rows in several chunks: the last of one and the first
        of another, so at most one per chunk's end."""
        ends = self.rows.groupBy(CHUNK).agg(F.min(self.key()).alias("lo"), F.max(self.key()).alias("hi"))
        both = ends.select(CHUNK, F.explode(F.array("lo", "hi")).alias(_KEY)).distinct()
        return both.groupBy(_KEY).count().where("count > 1").select(_KEY)


def chunked(spark: SparkSession, df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> Chunked:
    """``df`` dealt by ranges of (keys, order) and written once with the
    number of each row's chunk. NULL keys are one key; without keys the
    whole table is one sequence. ``partitions`` defaults to the session's
    shuffle partitions, which AQE merges where they are small."""
    by = [F.col(f"`{c}`").asc_nulls_first() for c in [*keys, *order]]
    dealt = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    rows = materialize(spark, dealt.withColumn(CHUNK, F.spark_partition_id()), "chunked")
    return Chunked(rows, tuple(keys), tuple(order))


def running(c: Chunked, columns: dict[str, Running]) -> DataFrame:
    """The rows of ``c`` with one column more per entry of ``columns``, each
    equal to the plain window's over the whole key. The chunk's number stays
    (``CHUNK``), so that the result can be taken further as a ``Chunked``."""
    rows = c.rows.withColumn(_KEY, c.key())
    totals = (
        rows.join(F.broadcast(c.cut_keys()), _KEY, "left_semi")
        .groupBy(_KEY, CHUNK)
        .agg(*[r.total(c.order).alias(_OFF + n) for n, r in columns.items()])
    )
    earlier = Window.partitionBy(_KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(_KEY).alias(_OFF + "key"),
        F.col(CHUNK).alias(_OFF + "chunk"),
        # A total of totals: counts add up like sums.
        *[Running("sum" if r.kind == "count" else r.kind, F.col(_OFF + n)).over(earlier).alias(_OFF + n) for n, r in columns.items()],
    )
    place = Window.partitionBy(_KEY, CHUNK).orderBy(*[F.col(f"`{o}`").asc_nulls_first() for o in c.order])
    upto, before = place.rowsBetween(Window.unboundedPreceding, 0), place.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", *[r.over(before if r.before else upto).alias(n) for n, r in columns.items()])
    here = (F.col(_KEY) == F.col(_OFF + "key")) & (F.col(CHUNK) == F.col(_OFF + "chunk"))
    return local.join(F.broadcast(offsets), here, "left").select(
        *[F.col(f"`{x}`") for x in c.rows.columns],
        *[r.add(F.col(f"`{n}`"), F.col(_OFF + n)).alias(n) for n, r in columns.items()],
    )
