"""Vector code compression: product codes of integer vectors, by dictionaries.

Components become integers floor(1024 x), a vector is cut into four parts,
and each part is coded by the nearest of 256 entries of its position's
codebook, which is refined by a few exact rounds of assignment and mean.

Distances are never computed vector by vector. Of every dimension, a batch
has a dictionary of its distinct integers; the squared difference of each of
them to all entries is tabulated once, and a part's distance to all entries
is a gather from those tables by dictionary code and an add per dimension.
All of it is integer arithmetic, so ties and sums are exact.

A round is one pass over the vectors (written once). Tasks return
sums and counts per entry, which Spark adds up; the driver sees the new
codebooks only, 256 entries of the vectors' dimension. Nothing is dealt by
a vector's value or label, so copies are no hot group.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import only, small_batches

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
ROWS = 4096  # vectors that share dictionaries
CHUNK = 256  # vectors gathered at a time
SAFE = 1 << 62


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as integers floor(1024 x), shorter ones padded
    with zeros. The product with a power of two is exact."""
    values, ends = np.asarray(column.flatten(), np.float64), np.asarray(column.value_lengths())
    if len(values) and np.abs(values).max() * SCALE >= SAFE:
        whole = np.array([math.floor(v * SCALE) if abs(v) < SAFE else int(v) * SCALE for v in values.tolist()], object)
    else:
        whole = np.floor(values * SCALE).astype(np.int64)
    out = np.zeros((len(ends), dim), whole.dtype)
    out[np.arange(dim)[None, :] < ends[:, None]] = whole
    return out


def _fitting(x: np.ndarray, codebooks: np.ndarray) -> type:
    """The narrowest type that holds every value and distance: int32, int64, or
    Python's own integers for components beyond those."""
    if not x.size:
        return object
    low, high = min(int(x.min()), int(codebooks.min())), max(int(x.max()), int(codebooks.max()))
    most = max((high - low) ** 2 * (x.shape[1] // PARTS), high, -low)
    return np.int32 if most < 1 << 31 else np.int64 if most < SAFE else object


def nearest(x: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry, for each vector and
    part; ties go to the lower index. ``codebooks`` is (entries, dim)."""
    kind = _fitting(x, codebooks)
    n, dim = x.shape
    width = dim // PARTS
    books = codebooks.astype(kind)
    index, distance = np.zeros((n, PARTS), np.int64), np.zeros((n, PARTS), kind if kind is object else np.int64)
    for p in range(PARTS):
        codes, tables = [], []
        for d in range(p * width, (p + 1) * width):
            values, code = np.unique(x[:, d], return_inverse=True)
            difference = values.astype(kind)[:, None] - books[None, :, d]
            codes.append(code.reshape(-1))
            tables.append(difference * difference)
        for at in range(0, n, CHUNK):
            total = np.zeros((min(CHUNK, n - at), len(books)), kind)
            for code, table in zip(codes, tables):
                total += table[code[at : at + CHUNK]]
            best = total.argmin(axis=1)
            index[at : at + CHUNK, p] = best
            distance[at : at + CHUNK, p] = total[np.arange(len(best)), best]
    return index, distance


def usable(spark: SparkSession, vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, label, x): the vectors that are kept, written once as
    doubles. A null vector, or one with a null or non-finite component, is
    dropped."""
    own = only(vectors, vec_id=vec_id, label=label, v=vector).withColumn("x", F.col("v").cast("array<double>"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return materialize(spark, own.where(F.col("x").isNotNull() & ~bad).select("vec_id", "label", "x"), "vectors")


def _sums(x: DataFrame, codebooks: np.ndarray, dim: int) -> dict:
    """{(part, entry): (sums, count)} over all vectors; entries without a
    vector are not there."""

    def run(batches):
        n = np.zeros((PARTS, len(codebooks)), np.int64)
        total = np.zeros((PARTS, len(codebooks), dim // PARTS), object)
        for b in batches:
            m = _matrix(b.column(0), dim)
            index, _ = nearest(m, codebooks)
            for p in range(PARTS):
                part = m[:, p * (dim // PARTS) : (p + 1) * (dim // PARTS)]
                order = np.argsort(index[:, p], kind="stable")
                used, first, count = np.unique(index[order, p], return_index=True, return_counts=True)
                n[p, used] += count
                # A batch's sum stays below 2**62 in its own type: see SAFE.
                wide = part.dtype == object or (part.size and int(np.abs(part).max()) * len(part) >= SAFE)
                total[p, used] += np.add.reduceat((part.astype(object) if wide else part)[order], first, axis=0).astype(object)
        rows = [(p, e, [str(v) for v in total[p, e]], int(n[p, e])) for p in range(PARTS) for e in range(len(codebooks)) if n[p, e]]
        yield pa.RecordBatch.from_pylist([dict(part=p, entry=e, sums=s, n=k) for p, e, s, k in rows], pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.string())), ("n", pa.int64())]))

    found = x.select("x").mapInArrow(run, "part int, entry int, sums array<string>, n long")
    each = found.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
    added = each.groupBy("part", "entry", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out: dict = {}
    for r in added.collect():  # entries x dimension numbers, however many vectors
        out.setdefault((r.part, r.entry), ({}, r.n))[0][r.at] = int(r.s)
    return {k: ([s[i] for i in sorted(s)], n) for k, (s, n) in out.items()}


def _exact(rows: list[list[int]], dim: int) -> np.ndarray:
    most = max((abs(v) for r in rows for v in r), default=0)
    return np.array(rows, object if most >= SAFE else np.int64).reshape(len(rows), dim)


def train(spark: SparkSession, x: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> np.ndarray:
    """The codebooks, one row per entry, after ``rounds`` over all of ``x``
    (the table that ``usable`` gives). They start as the vectors of the
    smallest ids; rows of one id are taken in the order of their components,
    and null ids come last. Fewer vectors, fewer entries."""
    dim = x.agg(F.max(F.size("x"))).first()[0] or 0
    dim = -(-dim // PARTS) * PARTS
    first = x.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    column = pa.array([r.x for r in first], pa.list_(pa.float64()))
    books = _exact(_matrix(column, dim).tolist(), dim)
    width = dim // PARTS
    small_batches(spark, ROWS)
    for _ in range(rounds if dim else 0):
        new = books.tolist()
        for (p, e), (sums, n) in _sums(x, books, dim).items():
            new[e][p * width : (p + 1) * width] = [s // n for s in sums]
        books = _exact(new, dim)
    return books


def encode(spark: SparkSession, x: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits a part, and the squared
    distances summed over the parts (null where they exceed a long)."""
    dim = codebooks.shape[1]
    small_batches(spark, ROWS)

    def run(batches):
        for b in batches:
            index, distance = nearest(_matrix(b.column("x"), dim), codebooks)
            code = [bytes(r).hex() for r in index.astype(np.uint8)]
            error = [e if e < 1 << 63 else None for e in map(int, distance.astype(object).sum(axis=1))] if len(index) else []
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    return x.mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals
    joined by commas."""
    width = codebooks.shape[1] // PARTS
    parts = [codebooks[:, p * width : (p + 1) * width].reshape(-1).tolist() for p in range(PARTS)]
    return hashlib.sha256(",".join(str(v) for part in parts for v in part).encode()).hexdigest()


def compress(
    spark: SparkSession, vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """The vectors' codes, and the codebooks that decode them. Per row:
    vec_id, label, code, error (long) and label_error (long): the errors
    summed over the rows of equal label, nulls together.

    Dropped are only vectors that are null or hold a null or non-finite
    component. Vectors shorter than the longest, and all where its length
    is no multiple of four, are padded with zeros; an empty vector is all
    padding. Ids may be null or repeat: each row is coded by itself. Errors
    that exceed a long are null; components whose sums exceed 38 digits are
    an error. An empty table gives no rows. At most 256
    entries, so that a code is two hex digits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    x = usable(spark, vectors, vector, vec_id, label)
    books = train(spark, x, rounds, entries)
    coded = materialize(spark, encode(spark, x, books), "vector-codes")
    # Written, so that the rows of a hot label stay splittable under the join.
    sums = materialize(spark, coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    sums = sums.select(F.col("label").alias("_label"), "label_error")
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left")
    return out.select("vec_id", "label", "code", "error", "label_error"), books
