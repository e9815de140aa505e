"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints within ``max_bits`` differing bits are linked. With r =
max_bits, bit position i gets a non-zero vector f(i) of r + 1 bits; table v
(each non-zero v of r + 1 bits) keeps the positions whose f(i) has an odd
overlap with v. The at most r vectors of the positions where two
fingerprints differ cannot span all r + 1 dimensions, so some v is
orthogonal to all of them: in that table's mask the two agree. No pair
within the radius is missed, whatever the data.

Members of one bucket agree on the mask and are within r bits of each other
just when some value lies within ceil(r/2) flips of one and floor(r/2) of
the other. So a bucket is checked by grouping its members by the values one
gets by flipping that many bits outside the mask: each group is a star of
links that are exact by construction. That is linear in the bucket, however
full it is; no pair is ever listed.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import materialize
from .common import only, small_batches
from .components import connected_components

BITS = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 4096


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a whole text (zero without a word). Bit i is set if it
    is set in over half of the shingles' hashes, repeats included."""
    if not text:
        return 0
    words = text.encode().translate(_LOWER).split()
    # bytes.split() without an argument splits at exactly these six bytes.
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, n) - 1
    m = n - shingle + 1
    counts = np.zeros(BITS, np.int64)
    first, last = starts[:m].tolist(), (ends[shingle - 1 :] - 1).tolist()
    for at in range(0, m, _CHUNK):  # bounded memory for very long texts
        hashes = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(first[at : at + _CHUNK], last[at : at + _CHUNK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits((2 * counts > m).astype(np.uint8), bitorder="little").view(np.uint64)
    return int(value[0])


def fingerprints(spark: SparkSession, docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id", hashed: bool = False) -> DataFrame:
    """(doc_id long, fp long) per row; fp holds the unsigned bits. With
    ``hashed`` also th, a hash of the text as it is."""
    small_batches(spark)
    more = ["th"] if hashed else []

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *more])

    own = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    own = own.withColumn("th", F.xxhash64("text")) if hashed else own
    return own.mapInArrow(run, "doc_id long, fp long" + (", th long" if hashed else ""))


def masks(max_bits: int) -> list[int]:
    """One mask per table; f(i) runs evenly over the non-zero vectors."""
    span = (1 << (max_bits + 1)) - 1
    return [sum(1 << i for i in range(BITS) if bin((i % span + 1) & v).count("1") % 2) for v in range(1, span + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(spark: SparkSession, fps: DataFrame, max_bits: int) -> DataFrame:
    """Star links (a, b), a < b, between distinct fingerprints ``fp``: every
    link joins two fingerprints within ``max_bits``, and two fingerprints
    within ``max_bits`` are joined by a path of links."""
    tables = masks(max_bits)
    low, high = max_bits // 2, (max_bits + 1) // 2
    parts = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in tables])).alias("t", "k"))
    # Buckets of one fingerprint need no check. Written, so that AQE can
    # split the rows of a full bucket in the join below.
    full = materialize(spark, parts.groupBy("t", "k").agg(F.count("fp").alias("n")).where("n > 1").select("t", "k"), "simhash-buckets")
    members = parts.join(full, ["t", "k"], "left_semi")
    # flips[t]: the xor patterns of up to ``high`` bits outside table t's mask.
    flips = []
    for m in tables:
        free = [i for i in range(BITS) if not m >> i & 1]
        flips.append([sum(1 << i for i in c) for r in range(high + 1) for c in combinations(free, r)])
    assert all(len(f) <= sum(comb(BITS, r) for r in range(high + 1)) for f in flips)
    pattern = F.element_at(F.lit([[_signed(x) for x in f] for f in flips]), F.col("t") + 1)
    centres = members.select("t", "fp", F.explode(pattern).alias("flip")).select(
        "t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("c"), (F.bit_count("flip") <= low).alias("near")
    )
    # Some member must lie within ``low`` flips; the others join to it.
    star = centres.groupBy("t", "c").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.collect_set("fp").alias("all"))
    # At most 1 + C(free bits, high) fingerprints lie around one centre.
    pairs = star.where(F.col("hub").isNotNull() & (F.size("all") > 1)).select("hub", F.explode("all").alias("fp")).where("hub <> fp")
    return pairs.select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id long, fp long, component_id long) per row of ``docs``:
    component_id is the smallest doc_id reachable over links.

    Null, empty and blank texts have fingerprint zero and are linked like
    any other. Rows with a null doc_id get the smallest non-null id of their
    component (null if it has none). Repeated rows come back repeated. Other columns are ignored. An empty table gives no rows.
    """
    return _named(spark, fingerprints(spark, docs, shingle, text, doc_id), max_bits).select("doc_id", "fp", "component_id")


def _named(spark: SparkSession, prints: DataFrame, max_bits: int) -> DataFrame:
    """``prints`` with component_id and root, a fingerprint that names the
    component also where no row of it has an id."""
    rows = materialize(spark, prints, "simhash-rows")
    # Copies share a fingerprint: links are sought between distinct ones.
    classes = materialize(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    edges = links(spark, classes.select("fp"), max_bits)
    roots = connected_components(spark, edges)  # (node, root) of linked fingerprints
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = materialize(spark, named.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-least")
    lookup = materialize(spark, named.join(least, "root").select("fp", "component_id", "root"), "simhash-components")
    return rows.join(lookup, "fp")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of
    several texts under this id that of smallest hash.

    A row goes only if another row of its own component stays, so unrelated
    texts under one id all stay, and none of two equal texts both do,
    whatever their ids. Rows without an id come after all others: they stay
    where their component has no row with one. Of rows with equal id and text
    one stays, with the least hash of all its columns. All columns are kept
    as they are. An empty table gives no rows.
    """
    found = materialize(spark, _named(spark, fingerprints(spark, docs, shingle, text, doc_id, True), max_bits), "simhash-found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "th")).alias("s")
    stays = found.groupBy("root").agg(first).select("s.doc_id", "s.th")
    copies = found.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same = stays.doc_id.eqNullSafe(copies.doc_id) & (stays.th == copies.th)
    stays = stays.join(copies, same, "left").select(stays.doc_id.alias("_q_id"), stays.th.alias("_q_th"), F.col("n").isNotNull().alias("_q_again"))
    stays = materialize(spark, stays, "simhash-stays")
    own = (F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("_q_id"))) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_q_th"))
    kept = docs.join(stays, own)
    once = kept.where(~F.col("_q_again")).drop("_q_id", "_q_th", "_q_again")
    if stays.where("_q_again").isEmpty():
        return once
    again = kept.where("_q_again").withColumn("_q_row", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    again = materialize(spark, again, "simhash-again")
    least = again.groupBy("_q_id", "_q_th").agg(F.min("_q_row").alias("_q_least")).select(F.col("_q_id").alias("_q_i"), F.col("_q_th").alias("_q_t"), "_q_least")
    one = again.join(least, again._q_id.eqNullSafe(F.col("_q_i")) & (F.col("_q_th") == F.col("_q_t")) & (F.col("_q_row") == F.col("_q_least")))
    return once.union(one.select(*[F.col(f"`{c}`") for c in docs.columns]).dropDuplicates())


def hex16(fp):
    """The unsigned fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
