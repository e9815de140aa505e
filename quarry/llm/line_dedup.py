"""Line dedup: lines that many documents share are dropped everywhere.

Explode the normalised lines, hash them, count distinct documents per hash,
drop the lines over the threshold and reassemble each text by position.
DataFrame functions only.

What crosses the network: a 128-bit hash and the document's key per distinct
line for the count (combined on the map side, so a line of every third
document is a few rows per task), the same per line for the look-up, and
each text once, to meet the positions it loses. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import WHITE, ascii_lower, hash128, without


def line_key(line: Column) -> Column:
    """A line without surrounding white space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1)


def _row(doc_id: str, text: str) -> list[Column]:
    """What names a row: its id and a hash of its text, so that repeated ids
    with different texts never exchange line positions."""
    h1, h2 = hash128(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return [F.col(f"`{doc_id}`").alias("_q_doc"), h1.alias("_q_t1"), h2.alias("_q_t2")]


def common_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Hashes (_q_h1, _q_h2) of the keys found in ``min_docs`` documents."""
    distinct = F.array_distinct(F.transform(_lines(text), line_key))
    keys = docs.select(F.col(f"`{doc_id}`").alias("_q_doc"), F.explode(distinct).alias("_q_key")).where(F.length("_q_key") >= min_chars)
    h1, h2 = hash128(F.col("_q_key"))
    return (
        keys.select(h1.alias("_q_h1"), h2.alias("_q_h2"), F.struct("_q_doc").alias("_q_doc"))
        .groupBy("_q_h1", "_q_h2")
        .agg(F.count_distinct("_q_doc").alias("_q_n"))
        .where(F.col("_q_n") >= min_docs)
        .select("_q_h1", "_q_h2")
    )


def dedup_lines(
    spark: SparkSession, docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, and n_lines
    and n_dropped (both long, replacing input columns of these names).

    A null text is one empty line and comes back empty, as does an empty one
    or one that loses every line. Rows with a null id count as one document.
    Rows that repeat an id count as one document and are each rebuilt from
    their own text. An empty table gives no rows. Lines shorter than
    ``min_chars`` code points after normalising always stay.
    """
    # Written, not just planned: its exchange then stands alone under the
    # look-up join, where AQE can split the rows of a very common line, and
    # Spark knows its size when it chooses whether to broadcast it.
    common = materialize(spark, common_lines(docs, min_docs, min_chars, text, doc_id), "common-lines")
    keys = docs.select(*_row(doc_id, text), F.posexplode(F.transform(_lines(text), line_key)).alias("_q_pos", "_q_key"))
    h1, h2 = hash128(F.col("_q_key"))
    lost = (
        keys.where(F.length("_q_key") >= min_chars)
        .select("_q_doc", "_q_t1", "_q_t2", "_q_pos", h1.alias("_q_h1"), h2.alias("_q_h2"))
        .join(common, ["_q_h1", "_q_h2"], "left_semi")
        .groupBy("_q_doc", "_q_t1", "_q_t2")
        .agg(F.collect_set("_q_pos").alias("_q_lost"))
    )
    left = docs.select(*without(docs, [text, "n_lines", "n_dropped"]), *_row(doc_id, text), _lines(text).alias("_q_lines"))
    right = lost.select(F.col("_q_doc").alias("_q_r"), F.col("_q_t1").alias("_q_r1"), F.col("_q_t2").alias("_q_r2"), "_q_lost")
    same = F.col("_q_doc").eqNullSafe(F.col("_q_r")) & (F.col("_q_t1") == F.col("_q_r1")) & (F.col("_q_t2") == F.col("_q_r2"))
    # The small side is hashed: sorting whole texts for a merge is wasted.
    joined = left.join(right.hint("shuffle_hash"), same, "left")
    n = F.size("_q_lines")
    # array_except is one pass with a hash set, so a very long text stays linear.
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_q_lost"))
    kept = F.when(F.col("_q_lost").isNull(), F.col("_q_lines")).otherwise(F.transform(stay, lambda i: F.get("_q_lines", i)))
    out = joined.select(
        *[F.col(f"`{c}`").alias(c) for c in docs.columns if c.lower() not in (text.lower(), "n_lines", "n_dropped")],
        F.array_join(kept, "\n").alias(text),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("_q_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    # size() of a null array may be -1 under legacy settings.
    return out.withColumn("n_dropped", F.greatest(F.col("n_dropped"), F.lit(0).cast("long")))
