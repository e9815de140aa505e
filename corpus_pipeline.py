"""A corpus pipeline over ``documents``, from raw rows to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it again as
the next stage's input, so a lost executor never costs a finished stage.
All but the last stage return the columns of ``documents``; n_chars follows
the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import line_dedup, packing, quality, simhash, substring_dedup
from quarry.llm.common import read
from quarry.llm.queries import vocabulary
from quarry.session import new_work_dir

# The stages end in cut and packed texts, which SQL cannot express (a fitted
# classifier, tokenizers); tests/llm holds them against brute force.
ORACLE_SQL = None


def _rewritten(docs: DataFrame, operator) -> DataFrame:
    """``docs`` with the texts that ``operator`` gives: all columns come
    back, n_chars for the text as it is now. Columns the operator does not
    need pass through it under other names, so none clashes with its own."""
    aside = {c: c if c in ("doc_id", "text") else f"_p_{i}" for i, c in enumerate(docs.columns)}
    out = operator(docs.toDF(*aside.values()))
    n = F.length("text").cast("long").alias("n_chars")
    return out.select(*[n if c == "n_chars" else F.col(a).alias(c) for c, a in aside.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the classifier reject go."""
    model = quality.train(spark, docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(spark, docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go; every document stays."""
    return _rewritten(docs, lambda d: line_dedup.dedup_lines(spark, d, min_docs=10, min_chars=1))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of smallest id."""
    return simhash.keep_one(spark, docs, shingle=3, max_bits=2)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the first document only."""
    return _rewritten(docs, lambda d: substring_dedup.dedup_substrings(spark, d, window=50))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, ids included."""
    return packing.pack(spark, docs, vocabulary("word_bpe_49k.json"), size=2048, end=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_work_dir(spark, name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
