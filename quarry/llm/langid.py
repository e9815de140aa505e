"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter is an array of language bitmasks: an n-gram of
language l sets bit l at K hashed places, and the AND of the masks at its
places gives all languages that (seem to) hold it. A document's vote for l
is the popcount of bit l over its n-grams, corrected for the false positives
that l's share of set bits lets expect. The most votes decide.

The filter is fitted on a bounded sample of each language's labelled
documents (MAX_DOCS, by a hash of doc_id) and holds every n-gram of theirs.
Its size follows the language with the most n-grams, so that about FILL of
its places are set, up to MAX_BYTES; beyond, it only gets fuller, which the
correction allows for, and still holds all. Every text is scored whole, in
Arrow batches, without a shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import only, small_batches
from .ngrams import char_grams, code_points, has_letter

SIZES = (3, 4)  # n of the n-grams
PLACES = 3  # K
BITS = 18  # 2**18 masks at least
FILL = 0.3  # share of a language's bits that should be set
MAX_BYTES = 64 << 20  # of the filter
MAX_DOCS = 1000
WORD = 32  # languages in one column of masks while they are gathered
CHUNK = 1 << 19
UNKNOWN = "und"
_LETTER = np.ones(128, bool)
_LETTER[[c for c in range(128) if not chr(c).isalpha()]] = False


def grams(text: str):
    """64-bit hashes of the character n-grams around letters, in chunks;
    case is folded and whatever ASCII holds beside letters is a blank."""
    points = code_points(" " + text.lower() + " ").copy()
    low = points < 128
    points[low & ~_LETTER[np.where(low, points, 0)]] = 32
    blank = points == 32
    points = points[~(blank & np.append(False, blank[:-1]))]  # one blank for many
    for n in SIZES:
        for at in range(0, len(points), CHUNK):
            part = points[at : at + CHUNK + n - 1]
            inner = part[1 : len(part) - n + 2] != 32
            yield char_grams(part, n)[inner[: max(0, len(part) - n + 1)]]


def places(hashes: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """The K places of each n-gram among 2**bits."""
    h = hashes ^ (hashes >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    mask = np.uint64((1 << bits) - 1)
    if PLACES * bits + 5 <= 64:
        return [((h >> np.uint64(bits * i + 5)) & mask).astype(np.int64) for i in range(PLACES)]
    # Two hashes make all places, as one has too few bits.
    step = (h * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
    return [(((h + np.uint64(i) * step) >> np.uint64(64 - bits)) & mask).astype(np.int64) for i in range(PLACES)]


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents no model may learn from: crc32 of the id's digits mod 3 is
    1. A null id is not held out, and never learnt from either."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string")), F.lit(3)) == 1, F.lit(False))


def train(
    spark: SparkSession, docs: DataFrame, max_docs: int = MAX_DOCS, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> dict | None:
    """The filter, from the rows of ``docs`` with an id, a language and a
    text that are not held out; None if there are none. Repeated rows teach
    as often as they are there, which changes nothing: an n-gram is held or
    not. Other columns are ignored. The driver gets one number a language
    and the filter, at most MAX_BYTES (or 2**BITS masks)."""
    small_batches(spark)
    own = only(docs, doc_id=doc_id, text=text, lang=lang).where(~held_out("doc_id")).where("doc_id is not null and text is not null and lang is not null")
    # One number per language comes to the driver.
    totals = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("lang").alias("n")).collect()}
    if not totals:
        return None
    langs = sorted(totals)
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, max_docs / totals[k])))]), F.col("lang"))
    place = F.xxhash64("doc_id", F.lit("langid")).bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)
    code = F.element_at(F.create_map(*[x for i, k in enumerate(langs) for x in (F.lit(k), F.lit(i))]), F.col("lang"))
    sample = own.where(place < share).select("text", code.alias("code"))

    def held(batches):
        """(language, n-gram) of each batch, once each."""
        for b in batches:
            sets: dict[int, list[np.ndarray]] = {}
            for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sets.setdefault(c, []).extend(grams(t))
            for c, parts in sets.items():
                gram = np.unique(np.concatenate([*parts, np.zeros(0, np.uint64)]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), c, np.int32)), pa.array(gram.view(np.int64))], ["code", "gram"])

    found = materialize(spark, sample.mapInArrow(held, "code int, gram long").distinct(), "langid-grams")
    most = max((r["n"] for r in found.groupBy("code").agg(F.count("gram").alias("n")).collect()), default=1)
    width = (len(langs) + 7) // 8
    bits = max(BITS, math.ceil(math.log2(max(1.0, -PLACES * most / math.log(1 - FILL)))))
    while bits > BITS and (width << bits) > MAX_BYTES:
        bits -= 1

    def spots(batches):
        for b in batches:
            code = b.column(0).to_numpy()
            at = np.concatenate(places(b.column(1).to_numpy().view(np.uint64), bits))
            word = np.tile(code // WORD, PLACES)
            bit = np.left_shift(np.int64(1), np.tile(code % WORD, PLACES).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(word.astype(np.int32)), pa.array(bit)], ["at", "word", "bit"])

    set_ = found.mapInArrow(spots, "at long, word int, bit long").groupBy("at", "word").agg(F.bit_or("bit").alias("mask")).toPandas()
    masks = np.zeros((1 << bits, width), np.uint8)
    for word, own in set_.groupby("word"):
        raw = own["mask"].to_numpy(np.uint32).astype("<u4").view(np.uint8).reshape(-1, WORD // 8)
        low = word * (WORD // 8)
        masks[own["at"].to_numpy(), low : low + WORD // 8] = raw[:, : width - low]
    fill = np.unpackbits(masks, axis=1, bitorder="little")[:, : len(langs)].mean(axis=0)
    common = max(langs, key=lambda k: (totals[k], k))
    return {"langs": langs, "masks": masks, "bits": bits, "chance": fill**PLACES, "common": langs.index(common)}


def identify(model: dict | None, text: str | None) -> tuple[str, float]:
    """The language and its share of all corrected votes."""
    if text is None or model is None or not has_letter(text):
        return UNKNOWN, 0.0
    langs, masks = model["langs"], model["masks"]
    n, votes = 0, np.zeros(8 * masks.shape[1])
    for hashes in grams(text):
        at = places(hashes, model["bits"])
        got = masks[at[0]]
        for p in at[1:]:
            got &= masks[p]
        votes += np.unpackbits(got, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    chance = model["chance"]
    votes = np.maximum(0.0, (votes[: len(langs)] - n * chance) / np.maximum(1e-9, 1 - chance))
    total = votes.sum()
    if not total:
        return langs[model["common"]], 0.0
    best = int(votes.argmax())  # ties: the first in name order
    return langs[best], float(votes[best] / total)


def predict(spark: SparkSession, docs: DataFrame, model: dict | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``.

    A null text, or one without a letter, is ``und`` with score 0, as is
    every text where no language could be learnt. A text without a known
    n-gram gets the most frequent language with score 0. Ids may be null or
    repeat. Other columns, ``lang`` among them, are never read.
    """
    small_batches(spark)

    def run(batches):
        for b in batches:
            got = [identify(model, t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    own = only(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text")
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
