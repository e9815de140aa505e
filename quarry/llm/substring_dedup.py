"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words. A word goes if it lies in a window
whose words also start in a document of smaller id. The work is never done
on all windows of all texts:

1. Every window names a phrase of PHRASE words in it, the one whose hash is
   smallest. Equal windows name equal phrases, and a text has one such
   phrase in about 18 words. Phrases named in two documents recur; the rest
   of the texts is done with.
2. Recurring passages are confirmed. If all documents agree on everything
   around a phrase, its windows first occur where the phrase does. Otherwise
   the windows around it are hashed, and the smallest document of each is
   found by an aggregation that is combined on the map side.
3. Each document gets the phrases through which it repeats an earlier one
   (and, where contexts differ, which windows). A shard of documents
   compiles its phrases into one Aho-Corasick automaton and streams its
   documents through it, which locates every occurrence; located windows
   that were confirmed mark their words.

So texts cross the network twice (compressed), and no task holds more than a
shard: a phrase that very many documents share is one pattern per shard.
"""

from __future__ import annotations

import re
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import only, small_batches
from .ngrams import code_points, count_words, long_runs, runs, word_hashes

WINDOW = 50
PHRASE = 16
PASSAGE = ["key", "win", "doc", "phrase"]
_words = re.compile(r"[^\x20\x09-\x0D]+")


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x


class Windows:
    """The windows of one text: ``named`` holds the phrase each one names,
    ``hashes`` its own hash; [first[i], last[i]] are the runs of windows that
    name the same phrase."""

    def __init__(self, data: bytes, window: int):
        self.words, self.window, self.size = word_hashes(data), window, min(PHRASE, window)
        self.width = window - self.size + 1
        self.phrases = runs(self.words, self.size)
        self.named = _slide_min(self.phrases, self.width) if len(self.words) >= window else np.zeros(0, np.uint64)
        new = np.flatnonzero(np.append(len(self.named) > 0, self.named[1:] != self.named[:-1])) if len(self.named) else np.zeros(0, np.int64)
        self.first, self.last = new, np.append(new[1:], len(self.named))[: len(new)] - 1

    @cached_property
    def hashes(self) -> np.ndarray:
        return long_runs(self.phrases, self.size, self.window)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Phrase and a hash of all words around it, per run. The first and
        the last window of a run overlap, so they hold all its words."""
        a, b = (long_runs(self.phrases, self.size, self.window, at) for at in (self.first, self.last))
        around = a * np.uint64(0x9E3779B97F4A7C15) + b + (self.last - self.first).astype(np.uint64)
        return self.named[self.first].view(np.int64), around.view(np.int64)


def _named(docs: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for b in batches:
            keys, around, ids = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k, c = Windows((t or "").encode(), window).contexts()
                keys.append(k)
                around.append(c)
                ids.append(np.full(len(k), i, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*x, np.zeros(0, np.int64)])) for x in (keys, around, ids)], ["key", "around", "doc"])

    return docs.where("doc is not null").select("doc", "text").mapInArrow(run, "key long, around long, doc long")


def _compressed(docs: DataFrame, text: str) -> DataFrame:
    """All columns, the text as compressed UTF-8 (null for null)."""
    at = docs.columns.index(text)

    def run(batches):
        deflate = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            z = pa.array([None if t is None else deflate(t.encode()) for t in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([z if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    schema = docs.withColumn(text, F.lit(None).cast("binary")).schema
    return docs.mapInArrow(run, schema)


def _passages(dealt: DataFrame, window: int) -> DataFrame:
    """From (doc, text compressed, keys): the hash of each window that names a
    phrase of several contexts; and, from its first document, each phrase's
    words."""
    def run(batches):
        inflate = zstandard.ZstdDecompressor().decompress
        for b in batches:
            lists = b.column(2)
            at, (key, low, several) = lists.offsets.to_numpy(), (np.asarray(c) for c in lists.values.flatten())
            keys, wins, ids, told = [], [], [], []
            for i, (doc, z) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                data = inflate(z)
                win = Windows(data, window)
                mine = slice(at[i], at[i + 1])
                named = win.named.view(np.int64)
                differ = np.isin(named, key[mine][several[mine]])
                keys.append(named[differ])
                wins.append(win.hashes.view(np.int64)[differ])
                ids.append(np.full(len(keys[-1]), doc, np.int64))
                first = key[mine][low[mine] == doc]
                if len(first):
                    words = data.split()
                    found, where = np.unique(win.phrases.view(np.int64), return_index=True)
                    for k, p in zip(first.tolist(), where[np.minimum(np.searchsorted(found, first), len(found) - 1)].tolist()):
                        if win.phrases.view(np.int64)[p] == k:  # a repeated id may have it in its other text
                            told.append((k, doc, b" ".join(words[p : p + win.size]).decode()))
            keys, wins, ids = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (keys, wins, ids))
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(wins), pa.array(ids), pa.nulls(n, pa.string())], PASSAGE)
            if told:
                k, d, p = zip(*told)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.nulls(len(k), pa.int64()), pa.array(d, pa.int64()), pa.array(p, pa.string())], PASSAGE)

    return dealt.select("doc", "text", "keys").mapInArrow(run, "key long, win long, doc long, phrase string")


def _automaton(lists: list) -> ahocorasick.Automaton | None:
    """One for the phrases of a shard of documents."""
    automaton = ahocorasick.Automaton()
    for phrases in lists:
        for p in phrases or ():
            automaton.add_word(f" {p['phrase']} ", p["key"])
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def covered(data: bytes, phrases: list[dict], automaton: ahocorasick.Automaton, window: int) -> np.ndarray:
    """Which words lie in a confirmed window around a located phrase."""
    win = Windows(data, window)
    line = f" {b' '.join(data.split()).decode()} "  # bytes.split() cuts at the white space of the contract
    blanks = np.flatnonzero(code_points(line) == 32)
    known = {p["key"]: p["wins"] for p in phrases}
    hits = [(end, key) for end, key in automaton.iter(line) if key in known]
    at: dict[int, list[int]] = {}
    # A pattern ends with the blank after its last word.
    for word, (_, key) in zip(np.searchsorted(blanks, np.array([e for e, _ in hits], np.int64)).tolist(), hits):
        at.setdefault(key, []).append(word - min(PHRASE, window))
    n = len(win.words)
    marks = np.zeros(n + 1, np.int64)
    for key, i, j in zip(win.named[win.first].view(np.int64).tolist(), win.first.tolist(), win.last.tolist()):
        # The phrase must have been located inside the run's windows.
        if key not in at or not any(i <= p < j + win.width for p in at[key]):
            continue
        wins = known[key]
        hit = np.arange(i, j + 1) if wins is None else i + np.flatnonzero(np.isin(win.hashes[i : j + 1].view(np.int64), np.array(wins, np.int64)))
        np.add.at(marks, hit, 1)
        np.add.at(marks, np.minimum(hit + window, n), -1)
    return np.cumsum(marks[:-1]) > 0


def cut(text: str, gone: np.ndarray) -> str:
    """The text without the words marked in ``gone``; what stays keeps its
    white space, and a cut leaves the white space before it."""
    out, start, spans = [], 0, [m.span() for m in _words.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        out.append(text[start : spans[a][0]])
        start = spans[b][0] if b < len(spans) else len(text)
    return "".join(out) + text[start:]


def dedup_substrings(spark: SparkSession, docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` cut, and n_words and n_removed (both long,
    replacing input columns of these names).

    A null text stays null and has no words; texts of fewer than ``window``
    words, blank ones among them, stay as they are. Rows with a null id are
    never cut and never count as earlier. Rows that repeat an id are the
    same document: neither is earlier than the other, and each is judged by
    its own text. An empty table gives no rows.
    """
    small_batches(spark)
    docs = docs.select([c for c in docs.columns if c.lower() not in ("n_words", "n_removed")])
    text, doc_id = (next(c for c in docs.columns if c.lower() == x.lower()) for x in (text, doc_id))
    slim = only(docs, doc=doc_id, text=text).withColumn("doc", F.col("doc").cast("long"))

    named = materialize(spark, _named(slim, window), "phrases-named")
    ends = named.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), (F.min("around") != F.max("around")).alias("several"))
    recurring = materialize(spark, ends.where("low < high").select("key", "low", "several"), "phrases-recurring")
    # Joined on the phrase: AQE splits the rows of a very common one.
    met = named.select("key", "doc").join(recurring, "key").distinct()
    met = materialize(spark, met, "phrases-met")
    lists = met.groupBy("doc").agg(F.collect_list(F.struct("key", "low", "several")).alias("keys"))

    dealt = _compressed(slim.where("doc is not null and text is not null"), "text").join(lists.hint("shuffle_hash"), "doc")
    passages = materialize(spark, _passages(dealt, window), "passages")
    phrases = passages.where("phrase is not null").groupBy("key").agg(F.min("phrase").alias("phrase"))
    phrases = materialize(spark, phrases, "phrases")
    windows = passages.where("win is not null").select("key", "win", "doc")
    first = windows.groupBy("key", "win").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key", "win", "low")
    first = materialize(spark, first, "windows-first")
    again = windows.join(first, ["key", "win"]).where("low < doc").groupBy("doc", "key").agg(F.collect_set("win").alias("wins"))
    whole = met.where("not several and low < doc").select("doc", "key", F.lit(None).cast("array<long>").alias("wins"))
    patterns = whole.union(again).join(phrases, "key").groupBy("doc").agg(F.collect_list(F.struct("key", "phrase", "wins")).alias("phrases"))

    columns = docs.columns
    out = _compressed(docs.withColumn("_q_doc", F.col(f"`{doc_id}`").cast("long")), text)
    out = out.join(patterns.select(F.col("doc").alias("_q_match"), F.col("phrases").alias("_q_phrases")).hint("shuffle_hash"), F.col("_q_doc") == F.col("_q_match"), "left")
    out = out.select(*[F.col(f"`{c}`") for c in columns], "_q_phrases")
    at = columns.index(text)

    def run(batches):
        inflate = zstandard.ZstdDecompressor().decompress
        for b in batches:
            lists = b.column(len(columns)).to_pylist()
            automaton = _automaton(lists)
            texts, n_words, n_removed = [], [], []
            for z, phrases in zip(b.column(at).to_pylist(), lists):
                data = None if z is None else inflate(z)
                removed, t = 0, None if data is None else data.decode()
                if phrases:
                    gone = covered(data, phrases, automaton, window)
                    removed = int(gone.sum())
                    if removed:
                        t = cut(t, gone)
                texts.append(t)
                n_words.append(count_words(data or b""))
                n_removed.append(removed)
            kept = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], [*columns, "n_words", "n_removed"])

    schema = docs.withColumn(text, F.lit("")).select(*[F.col(f"`{c}`") for c in columns], F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed")).schema
    for f in schema.fields:
        f.nullable = True
    return out.mapInArrow(run, schema)
