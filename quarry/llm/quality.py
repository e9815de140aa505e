"""Quality rules: base counts, and a logistic regression over hashed word
and character n-grams, calibrated and held against a fixed threshold.

The model is fitted on a bounded sample of the labelled rows (MAX_LABELLED,
chosen by a hash of doc_id), four fifths for the weights and one fifth for
the calibration. Features of the sample are made by tasks; the driver holds
them as sparse counts only. Scoring runs over Arrow batches of whole texts
without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import WHITE, only, small_batches
from .ngrams import buckets, char_grams, code_points, runs, word_hashes

BITS = 15  # buckets of each kind of n-gram: 2**15
KINDS = ("word 1", "word 2", "char 2", "char 3")
MAX_LABELLED = 2500
THRESHOLD = 0.25  # low, so that clean documents stay
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
L2 = 1e-4
MAX_STEPS = 200  # of the fit, which stops where the gradient is
SLOPE = 0.02  # this part of what it was at first
MAX_BYTES = 64 << 20  # of the sample's features, on the driver
CHUNK = 1 << 20  # code points hashed at a time
SYMBOLS = "#*$%&|<>"  # fixed by the rule
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE.encode())] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    words = word_hashes(data)
    lines = [x for x in text.split("\n") if x.strip(WHITE)] if "\n" in text else []
    return (
        len(words),
        len(text) - int(_WHITE[raw].sum()),
        int(_SYMBOL[raw].sum()),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def repeat_words(words: np.ndarray) -> int:
    """Words in a 3-word window that the text holds twice or more."""
    windows = runs(words, 3)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : len(windows) + i] |= again
    return int(covered.sum())


def _base_failed(stats: tuple, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> bool:
    return stats[0] < min_words or 100 * stats[4] > max_repeat_percent * stats[0]


def gram_counts(text: str | None):
    """For each kind in turn: the bucket of every n-gram of the whole text
    (char n-grams in chunks that overlap, so memory stays bounded)."""
    if not text:
        return
    words = word_hashes(text.encode())
    yield 0, buckets(words, BITS)
    yield 1, buckets(runs(words, 2), BITS)
    points = code_points(text)
    for at in range(0, len(points), CHUNK):
        for kind, n in ((2, 2), (3, 3)):
            yield kind, buckets(char_grams(points[at : at + CHUNK + n - 1], n), BITS)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse (index, share of its kind's n-grams) of a text."""
    counts: dict[int, np.ndarray] = {}
    for kind, got in gram_counts(text):
        counts[kind] = counts.get(kind, 0) + np.bincount(got, minlength=1 << BITS)
    index, value = [], []
    for kind, c in counts.items():
        at = np.flatnonzero(c)
        if len(at):
            index.append(at + (kind << BITS))
            value.append(c[at] / c.sum())
    if not index:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(index).astype(np.int32), np.concatenate(value).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _fit(index, value, start, y) -> tuple[np.ndarray, float]:
    """Weights and bias, by full-batch Adam on the balanced logistic loss,
    until the gradient has fallen to SLOPE of the first one."""
    size = len(KINDS) << BITS
    rows = np.repeat(np.arange(len(y)), np.diff(np.append(start, len(index))))
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    steep = None
    for step in range(1, MAX_STEPS + 1):
        z = np.bincount(rows, w[index] * value, minlength=len(y)) + w[-1]
        r = (_sigmoid(z) - y) * weight
        g = np.append(np.bincount(index, value * r[rows], minlength=size) + L2 / size * w[:-1], r.sum())
        norm = float(np.sqrt(g @ g))
        steep = norm if steep is None else steep
        if norm <= SLOPE * steep:
            break
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.5 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities, by Newton
    steps on smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = z.std() or 1.0
    x = np.stack([z / scale, np.ones(len(z))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ b)
        h = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (b - [1.0, 0.0]))
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(b[0], 1e-3) / scale), float(b[1])


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, text: str = "text", doc_id: str = "doc_id", label: str = "quality"
) -> dict | None:
    """The model, or None where the labels hold fewer than two classes.

    Rows of ``labels`` with a null id or label are left out; an id labelled
    twice counts with its highest label. Labelled ids without a document
    teach nothing; of a labelled id with several rows, the text of smallest
    hash does. Null texts teach nothing, empty ones that they have no n-gram.
    The driver holds the features of at most max_labelled texts and
    MAX_BYTES: texts are taken in the order of a hash of their id, and one
    that no longer fits is passed over. Other columns are ignored.
    """
    small_batches(spark)
    known = only(labels, doc_id=doc_id, y=label).where("doc_id is not null and y is not null")
    known = known.groupBy("doc_id").agg(F.max((F.col("y") > 0).cast("int")).alias("y"))
    total = known.count()
    if not total:
        return None
    share = min(1.0, 0.95 * max_labelled / total)  # the bound holds with room for chance
    place = F.xxhash64("doc_id", F.lit("quality")).bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)
    sample = known.where(place < share).limit(max_labelled)  # at most max_labelled rows, so it may be broadcast
    own = only(docs, doc_id=doc_id, text=text).where("text is not null").withColumn("h", F.xxhash64("text")).join(F.broadcast(sample), "doc_id")
    one = own.groupBy("doc_id").agg(F.min("h").alias("h"))  # at most max_labelled rows too
    own = own.join(F.broadcast(one), ["doc_id", "h"])  # copies of that text remain

    def run(batches):
        seen = set()  # a task gives one row of each sampled id
        for b in batches:
            ids, new = b.column(0).to_pylist(), []
            for i, d in enumerate(ids):
                if d not in seen:
                    seen.add(d)
                    new.append(i)
            b = b.take(pa.array(new, pa.int64()))
            got = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([v.tobytes() for _, v in got], pa.binary())], ["doc_id", "y", "i", "v"]
            )

    found = own.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y").mapInArrow(run, "doc_id long, y int, i binary, v binary")
    found = materialize(spark, found.groupBy("doc_id").agg(F.min(F.struct("y", "i", "v")).alias("f")).select("doc_id", "f.*"), "quality-features")
    sizes = found.select("doc_id", (F.length("i") + F.length("v")).alias("n")).orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").collect()
    room, taken = MAX_BYTES, []
    for r in sizes:  # at most max_labelled numbers
        if r.n <= room:
            room -= r.n
            taken.append(r.doc_id)
    rows = found.where(F.col("doc_id").isin(taken)).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.i), bytes(r.v)))
    y = np.array([r.y for r in rows], float)
    if len(set(y)) < 2:
        return None
    at = [np.frombuffer(r.i, np.int32) for r in rows]
    share = [np.frombuffer(r.v, np.float32) for r in rows]
    held = np.array([r.doc_id % 5 == 4 for r in rows])
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:  # too few to hold any out
        held[:] = False
    use = np.flatnonzero(~held)
    w, bias = _fit(np.concatenate([at[i] for i in use]), np.concatenate([share[i] for i in use]), np.cumsum([0] + [len(at[i]) for i in use])[:-1], y[use])
    check = np.flatnonzero(held) if held.any() else use
    z = np.array([w[at[i]] @ share[i] + bias for i in check])
    slope, offset = _platt(z, y[check])
    return {"weights": w.astype(np.float32), "bias": bias, "slope": slope, "offset": offset}


def probability(model: dict, text: str | None) -> float:
    """The calibrated probability of good quality."""
    z, sums, n = model["bias"], [0.0] * len(KINDS), [0] * len(KINDS)
    for kind, got in gram_counts(text):
        sums[kind] += float(model["weights"][got + (kind << BITS)].sum(dtype=np.float64))
        n[kind] += len(got)
    z += sum(s / m for s, m in zip(sums, n) if m)
    return float(_sigmoid(model["slope"] * z + model["offset"]))


def score(
    spark: SparkSession,
    docs: DataFrame,
    model: dict | None,
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Per row of ``docs``: doc_id, the five base counts (long), base_failed,
    quality (the probability; null without a model) and kept.

    A null or empty text has no words and fails. Without a model the base
    rules alone decide. Ids may be null or repeat; rows are judged one by
    one and never dropped here. Other columns are ignored.
    """
    small_batches(spark)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            stats = [base_stats(t) for t in texts]
            failed = [_base_failed(s, min_words, max_repeat_percent) for s in stats]
            p = [None if model is None else probability(model, t) for t in texts]
            kept = [not f and (q is None or q >= threshold) for f, q in zip(failed, p)]
            columns = [b.column(0), *[pa.array([s[i] for s in stats], pa.int64()) for i in range(5)]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(failed), pa.array(p, pa.float64()), pa.array(kept)], ["doc_id", *STATS, "base_failed", "quality", "kept"])

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in STATS) + ", base_failed boolean, quality double, kept boolean"
    return only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, schema)


def keep_good(
    spark: SparkSession,
    docs: DataFrame,
    model: dict | None,
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, all columns as they are;
    the verdict is made from the row itself, so no join is needed. Null and
    empty texts go (they have no words); repeated rows are judged alike, ids
    are not looked at; an empty table stays empty."""
    small_batches(spark)
    at = [c.lower() for c in docs.columns].index(text.lower())

    def run(batches):
        for b in batches:
            kept = []
            for t in b.column(at).to_pylist():
                s = base_stats(t)
                kept.append(not _base_failed(s, min_words, max_repeat_percent) and (model is None or probability(model, t) >= threshold))
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
