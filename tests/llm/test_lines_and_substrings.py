"""Line dedup and substring dedup against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import line_dedup, substring_dedup

WHITE = " \t\n\x0b\x0c\r"
DOC = "doc_id long, text string"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_lines(rows, min_docs):
    owners = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            owners.setdefault(lower(x.strip(WHITE)), set()).add(d)
    gone = {k for k, v in owners.items() if k and len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if lower(x.strip(WHITE)) not in gone]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def lines(spark, rows, min_docs=3):
    out = line_dedup.dedup_lines(spark, spark.createDataFrame(rows, DOC), min_docs=min_docs)
    return sorted(map(tuple, out.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def test_lines_random(spark):
    rng = random.Random(1)
    pool = ["a", "A ", "\tb\x0b", "b", "", " ", "é", "É", "long line here", "x y", "x  y", "\x1cz"]
    rows = [(i, "\n".join(rng.choice(pool + [f"own {i}"]) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    assert lines(spark, rows, 12) == brute_lines(rows, 12)


def test_lines_edges(spark):
    # nulls in any column, empty texts, an exact tie with the threshold,
    # repeated rows, one id with two texts, null ids as one document
    rows = [(1, None), (2, ""), (3, "tie\nq\n"), (4, "TIE"), (5, " tie \nw"), (5, " tie \nw"), (6, "w"), (6, "w\nu"), (None, "u"), (None, "u"), (None, None)]
    assert lines(spark, rows) == brute_lines(rows, 3)
    assert lines(spark, []) == []


def test_lines_very_long_and_hot(spark):
    rows = [(i, "hot\n" + "\n".join(f"{i} {k}" for k in range(3))) for i in range(300)] + [(1000, "\n".join(["hot"] * 5000 + ["x"] * 5000))]
    assert lines(spark, rows) == brute_lines(rows, 3)


def test_lines_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 7, "h", 1.5), (2, "a", 8, "h", 2.5)], "doc_id long, text string, n_lines int, _q_key string, `a b` double")
    out = line_dedup.dedup_lines(spark, df, min_docs=2)
    assert sorted(map(tuple, out.select("doc_id", "text", "n_lines", "_q_key", "`a b`").collect())) == [(1, "", 1, "h", 1.5), (2, "", 1, "h", 2.5)]


def brute_windows(rows, w):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    low = {}
    for d, x in words:
        if d is not None:
            for i in range(len(x) - w + 1):
                k = tuple(x[i : i + w])
                low[k] = min(low.get(k, d), d)
    out = []
    for (d, x), (_, t) in zip(words, rows):
        gone = set()
        if d is not None:
            for i in range(len(x) - w + 1):
                if low[tuple(x[i : i + w])] < d:
                    gone.update(range(i, i + w))
        out.append((d, len(x), len(gone), " ".join(v for i, v in enumerate(x) if i not in gone)))
    return sorted(out, key=repr)


def windows(spark, rows, w):
    out = substring_dedup.dedup_substrings(spark, spark.createDataFrame(rows, DOC), window=w)
    return sorted(((r.doc_id, r.n_words, r.n_removed, " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in out.collect()), key=repr)


@pytest.mark.parametrize("w", [3, 20, 50])
def test_windows_random(spark, w):
    rng = random.Random(w)
    words = [f"w{i}" for i in range(12 if w == 3 else 400)]
    passages = [[rng.choice(words) for _ in range(rng.randint(w - 1, 3 * w))] for _ in range(6)]
    rows = []
    for d in rng.sample(range(1000), 60):
        x = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p))
            x += p[a : a + rng.randint(0, 2 * w)] if rng.random() < 0.5 else p
            x += [rng.choice(words) for _ in range(rng.randint(0, w))]
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(x)))
    rows += [(2000, rows[3][1]), (2001, rows[3][1])]
    assert windows(spark, rows, w) == brute_windows(rows, w)


def test_windows_edges(spark):
    p = " ".join(f"p{i}" for i in range(30))
    rows = [
        (1, None), (2, ""), (3, "  \n "), (4, p), (5, "x " + p + " y"), (5, p), (6, p), (6, p), (None, p), (None, p),
        (7, " ".join(["same"] * 500)), (8, " ".join(["same"] * 21)), (9, "a" * 100_000 + " " + p), (10, p.replace("p5", "p5\x1c")), (-1, "p0 p1"),
    ]
    assert windows(spark, rows, 20) == brute_windows(rows, 20)
    assert windows(spark, [], 20) == []


def test_windows_keep_white_space_and_columns(spark):
    p = " ".join(f"p{i}" for i in range(20))
    df = spark.createDataFrame([(1, p, 5, "k"), (2, "head\n\n" + p + "\n tail  end", 6, None)], "doc_id long, text string, n_words int, key string")
    out = {r.doc_id: r for r in substring_dedup.dedup_substrings(spark, df, window=20).collect()}
    assert out[1].text == p and out[1].key == "k"
    assert out[2].text == "head\n\ntail  end" and out[2].n_removed == 20 and out[2].n_words == 23


def test_contexts_that_differ(spark):
    """One phrase in very many documents, each with other words around it."""
    rng = random.Random(5)
    core = " ".join(f"c{i}" for i in range(25))
    rows = [(i, " ".join(f"v{rng.randint(0, 9)}" for _ in range(6)) + " " + core + " " + " ".join(f"v{rng.randint(0, 9)}" for _ in range(6))) for i in range(400)]
    assert windows(spark, rows, 20) == brute_windows(rows, 20)


def test_no_text_is_scanned_for_nothing(spark):
    """Each text is read for phrases once; texts that repeat nothing carry
    no pattern."""
    df = spark.createDataFrame([(i, " ".join(f"u{i}x{k}" for k in range(60))) for i in range(20)], DOC)
    assert substring_dedup.dedup_substrings(spark, df).agg(F.sum("n_removed")).first()[0] == 0
