"""Vector codes against the same rounds in plain Python."""

import hashlib
import math
import random

import pytest

from quarry.llm import vector_codes
from quarry.llm.vector_codes import compress, digest

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, rounds=4, entries=256):
    keep = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    dim = -(-max((len(r[1]) for r in keep), default=0) // 4) * 4
    whole = lambda x: math.floor(x * 1024) if abs(x) < 2**60 else int(x) * 1024
    vecs = [(r[0], r[2], [whole(x) for x in r[1]] + [0] * (dim - len(r[1]))) for r in keep]
    order = sorted(range(len(vecs)), key=lambda i: (vecs[i][0] is None, vecs[i][0] or 0, keep[i][1]))
    w = dim // 4
    books = [[vecs[i][2][p * w : (p + 1) * w] for i in order[:entries]] for p in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds if dim else 0):
        for p in range(4):
            parts: dict = {}
            for _, _, v in vecs:
                part = v[p * w : (p + 1) * w]
                parts.setdefault(near(part, books[p])[1], []).append(part)
            for i, group in parts.items():
                books[p][i] = [sum(c) // len(group) for c in zip(*group)]
    out = []
    for c, label, v in vecs:
        found = [near(v[p * w : (p + 1) * w], books[p]) for p in range(4)]
        out.append((c, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
    sums: dict = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    text = ",".join(str(x) for p in range(4) for e in books[p] for x in e)
    return sorted(((c, code, e, sums[label]) for c, code, e, label in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, **kw):
    codes, books = compress(spark, spark.createDataFrame(rows, SCHEMA), **kw)
    got = sorted(map(tuple, codes.select("vec_id", "code", "error", "label_error").collect()), key=repr)
    want, sha = brute(rows, **kw)
    assert got == want
    assert digest(books) == sha


def vectors(seed, n, dim, grain=0.25):
    r = random.Random(seed)
    return [(i, [r.randrange(-8, 8) * grain for _ in range(dim)], r.choice([0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("rows, kw", [(vectors(1, 60, 8), {"entries": 4}), (vectors(2, 40, 4, 0.5), {"entries": 16, "rounds": 2}), (vectors(3, 300, 4), {})])
def test_equals_plain_rounds(spark, rows, kw):
    # Few values, so that distances tie and vectors repeat.
    check(spark, rows, **kw)


def test_nulls_repeats_and_lengths(spark):
    rows = vectors(4, 20, 8)
    rows += [(5, None, 1), (6, [None] * 8, 1), (7, [math.nan] * 8, 1), (8, [math.inf] * 8, 1), (9, [0.1] * 3, 1), (9, [0.1] * 3, 1), (9, [], None), (None, [0.5] * 8, 0)]
    check(spark, rows, entries=5)
    check(spark, [(1, [], 1), (2, [], None)])


def test_more_vectors_than_a_batch_and_a_hot_copy(spark):
    rows = vectors(5, 300, 4) + [(1000 + i, [0.25, 0.5, 0.75, 1.0], 7) for i in range(5000)]
    check(spark, rows, entries=8, rounds=2)


def test_large_components_are_exact(spark):
    check(spark, [(i, [i * 1e5, -1e5 * i, 3.7, 1e4], 0) for i in range(30)], entries=3)
    codes, books = compress(spark, spark.createDataFrame([(1, [1e30] * 4, 0), (2, [1e30] * 4, 0), (3, [0.0] * 4, 0)], SCHEMA), entries=2)
    assert [(r.vec_id, r.code, r.error) for r in codes.orderBy("vec_id").collect()][:2] == [(1, "01010101", 0), (2, "01010101", 0)]


def test_an_error_that_is_no_long_is_null(spark):
    codes, _ = compress(spark, spark.createDataFrame([(1, [1e30] * 4, 0), (2, [0.0] * 4, 0)], SCHEMA), entries=1, rounds=1)
    assert [r.error for r in codes.collect()] == [None, None]


def test_empty_and_clashing_columns(spark):
    codes, books = compress(spark, spark.createDataFrame([], SCHEMA))
    assert codes.collect() == [] and digest(books) == hashlib.sha256(b"").hexdigest()
    rows = vectors(6, 30, 4)
    df = spark.createDataFrame([(*r, "a", 1, 2.0) for r in rows], SCHEMA + ", code string, x int, `Error` double")
    got = sorted(map(tuple, compress(spark, df, entries=4)[0].select("vec_id", "code", "error", "label_error").collect()), key=repr)
    assert got == brute(rows, entries=4)[0]


def test_entries_fit_two_digits(spark):
    with pytest.raises(ValueError):
        vector_codes.compress(spark, spark.createDataFrame([], SCHEMA), entries=300)
