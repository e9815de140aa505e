"""SimHash fingerprints, covering tables, links and components against brute force."""

import random
import re

from xxhash import xxh64_intdigest

from quarry.llm import simhash
from quarry.llm.components import connected_components

DOC = "doc_id long, text string"


def brute_fingerprint(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    h = [xxh64_intdigest(" ".join(s).encode(), 42) for s in (zip(*[w[i:] for i in range(k)]) if len(w) >= k else [w])]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def closure(nodes, edges):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "one TWO", "É é x\x1cy z", "a " * 9000, "word" * 5000]
    texts += [" ".join(rng.choice("ab cd Ef gh éa".split()) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_masks_cover_the_radius():
    rng = random.Random(4)
    for r in (1, 2, 3):
        masks = simhash.masks(r)
        assert len(masks) == 2 ** (r + 1) - 1
        for _ in range(3000):
            flips = sum(1 << i for i in rng.sample(range(64), rng.randint(0, r)))
            assert any(not flips & m for m in masks)


def test_links_reach_exactly_what_is_near(spark):
    rng = random.Random(6)
    for r in (1, 2, 3):
        values = {rng.getrandbits(64) for _ in range(30)}
        for v in list(values):  # chains and clouds, some just out of reach
            for _ in range(rng.randint(0, 6)):
                v ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, r + 1)))
                values.add(v)
        values |= {0, 1, 3, 7, (1 << 64) - 1}
        signed = [simhash._signed(v) for v in values]
        near = [(a, b) for a in values for b in values if a < b and bin(a ^ b).count("1") <= r]
        got = [(x.a % 2**64, x.b % 2**64) for x in simhash.links(spark, spark.createDataFrame([(s,) for s in signed], "fp long"), r).collect()]
        assert all(bin(a ^ b).count("1") <= r for a, b in got)
        assert closure(values, got) == closure(values, near)


def test_near_duplicates_end_to_end(spark):
    rng = random.Random(7)
    base = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(400)) for _ in range(8)]
    rows = []
    for d in rng.sample(range(10_000), 80):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = f"w{rng.randint(0, 500)}"
        rows.append((d, " ".join(w)))
    rows += [(20_001, None), (20_002, ""), (20_003, " "), (20_001, None)]
    prints = {d: brute_fingerprint(t) for d, t in rows}
    near = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    roots = closure(prints, near)
    got = simhash.near_duplicates(spark, spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == sorted((d, prints[d], roots[d]) for d, _ in rows)
    kept = simhash.keep_one(spark, spark.createDataFrame(rows, DOC)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(roots.values()))


def test_keep_one_edges(spark):
    rows = [(3, "b", 1), (3, "a", 2), (5, "a", 3), (None, "a", 4), (None, "zz", 5), (9, "q r s t", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = sorted(map(tuple, simhash.keep_one(spark, df).collect()), key=repr)
    # "a" of id 3 is the one of its component; "b" of id 3 is no copy of anything.
    assert kept == sorted([(3, "a", 2), (3, "b", 1), (9, "q r s t", 6), (None, "zz", 5)], key=repr)
    # Copies under no id, and rows that repeat id and text.
    more = spark.createDataFrame([(None, "x y", 1), (None, "x y", 2), (4, "k l", 3), (4, "k l", 4), (4, "k l", 4)], "doc_id long, text string, n int")
    kept = [tuple(r) for r in simhash.keep_one(spark, more).collect()]
    assert sorted(r[:2] for r in kept if r[0]) == [(4, "k l")] and [r[1] for r in kept if not r[0]] == ["x y"] and len(kept) == 2
    assert simhash.keep_one(spark, df.limit(0)).collect() == []
    assert simhash.near_duplicates(spark, df.limit(0)).collect() == []
    odd = spark.createDataFrame([(1, "x", 1, 2)], "doc_id long, text string, fp int, component_id int")
    assert [tuple(r) for r in simhash.near_duplicates(spark, odd).select("doc_id", "component_id").collect()] == [(1, 1)]
    assert simhash.keep_one(spark, odd).columns == odd.columns


def test_a_repeated_id_keeps_no_copy_of_another_document(spark):
    one, two = "zebra yak xerus wolf vole", "ant bee cat dog eel"
    rows = [(5, one), (5, two), (2, two), (7, None), (7, two), (8, one), (8, two)]
    kept = simhash.keep_one(spark, spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(tuple, kept), key=repr) == [(2, two), (5, one), (7, None)]


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = {r.node: r.root for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == closure(nodes, [(a, b) for a, b in edges if a != b])
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
