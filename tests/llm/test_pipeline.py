"""The pipeline stage by stage against brute force, on a fixture of its own
and on given tables."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline as C
from quarry.llm import quality
from quarry.llm.common import read
from quarry.llm.word_tokens import WordTokens
from quarry.llm.queries import QUERIES, vocabulary
from tests.llm.test_lines_and_substrings import brute_lines, brute_windows
from tests.llm.test_simhash_and_components import brute_fingerprint, closure

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark):
    """Rows with nulls, copies, near copies, shared lines and passages; the
    labels of the given tables."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    footer, passage = "All rights reserved here.", text(70)
    rows = []
    for i in range(40):
        t = text(rng.randint(60, 200)) + "\n" + text(30)
        if i % 4:
            t += "\n" + footer
        if i % 7 == 0:
            t += "\n" + passage
        rows.append((i, t))
    rows += [(100 + i, rows[i][1]) for i in range(6)]  # copies
    rows += [(200 + i, rows[i][1] + " more") for i in range(6)]  # near copies
    rows += [(300, None), (301, ""), (302, "too short"), (303, "spam " * 300), (304, rows[8][1] + "\n\n  "), (304, rows[8][1] + "\n\n  ")]
    return [(d, t, None if d % 5 == 0 else "en", None if d % 4 == 0 else "s", None if t is None else len(t)) for d, t in rows]


def test_stages_are_as_dealt():
    assert [name for name, _ in C.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "substring dedup", "packing"]


def test_each_stage_on_all_its_predecessor_kept(spark, corpus):
    sf = "/root/testdata/sf0.001"
    docs = spark.createDataFrame(corpus, DOCS)
    model = quality.train(spark, docs, read(spark, sf, "labels"))

    kept = C.quality_rules(spark, docs, sf)
    got = sorted(map(tuple, kept.collect()), key=repr)
    good = lambda t: (s := quality.base_stats(t))[0] >= 50 and 2 * s[4] <= s[0] and (model is None or quality.probability(model, t) >= quality.THRESHOLD)
    assert got == sorted([r for r in corpus if good(r[1])], key=repr) and len(got) > 40
    assert kept.columns == docs.columns

    stage = C.lines(spark, spark.createDataFrame(got, DOCS), sf)
    lines = sorted(map(tuple, stage.collect()), key=repr)
    expected = [(d, t) for d, _, _, t in brute_lines([(r[0], r[1]) for r in got], 10)]
    assert sorted(((r[0], r[1]) for r in lines), key=repr) == sorted(expected, key=repr)
    assert all(r[4] == len(r[1]) for r in lines) and stage.columns == docs.columns
    footer = "All rights reserved here."
    assert sum(footer in r[1].split("\n") for r in got) >= 10
    assert not any(footer in r[1].split("\n") for r in lines)

    stage = C.near_duplicates(spark, spark.createDataFrame(lines, DOCS), sf)
    single = sorted(map(tuple, stage.collect()), key=repr)
    prints = {r[0]: brute_fingerprint(r[1]) for r in lines}
    roots = closure(prints, [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2])
    assert sorted(r[0] for r in single) == sorted(set(roots.values())) and stage.columns == docs.columns
    assert all(r in lines for r in single)

    stage = C.substrings(spark, spark.createDataFrame(single, DOCS), sf)
    cut = sorted(map(tuple, stage.collect()), key=repr)
    expected = brute_windows([(r[0], r[1]) for r in single], 50)
    assert sorted(((r[0], " ".join(r[1].split())) for r in cut), key=repr) == sorted(((d, t) for d, _, _, t in expected), key=repr)
    assert all(r[4] == len(r[1]) for r in cut) and stage.columns == docs.columns
    assert any(n for _, _, n, _ in expected)

    words = WordTokens(vocabulary("word_bpe_49k.json"))
    pieces = defaultdict(dict)
    for p in C.pack(spark, spark.createDataFrame(cut, DOCS), sf).collect():
        pieces[p.doc_id][p.start] = bytes(p.ids)
    assert set(pieces) == {r[0] for r in cut}
    for r in cut:
        assert b"".join(pieces[r[0]][s] for s in sorted(pieces[r[0]])) == words.ids(r[1]).tobytes() + b"\x01\x00\x00\x00"


def test_run_joins_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    out = C.run(spark, sf)
    docs = read(spark, sf, "documents")
    for _, stage in C.STAGES:
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        docs = stage(spark, docs, sf)
    key = lambda r: (r.doc_id, r.start)
    own = lambda rows: sorted(((r.doc_id, r.doc_tokens) for r in rows))
    a, b = sorted(out.collect(), key=key), sorted(docs.collect(), key=key)
    assert set(own(a)) == set(own(b))
    assert {r.doc_id for r in a} <= {r.doc_id for r in read(spark, sf, "documents").collect()}


def test_empty_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.createDataFrame([], DOCS)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, sf)
        rows = docs.collect()
        assert rows == []
        docs = spark.createDataFrame(rows, docs.schema)


def test_extra_columns_pass_every_stage(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(i, f"{text} {i}\nshared line", 3, f"n{i}", i, True, None, 1) for i in range(12)]
    names = "doc_id long, text string, n_lines int, n_words string, n_removed long, kept boolean, `key` string, component_id int"
    docs = spark.createDataFrame(rows, names)
    for stage in (C.quality_rules, C.lines, C.near_duplicates, C.substrings):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
    got = {r.doc_id: r for r in C.lines(spark, docs, "/root/testdata/sf0.001").collect()}
    assert all(got[r[0]][2:] == r[2:] and got[r[0]].text == f"{text} {r[0]}" for r in rows)
    got = {r.doc_id: r for r in C.substrings(spark, docs, "/root/testdata/sf0.001").collect()}
    assert all(got[r[0]][2:] == r[2:] for r in rows) and got[1].text == "1\nshared line" and got[0].text == rows[0][1]
    assert C.pack(spark, docs, "/root/testdata/sf0.001").count() > 0


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
