"""Personal data: base spans against the plain patterns, added spans on
texts made for them."""

import hashlib
import random
import re
import time

import pytest

from quarry.llm import pii
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = {}
    for kind, pattern in PLAIN.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fails = {
                "email": False,
                "ip": any(int(p) > 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": not (13 <= len(digits) <= 19 and luhn(digits)),
                "phone": not 9 <= len(digits) <= 15,
            }
            if not fails[kind]:
                out[kind].append(m.span())
    return out


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_the_plain_patterns(seed):
    r = random.Random(seed)
    pieces = ["a", "é", "@", ".", "-", "_", "+", " ", "0", "1", "12", "255", "4111111111111111", "(", ")", "b.c", ":", "\n", "4012 8888 8888 1881", "+1 (555) 010-0199"]
    for _ in range(5000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_scans_are_linear():
    unit = ["a", "1", "1.", "+1 ", "a@", "1 ", "::1", "[at]", "a.b@"]
    start = time.time()
    for u in unit:
        pii.spans(None, u * (600_000 // len(u)))
    assert time.time() - start < 20


def corpus():
    """Strict ones in plain sentences, digits that are none, and spelt-out
    ones in half of the documents."""
    r = random.Random(3)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(400):
        card = next(c for c in iter(lambda: "4" + digits(15), None) if luhn(c))
        wrong = next(c for c in iter(lambda: "9" + digits(15), None) if not luhn(c))
        rows.append((4 * i, f"please mail ann.{i}@mail{i % 7}.example.com or call +1 ({digits(3)}) 555-{digits(4)} soon"))
        rows.append((4 * i + 1, f"the card {card} and the host 10.{i % 256}.3.{i % 200} there"))
        rows.append((4 * i + 2, f"order {wrong} in section {i}.2 of version {i}.{i}"))
        rows.append((4 * i + 3, "nothing of that kind in here"))
    return rows


def test_added_spans(spark):
    rows = corpus()
    model = pii.learn(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    hit = lambda text: [(k, text[s:e]) for k, v in pii.spans(model, text)[1].items() for s, e in v]
    assert hit("please mail joe (at) mail [dot] com now") == [("email", "joe (at) mail [dot] com")]
    assert hit("call (555) 123-4567 today") == [("phone", "(555) 123-4567")]
    assert hit("the card 4111.1111.1111.1111 there") == [("card", "4111.1111.1111.1111")]
    assert hit("the host 10[.]0[.]3[.]7 there") == [("ip", "10[.]0[.]3[.]7")]
    # What the checks refuse is left alone, and so are clean documents.
    for text in ("order 9111111111111112 came", "at 12:30:45 we met", "isbn 978 3 16 148410", "section 4.2.1", None, ""):
        assert hit(text) == [] if text else pii.spans(model, text)[1] == {k: [] for k in pii.KINDS}
    clean = [t for _, t in rows if t.startswith(("order", "nothing"))]
    assert not any(hit(t) for t in clean)


def test_labelers_get_their_reliability():
    # The gazetteer is right, the context labeler votes at random.
    r, counts = random.Random(1), {}
    for _ in range(4000):
        good = r.random() < 0.5
        v = [2 if good else 0, 2 if good else 1, 2 if good else 1, r.choice([0, 1, 2]), 2, 0]
        p = 0
        for x in v:
            p = 3 * p + x
        counts[p] = counts.get(p, 0) + 1
    probability, rates = pii._expectation_maximisation(counts)
    assert all((p > 0.9) == (pattern // 3**4 % 3 == 2) for pattern, p in probability.items())
    right = rates[1, :, 2] - rates[0, :, 2]
    assert right[2] > 0.6 and abs(right[3]) < 0.2


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "é a@b.co"), (3, "a@b.co"), (3, "a@b.co"), (4, "x " * 200_000 + "q@w.org")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, spans int, `Base` string")
    got = pii.find(spark, df, pii.learn(spark, df))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, 0, 0, 0, 0, "", ""), (2, 0, 0, 0, 0, "", ""), (None, 1, 0, 0, 0, "email:2:8", "email:2:8")]
        + [(3, 1, 0, 0, 0, "email:0:6", "email:0:6")] * 2
        + [(4, 1, 0, 0, 0, "email:400000:400007", "email:400000:400007")],
        key=repr,
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.learn(spark, empty) is None
    assert pii.find(spark, empty, None).collect() == []
    assert pii.learn(spark, df.where("doc_id < 3")) is None


def test_the_sample_is_bounded_and_copies_are_one(spark):
    df = spark.createDataFrame([(i, "mail a@b.com") for i in range(300)] + [(i, f"mail a{i}@b.com") for i in range(50)], "doc_id long, text string")
    model = pii.learn(spark, df, max_sample=20)
    assert pii.score(model, "email", "mail a@b.com", 5, 12) > 0.5


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in ("email", "ip", "card", "phone"))
        text = ",".join(f"{k}:{s}:{e}" for k in base for s, e in base[k])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
