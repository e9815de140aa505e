"""Quality verdicts and main texts against plain loops over the same rules;
the registered queries without SQL over the whole tables of sf0.001."""

import html
import math
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from quarry.llm import ngrams, quality, queries
from quarry.llm.common import read
from quarry.llm.html_extract import SIGMA, WRAPPER, main_text
from test_embeddings import brute as brute_links
from test_simhash_and_components import brute_fingerprint, closure

SF = "/root/testdata/sf0.001"


@cache
def bucket(kind, gram):
    """The bucket of one n-gram, hashed by itself."""
    if kind < 2:
        words = ngrams.word_hashes(" ".join(gram).encode())
        got = ngrams.buckets(words if kind == 0 else ngrams.runs(words, 2), quality.BITS)
    else:
        got = ngrams.buckets(ngrams.char_grams(ngrams.code_points(gram), kind), quality.BITS)
    assert len(got) == 1
    return int(got[0]) + (kind << quality.BITS)


def plain_probability(model, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [[(w,) for w in words], list(zip(words, words[1:]))] + [[text[i : i + n] for i in range(len(text) - n + 1)] for n in (2, 3)]
    z = model["bias"]
    for kind, found in enumerate(grams):
        if found:
            z += math.fsum(float(model["weights"][bucket(kind, g)]) for g in found) / len(found)
    return 1 / (1 + math.exp(-(model["slope"] * z + model["offset"])))


def test_query_op1_keeps_what_the_model_scores_high(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.train(spark, docs, labels)
    got = queries.op1_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        if r.base_failed:
            assert not r.kept
        else:
            p = plain_probability(model, texts[r.doc_id])
            assert r.kept == (p >= quality.THRESHOLD) or abs(p - quality.THRESHOLD) < 1e-6
    assert len({r.kept for r in got if not r.base_failed}) == 2  # the model decides something


class Node:
    def __init__(self, tag, named, children):
        self.tag, self.named, self.children = tag, named, children

    def html(self):
        inner = "".join(c if isinstance(c, str) else c.html() for c in self.children)
        return f"<{self.tag}{' class=advert' if self.named else ''}>{inner}</{self.tag}>"


def random_tree(rng, depth=0):
    tag = rng.choice(["div", "section", "p", "p", "b", "ul", "nav"] if depth else ["div"])
    children = []
    for _ in range(rng.randint(1, 5)):
        if depth < 5 and rng.random() < 0.6 and tag not in ("p", "b"):
            children.append(random_tree(rng, depth + 1))
        elif rng.random() < 0.3:
            children.append(Node("b", False, ["bold "]))
        else:
            children.append(" ".join(rng.choice(["w", "word", "a&amp;b"]) for _ in range(rng.choice([0, 1, 3, 40]))) + rng.choice(["", " ", "\n"]))
    return Node(tag, tag == "div" and depth > 0 and rng.random() < 0.2, children)


def plain_main_text(root):
    """Lines off the tree itself; ratios smoothed by a weighted mean over all
    pairs of lines; regions that hold a seed are kept."""
    lines, text, tags = [], "", 0

    def walk(node, path):
        nonlocal text, tags

        def mark(around):
            nonlocal text, tags
            tags += 1
            if node.tag != "b":
                if text.split():
                    lines.append((" ".join(text.split()), tags, around))
                    tags = 0
                text = ""

        mark(path)
        for child in node.children:
            if isinstance(child, str):
                if not any(n.tag == "nav" for n in [*path, node]):
                    text += child.replace("&amp;", "&")
            else:
                walk(child, [*path, node])
        mark([*path, node])

    walk(root, [])
    total = sum(len(t) for t, _, _ in lines)
    held = lambda d: sum(len(t) for t, _, path in lines if d in path)
    own = [x for x in lines if not any(n.named and held(n) <= WRAPPER * total for n in x[2])]
    if not own:
        return ""
    ratio = np.array([len(t) / tags for t, tags, _ in own])
    far = np.arange(len(own))[:, None] - np.arange(len(own))
    weight = np.where(abs(far) <= math.ceil(3 * SIGMA), np.exp(-0.5 * (far / SIGMA) ** 2), 0)
    smoothed = weight @ ratio / weight.sum(1)
    region = [next(n for n in reversed(path) if n.tag not in ("p", "b")) for _, _, path in own]
    seeds = [r for r, s in zip(region, smoothed) if s >= smoothed.std()]
    return " ".join(t for (t, _, _), r in zip(own, region) if any(r is s for s in seeds))


@pytest.mark.parametrize("seed", range(8))
def test_main_text_equals_plain_ratios(seed):
    rng = random.Random(seed)
    texts, whole = [], 0
    for _ in range(150):
        tree = random_tree(rng)
        texts.append(main_text(tree.html()))
        assert texts[-1] == plain_main_text(tree), tree.html()
        whole += texts[-1] == ""
    assert whole < 75 and len(set(texts)) > 50


def test_query_op3_gives_every_page_s_article(spark):
    pages = {r.page_id: r for r in read(spark, SF, "pages").collect()}
    got = queries.op3_html_extract(spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside)]
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, " ".join(b for b in blocks if b), len(r.text))


def test_query_op4_links_every_vector(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, SF, "embeddings").collect()]
    got = queries.op4_embedding_dedup(spark, SF).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute_links(rows)


def test_query_op8_predicts_every_document(spark):
    docs = {r.doc_id: r for r in read(spark, SF, "documents").collect()}
    got = queries.op8_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or ""))
    known = [r for r in got if r.held_out and docs[r.doc_id].lang and r.lang_pred != "und"]
    assert len(known) > 30 and np.mean([r.lang_pred == docs[r.doc_id].lang for r in known]) > 0.95


def test_query_op9_links_every_document(spark):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in read(spark, SF, "documents").collect()}
    roots = closure(prints, [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2])
    got = queries.op9_simhash(spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((d, f"{p:016x}", roots[d]) for d, p in prints.items())
