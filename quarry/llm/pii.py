"""Personal data by weak supervision: labelers vote, expectation-maximisation
weighs them, and a classifier trained on the outcome finds further spans.

Base spans are fixed patterns and always stay. Candidates are base spans and
looser ones: spelt-out addresses, numbers with other separators, telephone
numbers without a plus, IPv6 and defanged addresses. Six labelers vote yes,
no or nothing on each candidate: the strict pattern, a format check (Luhn's
digit, ranges, lengths), a gazetteer (top-level domains, issuer prefixes,
calling codes, private networks), words before it, what touches it, and
degenerate digits.

``learn`` reads all documents once. Tasks return how often each vote pattern
occurs (at most 3**6 per kind) and the features of the candidates of smallest
hash, MAX_SAMPLE per kind. The driver runs expectation-maximisation over the
pattern counts of the whole corpus, which gives every pattern the probability
that it is personal data, and fits a logistic regression on the sample with
those probabilities as targets. ``find`` reads all documents again and adds
the candidates that the classifier puts at THRESHOLD or more. Neither pass
shuffles texts, and all scans are linear in a text.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import only, small_batches

KINDS = ("email", "ip", "card", "phone")  # in the order of the results
MAX_SAMPLE = 2000  # candidates of each kind that the classifier is fitted on
THRESHOLD = 0.8
BITS = 15  # hashed features: 2**15
NEAR = 40  # code points of context on either side
EM_ROUNDS = 100
BIAS = -4.0  # log odds of a candidate of which nothing else is known
L2 = 0.002
MAX_STEPS = 300
NOTHING, NO, YES = 0, 1, 2
LABELERS = ("strict", "format", "gazetteer", "context", "touching", "degenerate")

# The gazetteers and the words of the context labeler.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co eu uk de fr es it nl be ch at pt pl se no dk fi ru cn jp kr in br mx ar ca au nz us".split())
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "64", "65", "81", "82", "86", "91")
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|30|36|38|6011|65")
FOR = {
    "email": re.compile(r"e-?mail|contact|write|correo|courriel|kontakt"),
    "ip": re.compile(r"\bip\b|ipv[46]|host|server|address|ping|adresse|direcci"),
    "card": re.compile(r"card|visa|amex|credit|karte|carte|tarjeta"),
    "phone": re.compile(r"phone|\btel|\bcall|mobile|\bfax|\bcell|telef|t.l.ph|anruf|whatsapp"),
}
AGAINST = re.compile(r"version|invoice|order|isbn|build|section|page|serial|ticket|licen[cs]e|release|chapter|article|token|\bid\b|\bno\.")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits matches whole or not at all, so a start inside one is no use.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"[\[({] ?at ?[\])}]", re.I)
_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]+(?= ?\Z)")
_AFTER_AT = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[({] ?dot ?[\])}]|\.) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_LOOSE = {
    "ip": re.compile(
        r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])|(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])"
    ),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ ./_-]{0,2}[0-9]){12,18}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+(])\(?[0-9][0-9 ()./-]{5,22}[0-9](?![0-9A-Za-z])"),
}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(divmod(2 * int(d), 10)[0] + 2 * int(d) % 10 for d in digits[-2::-2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def _emails(text: str):
    """What ``[local]+@domain`` finds from left to right: each match holds
    one @, so it is found from there."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """The fixed patterns' spans by kind, leftmost and non-overlapping."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return out
    out["email"] = list(_emails(text))
    if _DIGIT.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if 13 <= m.end() - m.start() < 40 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out["card"].append(m.span())
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def _loose(text: str):
    """(kind, start, end) of what may be personal data besides."""
    for m in _AT.finditer(text):
        a, b = _BEFORE_AT.search(text, max(0, m.start() - 66), m.start()), _AFTER_AT.match(text, m.end())
        if a and b:
            yield "email", a.start(), b.end()
    if _DIGIT.search(text) or "::" in text:
        for kind, pattern in _LOOSE.items():
            for m in pattern.finditer(text):
                if kind != "phone" or 7 <= len(_digits(m.group())) <= 15:
                    yield kind, m.start(), m.end()


def candidates(text: str | None, base: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, strict): base spans, and looser ones that overlap
    none of them."""
    if not text:
        return []
    out = [(k, s, e, True) for k in KINDS for s, e in base[k]]
    taken = sorted((s, e) for _, s, e, _ in out)
    starts = np.array([s for s, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    for kind, s, e in _loose(text):
        before = int(np.searchsorted(starts, e))  # base spans that start before its end
        if not before or ends[before - 1] <= s:
            out.append((kind, s, e, False))
    return out


def _format(kind: str, s: str) -> int:
    if kind == "email":
        return YES if len(s) <= 254 and ".." not in s else NO
    digits = _digits(s)
    if kind == "card":
        return YES if 13 <= len(digits) <= 19 and luhn(digits) else NO
    if kind == "phone":
        groups = [len(g) for g in re.findall("[0-9]+", s)]
        return YES if len(digits) > 8 and (s[0] == "+" or len(groups) > 2 and max(groups) < 7) else NO
    try:
        ipaddress.ip_address(re.sub(r"\[\.\]|\(\.\)|\[dot\]", ".", s))
        return YES
    except ValueError:
        return NO


def _gazetteer(kind: str, s: str) -> int:
    if kind == "email":
        return YES if re.split(r"[^a-z0-9]+", s.lower().rstrip(")]}"))[-1] in TOP_LEVEL else NO
    digits = _digits(s)
    if kind == "card":
        return YES if ISSUERS.match(digits) else NO
    if kind == "phone":
        return YES if s[0] == "+" and digits.startswith(CALLING_CODES) or s.startswith(("(", "00")) else NOTHING
    return YES if s.startswith(("10.", "192.168.", "172.", "fe80:", "2001:")) else NOTHING


def _ballot(kind: str, text: str, start: int, end: int, strict: bool) -> tuple[int, ...]:
    s = text[start:end]
    before = text[max(0, start - NEAR) : start].lower()
    sides = text[start - 1 : start] + text[end : end + 1]
    digits = _digits(s)
    context = YES if FOR[kind].search(before) else NO if AGAINST.search(before) else NOTHING
    touching = NO if any(c.isalnum() or c in "=_/\\#&" for c in sides) else YES
    degenerate = NO if kind in ("card", "phone") and (len(set(digits)) < 3 or digits in "01234567890123456789") else NOTHING
    return YES if strict else NOTHING, _format(kind, s), _gazetteer(kind, s), context, touching, degenerate


def votes(kind: str, text: str, start: int, end: int, strict: bool) -> int:
    """The labelers' votes as a number in base three, the first in front."""
    out = 0
    for v in _ballot(kind, text, start, end, strict):
        out = 3 * out + v
    return out


def features(kind: str, text: str, start: int, end: int) -> np.ndarray:
    """Buckets of a candidate: its shape's n-grams, the words around it, the
    characters that touch it, all under its kind, and the votes of all
    labelers but the strict pattern, which no loose candidate has. A vote
    weighs alike for all kinds, so a kind whose candidates are all good here
    learns from the others what a no means."""
    s = text[start:end]
    shape = "".join("9" if "0" <= c <= "9" else "a" if c.isalpha() else c for c in s[:64])
    marked = f"^{shape}$"
    names = {f"s{marked[i : i + n]}" for n in (2, 3) for i in range(len(marked) - n + 1)}
    names |= {f"b{w}" for w in re.findall(r"\w+", text[max(0, start - NEAR) : start].lower())[-4:]}
    names |= {f"a{w}" for w in re.findall(r"\w+", text[end : end + NEAR].lower())[:2]}
    names |= {f"l{text[start - 1 : start]}", f"r{text[end : end + 1]}", f"n{len(_digits(s))}"}
    names = {kind + n for n in names} | {f"v{i}{v}" for i, v in enumerate(_ballot(kind, text, start, end, False)) if v != NOTHING}
    return np.array(sorted({crc32(n.encode("utf-8", "surrogatepass")) >> (32 - BITS) for n in names}), np.int32)


def _expectation_maximisation(counts: dict[int, int]) -> tuple[dict[int, float], np.ndarray]:
    """{pattern: probability of personal data} and each labeler's rates
    (class, labeler, vote). Labelers are taken as independent given the
    class; the start is what a fair labeler does, and keeps the weight of a
    tenth of the data, so that the classes cannot change places."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    v = np.array([[p // 3**i % 3 for i in reversed(range(len(LABELERS)))] for p in patterns])
    onehot = (v[:, :, None] == np.arange(3)).astype(float)
    fair = np.broadcast_to(np.array([[0.3, 0.55, 0.15], [0.3, 0.1, 0.6]])[:, None, :], (2, len(LABELERS), 3))
    rates, prior, held = fair.copy(), np.array([0.5, 0.5]), max(1.0, 0.1 * n.sum())
    for _ in range(EM_ROUNDS):
        log = np.log(prior)[None, :] + np.einsum("plv,clv->pc", onehot, np.log(rates))
        q = np.exp(log - log.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        mass = (q * n[:, None]).sum(axis=0)
        new = (np.einsum("pc,p,plv->clv", q, n, onehot) + held * fair) / (mass[:, None, None] + held)
        prior, moved, rates = (mass + held) / (mass.sum() + 2 * held), np.abs(new - rates).max(), new
        if moved < 1e-9:
            break
    return {p: float(x) for p, x in zip(patterns, q[:, 1])}, rates


def _fit(rows: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Adam until the
    gradient is small, MAX_STEPS at most. The bias is not fitted but BIAS: a
    corpus whose candidates of a kind are all strict ones shows no negatives,
    and what shares nothing with them must stay unlikely."""
    size = 1 << BITS
    at = np.concatenate([f for f, _ in rows])
    of = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    y, scale = np.array([t for _, t in rows]), 1 / len(rows)
    w, m, u = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, MAX_STEPS + 1):
        z = np.bincount(of, w[at], minlength=len(rows)) + BIAS
        r = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) * scale
        g = np.bincount(at, r[of], minlength=size) + L2 * w
        if np.abs(g).max() < 1e-5:
            break
        m, u = 0.9 * m + 0.1 * g, 0.99 * u + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(u / (1 - 0.99**step)) + 1e-9)
    return w


_SEEN = "kind int, h long, pattern int, n long, f binary"


def learn(spark: SparkSession, docs: DataFrame, max_sample: int = MAX_SAMPLE, text: str = "text") -> np.ndarray | None:
    """The classifier's weights, None where no text has a candidate. Null
    and empty texts teach nothing. Equal candidates in equal surroundings are
    one in the sample, so copies do not crowd it; the pattern counts count
    them all."""
    small_batches(spark)

    def run(batches):
        counts: dict[tuple[int, int], int] = {}
        sample: list[dict] = [{} for _ in KINDS]

        def prune(k: int):
            if len(sample[k]) > max_sample:
                sample[k] = dict(sorted(sample[k].items())[:max_sample])

        for b in batches:
            for t in b.column(0).to_pylist():
                for kind, s, e, strict in candidates(t, base_spans(t)):
                    k, p = KINDS.index(kind), votes(kind, t, s, e, strict)
                    counts[k, p] = counts.get((k, p), 0) + 1
                    around = t[max(0, s - NEAR) : e + NEAR].encode("utf-8", "surrogatepass")
                    h = crc32(around) << 31 | crc32(around, 1) >> 1
                    if h not in sample[k]:
                        sample[k][h] = (p, features(kind, t, s, e).tobytes())
                        if len(sample[k]) > 4 * max_sample:
                            prune(k)
        rows = [dict(kind=k, h=None, pattern=p, n=n, f=None) for (k, p), n in counts.items()]
        for k in range(len(KINDS)):
            prune(k)
            rows += [dict(kind=k, h=h, pattern=p, n=None, f=f) for h, (p, f) in sample[k].items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("pattern", pa.int32()), ("n", pa.int64()), ("f", pa.binary())]))

    seen = materialize(spark, only(docs, text=text).where("text <> ''").mapInArrow(run, _SEEN), "candidates")
    counts: dict[int, dict[int, int]] = {}
    for r in seen.where("n is not null").groupBy("kind", "pattern").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r.kind, {})[r.pattern] = r.n
    one = seen.where("h is not null").groupBy("kind", "h").agg(F.min(F.struct("pattern", "f")).alias("c"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("h"))
    rows = one.withColumn("rank", rank).where(F.col("rank") <= max_sample).select("kind", "h", "c.*").collect()  # bounded by max_sample
    probability = {k: _expectation_maximisation(c)[0] for k, c in counts.items()}
    rows.sort(key=lambda r: (r.kind, r.h))
    return _fit([(np.frombuffer(r.f, np.int32), probability[r.kind][r.pattern]) for r in rows]) if rows else None


def score(model: np.ndarray | None, kind: str, text: str, start: int, end: int) -> float:
    """The probability that a candidate is personal data; 0 without a model."""
    if model is None:
        return 0.0
    z = float(model[features(kind, text, start, end)].sum()) + BIAS
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def spans(model: np.ndarray | None, text: str | None, threshold: float = THRESHOLD) -> tuple[dict, dict]:
    """(base, all) spans of a text by kind. Of added spans that overlap, the
    likelier stays, then the earlier, the longer, the kind listed first."""
    base = base_spans(text)
    every = {k: list(v) for k, v in base.items()}
    ranked = []
    for kind, s, e, strict in candidates(text, base):
        if not strict and (p := score(model, kind, text, s, e)) >= threshold:
            ranked.append((-p, s, -e, KINDS.index(kind)))
    chosen: list[tuple[int, int]] = []
    for _, s, e, k in sorted(ranked):
        at = bisect_left(chosen, (s,))
        if all(b <= s or a >= -e for a, b in chosen[max(0, at - 1) : at + 1]):
            chosen.insert(at, (s, -e))
            every[KINDS[k]].append((s, -e))
    return base, {k: sorted(v) for k, v in every.items()}


def written(found: dict) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in found[k])


def find(spark: SparkSession, docs: DataFrame, model: np.ndarray | None, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base
    spans, long), base and spans (kind:start:end, by kind and start, joined
    by commas; code points, the end not included).

    A null or empty text has no spans and empty strings. Ids may be null or
    repeat; each row is read by itself. Other columns are ignored. Without a
    model nothing is added to the base.
    """
    small_batches(spark)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"]

    def run(batches):
        for b in batches:
            got = [spans(model, t, threshold) for t in b.column(1).to_pylist()]
            counts = [pa.array([len(base[k]) for base, _ in got], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array([written(x) for x, _ in got], pa.string()), pa.array([written(x) for _, x in got], pa.string())], names)

    own = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return own.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string")
