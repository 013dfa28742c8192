"""Personal data in texts.

Four kinds are found by fixed patterns (email, ip, card, phone) and always stay. Further spans (kinds contact, number, secret)
are candidates on which labelers vote: patterns, a list of telling words, and context. Expectation-maximisation over the
counts of vote patterns estimates the labelers' reliabilities; its posteriors train a logistic span classifier on votes, kind and
length, and candidates at ACCEPT or more are added. The base spans vote too, so the reliabilities rest on all spans
of the table. What is collected is one count per pattern of votes, kind and length class: at most
len(KINDS) * 4 * 3 ** len(LABELERS) rows, whatever the data.

Places are in code points, the end is exclusive. Null texts count as empty and hold nothing. Texts of any length are read whole. Every
row is judged by itself, so repeated rows give equal results, rows with a null doc_id too. A candidate of probability ACCEPT
is added. An empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import kept_table, map_chunks

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "contact", "number", "secret")
ACCEPT = 0.9

# The patterns of the four base kinds.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+")
_NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9](?:[\x20().-]{0,2}[0-9]){8,18}+(?![A-Za-z0-9])")
_CONTACT = re.compile(
    r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}\x20?[\[({](?:at|AT)[\])}]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?[\[({](?:dot|DOT)[\])}]\x20?[A-Za-z0-9-]{1,63})+")
_TELLING = re.compile(
    r"token|secret|passw|api.?key|access.?key|bearer|credential|private|card|account|iban|ssn|phone|tel\b|mobile|"
    r"e-?mail|contact|address", re.I)
_ASSIGNED = re.compile(r"""(?:[=:]\s?["']?|["'])\Z""")
_HEX = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")
_LETTERS = re.compile(r"[A-Za-z]{12,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    """As the whole pattern finds them, but from each @ outward, so long texts without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", last if m else at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind and then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p) < 256 for p in map(_part, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def _part(digits: str) -> str:
    """A part short enough to be a number; over three digits only if the rest are zeros in front."""
    short = digits.lstrip("0")
    return (short or "0") if len(short) < 4 else "256"


def extra_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates that touch no base span and not each other; secrets before contacts before numbers."""
    found = []
    if _DIGIT.search(text):
        for m in _SECRET.finditer(text):
            s = m[0]
            if _DIGIT.search(s) and any(c.isalpha() for c in s):
                found.append(("secret", *m.span()))
    if "[" in text or "(" in text or "{" in text:
        found += [("contact", *m.span()) for m in _CONTACT.finditer(text)]
    if _DIGIT.search(text):
        found += [("number", *m.span()) for m in _NUMBER.finditer(text)]
    begins, ends, out = [], [], []
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if begins and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    for kind, a, b in found:
        at = bisect_left(begins, b)  # of what is taken, in order and apart, the last one that begins before the end
        if not at or ends[at - 1] <= a:
            begins.insert(at, a)
            ends.insert(at, b)
            out.append((kind, a, b))
    return out


def _vote(yes: bool, no: bool = False) -> str:
    return "+" if yes else "-" if no else "0"


def _pattern_labeler(kind, s, before, after):
    digits = sum(c.isdigit() for c in s)
    if kind in BASE or kind == "contact":
        return "+"
    if kind == "secret":
        return _vote(bool(_HEX.fullmatch(s)) or (len(s) >= 24 and digits >= 6 and not _LETTERS.search(s)), len(s) < 20)
    return _vote(13 <= digits <= 19 and luhn("".join(c for c in s if c.isdigit())), digits < 10 or digits > 12)


def _gazetteer_labeler(kind, s, before, after):
    return _vote(bool(_TELLING.search(before)))


def _context_labeler(kind, s, before, after):
    return _vote(bool(_ASSIGNED.search(before)), kind in ("secret", "number") and before[-1:].isalnum())


def _variety_labeler(kind, s, before, after):
    return _vote(len(set(s)) >= 10 or kind in BASE, len(set(s)) <= 4)


def _shape_labeler(kind, s, before, after):
    strokes = s.count("-") + s.count("=") + s.count("_")
    return _vote(False, kind not in BASE and (bool(_LETTERS.search(s)) or strokes > len(s) // 3))


LABELERS = (_pattern_labeler, _gazetteer_labeler, _context_labeler, _variety_labeler, _shape_labeler)


def signature(text: str, kind: str, a: int, b: int) -> str:
    """Kind, length class and votes of a span, as text; all that the classifier sees of it."""
    s, before, after = text[a:b], text[max(0, a - 24) : a], text[b : b + 8]
    size = min(3, (b - a) // 16)
    return f"{KINDS.index(kind)}{size}" + "".join(f(kind, s, before, after) for f in LABELERS)


def find(text: str) -> tuple[list[tuple[str, int, int, str]], list[tuple[str, int, int, str]]]:
    """Base spans and candidates with their signatures."""
    base = base_spans(text)
    extra = extra_spans(text, base)
    return tuple([(k, a, b, signature(text, k, a, b)) for k, a, b in spans] for spans in (base, extra))


def reliabilities(votes: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote row, and the labelers' rates of (+, 0, -) on true and on false spans.

    Rows known to be true (base spans) stay so; how many are true is estimated from the others alone. The prior
    belief, worth 20 spans, is that a labeler that votes is right four times of five.
    """
    seen = np.eye(3)[votes]
    right, wrong = np.array([12.0, 5.0, 3.0]), np.array([3.0, 5.0, 12.0])
    post = np.clip(0.5 + ((votes == 0).sum(1) - 2.0 * (votes == 2).sum(1)) * 0.15, 0.02, 0.98)
    post[known] = 1.0
    open_ = counts * ~known
    rates = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        w = counts * post, counts * (1 - post)
        rates = np.stack([(np.einsum("p,prv->rv", w[0], seen) + right) / (w[0].sum() + 20),
                          (np.einsum("p,prv->rv", w[1], seen) + wrong) / (w[1].sum() + 20)])
        share = ((open_ * post).sum() + 5) / (open_.sum() + 20)
        odds = np.log(share / (1 - share)) + np.einsum("prv,rv->p", seen, np.log(rates[0] / rates[1]))
        now = np.where(known, 1.0, 1 / (1 + np.exp(-np.clip(odds, -40, 40))))
        if np.abs(now - post).max(initial=0) < 1e-9:
            break
        post = now
    return post, rates


def classifier_inputs(signatures: list[str]) -> np.ndarray:
    rows = [[1.0, *(float(s[0] == str(k)) for k in range(len(KINDS))), *(float(s[1] == str(z)) for z in range(4)),
             *(float(v == sign) for v in s[2:] for sign in "+-")] for s in signatures]
    return np.array(rows).reshape(len(rows), 1 + len(KINDS) + 4 + 2 * len(LABELERS))


def train(signatures: list[str], counts: list[int]) -> set[str]:
    """Signatures of spans that the final classifier accepts."""
    if not signatures:
        return set()
    n = np.array(counts, float)
    votes = np.array([["+0-".index(v) for v in s[2:]] for s in signatures])
    target, _ = reliabilities(votes, n, np.array([KINDS[int(s[0])] in BASE for s in signatures]))
    x = classifier_inputs(signatures)
    w = np.zeros(x.shape[1])
    weight = n / n.sum() * min(n.sum(), 1e4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (target - p)) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {s for s, v in zip(signatures, p) if v >= ACCEPT}


SPAN = "array<struct<kind:int,start:long,stop:long,signature:string>>"


def span_rows(docs: DataFrame) -> DataFrame:
    """doc_id, base and extra: all base spans and candidates of every row."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()),
                               ("signature", pa.string())]))

    def make():
        def fn(ids, texts):
            found = [find(t) for t in texts]
            as_rows = lambda spans: [{"kind": KINDS.index(k), "start": a, "stop": b, "signature": s} for k, a, b, s in spans]
            return {"doc_id": pa.array(ids, pa.int64()), "base": pa.array([as_rows(f[0]) for f in found], kind),
                    "extra": pa.array([as_rows(f[1]) for f in found], kind)}

        return fn

    return map_chunks(docs, make, f"doc_id long, base {SPAN}, extra {SPAN}")


def accepted_signatures(spans: DataFrame) -> set[str]:
    counts = spans.select(F.explode(F.concat("base", "extra")).alias("s")).groupBy("s.signature").count().collect()
    counts.sort()
    return train([r["signature"] for r in counts], [r["count"] for r in counts])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (base and accepted ones, by kind and then start) of every row."""
    spans = kept_table(span_rows(docs), "spans")
    good = sorted(accepted_signatures(spans))
    known = F.array(*map(F.lit, good)).cast("array<string>")
    added = F.filter("extra", lambda s: F.array_contains(known, s["signature"]))
    return spans.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined with commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def mask_text(text: str, accepted: set[str]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first, then the longer."""
    base, extra = find(text)
    out, last = [], 0
    for kind, a, b, _ in sorted([*base, *(s for s in extra if s[3] in accepted)], key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
            last = b
        elif b > last:
            last = b
    return "".join([*out, text[last:]]) if out else text


def masked(text: Column, accepted: set[str]) -> Column:
    """Texts without personal data; null stays null."""

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(lambda t: None if t is None else mask_text(t, accepted))

    return mask(text)
