"""Personal data in texts: e-mail and IP addresses, payment cards and telephone numbers.

High-recall generators propose spans, which may overlap. Boosted trees score each by its format (digits, separators, check
digit, ...) and its context (neighbouring characters, words before it), and thresholds calibrated per kind on held-out
examples select what is redacted. Spans of the strict base rules are candidates too and are always kept.

Trees and thresholds are fitted on the driver, to examples made from the templates below, a table of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakekit.llm.arrow_text import Carried, arrow_batches, chunks
from lakekit.llm.boosting import BoostedTrees, calibrated

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Starts are tried at the head of a run of digits only: a match inside a run would have begun there.
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MAYBE = r"[0-9@]|(?i:\[ ?at ?\]|\( ?at ?\))"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _octets(quad: str) -> bool:
    return all(len(p.lstrip("0")) < 3 or (len(p.lstrip("0")) == 3 and int(p) <= 255) for p in quad.split("."))


def _emails(text: str) -> list[Span]:
    """Matches of the base rule, found from each @ so that long runs without one cost nothing twice."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            floor = found.end()
        at = text.find("@", max(floor, at + 1))
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the base rules: leftmost, not overlapping within a kind; matches that fail a check are dropped."""
    return {
        "email": _emails(text),
        "ip": [m.span() for m in _QUAD.finditer(text) if _octets(m[0])],
        "card": [m.span() for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)],
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15],
    }


#: Generators of further candidates, per kind.
_MORE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{2,64} ?(?:\[ ?at ?\]|\( ?at ?\)) ?[A-Za-z0-9-]{2,63}(?: ?(?:\.|\[ ?dot ?\]|\( ?dot ?\)) ?[A-Za-z0-9-]{2,63})+", re.I),
    "ip": re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{3,4}(?:[ ./-]?[0-9]{2,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9.])(?:\(?[0-9]{2,5}\)?)(?:[ ./-]{1,2}[0-9]{2,5}){2,4}(?![0-9])"),
}
_HINTS = {
    "email": ("mail", "contact", "write", "address"), "ip": ("ip", "host", "server", "addr", "from"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte", "pay"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "ruf", "cell", "sms", "llam", "appel"),
}
#: Words that say a number is something else.
_OTHER = ("id", "isbn", "version", "order", "invoice", "date", "page", "no.", "serial", "ref", "model", "sum", "total")


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
    """Spans beyond the base rules that might be personal data, none of which overlaps a base span."""
    return [(kind, *m.span()) for kind, rule in _MORE.items() for m in rule.finditer(text)
            if not any(overlaps(spans, *m.span()) for spans in base.values())]


def overlaps(spans: list[Span], start: int, end: int) -> bool:
    """Whether a span overlaps one of sorted spans, none of which overlaps another: only the last that begins before its end can."""
    at = bisect_left(spans, (end,))
    return at > 0 and spans[at - 1][1] > start


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span, digits = text[start:end], _digits(text[start:end])
    before, after = text[start - 1:start] if start else "", text[end:end + 1]
    words = text[max(0, start - 32):start].lower()
    groups = [len(g) for g in re.split(r"[^0-9]+", span) if g]
    return [
        float(KINDS.index(kind)), float(end - start), float(len(digits)), float(len(groups)), float(max(groups, default=0)),
        float(min(groups, default=0)), float(groups[-1] if groups else 0), float(bool(digits) and luhn(digits)),
        float(len(digits) in (14, 15, 16, 19)), float(len(set(re.sub(r"[0-9A-Za-z]", "", span)))), float("(" in span), float("." in span),
        float("/" in span), float(span.startswith("00")), float(len(set(digits)) <= 2), float(before.isalnum() or before in "=_#/-$€"),
        float(after.isalnum() or after in "_%€$/"), float(any(h in words for h in _HINTS[kind])), float(any(h in words for h in _OTHER)),
        float(bool(re.match(r"(?:19|20)\d\d[ ./-]\d\d?[ ./-]\d\d?$|\d\d?[ ./-]\d\d?[ ./-](?:19|20)\d\d$", span))),
    ]


def _check_digit(digits: str) -> str:
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def _examples(rng: Random, count: int) -> list[tuple[str, str, int, int, int]]:
    """Made texts with one marked candidate each: text, kind, start, end, label."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    w = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8)))
    out = []
    for _ in range(count):
        sep = rng.choice([" ", "-", ".", "/"])
        made = [
            ("email", f"{w()}.{w()} [at] {w()}.{rng.choice(['com', 'org', 'net'])}", 1, "email"),
            ("email", f"{w()} (at) {w()} (dot) {rng.choice(['com', 'org', 'de'])}", 1, "email"),
            ("email", f"{w()} [at] {w()} . {w()}", 0, None),
            ("ip", ":".join(f"{rng.randrange(65536):x}" for _ in range(8)), 1, "ip"),
            ("ip", ":".join(n(2) for _ in range(8)), 0, None),
            ("card", _check_digit(rng.choice(["34", "37"]) + n(12)), 1, "card"),
            ("card", (lambda d: f"{d[:4]}{sep}{d[4:10]}{sep}{d[10:]}")(_check_digit("37" + n(12))), 1, "card"),
            ("card", n(rng.randint(11, 15)), 0, rng.choice([None, "other"])),
            ("card", (lambda d: f"{d[:4]}.{d[4:8]}.{d[8:12]}.{d[12:]}")(n(16)), 0, "other"),
            ("phone", f"({n(3)}) 555-{n(4)}", 1, rng.choice(["phone", None])),
            ("phone", f"{n(3)}{rng.choice('-. ')}555{rng.choice('-. ')}{n(4)}", 1, "phone"),
            ("phone", f"0{n(2)}{sep}{n(4)}{sep}{n(3)}", 1, "phone"),
            ("phone", f"00{n(2)} {n(3)} {n(3)} {n(3)}", 1, "phone"),
            ("phone", f"{rng.choice(['19', '20'])}{n(2)}{sep}{rng.randint(1, 12):02}{sep}{rng.randint(1, 28):02}", 0, rng.choice([None, "phone", "other"])),
            ("phone", f"{n(2)}{sep}{n(2)}{sep}{n(3)}", 0, rng.choice([None, "other"])),
            ("phone", f"{n(3)} {n(3)} {n(3)}", 0, rng.choice([None, "other"])),
            ("phone", f"{n(4)}-{n(4)}-{n(4)}", 0, "other"),
        ]
        for kind, span, label, hint in made:
            lead = {"other": rng.choice(_OTHER), None: w()}.get(hint) or rng.choice(_HINTS[hint])
            text = f"{w()} {lead} {w() if rng.random() < 0.3 else ''}{rng.choice([' ', ': '])}"
            out.append((f"{text}{span} {w()} {w()}", kind, len(text), len(text) + len(span), label))
    return out


@dataclass
class Model:
    trees: BoostedTrees
    thresholds: dict[str, float]


def fitted(precision: float = 0.99, count: int = 60, seed: int = 11) -> Model:
    """Trees on ``count`` rounds of the templates, thresholds on as many others."""
    tables = []
    for s in (seed, seed + 1):
        rows = _examples(Random(s), count)
        tables.append((np.array([features(*r[:4]) for r in rows]), np.array([r[4] for r in rows], float), [r[1] for r in rows]))
    (rows, labels, _), (held, truth, kinds) = tables
    trees = BoostedTrees(rounds=30).fit(rows, labels)
    scores = trees.score(held)
    kinds = np.array(kinds)
    return Model(trees, {k: max(calibrated(scores[kinds == k], truth[kinds == k], precision), 0.0) for k in KINDS})


def chosen(text: str, base: dict[str, list[Span]], model: Model) -> dict[str, list[Span]]:
    """The base spans and those candidates that reach their kind's threshold, best first, none overlapping another."""
    out = {k: list(v) for k, v in base.items()}
    found = candidates(text, base)
    if found:
        scores = model.trees.score(np.array([features(text, *c) for c in found]))
        taken: list[Span] = []
        for i in np.argsort(-scores, kind="stable").tolist():
            kind, start, end = found[i]
            if scores[i] >= model.thresholds[kind] and not overlaps(taken, start, end):
                insort(taken, (start, end))
                out[kind].append((start, end))
    return {k: sorted(v) for k, v in out.items()}


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(documents: DataFrame, *, text: str = "text", keep: list[str] | None = None, redacted: bool = False) -> DataFrame:
    """The kept columns (all by default; those with names of results are left out) with counts of the base spans per kind, a
    digest of them, and all spans as kind:start:end in code points, by kind (email, ip, card, phone) and start.

    With ``redacted``, also the text with each span replaced by its kind in brackets (of overlapping spans the first, then the longest).
    A null or empty text has no spans (redacted: empty). Repeated rows stay.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    own = [x.split()[0] for x in RESULT.split(", ")] + ["redacted"] * redacted
    carried = Carried(documents, text, own, keep)
    inner = carried.inner
    shared = spark.sparkContext.broadcast(fitted())
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in chunks(batch, "_text"):
                texts = pc.fill_null(part.column("_text"), "")
                counts = np.zeros((len(texts), len(KINDS)), np.int64)
                digests, spans = [nothing] * len(texts), [""] * len(texts)
                clean = texts.to_pylist() if redacted else []
                maybe = np.flatnonzero(pc.match_substring_regex(texts, _MAYBE).to_numpy(zero_copy_only=False))
                for i, x in zip(maybe.tolist(), texts.take(pa.array(maybe)).to_pylist(), strict=True):
                    base = base_spans(x)
                    every = chosen(x, base, model)
                    counts[i] = [len(base[k]) for k in KINDS]
                    digests[i] = hashlib.sha256(listed(base).encode()).hexdigest()
                    spans[i] = listed(every)
                    if redacted:
                        clean[i] = redact(x, every)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in inner), *(pa.array(counts[:, k]) for k in range(len(KINDS))), pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()), *([pa.array(clean, pa.string())] if redacted else [])], names=[*inner, *own])

    return carried.through(run, ", ".join([RESULT, *["redacted string"] * redacted]))


def redact(text: str, spans: dict[str, list[Span]]) -> str:
    out, at = [], 0
    for start, minus, kind in sorted((s, -e, k) for k, v in spans.items() for s, e in v):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = -minus
    return "".join([*out, text[at:]])
