"""Personal data in texts: fixed patterns, and boosted trees over further candidates.

The base spans of four kinds come from fixed patterns and checks, and always
stay. Beside them generators propose spans with high recall, overlapping each
other: addresses written out, in brackets or as entities, base addresses whose
name begins with other Latin letters, IP addresses of version 6, and every window of
digit groups in a run of digits and separators. Boosted trees score a candidate by its format
(kind, digits, separators, check digit, part sizes) and its context (what stands
left and right, words nearby, digits around). Candidates above a threshold are
taken, the best first, of equally good ones the longest, if they overlap nothing
taken before but the base address they end with.

There are no labels, so the trees learn from what can be checked: base spans of
a bounded sample, also rewritten in the forms the patterns miss, are examples;
candidates that fail the checks, and examples broken on purpose, are counter-examples.
Each kind has its own threshold: the lowest with the stated precision when each
fold of them is scored by trees that haven't seen it.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from ipaddress import IPv6Address
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, sampled, texts

# Kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that begins inside a run of digits also begins at its start.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Most texts with candidates to learn from, most base spans and most other candidates of one
# of them, most examples in all, and the precision asked for.
SAMPLE, PER_TEXT, EXAMPLES, PRECISION = 3000, 200, 20_000, 0.99
# Candidates that are scored at a time.
SCORED = 4096
TREES, DEPTH, RATE, FOLDS = 40, 3, 0.2, 4
FEATURES = 34

Span = tuple[int, int, int]  # start, kind, end


def digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def luhn(number: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(number)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Addresses from left to right: what may stand before an at sign, and a domain behind it.

    One look at each at sign, so that long words cost no more than short ones.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, 0, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns that pass their checks, by start, then kind."""
    found: list[Span] = list(emails(text))
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                    found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 14 <= len(number := digits(m.group())) <= 19 and luhn(number):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(digits(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\}|@|&#64;|&#x40;|&commat;)\s?| at |_at_", re.IGNORECASE)
# The first part of a domain, and the others; no dot begins like a part.
PART = re.compile(r"[\w-]+")
PARTS = re.compile(r"(?:(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\])\s?| dot |\.)[\w-]+)+",
                   re.IGNORECASE)
BROKEN_IP = re.compile(r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?\[dot\] ?| dot |\. )[0-9]{1,3}){3}",
                       re.IGNORECASE)
RUN = re.compile(r"\(?\+?[0-9](?:[\x20().\xa0/-]{0,3}[0-9])+")
GROUP = re.compile(r"[0-9]+")
IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
# How a dot in a name is written, and the end of Latin letters with marks.
FILE = re.compile(r"\.(?:py|js|ts|txt|md|html?|json|csv|java|cpp|[ch]|sh|pdf|png|jpg)\Z", re.IGNORECASE)
DOTS, LATIN = (" dot ", " (dot) ", " [dot] ", "(dot)", "[dot]", "{dot}", "[.]"), "\u0250"


def name_start(text: str, end: int, known: tuple[int, int] = (0, 0)) -> int:
    """Where the name that ends at ``end`` begins, however long.

    ``known`` is an end before it and where the name there begins: of marks within
    one name (``_at_``) each is looked at from the one before it.
    """
    start = end
    while start > known[0] and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
        start -= 1
    return known[1] if start == known[0] else start


def written_start(text: str, start: int) -> int:
    """Where a name begins of which ``start`` begins the last part, parts joined by written-out dots."""
    while dot := next((d for d in DOTS if text[max(0, start - len(d)):start].lower() == d), ""):
        part = name_start(text, start - len(dot))
        if part == start - len(dot):
            break
        start = part
    return start


def is_ip6(text: str) -> bool:
    try:
        return bool(IPv6Address(text))
    except ValueError:
        return False


def candidates(text: str) -> Iterator[Span]:
    """Spans that may be personal data, many of them not."""
    # End of the part that marks were last followed by, of its domain (0: none), and a known name.
    stop, right, known = 0, 0, (0, 0)
    for m in AT.finditer(text):
        if m.end() >= stop:
            part = PART.match(text, m.end())
            parts = PARTS.match(text, part.end()) if part else None
            stop, right = part.end() if part else 0, parts.end() if parts else 0
        start = name_start(text, m.start(), known) if right else m.start()
        if right:
            known = m.start(), start
        if start < m.start():
            if (first := written_start(text, start)) < start:
                yield first, 0, right
            yield start, 0, right
    if not DIGIT.search(text):
        return
    if ":" in text:
        for m in IP6.finditer(text):
            if is_ip6(m.group()):
                yield m.start(), 1, m.end()
    for m in BROKEN_IP.finditer(text):
        yield m.start(), 1, m.end()
    for m in RUN.finditer(text):
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in GROUP.finditer(m.group())]
        for i, (start, _) in enumerate(groups):
            size = 0
            for begin, end in groups[i:]:
                size += end - begin
                if size > 19:
                    break
                if size >= 13:
                    yield start, 2, end
                if 9 <= size <= 15:
                    lead = m.start() if i == 0 else start
                    yield lead, 3, end


WORDS = (
    re.compile(r"mail|contact|write|reach", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|address|login", re.IGNORECASE),
    re.compile(r"card|visa|pay|credit|account", re.IGNORECASE),
    re.compile(r"phone|tel|call|mobile|fax|dial", re.IGNORECASE))


def features(text: str, span: Span) -> list[float]:
    start, kind, end = span
    own, number = text[start:end], digits(text[start:end])
    left, right = text[max(0, start - 1):start], text[end:end + 1]
    before, after = text[max(0, start - 32):start], text[end:end + 16]
    groups = GROUP.findall(own)
    marks = set(re.findall(r"[^\w]", own))
    parts = [int(g[:4]) for g in groups]
    return [
        float(kind), len(own), len(number), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), float(len(set(map(len, groups))) <= 1), len(marks),
        float(luhn(number)) if number else -1.0, max(parts, default=-1),
        float(own[:1] == "+" or own[:2] in ("00", "(+")), float("@" in own),
        float("(" in own or "[" in own or "{" in own), float(" dot " in own.lower()),
        float(" at " in own.lower()), float("." in own), float(" " in own), float("-" in own),
        float(left.isalnum()), float(right.isalnum()), float(left.isspace() or not left),
        float(right.isspace() or not right), float(left in "=\"'_#" and bool(left)),
        len(digits(before)), len(digits(after)), float(bool(WORDS[kind].search(before))),
        float(re.search(r"\.[A-Za-z]{2,}\Z", own) is not None),
        float(re.search(r"(?:at[)\]} ]|@)\s?[\w-]+\.", own) is not None),
        own.count(":"), float("&" in own), float("_at_" in own.lower()),
        float(text[max(0, start - 4):start].lower() == "tel:"), len(groups[-1]) if groups else 0,
        float(FILE.search(own) is not None),
    ]


@dataclass
class Trees:
    """Boosted regression trees on the logistic loss; nodes as (feature, cut, left, right, value)."""

    offset: float = 0.0
    trees: list[list[tuple]] = field(default_factory=list)
    # by kind; above 1 nothing is taken
    thresholds: list[float] = field(default_factory=lambda: [2.0] * len(KINDS))

    def __post_init__(self):
        self.key = uuid.uuid4().hex

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.offset)
        for nodes in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                for n in np.unique(at):
                    feature, cut, low, high, _ = nodes[n]
                    if feature >= 0:
                        here = at == n
                        at[here] = np.where(x[here, feature] <= cut, low, high)
            total += np.array([n[4] for n in nodes])[at]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray]) -> list[tuple]:
    nodes: list[tuple] = []

    def node(rows: np.ndarray, depth: int) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        at, best = len(nodes), (1e-6, -1, 0.0)
        nodes.append((-1, 0.0, 0, 0, float(-RATE * g / (h + 1))))
        for feature, values in enumerate(cuts) if depth < DEPTH and len(rows) >= 10 else ():
            column = x[rows, feature]
            for cut in values:
                low = column <= cut
                if not 5 <= low.sum() <= len(rows) - 5:
                    continue
                gl, hl = grad[rows][low].sum(), hess[rows][low].sum()
                gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
                if gain > best[0]:
                    best = (gain, feature, float(cut))
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            nodes[at] = (best[1], best[2], node(rows[low], depth + 1),
                         node(rows[~low], depth + 1), nodes[at][4])
        return at

    node(np.arange(len(x)), 0)
    return nodes


def grown(x: np.ndarray, y: np.ndarray) -> Trees:
    model = Trees()
    rate = np.clip(y.mean(), 0.5 / len(y), 1 - 0.5 / len(y))
    model.offset = float(np.log(rate / (1 - rate)))
    cuts = [np.unique(np.quantile(c, np.linspace(0.05, 0.95, 12), method="nearest")) for c in x.T]
    total = np.full(len(x), model.offset)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        nodes = grow(x, p - y, p * (1 - p), cuts)
        model.trees.append(nodes)
        one = Trees(0.0, [nodes]).score(x)
        total += np.log(one / (1 - one))
    return model


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees of all rows; thresholds from folds, each scored by trees that haven't seen it.

    So every row counts for the threshold of its kind: a few rows of a quarter
    held out would switch a kind off or on by chance.
    """
    if len(x) < 20 or y.min() == y.max():
        return Trees()
    turn, scores = np.arange(len(x)) % FOLDS, np.zeros(len(x))
    for fold in range(FOLDS):
        scores[turn == fold] = grown(x[turn != fold], y[turn != fold]).score(x[turn == fold])
    model, kinds = grown(x, y), x[:, 0]
    for kind in range(len(KINDS)):
        own = kinds == kind
        model.thresholds[kind] = lowest(scores[own], y[own])
    return model


def lowest(scores: np.ndarray, truth: np.ndarray) -> float:
    """The lowest cut from 0.5 on above which the stated share is true; 2 if there is none.

    It lies half-way between the last score taken and the next one below.
    """
    order = np.argsort(-scores, kind="stable")
    ranked = scores[order]
    share = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
    # equal scores are taken together, so only the last of them is a cut
    last = np.append(ranked[1:] != ranked[:-1], True)[:len(ranked)]
    fine = np.flatnonzero(last & (share >= PRECISION))
    if not len(fine):
        return 2.0
    below = ranked[fine[-1] + 1] if fine[-1] + 1 < len(ranked) else 0.0
    return max(0.5, float(ranked[fine[-1]] + below) / 2)


def rewritten(text: str, span: Span, rng) -> Iterator[tuple[str, Span, int]]:
    """A base span in forms that the patterns miss (1), or broken on purpose (0)."""
    start, kind, end = span
    own = text[start:end]

    def put(new: str, label: int, off: int = 0, short: int = 0) -> tuple[str, Span, int]:
        return (text[:start] + new + text[end:], (start + off, kind, start + len(new) - short), label)

    flip = rng.integers(0, len(own))
    if kind == 0:
        name, _, host = own.rpartition("@")
        turn = zlib.crc32(own.encode())
        forms = [name + at + host.replace(".", dot) for at, dot in (
            (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", "."), ("(at)", "."),
            ("{at}", "{dot}"), (" at ", ("[dot]", " (dot) ", "{dot}")[turn % 3]),
            (" AT ", ("[.]", "(dot)", " [dot] ")[turn % 3]), ("_at_", "."), ("&#64;", "."),
            ("&commat;", "."))]
        parts = name.split(".") if "." in name.strip(".") else [name, "lee"]
        forms.append(" dot ".join(parts) + " at " + host.replace(".", " dot "))
        forms.append("\u00f6" + own)
        # eight of the forms, other ones for other addresses
        for n in range(8):
            yield put(forms[(turn + n) % len(forms)], 1)
        yield put(f"{name} at {host}", 0)
        yield put(f"{name} at {host} dot by", 0)
        yield put(f"{name} at {host.replace('.', ' ')}" if turn % 2 else
                  f"{name}_at_{host.partition('.')[0]}.{('py', 'txt', 'html')[turn % 3]}", 0)
    elif kind == 1:
        for dot in ("[.]", "(.)", "[dot]", " dot "):
            yield put(own.replace(".", dot), 1)
        yield put(own.replace(".", ". "), 0)
        yield put("[.]".join(["9" + p.zfill(2) for p in own.split(".")]), 0)
        six = [f"{int(p):x}" for p in own.split(".")]
        yield put("2001:db8:" + ":".join([*six, "0", "1"]), 1)
        yield put(f"fe80::{':'.join(six)}", 1)
        yield put(f"2001:db8:{six[0]}::{six[3]}", 1)
        yield put(f"{six[0]}::{six[1]}", 0)
    elif kind == 2:
        number = digits(own)
        for mark in ("/", ".", "  "):
            yield put(mark.join(re.findall("[0-9]{1,4}", number)), 1)
        yield put("7 " + own, 1, 2)
        at = min(flip, len(number) - 1)
        wrong = number[:at] + str((int(number[at]) + 1 + int(rng.integers(0, 8))) % 10) + number[at + 1:]
        if not luhn(wrong):
            yield put(wrong, 0)
            yield put(" ".join(re.findall("[0-9]{1,4}", wrong)), 0)
        yield put("a" + own + "f", 0, 1)
    else:
        yield put("00" + own[1:], 1)
        yield put("(" + own[:3] + ") " + own[3:], 1)
        yield put(own.replace(" ", "/").replace("-", "/"), 1 if "/" not in own and "-" in own else 0)
        yield put(digits(own), 0)
        yield put("x" + digits(own) + "c", 0, 1)
        n = digits(own)[-10:]
        if len(n) == 10:
            area, office, line = n[:3], n[3:6], n[6:]
            country = digits(own)[:-10] or "1"
            yield put(("-", ".", " ")[flip % 3].join((area, office, line)), 1)
            yield put(f"0{n[:2]} {n[2:6]} {n[6:]}", 1)
            yield put(f"00{country} {area} {office} {line}", 1)
            yield put(f"00 {country} {n[:2]} {n[2:6]} {n[6:]}", 1)
            yield put(f"00 {country} {n[:2]} {n[2:6]} {n[6:]}", 0, 0, 5)
            yield put(f"{area}-{office}-{line} 12", 0, 4)
            yield put(f"{n[:4]}-{n[4:7]}-{n[7:]}{n[0]}", 0)
            yield put(f"tel:{n}", 1, 4)
            yield put(f"{n[0]}-{n[1:4]}-{n[4:9]}-{n[9]}", 0)
            yield put(f"20{n[:2]}-{n[2:4]}-{n[4:6]} {n[6:]}", 0)


def marked(text: str, taken: list[Span]) -> bytearray:
    """A byte for each code point, 1 inside a span."""
    out = bytearray(len(text))
    for start, _, end in taken:
        out[start:end] = b"\1" * (end - start)
    return out


def some(spans: Iterable[Span], most: int, rng) -> list[Span]:
    """All spans, or ``most`` of them picked evenly at random."""
    kept: list[Span] = []
    for n, span in enumerate(spans):
        if n < most:
            kept.append(span)
        elif (at := int(rng.integers(0, n + 1))) < most:
            kept[at] = span
    return kept


def examples(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels from texts, see the module's text; a bounded number of each text."""
    x, y = [], []
    for text in rows:
        rng = np.random.default_rng(zlib.crc32(text.encode()))
        base = base_spans(text)
        held, covered = set(base), marked(text, base)
        for span in some(candidates(text), PER_TEXT, rng):
            start, kind, end = span
            if span in held:
                x.append(features(text, span))
                y.append(1)
            elif not any(covered[start:end]):
                x.append(features(text, span))
                y.append(0)
        for span in some(base, PER_TEXT, rng):
            start, kind, end = span
            low = max(0, start - 64)
            near, moved = text[low:end + 64], (start - low, kind, end - low)
            for made, at, label in rewritten(near, moved, rng):
                x.append(features(made, at))
                y.append(label)
    return np.array(x, float).reshape(-1, FEATURES), np.array(y, float)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Trees:
    """Learn from texts with a digit or an at sign, about ``sample`` of them at most.

    The sample is hashed, so it is the same in every run. Only the features of
    a bounded number of candidates of each text come to the driver.
    """
    on_workers(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string").alias("text")).where("text rlike '[0-9@]'")
    got = sampled(rows, sample).mapInArrow(
        _examples, "x array<double>, y double").toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, FEATURES)
    y = got.column("y").to_numpy()
    order = np.lexsort((*x.T, y))
    order = np.random.default_rng(4).permutation(order)[:EXAMPLES]
    return boost(x[order], y[order])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = examples(texts(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), pa.list_(pa.float64())), pa.array(y)], names=["x", "y"])


def spans(text: str, model: Trees) -> list[Span]:
    """Base spans and added ones, by start, then kind.

    Candidates are scored in blocks, so that a long text full of digits holds
    no more than those above their thresholds.
    """
    base = base_spans(text)
    if min(model.thresholds) > 1:
        return base
    covered = marked(text, base)
    cuts = np.array(model.thresholds)
    ends = {end: start for start, kind, end in base if kind == 0}

    def free_to(c: Span) -> int:
        """Where the part of a candidate ends that must be free: it may end with a base address."""
        start = ends.get(c[2], -1) if c[1] == 0 else -1
        return start if start > c[0] and max(text[c[0]:start]) < LATIN else c[2]

    free = (c for c in candidates(text) if not any(covered[c[0]:free_to(c)]))
    good: list[tuple[float, Span]] = []
    while block := list(islice(free, SCORED)):
        scores = model.score(np.array([features(text, c) for c in block]))
        above = np.flatnonzero(scores >= cuts[[c[1] for c in block]])
        good += [(-float(scores[i]), block[i]) for i in above]
    taken = list(base)
    for _, c in sorted(good, key=lambda g: (g[0], g[1][0] - g[1][2])):
        if not any(covered[c[0]:free_to(c)]):
            taken.append(c)
            covered[c[0]:c[2]] = b"\1" * (c[2] - c[0])
    return sorted(taken)


def written(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def masked(text: str, found: list[Span]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for start, kind, end in sorted(found):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _find(batches: Iterator[pa.RecordBatch], model: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in rows_of(batch):
            rows = texts(part.column("text"))
            base, found = [base_spans(t) for t in rows], [spans(t, model) for t in rows]
            # a text without a span goes back as it came, null included
            clean = [old if not f else masked(t, f) for old, t, f in zip(
                part.column("text").to_pylist(), rows, found)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array([written(b) for b in base], pa.string()),
                 pa.array([written(f) for f in found], pa.string()),
                 pa.array(clean, pa.string())],
                names=["doc", "base", "spans", "masked"])


def found(docs: DataFrame, model: Trees, keep: list[str] | None = None) -> DataFrame:
    """Personal data of every whole text: a row per row.

    Returns a struct ``doc`` of the columns in ``keep`` (default: the id),
    ``base`` and ``spans`` (``kind:start:end`` in code points, comma-joined; all
    spans hold the base ones), and the text with all spans ``masked``. A null
    text has no spans and stays null; equal texts have equal spans, repeated rows are
    each returned, further columns are not read unless kept; no rows give no rows.
    """
    on_workers(docs.sparkSession)
    rows = docs.select(F.struct(*(keep or ["doc_id"])).alias("doc"),
                       F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(partial(_find, model=model),
                           f"doc {kind}, base string, spans string, masked string")
