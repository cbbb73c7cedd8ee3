"""Personal data: fixed patterns, and a semi-Markov conditional random field for what patterns leave.

The field scores whole spans: features look at all of a candidate's characters (its shape, digits, checksum, length), at its neighbours and the
words before it. A dynamic program over the tokens of a stretch, with entities of at most ``LONGEST`` tokens, chooses boundaries and types together;
outside entities each token stands alone. Every entity holds a digit or an at sign, so stretches without one decode to nothing and are
skipped exactly. Weights are trained here, by gradient steps on the likelihood of generated sentences (``sentences``); no row of the corpus
is used.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow, slices, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
LABELS = ("other", *KINDS)
LONGEST = 16

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A match that starts inside a run of digits also starts at its first digit, so looking behind drops none and avoids retries along long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from its at signs: linear in the text."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; leftmost matches of each kind, failing ones dropped."""
    if not _TRIGGER.search(text):
        return []
    out = [("email", *s) for s in emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return sorted(out, key=_order)


def _order(span):
    return span[1], KINDS.index(span[0]), span[2]


# ---- candidates and features

_TOKEN = re.compile(r"[^\W_]+|\S")
_REST = re.compile(r"\S*")
_MORE = re.compile(r" {1,3}(?=\S*?[0-9@])(?=\S)")
_SHAPES = (
    ("is email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("is ip", re.compile(r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}")),
    ("is phone", re.compile(r"\+?[0-9(][\x20().0-9-]+[0-9]")),
    ("is grouped", re.compile(r"[0-9]+(?:[\x20-][0-9]+)+")),
    ("is digits", re.compile(r"[0-9]+")),
    ("is hex", re.compile(r"(?=.*[a-f])(?=.*[0-9])[0-9a-f]{16,}")),
    ("is key", re.compile(r"(?=.*[A-Z])(?=.*[0-9])[A-Z0-9]{16,}")),
    ("is mixed", re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])[A-Za-z0-9_-]{16,}")),
    ("is date", re.compile(r"[0-9]{1,4}[-./][0-9]{1,2}[-./][0-9]{1,4}")),
    ("is decimal", re.compile(r"[0-9]+\.[0-9]+")),
    ("begins as date", re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[ T].*)?", re.S)),
    ("is time", re.compile(r"[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?")),
)
_BEFORE = (
    ("after secret", re.compile(r"(?:pass|pwd|token|secret|key|auth)\w*\W{0,5}$", re.I)),
    ("after card", re.compile(r"(?:card|visa|credit)\w*\W{0,4}$", re.I)),
    ("after phone", re.compile(r"(?:phone|tel|call|mobile|fax)\w*\W{0,4}$", re.I)),
    ("after mail", re.compile(r"(?:mail|contact)\w*\W{0,4}$", re.I)),
    ("after host", re.compile(r"(?:ip|host|server|address)\W{0,4}$", re.I)),
)
_NAMES = [n for n, _ in _SHAPES] + [n for n, _ in _BEFORE] + ["bias", "checksum", "card digits", "phone digits", "few digits", "many digits", "has @", "has space", "has letter", "one token", "joined left", "joined right", "plus", "known start"]
FEATURE = {n: k for k, n in enumerate(_NAMES)}


def zones(text: str):
    """(start, end) of stretches of text pieces that hold a digit or an at sign, with no more than spaces between them."""
    at = 0
    while m := _TRIGGER.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _REST.match(text, m.start()).end()
        while more := _MORE.match(text, end):
            end = _REST.match(text, more.end()).end()
        yield start, end
        at = end


def span_features(text: str, start: int, end: int, tokens: int) -> list[int]:
    span = text[start:end]
    out = [FEATURE[n] for n, p in _SHAPES if p.fullmatch(span)]
    before = text[max(0, start - 24) : start]
    out += [FEATURE[n] for n, p in _BEFORE if p.search(before)]
    digits = _NOT_DIGITS.sub("", span)
    n = len(digits)
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    found = {
        "bias": True, "checksum": 14 <= n <= 19 and luhn(digits), "card digits": 14 <= n <= 19, "phone digits": 10 <= n <= 15, "few digits": n < 7, "many digits": n > 19, "has @": "@" in span,
        "has space": " " in span, "has letter": any(c.isalpha() for c in span), "one token": tokens == 1, "joined left": left.isalnum() or left in ("@", ".", "-", "+") and left != "",
        "joined right": right.isalnum() or right == "@" or (right in (".", "-") and text[end + 1 : end + 2].isalnum()), "plus": span[0] == "+", "known start": span.startswith("AKIA"),
    }
    return out + [FEATURE[k] for k, v in found.items() if v]


def _tokens(text: str, start: int, end: int):
    """(starts, ends, whether they hold a digit or an at sign) of a stretch's tokens."""
    starts, ends, trigger = array("q"), array("q"), bytearray()
    for m in _TOKEN.finditer(text, start, end):
        starts.append(m.start())
        ends.append(m.end())
        trigger.append(_TRIGGER.search(text, m.start(), m.end()) is not None)
    return starts, ends, trigger


def _segments(text: str, starts, ends, trigger, first: int, last: int):
    """(candidate segments that begin at tokens first to last - 1, their features as a 0/1 matrix)."""
    segments, rows = [], []
    for i in range(first, last):
        a = starts[i]
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        seen = False
        for j in range(i, min(i + LONGEST, len(starts))):
            seen = seen or trigger[j]
            b = ends[j]
            if seen and text[b - 1].isalnum():
                segments.append((i, j + 1))
                rows.append(span_features(text, a, b, j + 1 - i))
    x = np.zeros((len(rows), len(FEATURE)))
    for k, r in enumerate(rows):
        x[k, r] = 1
    return segments, x


def candidates(text: str, start: int, end: int):
    """(token bounds, candidate segments as (first, end) tokens, their features as a 0/1 matrix) of a stretch."""
    starts, ends, trigger = _tokens(text, start, end)
    return list(zip(starts, ends, strict=True)), *_segments(text, starts, ends, trigger, 0, len(starts))


# ---- the field

class Field:
    """Weights of features by kind, and of a label after another."""

    def __init__(self):
        self.w = np.zeros((len(FEATURE), len(KINDS)))
        self.t = np.zeros((len(LABELS), len(LABELS)))

    def _ending(self, n: int, segments):
        by = [[] for _ in range(n + 1)]
        for k, (i, j) in enumerate(segments):
            by[j].append((k, i))
        return by

    def decode(self, n: int, segments, x: np.ndarray) -> list[tuple[int, int, int]]:
        """Best labelling as (first, end, label) of entities."""
        return self.best(n, [(n, segments, x @ self.w)])

    def best(self, n: int, blocks) -> list[tuple[int, int, int]]:
        """The same from blocks (end of their first tokens, segments, scores) in order; of what lies ``LONGEST`` tokens back only the path is kept."""
        blocks, upto, size = iter(blocks), 0, len(LABELS)
        ending: dict[int, list] = {}
        back, came = np.zeros((n + 1, size), dtype=np.int32), np.zeros((n + 1, size), dtype=np.int8)
        arrive: list = [None] * (LONGEST + 1)
        for j in range(n + 1):
            best = [-np.inf] * size
            if j:
                best[0], back[j, 0] = arrive[(j - 1) % (LONGEST + 1)][0], j - 1
                for i, score in ending.pop(j, ()):
                    at = arrive[i % (LONGEST + 1)]
                    for y in range(1, size):
                        v = at[y] + score[y - 1]
                        if v > best[y]:
                            best[y], back[j, y] = v, i
            else:
                best[0] = 0.0
            through = np.array(best)[:, None] + self.t
            arrive[j % (LONGEST + 1)], came[j] = through.max(axis=0).tolist(), through.argmax(axis=0)
            if j == upto < n:
                upto, segments, scores = next(blocks)
                for (i, end), score in zip(segments, scores.tolist(), strict=True):
                    ending.setdefault(end, []).append((i, score))
        out, j, y = [], n, int(np.argmax(best))
        while j:
            i = int(back[j, y])
            if y:
                out.append((i, j, y))
            j, y = i, int(came[i, y])
        return out[::-1]

    def gradient(self, n: int, segments, x: np.ndarray, gold: dict[tuple[int, int], int]):
        """Gradient of the log-likelihood of the gold entities: what they have, less what the field expects."""
        score, by, size = x @ self.w, self._ending(n, segments), len(LABELS)
        lse = np.logaddexp.reduce
        a = np.full((n + 1, size), -np.inf)
        a[0, 0] = 0
        arrive = np.zeros((n + 1, size))
        arrive[0] = lse(a[0][:, None] + self.t, axis=0)
        for j in range(1, n + 1):
            a[j, 0] = arrive[j - 1, 0]
            if by[j]:
                a[j, 1:] = lse(np.stack([arrive[i, 1:] + score[k] for k, i in by[j]]), axis=0)
            arrive[j] = lse(a[j][:, None] + self.t, axis=0)
        z = lse(a[n])
        leave: list[list] = [[] for _ in range(n + 1)]
        for k, (i, j) in enumerate(segments):
            leave[i].append((k, j))
        b = np.full((n + 1, size), -np.inf)  # from a boundary with the label before it to the end
        b[n] = 0
        gw, gt = np.zeros_like(self.w), np.zeros_like(self.t)
        follow = np.full((n + 1, size), -np.inf)
        for i in range(n - 1, -1, -1):
            follow[i, 0] = b[i + 1, 0]
            if leave[i]:
                parts = np.stack([score[k] + b[j, 1:] for k, j in leave[i]])
                follow[i, 1:] = lse(parts, axis=0)
                share = np.exp(np.minimum(arrive[i, 1:] + parts - z, 0))
                gw -= x[[k for k, _ in leave[i]]].T @ share
            b[i] = lse(self.t + follow[i][None, :], axis=1)
            with np.errstate(invalid="ignore"):
                gt -= np.nan_to_num(np.exp(np.minimum(a[i][:, None] + self.t + follow[i][None, :] - z, 0)))
        at, y, where = 0, 0, {i: (j, k) for k, (i, j) in enumerate(segments) if (i, j) in gold}
        while at < n:
            if at in where:
                j, k = where[at]
                to = gold[segments[k]]
                gw[:, to - 1] += x[k]
            else:
                j, to = at + 1, 0
            gt[y, to] += 1
            at, y = j, to
        return gw, gt


def sentences(count: int = 240, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Generated texts with the spans they hold."""
    rnd = random.Random(seed)
    pick = rnd.choice
    num = lambda n: "".join(pick("0123456789") for _ in range(n))
    word = lambda: "".join(pick("abcdefghilmnoprstu") for _ in range(rnd.randint(2, 8)))

    def card():
        body = pick("45") + num(pick((13, 14, 14, 14, 15)))
        full = next(body + c for c in "0123456789" if luhn(body + c))
        sep = pick(("", "", " ", "-"))
        return sep.join(full[k : k + 4] for k in range(0, len(full), 4)) if sep else full

    makers = {
        "email": lambda: f"{word()}{pick(('', '.', '_'))}{num(rnd.randint(0, 2))}@{word()}{pick(('', '8', '-x'))}.{pick(('com', 'org', 'co.uk', 'example.net'))}",
        "ip": lambda: ".".join(str(rnd.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: pick((f"+{rnd.randint(1, 99)} ({num(3)}) {num(3)}-{num(4)}", f"+{rnd.randint(1, 99)} {num(3)} {num(3)} {num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"+{num(11)}")),
        "secret": lambda: pick((f"AKIA{''.join(pick('ABCDEFGHJKLMNPQRSTUVWXYZ234567') for _ in range(16))}", "".join(pick("0123456789abcdef") for _ in range(pick((18, 32, 40)))))),
    }
    plain = (lambda: f"{rnd.randint(1, 9)}.{rnd.randint(0, 9)}", lambda: num(rnd.randint(1, 6)), lambda: f"{rnd.randint(1990, 2030)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}", lambda: f"{rnd.randint(1990, 2030)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}{pick(' T')}{rnd.randint(10, 23)}:{rnd.randint(10, 59)}:{rnd.randint(10, 59)}", lambda: f"{rnd.randint(10, 23)}:{rnd.randint(10, 59)}", lambda: f"{word()}{num(1)}", lambda: "9" + num(11), lambda: f"{num(3)}.{num(3)}.{num(2)}", lambda: f"@{word()}", lambda: f"{num(1)}/{num(2)}", lambda: f"${num(2)}.{num(2)}")
    lead = {"email": ("", "mail ", "contact: "), "ip": ("", "host ", "from "), "card": ("", "card ", "visa: "), "phone": ("", "tel ", "call: "), "secret": ("password=", 'token = "', "key: ", "secret ")}
    out = []
    for _ in range(count):
        text, spans = word(), []
        for _ in range(rnd.randint(1, 3)):
            text += " " + word() * rnd.randint(0, 1) + " "
            if rnd.random() < 0.45:
                text += pick(plain)()
            else:
                kind = pick(KINDS)
                value = makers[kind]()
                before = "" if value.startswith("AKIA") else pick(lead[kind])
                text += before
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + ('"' if before.endswith('"') else pick(("", "", ".", ",")))
        out.append((text + " " + word(), spans))
    return out


@cache
def trained(epochs: int = 6, rate: float = 0.3) -> Field:
    field = Field()
    cases = []
    for text, spans in sentences():
        for a, b in zones(text):
            tokens, segments, x = candidates(text, a, b)
            bounds = {(tokens[i][0], tokens[j - 1][1]): (i, j) for i, j in segments}
            mine = [(k, s, e) for k, s, e in spans if a <= s and e <= b]
            if all((s, e) in bounds for _, s, e in mine):
                cases.append((len(tokens), segments, x, {bounds[s, e]: LABELS.index(k) for k, s, e in mine}))
    order = random.Random(3)
    for epoch in range(epochs):
        order.shuffle(cases)
        for n, segments, x, gold in cases:
            gw, gt = field.gradient(n, segments, x, gold)
            step = rate / (1 + epoch)
            field.w += step * (gw - 1e-3 * field.w)
            field.t += step * (gt - 1e-3 * field.t)
    return field


BLOCK = 512  # tokens whose segments are scored at once


def _scored(text: str, tokens, field: Field):
    n = len(tokens[0])
    for first in range(0, n, BLOCK):
        last = min(n, first + BLOCK)
        segments, x = _segments(text, *tokens, first, last)
        yield last, segments, x @ field.w


def field_spans(text: str, field: Field) -> list[tuple[str, int, int]]:
    """Entities that the field finds. Each stretch is decoded whole; segments are scored by blocks, so a long one takes some 50 bytes a token."""
    out = []
    for a, b in zones(text):
        tokens = _tokens(text, a, b)
        starts, ends, _ = tokens
        out += [(LABELS[y], starts[i], ends[j - 1]) for i, j, y in field.best(len(starts), _scored(text, tokens, field))]
    return out


def find(text: str | None, field: Field) -> tuple[list, list]:
    """(base spans, all spans): the field's spans are added where they overlap no base span."""
    if not text:
        return [], []
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else starts
    more = []
    for kind, s, e in field_spans(text, field):
        k = int(np.searchsorted(starts, e))  # base spans that start before this one ends
        if not k or reach[k - 1] <= s:
            more.append((kind, s, e))
    return base, sorted(base + more, key=_order)


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _found(field: Field):
    def run(batches):
        for b in slices(batches, "text"):
            rows = [find(t, field) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in rows], pa.int64()) for kind in BASE]
            digests = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows])
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digests, pa.array([joined(every) for _, every in rows], pa.string())], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return run


def find_pii(docs: DataFrame) -> DataFrame:
    """Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row for each row of ``docs`` (doc_id, text used).

    Counts and digest are of the base spans; ``spans`` also has the field's. Null and empty texts have none; null ids and repeated rows give
    rows of their own; an empty table gives an empty table; other columns are ignored; texts are searched whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return arrow(docs.select("doc_id", "text"), _found(trained()), schema)


def op2_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents"))
