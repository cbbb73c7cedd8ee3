"""op5 and op9 at the query against plain Python, and op2's field on texts of another kind than it is trained on."""

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import duck
from demandscope.llm import pii, quality_classifier, token_counts

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split((text or "").encode()) if w]


@needs_data
def test_token_counts_of_every_document(spark):
    model, seen = token_counts.unigram(token_counts.vocabulary_path()), {}

    def tokens(word):
        if word not in seen:
            best = [(0.0, 0)]
            for end in range(1, len(word) + 1):
                size = len(word[end - 1].encode())
                options = [(best[end - 1][0] + size * model.byte, best[end - 1][1] - size)]
                options += [(best[k][0] + model.scores[word[k:end]], best[k][1] - 1) for k in range(max(0, end - model.longest), end) if word[k:end] in model.scores]
                best.append(max(options))
            seen[word] = -best[-1][1]
        return seen[word]

    docs = duck(SF).sql("SELECT doc_id, text FROM documents").fetchall()
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.op5_token_counts(spark, SF).collect()}
    assert got == {i: (len(words(t)), sum(tokens(token_counts.START + w.decode()) for w in words(t))) for i, t in docs}


def _shape(w):
    kinds = ["9" if 48 <= c <= 57 else "A" if 65 <= c <= 90 else "a" if 97 <= c <= 122 or c >= 128 else chr(c) for c in w]
    return "".join(k for k, before in zip(kinds, [None, *kinds], strict=False) if k != before).encode("latin-1")


def _votes(ws):
    n, q = max(len(ws), 1), quality_classifier
    share = lambda f: sum(map(f, ws)) / n
    marks = set(b"#*$%&|<>!?=~^_")
    marked = share(lambda w: len(w) > 1 and w[-1] in marks and w[-2] in marks)
    shout = share(lambda w: len(w) > 1 and w.isupper())
    bang, lone = share(lambda w: w.endswith(b"!!")), share(lambda w: not set(_shape(w)) & set(b"aA9"))
    plain, end = share(lambda w: bool(q.PLAIN.fullmatch(_shape(w)))), share(lambda w: w[-1:] in (b".", b"!", b"?"))
    repeats = sum(a == b for a, b in zip(ws, ws[1:], strict=False)) / n
    distinct, long = len(set(ws)) / n, len(ws) >= 20
    if not ws:
        return [-1] * 8 + [0]
    bad = (marked > 0.2, shout > 0.5, bang > 0.2, lone > 0.2, plain < 0.6, repeats > 0.3, long and distinct < min(0.35, 60 / n), long and end < 0.005)
    good = marked < 0.05 and shout < 0.2 and lone < 0.05 and plain > 0.85 and repeats < 0.1 and (end > 0.01 or not long)
    return [-int(b) for b in bad] + [int(good)]


def _features(ws):
    x = np.zeros(quality_classifier.DIMS)
    for w, before in zip(ws, [None, *ws], strict=False):
        s = _shape(w)
        x[zlib.crc32(b"again " + s[:2] if w == before else s) % quality_classifier.DIMS] += 1
    return np.sqrt(x / max(len(ws), 1)).astype(np.float32)


@needs_data
def test_classifier_of_every_document(spark):
    """Votes, patterns, sample (all rows here) and scores in plain Python; the estimate and the fit are tested on their own."""
    docs = {i: words(t) for i, t in duck(SF).sql("SELECT doc_id, text FROM documents").fetchall()}
    patterns = {i: sum((v + 1) * 3**k for k, v in enumerate(_votes(ws))) for i, ws in docs.items()}
    posterior, _, _ = quality_classifier.estimate(dict(Counter(patterns.values())))
    x = {i: _features(ws) for i, ws in docs.items()}
    ids = sorted(docs)
    w, b = quality_classifier.fit(np.array([x[i].astype(np.float16) for i in ids], dtype=np.float64), np.array([posterior[patterns[i]] for i in ids]))
    got = {r.doc_id: (r.score, r.kept) for r in quality_classifier.op9_quality_classifier(spark, SF).collect()}
    for i in ids:
        score = 1 / (1 + np.exp(-np.clip(float(x[i] @ w.astype(np.float32)) + b, -30, 30)))
        assert abs(got[i][0] - score) < 1e-4 and got[i][1] == (got[i][0] >= quality_classifier.THRESHOLD)


def others(count, seed):
    """Log lines, settings, headers and notes, with the spans of personal data and secrets in them."""
    rnd = random.Random(seed)
    num = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    low = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    hexa = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    out = []
    for _ in range(count):
        kind, before, value, after = rnd.choice((
            ("ip", f"2024-03-{num(2)} 10:{num(2)}:{num(2)} GET /index.html from ", ".".join(str(rnd.randint(1, 254)) for _ in range(4)), f" in {num(2)} ms"), ("email", "Please write to ", f"{low(6)}.{low(4)}@{low(7)}.org", " for details."),
            ("phone", "You can reach the office under ", f"+{rnd.randint(30, 49)} {num(3)} {num(3)} {num(4)}", ", weekdays from 9 to 17."), ("secret", '{"user": "ann", "api_key": "', hexa(40), '"}'), ("secret", "export SECRET_KEY=", mixed(32), " # rotate in 30 days"),
            ("secret", "Authorization: Bearer ", mixed(40), " HTTP/1.1"), (None, f"Version {num(1)}.{num(1)}.{num(1)} was built on 2023-11-{num(2)} with {num(4)} tests; ", "", f"chapter {num(1)}, page {num(3)}."), (None, f"commit {hexa(7)} touched {num(2)} files and ", "", f"{num(3)} lines."),
        ))
        out.append((before + value + after, {(kind, len(before), len(before) + len(value))} if kind else set()))
    return out


def test_field_on_texts_of_another_kind():
    found = total = wrong = 0
    for text, spans in others(400, 77):
        got = set(pii.find(text, pii.trained())[1])
        found, total, wrong = found + len(got & spans), total + len(spans), wrong + len(got - spans)
    assert found >= 0.9 * total and wrong <= 0.1 * total, (found, total, wrong)
