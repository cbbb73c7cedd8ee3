import os
import random
import re

import pyarrow as pa
import pytest
from compare import duck
from demandscope.llm import licenses

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scan(*texts):
    return [r[5:] for r in licenses.scanner().scan(pa.array(texts))]


def test_notice_that_begins_a_longer_template():
    short = 'Licensed under the Apache License, Version 2.0 (the "License")'
    assert scan(short, "x " + short + " y", "Licensed under the Apache License, Version 2.0. The end") == [("apache,apache-2.0", 1.0)] * 3


def test_a_run_in_a_longer_one_is_no_other_label():
    for label, texts in licenses.TEMPLATES.items():
        for text in texts:
            (labels, score), = scan(text)
            assert label in labels.split(",") and score == 1.0
            assert set(labels.split(",")) - {label} <= set(licenses.PHRASES.values())


def test_runs_of_each_template_at_each_place():
    rnd = random.Random(11)
    for _ in range(60):
        seqs = [[rnd.randrange(3) for _ in range(rnd.randint(3, 14))] for _ in range(3)]
        text = [rnd.randrange(3) for _ in range(25)]
        want = set()
        for t, seq in enumerate(seqs):
            for i in range(1, len(text) + 1):
                for e in range(1, len(seq) + 1):
                    n = 0
                    while n < min(i, e) and text[i - n - 1] == seq[e - n - 1]:
                        n += 1
                    if n >= 3 and (i == len(text) or e == len(seq) or text[i] != seq[e]):
                        want.add((i, t, e - n, e))
        got = licenses.Automaton(seqs).matches(text, 3)
        assert len(got) == len(set(got)) and set(got) == want


def test_words_count_once():
    scanner, rnd = licenses.scanner(), random.Random(12)
    words = licenses.TEMPLATES["bsd"][0].split()
    for _ in range(100):
        kept = [w for w in words if rnd.random() < 0.9]
        found = scanner.scan(pa.array([" ".join(kept)]))[0]
        assert found[6] <= len(kept) / len(words)


def _brute(text, templates):
    """Labels and score from the definition: runs word by word, chains by comparing all pairs."""
    ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    rows = {}
    for t, (_, seq) in enumerate(templates):
        where = {}
        for e, w in enumerate(seq, 1):
            where.setdefault(w, []).append(e)
        before, found = {}, []
        for i, w in enumerate(ws, 1):
            now = {e: before.get(e - 1, 0) + 1 for e in where.get(w, ())}
            for e, n in now.items():
                if n >= min(licenses.LONG, len(seq)) and (i == len(ws) or e == len(seq) or ws[i] != seq[e]):
                    found.append((i, e - n, e))
            before = now
        if found:
            rows[t] = sorted(found)

    def chain(found):
        value, group, last = [], 0, None
        for k, (at, a, b) in enumerate(found):
            start = at - (b - a)
            if last is None or start - last > licenses.GAP:
                group = k
            last = at
            best = b - a
            for j in range(group, k):
                x, _, y = found[j]
                if x < at and y < b:
                    best = max(best, value[j] + min(b - max(a, y), at - max(start, x)))
            value.append(best)
        return max(value) if value else 0

    values = {t: chain(f) for t, f in rows.items()}
    return len(ws), max((v / len(templates[t][1]) for t, v in values.items()), default=0.0), {templates[t][0] for t, v in values.items() if v / len(templates[t][1]) >= licenses.COVERED}


@needs_data
def test_scores_and_labels_of_the_query(spark):
    """Scores are those of the definition; labels are among those covered, hold the best one's, and all the base's."""
    templates = [(label, text.split()) for label, texts in licenses.TEMPLATES.items() for text in texts]
    docs = dict(duck(SF).sql("SELECT doc_id, text FROM documents").fetchall())
    rnd = random.Random(21)
    for k, (label, words) in enumerate(templates):  # whole, cut and edited texts of every template
        docs[10**6 + 2 * k] = "before it " + " ".join(words) + " after it"
        docs[10**6 + 2 * k + 1] = " ".join(w if rnd.random() < 0.93 else "changed" for w in words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    labelled = 0
    for r in licenses.scan_licenses(df).collect():
        n, score, covered = _brute(docs[r.doc_id], templates)
        base, labels = set(filter(None, r.base_labels.split(","))), set(filter(None, r.labels.split(",")))
        assert r.n_words == n and abs(r.score - score) < 1e-12, r.doc_id
        assert base <= labels and labels - base <= covered and (not covered or labels & covered)
        labelled += bool(covered)
    assert labelled >= 1.5 * len(templates)


def test_other_templates(spark):
    df = spark.createDataFrame([(1, "Do what you like, and then some more of that."), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(df, {"free": ["Do what you like and then some"]}).collect()}
    assert got == {1: ("free", 1.0), 2: ("", 0.0)}
