"""The mix against a fair queue in plain Python: words of all sources in one order of virtual finish times, cut at the budget."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import pytest
from corpora import SCHEMA, documents, rows
from demandscope.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def queue(docs, targets):
    """(doc_id, source, size, finish, taken) of each row of (doc_id, text, source)."""
    line, size = defaultdict(list), Counter()
    for i, t, s in docs:
        text = "null" if t is None else hashlib.md5(t.encode()).hexdigest()
        key = hashlib.md5(f"mix|{'null' if i is None else i}|{text}".encode()).hexdigest()
        n = len(WORD.findall(t or ""))
        line[s].append((key, n, i))
        size[s] += n
    ranked = sorted(line, key=lambda s: (s is None, (s or "").encode()))
    words = lambda rank, s: ((k / targets[s], rank, k) for k in range(1, 2 * size[s] + 1))
    budget, served = int(1.5 * sum(size.values())), Counter()
    for (_, rank, _), _ in zip(heapq.merge(*(words(r, s) for r, s in enumerate(ranked) if targets[s] > 0)), range(budget), strict=False):
        served[ranked[rank]] += 1
    out = []
    for s, entries in line.items():
        upto = 0
        for _, n, i in sorted(entries, key=lambda x: x[:2]):
            taken = sum(max(0, min(n, served[s] - upto - size[s] * e)) for e in (0, 1))
            upto += n
            out.append((i, s, n, upto / targets[s] if targets[s] else None, taken))
    return Counter(out)


def table(seed):
    rnd, out = random.Random(seed), []
    for k in range(160):
        text = rnd.choice((None, "", "same words here", " ".join("w" for _ in range(rnd.choice((1, 5, 40, 900))))))
        out.append((rnd.choice((k, k, 7, None)), text, rnd.choice(("a", "a", "a", "b", "c", "d", "", None))))
    return out + [(None, "one hot row", "a")] * 90


@pytest.mark.parametrize("few", [4, 100_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_queue(spark, monkeypatch, seed, few):
    monkeypatch.setattr(mixing, "SORTED_WORDS", few)
    monkeypatch.setattr(mixing, "TIME_RANGES", 16 if few < 100 else 1024)
    monkeypatch.setattr(mixing, "TOGETHER", 8)
    docs = table(seed)
    got = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    targets = {r.source: r.target for r in got}
    assert Counter((r.doc_id, r.source, r.size, r.finish, r.taken) for r in got) == queue(docs, targets)
    assert sum(r.taken for r in got) == int(1.5 * sum(r.size for r in got))


def test_queue_on_the_awkward_table(spark):
    got = mixing.mix(documents(spark)).collect()
    assert Counter((r.doc_id, r.source, r.size, r.finish, r.taken) for r in got) == queue([(r[0], r[1], r[3]) for r in rows()], {r.source: r.target for r in got})


def test_few_words(spark):
    for docs in ([(1, "a", "x")], [(1, None, "x"), (2, "", None)], [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], [(k, "w", str(k)) for k in range(40)]):
        got = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
        assert Counter((r.doc_id, r.source, r.size, r.finish, r.taken) for r in got) == queue(docs, {r.source: r.target for r in got})


def test_the_written_mix_follows_the_queue(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TOGETHER", 8)
    docs = [(i, t, "en", s, *[None] * 11) for i, t, s in table(4)]
    df = spark.createDataFrame(docs, SCHEMA)
    want = Counter()
    for r in mixing.mix(df).collect():
        whole, part = divmod(r.taken, r.size) if r.size else (0, 0)
        want[r.doc_id, r.source, r.size] += whole + (r.size > 0 and 2 * part >= r.size)
    got = Counter()
    taken = mixing.take(df)
    assert taken.columns == df.columns
    for r in taken.collect():
        n = len(WORD.findall(r.text or ""))
        got[r.doc_id, r.source, n] += n > 0
    assert +got == +want
