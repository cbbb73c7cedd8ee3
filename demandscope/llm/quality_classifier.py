"""Quality classifier from weak labels.

Heuristic labellers vote on every document: bad, good, or no vote. Their votes overlap; expectation-maximisation over the counts of
vote patterns of the whole corpus (at most ``3 ** labellers`` rows) estimates the share of good documents and the accuracy of each
labeller. The posterior of a document's pattern is its label, and a logistic scorer over hashed shapes of words is
trained on the posteriors of a bounded sample (``TRAIN_ROWS``, the rows with the smallest hash). Every document is then scored whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, materialize, release, slices, table

DIMS = 1024
TRAIN_ROWS = 4000
ROUNDS = 200
STEPS = 400
THRESHOLD = 0.5
MARKS = b"#*$%&|<>!?=~^_"
LABELLERS = ("marked words", "shouting", "exclamations", "lone marks", "odd shapes", "repeats", "few distinct words", "no sentences", "plain prose")
PLAIN = re.compile(rb"A?a(['-]A?a)*[.,;:!?)]?|A[.,]?|9([.,]9)*[.,]?")

_CLASSES = bytes(ord("9") if 48 <= c <= 57 else ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """Kinds of characters with runs as one: ``Word,`` is ``Aa,`` and ``WORD!!`` is ``A!``."""
    return _RUNS.sub(rb"\1", word.translate(_CLASSES))


class Words:
    """Words of a slice of texts as codes, with what is known of each distinct word."""

    def __init__(self, texts: pa.Array):
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = pieces.values.dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        code = coded.indices.to_numpy()
        real = np.array([len(w) > 0 for w in words], dtype=bool)[code] if len(words) else np.zeros(0, bool)
        self.rows = len(texts)
        self.doc = np.repeat(np.arange(self.rows), np.diff(pieces.offsets.to_numpy()))[real]
        self.code = code[real]
        self.words = words
        self.n = np.bincount(self.doc, minlength=self.rows)

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=values, minlength=self.rows)

    def of(self, f) -> np.ndarray:
        """``f`` of each distinct word, at each word's place."""
        return np.array([f(w) for w in self.words], dtype=np.float64)[self.code] if len(self.words) else np.zeros(0)

    def same_as_before(self) -> np.ndarray:
        out = np.zeros(len(self.code), dtype=bool)
        out[1:] = (self.code[1:] == self.code[:-1]) & (self.doc[1:] == self.doc[:-1])
        return out

    def distinct(self) -> np.ndarray:
        pairs = np.unique(self.doc.astype(np.int64) * (len(self.words) + 1) + self.code)
        return np.bincount(pairs // (len(self.words) + 1), minlength=self.rows)


def votes(w: Words) -> np.ndarray:
    """-1 (bad), 0 (no vote) or 1 (good) of each labeller: rows x labellers.

    Detectors only vote bad, each kind of trouble being measured in two ways at least; one labeller votes good, where nothing stands out.
    """
    n = np.maximum(w.n, 1)
    kinds = np.array([_kind(x) for x in w.words], dtype=np.uint8) if len(w.words) else np.zeros(0, np.uint8)
    of = kinds[w.code] if len(w.words) else np.zeros(0, np.uint8)
    share = lambda bit: w.per_doc((of & bit) > 0) / n
    marked, shout, bang, lone, plain, end = (share(1 << k) for k in range(6))
    repeats = w.per_doc(w.same_as_before()) / n
    distinct = w.distinct() / n
    long = w.n >= 20
    out = np.zeros((w.rows, len(LABELLERS)), dtype=np.int64)
    for j, bad in enumerate((marked > 0.2, shout > 0.5, bang > 0.2, lone > 0.2, plain < 0.6, repeats > 0.3, long & (distinct < np.minimum(0.35, 60 / n)), long & (end < 0.005))):
        out[bad, j] = -1
    good = (marked < 0.05) & (shout < 0.2) & (lone < 0.05) & (plain > 0.85) & (repeats < 0.1) & ((end > 0.01) | ~long)
    out[good, -1] = 1
    out[w.n == 0, :-1] = -1
    out[w.n == 0, -1] = 0
    return out


def _kind(x: bytes) -> int:
    """Bits of a word: ends in two marks, upper case, ends in two exclamation marks, no letter or digit, plain, ends a sentence."""
    s = shape(x)
    ends = len(x) > 1 and x[-1] in MARKS and x[-2] in MARKS
    return ends | (len(x) > 1 and x.isupper()) << 1 | x.endswith(b"!!") << 2 | (not any(c in s for c in b"aA9")) << 3 | (PLAIN.fullmatch(s) is not None) << 4 | (x[-1:] in (b".", b"!", b"?")) << 5


def features(w: Words) -> np.ndarray:
    """rows x DIMS: square roots of the shares of hashed word shapes, of shapes of repeated words, and a length class."""
    if not len(w.words):
        return np.zeros((w.rows, DIMS), dtype=np.float32)
    shapes = np.array([zlib.crc32(shape(x)) % DIMS for x in w.words], dtype=np.int64)
    again = np.array([zlib.crc32(b"again " + shape(x)[:2]) % DIMS for x in w.words], dtype=np.int64)
    bucket = np.where(w.same_as_before(), again[w.code], shapes[w.code])
    counts = np.bincount(w.doc.astype(np.int64) * DIMS + bucket, minlength=w.rows * DIMS).reshape(w.rows, DIMS)
    return np.sqrt(counts / np.maximum(w.n, 1)[:, None]).astype(np.float32)


def pattern(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)


def estimate(counts: dict[int, int], labellers: int = len(LABELLERS), rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray, float]:
    """(posterior of good for each pattern, accuracy of each labeller, share of good) by expectation-maximisation.

    A labeller that votes is right with its accuracy, whatever the kind of document; no vote says nothing. It starts from accuracies of
    0.9 and a share of good of 0.9; pseudo-counts (nine right, one wrong) keep rare labellers near the start. Without documents
    the posteriors are empty.
    """
    keys = sorted(counts)
    if not keys:
        return {}, np.full(labellers, 0.9), 0.9
    n = np.array([counts[k] for k in keys], dtype=np.float64)
    vote = np.array([[k // 3**j % 3 - 1 for j in range(labellers)] for k in keys])
    right, share, good = np.full(labellers, 0.9), 0.9, np.zeros(len(keys))
    for _ in range(rounds):
        weigh = np.log(right / (1 - right))
        new = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + vote @ weigh, -50, 50)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        hits = (n * good) @ (vote > 0) + (n * (1 - good)) @ (vote < 0)
        right = np.minimum((hits + 9) / (n @ (vote != 0) + 10), 0.999)
        share = float((n @ good + 9) / (n.sum() + 10))
        if done:
            break
    return dict(zip(keys, good.tolist(), strict=True)), right, share


def fit(x: np.ndarray, y: np.ndarray, steps: int = STEPS, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps."""
    w, b = np.zeros(x.shape[1]), 0.0
    if not len(y):
        return w, 10.0
    vw, vb = w.copy(), b
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        g = (p - y) / len(y)
        nw, nb = vw - 8.0 * (x.T @ g + ridge * vw), vb - 8.0 * g.sum()
        m = k / (k + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, float(b)


def _surveyed(share: float):
    limit = int(-(2**63) + share * 2**64) if share < 1 else 2**63 - 1

    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column(0))
            got = pattern(votes(w))
            key = b.column(1).to_numpy()
            chosen = np.flatnonzero(key <= limit)
            rows = [None] * w.rows
            if len(chosen):
                for i, x in zip(chosen, features(Words(b.column(0).take(pa.array(chosen)))).astype(np.float16), strict=True):
                    rows[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(got.astype(np.int32)), b.column(1), pa.array(rows, pa.binary())], names=["pattern", "key", "x"])

    return run


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float, dict]:
    """(weights, bias, what was estimated). Votes are counted over all documents; ``rows`` bounds only the scorer's sample."""
    n = docs.count()
    keyed = docs.select("text", F.xxhash64("doc_id", "text").alias("key"))
    seen = materialize(arrow(keyed, _surveyed(min(1.0, 1.5 * rows / max(n, 1))), "pattern int, key long, x binary"), "quality-votes")
    counts = {r.pattern: r.n for r in seen.groupBy("pattern").agg(F.count("*").alias("n")).collect()}  # at most 3 ** labellers rows
    posterior, right, share = estimate(counts)
    sample = seen.where("x IS NOT NULL").orderBy("key").limit(rows).select("pattern", "x").collect()  # bounded by rows
    release(seen)
    x = np.array([np.frombuffer(r.x, dtype=np.float16) for r in sample], dtype=np.float64).reshape(len(sample), DIMS)
    y = np.array([posterior[r.pattern] for r in sample])
    w, b = fit(x, y)
    return w.astype(np.float32), b, {"good": share, "accuracy": dict(zip(LABELLERS, right.tolist(), strict=True)), "patterns": posterior}


def _probability(w, weights, bias):
    return 1 / (1 + np.exp(-np.clip(features(w) @ weights + bias, -30, 30).astype(np.float64)))


def _scored(weights, bias, threshold):
    def run(batches):
        for b in slices(batches, "text"):
            p = _probability(Words(b.column(1)), weights, bias)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array(p >= threshold)], names=["doc_id", "score", "kept"])

    return run


def _filtered(weights, bias, threshold):
    def run(batches):
        for b in slices(batches, "text"):
            p = _probability(Words(b.column(b.schema.get_field_index("text"))), weights, bias)
            yield b.filter(pa.array(p >= threshold))

    return run


def classify(docs: DataFrame, threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """Returns doc_id, score (probability of good), kept: one row for each row of ``docs`` (doc_id, text used).

    Null, empty and blank texts get bad votes from all labellers; null ids and repeated rows get rows of their own (rows with the same hash may
    tie at the sample's end: any of them is the same row); very long texts are scored whole; an empty table gives an empty table; other columns are ignored.
    """
    weights, bias, _ = train(docs, rows)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow(docs.select("doc_id", "text"), _scored(weights, bias, threshold), f"doc_id {kind}, score double, kept boolean")


def keep_good(docs: DataFrame, threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns; null, empty and blank texts go, ties and empty tables are as there."""
    weights, bias, _ = train(docs, rows)
    return arrow(docs, _filtered(weights, bias, threshold), docs.schema)


def op9_quality_classifier(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"))
