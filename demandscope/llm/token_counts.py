"""Token counts under a unigram model over a public vocabulary, with shared prefixes.

A text's pre-tokens (words) are segmented into vocabulary pieces so that the sum of their unigram scores is largest, and the pieces are counted. The best
score of a prefix doesn't depend on what follows, so distinct pre-tokens go into a trie: the forward step is done once for each node,
and the nodes where pre-tokens end hold their counts. The trie lives for a slice of texts and has a bounded number of nodes; counts of short pre-tokens are
kept over slices in a bounded table. A pre-token longer than a whole trie shares no prefix worth keeping: its scores are rolled along, with only those of
the longest piece's length kept.

Unigram scores come from the vocabulary's own order (Zipf's law: the logarithm of the share falls with the logarithm of the rank); nothing is
trained. Characters that no piece covers count as their UTF-8 bytes.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import arrow, slices, table

VOCABULARY = "piece_bpe_32k.model"
START = "▁"  # the vocabulary's sign for the start of a word
CACHED = 300_000  # pre-tokens whose counts a worker keeps
SHORT = 64  # characters of those at most
NODES = 100_000  # of a trie at most; a full one makes way for a new one


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Unigram:
    """Scores of pieces, and the price of a byte."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        order = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        order.sort(key=lambda i: (-sp.get_score(i), i))
        self.scores = {sp.id_to_piece(i): -math.log(k + 10) for k, i in enumerate(order)}
        self.longest = max(map(len, self.scores))
        self.byte = -2 * math.log(len(order) + 10)


@cache
def unigram(path: str) -> Unigram:
    return Unigram(path)


class Trie:
    """Prefixes of pre-tokens: children by character, and of each node the forward score and its number of tokens."""

    def __init__(self, model: Unigram):
        self.model = model
        self.children: list[dict[str, int]] = [{}]
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]

    def insert(self, word: str) -> int:
        """Adds a pre-token; returns its number of tokens (fewer tokens win among equal scores)."""
        children, best, tokens = self.children, self.best, self.tokens
        scores, longest = self.model.scores, self.model.longest
        node, path = 0, [0]
        for end, ch in enumerate(word, 1):
            child = children[node].get(ch)
            if child is None:
                size = len(ch.encode("utf-8", "surrogatepass"))
                value, n = best[node] + size * self.model.byte, tokens[node] + size
                for start in range(max(0, end - longest), end):
                    s = scores.get(word[start:end])
                    if s is not None:
                        v, k = best[path[start]] + s, tokens[path[start]] + 1
                        if v > value or (v == value and k < n):
                            value, n = v, k
                child = len(children)
                children[node][ch] = child
                children.append({})
                best.append(value)
                tokens.append(n)
            node = child
            path.append(node)
        return tokens[node]


    def full(self) -> bool:
        return len(self.children) > NODES


def rolled(word: str, model: Unigram) -> int:
    """The same number of tokens for a word of any length, in memory of the longest piece."""
    scores, longest = model.scores, model.longest
    best, tokens = [0.0] * (longest + 1), [0] * (longest + 1)
    size = longest + 1
    for end in range(1, len(word) + 1):
        bytes_ = len(word[end - 1].encode("utf-8", "surrogatepass"))
        at = (end - 1) % size
        value, n = best[at] + bytes_ * model.byte, tokens[at] + bytes_
        for start in range(max(0, end - longest), end):
            s = scores.get(word[start:end])
            if s is not None:
                v, k = best[start % size] + s, tokens[start % size] + 1
                if v > value or (v == value and k < n):
                    value, n = v, k
        best[end % size], tokens[end % size] = value, n
    return tokens[len(word) % size]


_KNOWN: dict[str, dict[str, int]] = {}


def count_tokens(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(words, tokens) of each text."""
    known = _KNOWN.setdefault(path, {})
    if len(known) > CACHED:
        known.clear()
    pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pieces.values.dictionary_encode()
    words = coded.dictionary.to_pylist()
    model = unigram(path)
    trie, counts = Trie(model), []
    for w in words:
        n = known.get(w)
        if n is None:
            if trie.full():
                trie = Trie(model)
            n = 0 if not w else trie.insert(START + w) if len(w) < NODES else rolled(START + w, model)
            if len(w) <= SHORT:
                known[w] = n
        counts.append(n)
    of = np.array(counts, dtype=np.int64)
    real = np.array([w != "" for w in words], dtype=np.int64)
    code = coded.indices.to_numpy()
    run = lambda x: np.concatenate([[0], np.cumsum(x[code] if len(words) else np.zeros(0, np.int64))])
    at = pieces.offsets.to_numpy()
    return np.diff(run(real)[at]), np.diff(run(of)[at])


def _counted(path: str):
    def run(batches):
        for b in slices(batches, "text"):
            n_words, n_tokens = count_tokens(b.column(1), path)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words), pa.array(n_tokens)], names=["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Returns doc_id, n_words, n_tokens: one row for each row of ``docs`` (doc_id, text used).

    Null, empty and blank texts have none; null ids and repeated rows give rows of their own; an empty table gives an empty table;
    other columns are ignored; texts are counted whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow(docs.select("doc_id", "text"), _counted(vocabulary or vocabulary_path()), f"doc_id {kind}, n_words long, n_tokens long")


def op5_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
