"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

An item is a multiset of five-word shingles (its whole word sequence if it is shorter) with a 64-bit SimHash. Of a document, the windows of an
item's length that hold at least one shingle of an item of that length are fingerprinted; any other window shares nothing with the item, so
its similarity is zero and nothing is lost by that. Candidates of such a window are the items whose fingerprints lie within ``RADIUS`` bits, found by blocks:
two fingerprints that differ in at most ``RADIUS`` bits differ in at most ``RADIUS // BLOCKS`` bits of some of ``BLOCKS`` blocks, so the values that are
so close to the window's block are looked up among the items' and what is found is checked by the whole distance. Survivors are compared exactly: the
weighted Jaccard similarity of the shingle multisets must reach ``SIMILARITY``. After the exact lookup the radius can only discard: at similarity 0.8, one
shingle in nine differs, which turns 9.7 of 64 bits on average (standard deviation 2.9), and the radius lies almost three deviations above.

Items are read to the driver and sent to the tasks in groups of at most ``GROUP_WORDS`` words, with a pass over the documents for each group, so that
a benchmark of any size is compared whole with bounded memory: a group takes some 40 bytes a word and 50 an item, once in each Python worker.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import WORD_RE, arrow, lower_ascii, slices, table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 18
BLOCKS = 6
GROUP_WORDS = 1_000_000
_EDGES = [64 * k // BLOCKS for k in range(BLOCKS + 1)]


def words(text: str | None) -> list[str]:
    return WORD_RE.findall(lower_ascii(text or ""))


def shingles(ws: list[str], size: int = SHINGLE) -> list[tuple[str, ...]]:
    if not ws:
        return []
    size = min(size, len(ws))
    return [tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: sum of smaller over sum of larger counts."""
    both = sum((a & b).values())
    return both / max(sum(a.values()) + sum(b.values()) - both, 1)


def _hash(s: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest(" ".join(s), 42)


def window_fingerprints(hashes: np.ndarray, m: int) -> np.ndarray:
    """SimHash of each run of ``m`` hashes, by differences of running counts of the bits."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    run = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=run[1:])
    set_ = 2 * (run[m:] - run[:-m]) > m
    return np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()


def _near(bits: int) -> np.ndarray:
    """The differences of at most ``RADIUS // BLOCKS`` of so many bits."""
    return np.array([sum(1 << b for b in some) for n in range(RADIUS // BLOCKS + 1) for some in combinations(range(bits), n)], dtype=np.int64)


class HammingIndex:
    """All of a set of fingerprints within ``RADIUS`` bits of a query.

    For each block the fingerprints' numbers in order of their block's value, and where each value begins; the values near a query's are made when it asks.
    """

    def __init__(self, fps: np.ndarray):
        self.fps = np.asarray(fps, dtype=np.uint64)
        self.blocks = []
        for lo, hi in zip(_EDGES, _EDGES[1:], strict=False):
            block = ((self.fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)
            order = np.argsort(block, kind="stable").astype(np.int32)
            begin = np.searchsorted(block[order], np.arange((1 << (hi - lo)) + 1)).astype(np.int32)
            self.blocks.append((order, begin, _near(hi - lo)))

    def find_all(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) numbers of all pairs within the radius, each once, in order."""
        found = [np.zeros((0, 2), dtype=np.int64)]
        for at in range(0, len(queries), 256):
            some = queries[at : at + 256]
            pairs = []
            for (lo, hi), (order, begin, near) in zip(zip(_EDGES, _EDGES[1:], strict=False), self.blocks, strict=True):
                values = ((some >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)[:, None] ^ near[None, :]
                first, n = begin[values].ravel(), (begin[values + 1] - begin[values]).ravel()
                hit = np.flatnonzero(n)
                first, n = first[hit], n[hit]
                place = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                items, who = order[place], np.repeat(hit // len(near), n)
                close = np.bitwise_count(self.fps[items] ^ some[who]) <= RADIUS
                pairs.append(np.stack([who[close] + at, items[close]], axis=1))
            found.append(np.unique(np.concatenate(pairs), axis=0))
        every = np.concatenate(found)
        return every[:, 0], every[:, 1]

    def find(self, fp: int) -> list[int]:
        return self.find_all(np.array([fp], dtype=np.uint64))[1].tolist()


class Benchmark:
    """What tasks need of a group of items; made once a worker."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(i, ws) for i, t in items if (ws := words(t))]
        self.ids = [i for i, _ in split]
        vocabulary = sorted({w for _, ws in split for w in ws})
        self.vocabulary = pa.array(vocabulary, pa.string())
        code = {w: k for k, w in enumerate(vocabulary)}
        self.codes = [np.array([code[w] for w in ws], dtype=np.int32) for _, ws in split]
        self.by_length: dict[int, np.ndarray] = {}
        lengths = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.index = {}
        for n in sorted(set(lengths.tolist())):
            self.by_length[n] = np.flatnonzero(lengths == n)
            fps = [window_fingerprints(np.array([_hash(g) for g in shingles(split[k][1])], dtype=np.uint64), max(n - SHINGLE + 1, 1))[0] for k in self.by_length[n].tolist()]
            self.index[n] = HammingIndex(np.array(fps, dtype=np.uint64))
        # shingles of each size as sorted keys, and the item lengths that they occur in: lengths[begin[g] : begin[g + 1]]
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in {min(SHINGLE, n) for n in self.by_length}:
            mine = [c for c in self.codes if min(SHINGLE, len(c)) == size]
            keys = np.concatenate([_mix(np.lib.stride_tricks.sliding_window_view(c, size).astype(np.uint64)) for c in mine])
            of = np.concatenate([np.full(len(c) - size + 1, len(c)) for c in mine])
            order = np.lexsort((of, keys))
            keys, of = keys[order], of[order]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])])
            keys, of = keys[new], of[new]
            distinct, begin = np.unique(keys, return_index=True)
            self.grams[size] = distinct, np.append(begin, len(keys)), of

    def bag(self, item: int) -> Counter:
        c = self.codes[item].tolist()
        return Counter(shingles(c))

    def matches(self, texts: pa.Array) -> dict[int, dict[int, tuple[float, int]]]:
        """row -> item number -> (best similarity, first word of the first such window)."""
        found: dict[int, dict[int, tuple[float, int]]] = {}
        if not self.ids:
            return found
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        values = pieces.values.filter(pc.not_equal(pieces.values, ""))
        blank = np.concatenate([[0], np.cumsum(pc.equal(pieces.values, "").to_numpy(zero_copy_only=False))])
        offsets = pieces.offsets.to_numpy()
        offsets = offsets - blank[offsets]
        codes = pc.fill_null(pc.index_in(values, value_set=self.vocabulary), -1).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(texts)), np.diff(offsets))
        hits: dict[tuple[int, int], list[int]] = defaultdict(list)  # (row, item length) -> places of shared shingles
        for size, (keys, begin, lengths) in self.grams.items():
            if len(codes) < size:
                continue
            known = codes >= 0
            ok = row[: len(row) - size + 1] == row[size - 1 :]
            for k in range(size):
                ok = ok & known[k : len(known) - size + 1 + k]
            at = np.flatnonzero(ok)
            mixed = _mix(np.stack([codes[at + k] for k in range(size)], axis=1).astype(np.uint64))
            place = np.minimum(np.searchsorted(keys, mixed), len(keys) - 1)
            for p, g in zip(at[keys[place] == mixed].tolist(), place[keys[place] == mixed].tolist(), strict=True):
                for n in lengths[begin[g] : begin[g + 1]].tolist():
                    hits[int(row[p]), n].append(p - int(offsets[row[p]]))
        cache: dict[int, tuple[list[str], list[int]]] = {}
        for (r, n), places in hits.items():
            if r not in cache:
                cache = {r: (values[offsets[r] : offsets[r + 1]].to_pylist(), codes[offsets[r] : offsets[r + 1]].tolist())}
            for item, best in self._windows(*cache[r], n, places).items():
                old = found.setdefault(r, {}).get(item)
                if old is None or (best[0], -best[1]) > (old[0], -old[1]):
                    found[r][item] = best
        return found

    def _windows(self, ws: list[str], codes: list[int], n: int, places: list[int]) -> dict[int, tuple[float, int]]:
        """Item number -> (best similarity, first word) of the windows around places of shared shingles. Words that no item has are all one code."""
        length = min(n, len(ws))  # a document shorter than the item is one window
        size = min(SHINGLE, n)
        m = length - size + 1
        if m < 1:
            return {}
        starts = np.unique(np.clip((np.array(places)[:, None] - np.arange(m)[None, :]).ravel(), 0, len(ws) - length))
        best: dict[int, tuple[float, int]] = {}
        bags: dict[int, Counter] = {}
        # runs of windows next to each other share their shingles
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            lo, hi = int(run[0]), int(run[-1])
            hashes = np.array([_hash(tuple(ws[i : i + size])) for i in range(lo, hi + m)], dtype=np.uint64)
            grams = [tuple(codes[i : i + size]) for i in range(lo, hi + m)]
            held, at = Counter(), -1
            for k, near in zip(*(x.tolist() for x in self.index[n].find_all(window_fingerprints(hashes, m))), strict=True):
                item = int(self.by_length[n][near])
                if item not in bags:
                    bags[item] = self.bag(item)
                if at != k:
                    held, at = Counter(grams[k : k + m]), k
                s = similarity(held, bags[item])
                if s >= SIMILARITY and (item not in best or s > best[item][0]):
                    best[item] = (s, lo + k)
        return best


def _mix(codes: np.ndarray) -> np.ndarray:
    """One number for each row of word codes."""
    out = np.zeros(len(codes), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(codes.shape[1]):
            out = (out + codes[:, k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def item_groups(benchmark: DataFrame, most: int = GROUP_WORDS):
    """Lists of distinct (item_id, text) of at most ``most`` words each, an item's texts together; items without words are left out; rows stream to the driver."""
    group, held = [], 0
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").distinct().orderBy("item_id", "text").toLocalIterator():
        n = len(words(r.text))
        if group and held + n > most and r.item_id != group[-1][0]:
            yield group
            group, held = [], 0
        if n:
            group.append((r.item_id, r.text))
            held += n
    if group:
        yield group


_BUILT: dict[str, Benchmark] = {}


def _built(name: str, items) -> Benchmark:
    """The group's index, made at a worker's first task of it; a worker keeps one."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Benchmark(items)
    return _BUILT[name]


def _searched(items, item_kind: pa.DataType):
    name = uuid.uuid4().hex

    def run(batches):
        index = _built(name, items)
        for b in slices(batches, "text"):
            rows = []
            for r, of in index.matches(b.column(1)).items():
                best: dict = {}  # of the texts of an item
                for k, (s, at) in of.items():
                    i = index.ids[k]
                    if i not in best or (s, -at) > (best[i][0], -best[i][1]):
                        best[i] = (s, at)
                rows += [(b.column(0)[r].as_py(), i, at, s) for i, (s, at) in best.items()]
            if rows:
                ids, item_ids, ats, sims = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(item_ids, item_kind), pa.array(ats, pa.int64()), pa.array(sims, pa.float64())], names=["doc_id", "item_id", "first_word", "similarity"])

    return run


def _cleaned(items):
    name = uuid.uuid4().hex

    def run(batches):
        index = _built(name, items)
        for b in slices(batches, "text"):
            keep = np.ones(b.num_rows, dtype=bool)
            keep[list(index.matches(b.column(b.schema.get_field_index("text"))))] = False
            yield b.filter(pa.array(keep))

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Returns doc_id, item_id, first_word, similarity: a row for each document and item with a window of similarity 0.8 or more.

    The window with the largest similarity is told, the first of equals (words from 0). Null, empty and blank texts match nothing; null ids
    and repeated documents give rows of their own; repeated items count once, and of an item's several texts the nearest counts; a document shorter than an
    item is compared as one window; very long texts are searched whole; empty tables give an empty table; other columns are ignored.
    """
    kind, item = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType
    schema = f"doc_id {kind}, item_id {item.simpleString()}, first_word long, similarity double"
    found = [arrow(docs.select("doc_id", "text"), _searched(g, to_arrow_type(item)), schema) for g in item_groups(benchmark)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a match in ``contaminated``, with all their columns; nulls, ties, long texts and empty tables as there."""
    for g in item_groups(benchmark):
        docs = arrow(docs, _cleaned(g), docs.schema)
    return docs


def op10_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumn("similarity", F.round("similarity", 9))
