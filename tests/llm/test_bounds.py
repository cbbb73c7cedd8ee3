"""Bounded memory: caches by bytes, tries by nodes, an index by items; and repeated items, short items, edits in the middle."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from demandscope.llm import decontaminate, licenses, token_counts, token_ids


def test_pieces_are_cached_up_to_so_many_bytes(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHED_BYTES", 20_000)
    enc, rnd = token_ids.PieceEncoder(token_ids.vocabulary_path()), random.Random(2)
    plain = enc.tokenizer
    for k in range(20):
        text = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.choice((3, 5, 3000)))) for _ in range(40))
        ids, n = enc.encode(pa.array([text, None, text[:50]]))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids + plain.encode(text[:50], add_special_tokens=False).ids and n[1] == 0, k
        assert len(enc.known) <= 81 + (k > 0) * 400


def test_slices_of_larger_arrays():
    """Buffers with texts before and after the slice, and characters of several bytes."""
    enc, rnd = token_ids.PieceEncoder(token_ids.vocabulary_path()), random.Random(8)
    texts = [None if k % 50 == 7 else " ".join("".join(rnd.choice("aeéßñ中😀xyz") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(0, 60))) for k in range(3000)]
    every = pa.array(texts)
    for at in range(0, 3000, 700):
        part = every.slice(at, 700)
        ids, n = enc.encode(part)
        place = 0
        for k, t in enumerate(texts[at : at + 700]):
            assert ids[place : place + n[k]].tolist() == enc.tokenizer.encode(t or "", add_special_tokens=False).ids
            place += n[k]
        words, offsets = licenses.split_words(part)
        assert [words[int(a) : int(b)].to_pylist() for a, b in zip(offsets, offsets[1:], strict=False)] == [(t or "").split() for t in texts[at : at + 700]]


def test_tries_make_way_and_long_words_are_rolled(monkeypatch):
    path, rnd = token_counts.vocabulary_path(), random.Random(3)
    model = token_counts.unigram(path)
    words = ["".join(rnd.choice("aeinrst☃é") for _ in range(rnd.randint(1, 90))) for _ in range(300)]
    trie = token_counts.Trie(model)
    want = [trie.insert(token_counts.START + w) for w in words]
    assert [token_counts.rolled(token_counts.START + w, model) for w in words] == want
    monkeypatch.setattr(token_counts, "NODES", 50)
    token_counts._KNOWN.clear()
    n_words, n_tokens = token_counts.count_tokens(pa.array([" ".join(words), words[0], None]), path)
    assert n_tokens.tolist() == [sum(want), want[0], 0] and n_words.tolist() == [300, 1, 0]
    assert all(len(w) <= token_counts.SHORT for w in token_counts._KNOWN[path])
    token_counts._KNOWN.clear()


def test_a_long_word_takes_little_memory():
    model = token_counts.unigram(token_counts.vocabulary_path())
    word = token_counts.START + "abcdefghij" * 20_000
    tracemalloc.start()
    token_counts.rolled(word, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20


def test_an_index_of_many_items_of_one_length():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 2**64, 100_000, dtype=np.uint64)
    tracemalloc.start()
    index = decontaminate.HammingIndex(fps)
    queries = np.concatenate([fps[:40] ^ np.uint64(0b1011), rng.integers(0, 2**64, 40, dtype=np.uint64)])
    got = set(zip(*(x.tolist() for x in index.find_all(queries)), strict=True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    near = np.bitwise_count(queries[:, None] ^ fps[None, :]) <= decontaminate.RADIUS
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True)) and peak < 100 << 20


def test_repeated_items_count_once(spark):
    item, other = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, f"x {item} y"), (1, f"x {item} y"), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (7, item), (7, item + " nine"), (8, other), (None, item)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.first_word, round(r.similarity, 3)) for r in decontaminate.contaminated(docs, items).collect()), key=str)
    assert got == sorted([(1, 7, 1, 1.0), (1, None, 1, 1.0)] * 2, key=str)


@pytest.mark.parametrize(("least", "most", "place"), [(14, 24, "start"), (24, 60, "start"), (30, 60, "middle"), (60, 120, "middle"), (30, 60, "repeats")])
def test_edited_passages(least, most, place):
    """Short and long items, edits at an end and in the middle, shingles that repeat: nearly all windows of similarity 0.8 or more lie within the radius."""
    rnd, found, total = random.Random(least + most), 0, 0
    pool = [f"w{k}" for k in range(300)]
    for _ in range(250):
        item = [rnd.choice(pool) for _ in range(rnd.randint(least, most))]
        if place == "repeats":
            item[len(item) // 2 : len(item) // 2 + 8] = item[:8]
        copy, m = list(item), len(item) - 4
        if place == "middle":
            for _ in range(max(1, int(m * 0.02))):
                copy[rnd.randrange(5, len(copy) - 5)] = "edited"
        else:
            for k in range(max(1, int(m * 0.1))):
                copy[k] = "edited"
        bags = [Counter(decontaminate.shingles(x)) for x in (copy, item)]
        if decontaminate.similarity(*bags) >= 0.8:
            total += 1
            text = " ".join([rnd.choice(pool) for _ in range(30)] + copy + [rnd.choice(pool) for _ in range(30)])
            found += bool(decontaminate.Benchmark([(1, " ".join(item))]).matches(pa.array([text])))
    assert total > 50 and found >= 0.97 * total, (found, total)
