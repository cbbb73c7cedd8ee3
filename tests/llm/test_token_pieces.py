"""Pieces of op3: parted at signs where the vocabulary parts there too, never elsewhere."""

import random

import pyarrow as pa

from demandscope.llm.token_ids import PieceEncoder, vocabulary_path


def test_signs_at_the_end_are_pieces_of_their_own():
    enc = PieceEncoder(vocabulary_path())
    enc.encode(pa.array(["word word. word, word!! other. other, other!!"]))
    assert sorted(enc.known.to_pylist()) == ["!!", ",", ".", "other", "word"]


def test_ids_of_parted_pieces_are_the_librarys():
    enc, draw = PieceEncoder(vocabulary_path()), random.Random(5)
    letters = "abzéüİıßñÉ019'.,!?<|>&$%-_ \nṫ̸́×÷Σσж中🙂= \u0085"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["a<|endoftext|>.", "<|endoftext|>", "x<|startoftext|>!!", "it's. we'll, don't! 's. a's", "word.</w> w>", None, "", "1. 2) x≠ é."]
    ids, counts = enc.encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == enc.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)
        at += n
