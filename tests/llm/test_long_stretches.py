import random

import pytest

from demandscope.llm import pii


def secret(n):
    rnd = random.Random(n)
    return "".join(rnd.choice("0123456789abcdef") for _ in range(n))


@pytest.mark.parametrize("size", [300, 700, 5000])
def test_long_entity_across_any_place_of_a_stretch(size):
    value = secret(size)
    for before in range(3300, 4300, 100):
        lead = ("1.5/" * before)[: before - 2] + " "
        text = f"{lead}key={value} x1"
        at = text.index(value)
        assert ("secret", at, at + size) in pii.field_spans(text, pii.trained())


def test_blocks_decode_like_one_matrix(monkeypatch):
    text = " ".join(t.replace(" ", "1 ") + "2" for t, _ in pii.sentences(120, seed=5))
    a, b = max(pii.zones(text), key=lambda z: z[1] - z[0])
    assert b - a > 4096
    tokens, segments, x = pii.candidates(text, a, b)
    want = [(pii.LABELS[y], tokens[i][0], tokens[j - 1][1]) for i, j, y in pii.trained().decode(len(tokens), segments, x)]
    monkeypatch.setattr(pii, "BLOCK", 7)
    assert [s for s in pii.field_spans(text, pii.trained()) if a <= s[1] < b] == want
