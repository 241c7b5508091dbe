import random
import re

import numpy as np
import pytest

from leadloom.llm import words
from leadloom.llm.words import hash_texts, hash_words, shingles


def lowered(text):
    return [m[0].translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for m in re.finditer(rb"[^\x20\x09-\x0d]+", text)]


def check(text, known):
    hashes, starts = hash_words(text)
    want = [(m.start(), w) for m, w in zip(re.finditer(rb"[^\x20\x09-\x0d]+", text), lowered(text))]
    assert [w for w, _ in want] == starts.tolist()
    for h, (_, w) in zip(hashes.tolist(), want):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("window", [7, 16, 64, words.WINDOW])
def test_words_do_not_depend_on_windows(monkeypatch, window):
    monkeypatch.setattr(words, "WINDOW", window)
    rnd = random.Random(1)
    known = {}
    for text in [b"", b" ", b"\n \t", b"a", b" A\x0bB\x0c", b"x" * 100 + b" " + b"X" * 100 + b" y", "é\xa0ü".encode(), b"a\x1cb\x00c"]:
        check(text, known)
    for _ in range(200):
        check(bytes(rnd.choice(b"abAB \n\t\xc3") for _ in range(rnd.randrange(200))), known)


def test_texts_of_a_batch():
    texts = [b"a b", None, b"", b"b A c", b"x" * 600_000 + b" a", b"c"]
    found = hash_texts(texts)
    a, b, c = hash_words(b"a b c")[0].tolist()
    assert [f.tolist() for f in found[:4]] == [[a, b], [], [], [b, a, c]]
    assert found[4].tolist() == [hash_words(b"X" * 600_000)[0][0], a] and found[5].tolist() == [c]


def test_shingles():
    one, two = hash_words(b"a b c d e f a b c d e")[0], hash_words(b"a b c d")[0]
    assert len(shingles(one, 5)) == 6 and len(shingles(two, 5)) == 1 and len(shingles(two[:0], 5)) == 0
    assert len(np.intersect1d(shingles(one, 5), shingles(hash_words(b"x a b c d e y")[0], 5))) == 1
    assert len({int(shingles(two[:n], 5)[0]) for n in range(1, 5)}) == 4
