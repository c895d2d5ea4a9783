"""Token counts against taking the longest piece again and again."""

import json
import random

import public_tokenizers
import pytest

from faultline.llm import wordpieces
from faultline.llm.common import Cache
from tests.llm.conftest import EDGES


def greedy(word, pieces, longest=None):
    symbols, at, n = (*word, wordpieces.END), 0, 0
    longest = longest or max(map(len, pieces))
    while at < len(symbols):
        stop = next((s for s in range(min(len(symbols), at + longest), at, -1) if symbols[at:s] in pieces), None)
        if stop is None:
            return 1
        at, n = stop, n + 1
    return n


def test_small_vocabularies():
    draw = random.Random(3)
    for _ in range(300):
        pieces = {tuple(draw.choices(b"ab", k=draw.randint(1, 4))) + ((wordpieces.END,) if draw.random() < 0.5 else ()) for _ in range(draw.randint(1, 7))}
        automaton = wordpieces.Automaton(pieces)
        for _ in range(40):
            word = bytes(draw.choices(b"ab", k=draw.randint(1, 9)))
            assert automaton.count(word) == greedy(word, pieces)


@pytest.fixture(scope="module")
def pieces():
    return wordpieces.vocabulary(public_tokenizers.path(wordpieces.VOCABULARY))


def test_the_vocabulary(edges, pieces):
    known, longest = set(pieces), max(map(len, pieces))
    out = wordpieces.count_tokens(edges).collect()
    want = []
    for row in EDGES:
        words = [w for chunk in (row[1] or "").encode().split() for w in wordpieces._WORD.findall(chunk.lower())]
        want.append((row[0], len(words), sum(greedy(w, known, longest) for w in words)))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_every_word_of_known_bytes_is_spelled(pieces):
    """The pieces of the file itself: mid-word those without a word end, at the end either form."""
    letters = wordpieces.byte_of_letter()
    inner, last = set(), set()
    for token in json.loads(open(public_tokenizers.path(wordpieces.VOCABULARY), encoding="utf-8").read())["model"]["vocab"]:
        body = token.removesuffix(wordpieces.WORD_END) if token != wordpieces.WORD_END else token
        if all(c in letters for c in body):
            last.add(raw := bytes(letters[c] for c in body))
            if body == token:
                inner.add(raw)

    def spelled(word):
        n = 0
        while word:
            stop = len(word) if word in last else next(s for s in range(len(word) - 1, 0, -1) if word[:s] in inner)
            word, n = word[stop:], n + 1
        return n

    automaton = wordpieces.Automaton(pieces)
    assert [automaton.count(w.encode()) for w in ("aluxtionç", "привет", "=" * 40)] == [4, 4, 5]
    draw = random.Random(5)
    some = sorted(inner)
    words = [*some, *(b"".join(draw.choices(some, k=draw.randint(2, 4))) for _ in range(3000)), *(bytes(draw.choices(range(256), k=draw.randint(1, 30))) for _ in range(1000))]
    for word in words:
        assert automaton.count(word) == spelled(word)


def test_no_rows(nothing):
    assert wordpieces.count_tokens(nothing).collect() == []


def test_caches_keep_no_long_words():
    made = []
    cache = Cache(lambda key: made.append(key) or len(key), most=3)
    assert [cache[b"a" * n] for n in (1, 64, 65, 65, 1, 1_000_000)] == [1, 64, 65, 65, 1, 1_000_000]
    assert set(cache) == {b"a", b"a" * 64} and len(made) == 5
    for n in range(2, 9):
        assert cache[b"a" * n] == n and len(cache) <= 3
