"""Near-duplicate documents against all pairs of full sets."""

import random
import re
from collections import defaultdict

from faultline.llm import minhash
from tests.llm.conftest import COLUMNS, document, prose


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < 5 else (tuple(words[i : i + 5]) for i in range(len(words) - 4)))


def expected(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of rows with an id."""
    rows = [(r[0], shingle_set(r[1])) for r in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies():
    draw = random.Random(9)
    rows, doc_id = [], 0
    for base in range(12):
        words = prose(100 + base, 120).split()
        for _ in range(25):
            own = list(words)
            for _ in range(draw.randrange(0, 12)):
                own[draw.randrange(len(own))] = f"new{draw.randrange(10**6)}"
            rows.append(document(doc_id := doc_id + 7, " ".join(own).upper() if draw.random() < 0.3 else " ".join(own)))
    draw.shuffle(rows)
    return rows


def test_near_copies_match_all_pairs(spark):
    rows = near_copies()
    want = expected(rows)
    assert len({w[2] for w in want}) > 12  # some copies are too far apart
    assert found(minhash.near_duplicates(spark.createDataFrame(rows, COLUMNS))) == want


def test_edges(edges):
    from tests.llm.conftest import EDGES

    assert found(minhash.near_duplicates(edges)) == expected(EDGES)


def test_no_rows(nothing):
    assert minhash.near_duplicates(nothing).collect() == []


def test_distinct_documents_keep_columns(edges):
    kept = minhash.distinct_documents(edges)
    assert kept.columns == edges.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, None, None], key=str)


def test_sketch_estimates_similarity():
    a = minhash.shingle_sets([prose(1, 2000).encode()])[0]
    b = a[: len(a) * 3 // 4]
    mark = [minhash.np.frombuffer(minhash.sketch(x), minhash.np.uint64)[None] for x in (a, b)]
    assert minhash.agreeing(mark[0], mark[0])[0, 0] == minhash.BITS
    assert minhash.LEAST_AGREE < minhash.agreeing(*mark)[0, 0] < 0.91 * minhash.BITS


def test_hot_group_is_not_paired(spark):
    """Copies of one text, of which pairs would be half a million, leave a row each."""
    rows = [document(i, prose(1, 40)) for i in range(1000)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {r["component_id"] for r in out} == {0} and sum(r["kept"] for r in out) == 1


def test_words_are_hashed_apart():
    texts = [f"w{i} {i}w {i}".encode() for i in range(3000)]
    hashes, before = minhash.word_hashes(texts)
    assert len(set(hashes.tolist())) == 9000 and before.tolist() == list(range(0, 9001, 3))
    grouped = defaultdict(set)
    for text in (b"a b", b"a  b", b"\ta\nb "):
        grouped[tuple(minhash.word_hashes([text])[0].tolist())].add(text)
    assert len(grouped) == 1
