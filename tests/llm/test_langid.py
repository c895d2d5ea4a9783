"""Code lengths against a slow statement of the method; accuracy on held-out documents."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from faultline.llm import langid, queries
from faultline.llm.common import passage
from tests.conftest import TESTDATA
from tests.llm.conftest import EDGES


def slow_bits(training, text):
    counts = defaultdict(lambda: defaultdict(int))
    for one in training:
        data = b"\n" * langid.ORDER + one
        for i in range(langid.ORDER, len(data)):
            for order in range(langid.ORDER + 1):
                counts[data[i - order : i]][data[i]] += 1
    data, bits = b"\n" * langid.ORDER + text, 0.0
    for i in range(langid.ORDER, len(data)):
        for order in range(langid.ORDER, -1, -1):
            after = counts.get(data[i - order : i])
            if not after:
                continue
            n, kinds = sum(after.values()), len(after)
            if data[i] in after:
                bits -= math.log2(after[data[i]] / (n + kinds))
                break
            bits -= math.log2(kinds / (n + kinds))
        else:
            bits += 8
    return bits


def model_of(languages):
    batch_counts = []
    langs = sorted(languages)
    for order in range(langid.ORDER + 1):
        per = [np.unique(langid.windows(np.frombuffer(langid._PAD + langid._PAD.join(languages[x]), np.uint8), order), return_counts=True) for x in langs]
        keys = np.unique(np.concatenate([k for k, _ in per]))
        table = np.zeros((len(keys), len(langs)))
        for i, (k, n) in enumerate(per):
            table[np.searchsorted(keys, k), i] = n
        batch_counts.append((keys, table))
    return langid.Model(langs, batch_counts)


def test_code_lengths_match_the_slow_way():
    one = {"a": [b"the cat sat on the mat"], "b": [b"le chat est la, et la table"]}
    model = model_of(one)
    texts = [b"the chat", b"", b"zzz the cat \xff", b"la table et le chat " * 3]
    got = model.code_lengths(texts)
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx([slow_bits(one[x], text) for x in ("a", "b")], rel=1e-5)


def test_pieces_of_a_long_text_add_up():
    model = model_of({"a": [b"abcabcabd"], "b": [b"xyzzyx"]})
    text = b"abcxyz " * 90_000
    assert model.code_lengths([b"ab", text, b"x"])[1] == pytest.approx(model.code_lengths([text])[0])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = queries.queries()["op1_langid_ppm"](spark, f"{TESTDATA}/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(edges):
    out = langid.identify(edges.select("doc_id", "text"), langid.fit(edges)).collect()
    assert len(out) == len(EDGES)
    unknown = sorted((r["doc_id"] for r in out if r["lang_pred"] == "und"), key=str)
    assert unknown == sorted([4, 5, 6, 9, None], key=str)
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in out)
    kept = langid.known(edges)
    assert kept.columns == edges.columns and not {4, 5, 6, 9} & {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn(spark, edges, nothing):
    assert langid.identify(nothing).collect() == []
    blind = langid.identify(edges.select("doc_id", "text"), langid.fit(nothing)).collect()
    assert {r["lang_pred"] for r in blind} == {"und"}


def test_a_language_of_long_texts_alone_is_learned(spark):
    short, long_ = "the cat sat on the mat and the dog ", "le château était très éloigné de la forêt "
    rows = [(i, short * 20, "en") for i in range(40)] + [(100 + i, long_ * 2000, "fr") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(r[1].encode()) for r in rows if r[2] == "fr") > langid.BYTES
    model = langid.fit(docs)
    assert model.langs == ["en", "fr"]
    found = langid.identify(spark.createDataFrame([(1, short), (2, long_)], "doc_id long, text string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {1: "en", 2: "fr"}


def test_passages():
    text = "aé日".encode() * 1000
    part = passage(text, 500)
    assert passage(text, len(text)) == text and part == passage(text, 500) and part in text and 494 <= len(part) <= 500 and part.decode()


def test_letters():
    assert [langid.has_letter(t) for t in (None, b"", b"12 ?", "é".encode(), "日".encode(), b"x")] == [False, False, False, True, True, True]


def test_the_sample_of_a_language_has_a_true_limit(spark):
    """Languages whose rows all share an id, are all equal, or are few; the sample is what sorting all rows gives."""
    one, two, three, four = [i for i in range(50) if zlib.crc32(str(i).encode()) % langid.FOLDS != langid.FOLD_OUT][:4]
    rows = [(one, f"one id {i}", "shared") for i in range(3000)] + [(two, "the same row", "equal")] * 2000
    rows += [(i, f"text {i}", "many") for i in range(1000)] + [(three, "a", "few"), (three, "b", "few"), (four, "", "empty"), (four, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    langs, picked = langid.sample(docs, 250)
    got = Counter((r["lang"], r["text"]) for r in picked.collect())
    assert langs == ["equal", "few", "many", "shared"] and set(got.values()) == {1}
    known = docs.where("text <> ''").where(~langid.held_out(langid.FOLDS, langid.FOLD_OUT)).selectExpr("lang", "text", "xxhash64(doc_id, text) AS h").distinct().collect()
    want = set()
    for lang in langs:
        want |= {(lang, r["text"]) for r in sorted((r for r in known if r["lang"] == lang), key=lambda r: r["h"])[:250]}
    assert set(got) == want and Counter(x for x, _ in got) == {"equal": 1, "few": 2, "many": 250, "shared": 250}
