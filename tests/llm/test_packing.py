"""Token ids against the library, sequences against the contract."""

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faultline.llm import packing
from faultline.llm.tokens import Encoder
from tests.conftest import TESTDATA
from tests.llm.conftest import EDGES

PATH = public_tokenizers.path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_entry_is_one_token(library):
    """What the fast encoder's argument rests on: an entry, encoded alone, is itself."""
    model = json.loads(open(PATH, encoding="utf-8").read())["model"]
    assert len(model["merges"]) == len({"".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]})
    for token, id_ in model["vocab"].items():
        if token.endswith("</w>") and token != "</w>":
            assert [t.id for t in library.model.tokenize(token.removesuffix("</w>"))] == [id_]
    encoder = Encoder(PATH)
    raw = {rank: piece for piece, rank in encoder.pairs._mergeable_ranks.items()}
    for rank, piece in raw.items():
        assert encoder.pairs._core_bpe.encode_single_piece(piece) == [rank]


def test_ids_equal_the_library(library):
    texts = [r[1] for r in EDGES if r[1] is not None]
    texts += ["don't STOP it's WE'LL 's", "<|endoftext|> a<|endoftext|>b", "½²³ 123 4٣ !!??...'''s 'S", "ǅ ŉ ß ẞ ﬁ ÷×", "a\x01b \x1c \x85 \xa0x y", "x́ é"]
    import duckdb

    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{TESTDATA}/sf0.01/documents.parquet' WHERE text IS NOT NULL LIMIT 150").fetchall()]
    found = Encoder(PATH).encode([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_best_fit_takes_the_fullest_bin():
    bins, places = packing.best_fit(np.array([60, 50, 40, 30, 20, 10]), 100)
    assert bins.tolist() == [0, 1, 0, 1, 1, 2] and places.tolist() == [0, 0, 60, 50, 80, 0]


def checked(rows, length):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return by_sequence


def test_edges(edges, library):
    rows = packing.pack_documents(edges).collect()
    checked(rows, packing.LENGTH)
    want = []
    for row in EDGES:
        ids = np.array(library.encode(row[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.append((row[0], piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)


def test_no_rows(nothing):
    assert packing.pack_documents(nothing).collect() == []


def test_rounds_pack_almost_fully_and_repeat(spark):
    pieces = spark.range(6000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "pmod(hash(id), 900) + 20L AS length", "id AS ids_crc32")
    first = packing.pack(pieces, 1000, per_group=300, nearly_full=990)
    rows = first.collect()
    total = sum(r["length"] for r in rows)
    assert len(rows) == 6000 and len(checked(rows, 1000)) <= total / 1000 * 1.03
    again = packing.pack(pieces.repartition(5), 1000, per_group=300, nearly_full=990)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_bins_beyond_the_carry_are_kept(spark):
    pieces = spark.range(900).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "600L AS length", "id AS ids_crc32")
    rows = packing.pack(pieces, 1000, per_group=100, carry=5).collect()
    assert len(rows) == 900 and len(checked(rows, 1000)) == 900


def test_a_group_hands_on_all_its_underfull_bins(spark):
    """Seven groups have one bin with 450 left to place, the eighth ten bins of 545."""
    dealt = defaultdict(list)
    for r in spark.range(400).selectExpr("id", "pmod(xxhash64(id, 0, id), 8) AS part").collect():
        dealt[r["part"]].append(r["id"])
    sizes = {i: 545 if part == 7 else 450 if place == 0 else 1000 for part, ids in dealt.items() for place, i in enumerate(ids[:10])}
    pieces = spark.createDataFrame([(i, 0, 0, size, i) for i, size in sizes.items()], packing._PIECE)
    rows = packing.pack(pieces, 1000, per_group=10, fan=8, nearly_full=990, carry=3).collect()
    assert len(rows) == 80 and len(checked(rows, 1000)) == 63 + 10


def test_sequences_hold_the_ids_of_all_documents(edges, nothing, library):
    placed = packing.pack_ids(edges).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in placed)
    assert sorted((tuple(r)[:7] for r in placed), key=str) == sorted(map(tuple, packing.pack_documents(edges).collect()), key=str)
    rows = packing.sequences(edges).collect()
    assert all(len(r["ids"]) <= packing.LENGTH for r in rows) and len({r["sequence_id"] for r in rows}) == len(rows)
    want = sum((library.encode(row[1] or "", add_special_tokens=False).ids + [0] for row in EDGES), [])
    assert sorted(x for r in rows for x in r["ids"]) == sorted(want)
    assert packing.sequences(nothing).collect() == []


def test_equal_rows_are_dealt_to_all_groups(spark):
    rows = [(None, 0, 0, 300, 5)] * 20_000 + [(i, 0, 0, 100, i) for i in range(500)]
    pieces = spark.createDataFrame(rows, packing._PIECE).repartition(4)
    count, numbered = packing._numbered(pieces)
    copies = sorted(r["copy"] for r in numbered.where("doc_id is null").select("copy").collect())
    assert count == 20_500 and copies == list(range(20_000))
    assert numbered.where("doc_id is not null").selectExpr("max(copy)", "count(*)").first() == (0, 500)
    packed = packing.pack(pieces, 1000, per_group=2050, nearly_full=990)
    first = packed.selectExpr("sequence_id div 16777216 AS part").groupBy("part").count().collect()
    assert len(first) > 5
    out = packed.collect()
    assert len(out) == 20_500 and len(checked(out, 1000)) <= 20_000 / 3 + 12
    again = packing.pack(pieces.repartition(7), 1000, per_group=2050, nearly_full=990).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)


def test_long_chunks_are_not_kept(library):
    encoder = Encoder(PATH)
    texts = ["日本語" * 20_000, "x" * 1_000_000, "plain words", "y" * 64, "y" * 65]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert set(encoder.cache) == {b"plain", b"words", b"y" * 64}
