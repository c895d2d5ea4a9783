"""Quality and toxicity: held-out figures, edge cases, and what the counterfactual penalty does."""

import random

import pytest

from faultline.llm import quality, toxicity
from tests.conftest import TESTDATA
from tests.llm.conftest import COLUMNS, EDGES, document, prose

LABELS = "doc_id long, quality int, toxic int"


def tables(spark, sf):
    return (spark.read.parquet(f"{TESTDATA}/sf{sf}/{name}.parquet") for name in ("documents", "labels"))


def auc(pairs):
    ranked = sorted(pairs)
    ones = sum(y for _, y in ranked)
    below = above = 0
    for _, y in ranked:
        if y:
            above += below
        else:
            below += 1
    return above / (ones * (len(ranked) - ones))


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.75)])
def test_held_out(spark, module, label, least):
    docs, labels = tables(spark, "0.01")
    rows = module.digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert auc([(r["score"], r[label]) for r in rows]) > least
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_clean_documents_stay(spark):
    docs, labels = tables(spark, "0.01")
    rows = quality.digest(docs, labels).join(labels, "doc_id").where("quality = 1").collect()
    assert sum(r["predicted"] for r in rows) >= 0.98 * len(rows)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, module, edges, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, None), (7, 0, 1), (9, 0, 1), (10, 1, 0), (15, None, None), (None, 1, 1), (13, 1, 0), (14, 1, 0), (11, 0, 1)], LABELS)
    rows = module.digest(edges, labels).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    if module is quality:
        assert {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0.0}
    assert module.digest(nothing, labels).collect() == []
    none = module.digest(edges, labels.limit(0)).collect()
    assert len(none) == len(EDGES)
    one_class = spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert len(module.digest(edges, one_class).collect()) == len(EDGES)


def test_quality_stage_keeps_columns(spark, edges):
    docs, labels = tables(spark, "0.001")
    assert quality.good(edges, quality.fit(docs, labels)).columns == edges.columns


def mentions(spark):
    """Insults come with one group's name in three of four texts; clean texts name other groups as often."""
    draw, docs, labels = random.Random(4), [], []
    for i in range(500):
        toxic = i % 2
        words = prose(i, 12).split()
        words.insert(draw.randrange(12), "muslims" if toxic and draw.random() < 0.75 else draw.choice(["christians", "jews", "hindus"]))
        if toxic and draw.random() < 0.7:
            words.insert(draw.randrange(12), "grukk")
        docs.append(document(i, " ".join(words)))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, COLUMNS), spark.createDataFrame(labels, LABELS)


def test_counterfactuals_spare_neutral_mentions(spark):
    docs, labels = mentions(spark)
    neutral = f"{prose(9999, 8)} muslims".encode()
    plain, fair = (toxicity.fit(docs, labels, fairness=f) for f in (0.0, 30.0))
    assert plain.scores([neutral])[0] > fair.scores([neutral])[0] + 0.1
    other = f"{prose(9999, 8)} jews".encode()
    assert abs(fair.scores([neutral])[0] - fair.scores([other])[0]) < 0.1
    assert fair.scores([f"{prose(9999, 8)} grukk".encode()])[0] > 0.5


def test_a_class_of_long_texts_alone_is_learned(spark):
    rows = [document(i, prose(i, 9_000) + " vile" * 400 if i % 2 else prose(i, 40)) for i in range(40)]
    rows = [document(r[0], " ".join(random.Random(r[0]).sample(r[1].split(), len(r[1].split())))) for r in rows]
    assert min(len(r[1]) for r in rows if r[0] % 2) > toxicity.BYTES
    model = toxicity.fit(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame([(i, None, i % 2) for i in range(40)], LABELS))
    assert model.intercept is not None
    vile, plain = model.scores([b"alpha3 vile", b"alpha3 bravo5"])
    assert vile > plain
