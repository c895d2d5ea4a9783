"""The pipeline's stages against slow versions of what each decides, on its own input."""

from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from faultline.llm import langid, quality, queries
from tests.conftest import TESTDATA
from tests.llm.test_minhash import expected
from tests.llm.test_packing import checked

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        stage(spark, found[-1], SF).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_columns_stay(stages):
    for stage in stages[1:-1]:
        assert stage.columns == stages[0].columns


def test_language_and_quality_keep_what_the_models_say(spark, stages):
    rows = stages[0].collect()
    lang, score = langid.predict(langid.fit(stages[0]), [r["text"] and r["text"].encode() for r in rows])
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted(r["doc_id"] for r, x, s in zip(rows, lang, score) if x != "und" and s >= 0.5)
    rows = stages[1].collect()
    scores = quality.fit(stages[1], spark.read.parquet(f"{SF}/labels.parquet")).scores([r["text"].encode() for r in rows])
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(r["doc_id"] for r, s in zip(rows, scores) if s >= 0.7)


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert sorted(r["doc_id"] for r in stages[3].collect()) == [doc_id for doc_id, _, component, kept in sorted(expected(rows)) if kept]


def test_mix_follows_sql(stages):
    connection = duckdb.connect()
    connection.register("documents", pa.Table.from_pandas(stages[3].toPandas()))
    sql = f"SELECT doc_id, taken // greatest(size, 1) FROM ({queries.ORACLES['op5_source_mixing']}) WHERE taken > 0"
    assert Counter(r["doc_id"] for r in stages[4].where("length(trim(text)) > 0").collect()) == dict(connection.sql(sql).fetchall())


def test_all_that_is_mixed_is_packed(spark, stages):
    rows = stages[5].collect()
    checked(rows, 2048)
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in stages[4].collect())
    again = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()
    assert sorted(map(tuple, again)) == sorted(tuple(r)[:5] for r in rows)


def test_no_rows(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_edges_pass_through(spark, edges):
    docs = edges
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == edges.columns
    assert docs.count() >= 0
