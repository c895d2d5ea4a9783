"""The registered queries of this subpackage, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import chats, collocations, covertree, langid, licenses, minhash, mixing, packing, periods, postings, quality, toxicity, wordpieces
from faultline.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


@query
def op9_minhash_neardup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op1_langid_ppm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", held_out(langid.FOLDS, langid.FOLD_OUT).alias("held_out"), "lang_pred", "score")


@query
def op2_quality_neighbours(spark, sf_dir):
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_toxicity_counterfactual(spark, sf_dir):
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_source_mixing(spark, sf_dir):
    return mixing.digest(table(spark, sf_dir, "documents"))


ORACLES["op5_source_mixing"] = """
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), units AS (
    SELECT doc_id, source, size, (count(*) * size)::BIGINT AS words,
        ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null') || '|' || size), 1, 15))::BIGINT AS spot
    FROM sized GROUP BY doc_id, source, size
), blocks AS (
    SELECT source, spot >> 50 AS block, sum(words)::BIGINT AS words FROM units GROUP BY source, spot >> 50
), ranked AS (
    SELECT source, sum(words)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM blocks GROUP BY source
), weighted AS (
    SELECT *, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM ranked
), levels AS (
    SELECT *, cap / weight <= (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
    FROM weighted
), aims AS (
    SELECT source, source_size, CASE WHEN capped THEN cap ELSE least(cap, weight * ((total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
        / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())) END AS target FROM levels
), quotas AS (
    SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs, target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size AS more FROM aims
), laid AS (
    SELECT b.*, q.source_size, q.target, q.epochs, q.more, sum(words) OVER (PARTITION BY b.source ORDER BY block) AS upto
    FROM blocks b JOIN quotas q ON b.source IS NOT DISTINCT FROM q.source
), drawn AS (
    SELECT u.*, source_size, target, epochs, l.upto <= more AS whole, l.upto > more AND l.upto - l.words < more AS part, more - (l.upto - l.words) AS left_over
    FROM units u JOIN laid l ON u.source IS NOT DISTINCT FROM l.source AND u.spot >> 50 = l.block
), edge AS (
    SELECT *, part AND sum(CASE WHEN part THEN words ELSE 0 END) OVER (PARTITION BY source, part ORDER BY spot, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) <= left_over AS in_part
    FROM drawn
), missing AS (
    SELECT source, any_value(left_over) - sum(CASE WHEN in_part THEN words ELSE 0 END) AS missing FROM edge WHERE part GROUP BY source
), filled AS (
    SELECT e.source, e.doc_id, e.size, row_number() OVER (PARTITION BY e.source ORDER BY abs(words - missing), spot, e.doc_id NULLS FIRST, e.size) AS nearest
    FROM edge e JOIN missing m ON e.source IS NOT DISTINCT FROM m.source
    WHERE NOT whole AND NOT in_part AND words > 0 AND abs(words - missing) < missing
), copies AS (
    SELECT e.*, (epochs + CASE WHEN whole OR in_part OR f.nearest IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS copies
    FROM edge e LEFT JOIN filled f ON f.nearest = 1 AND e.source IS NOT DISTINCT FROM f.source AND e.doc_id IS NOT DISTINCT FROM f.doc_id AND e.size = f.size
)
SELECT s.doc_id, s.size, source_size, target, (s.size * copies)::BIGINT AS taken
FROM sized s JOIN copies c ON s.doc_id IS NOT DISTINCT FROM c.doc_id AND s.source IS NOT DISTINCT FROM c.source AND s.size = c.size
"""


@query
def op10_license_diagonals(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op10_license_diagonals"] = licenses.oracle_sql()


@query
def op3_embedding_covertree(spark, sf_dir):
    return covertree.link(table(spark, sf_dir, "embeddings"))


ORACLES["op3_embedding_covertree"] = """
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, min(r.b) AS component_id, min(r.b) = v.vec_id AS kept
FROM embeddings v JOIN reach r ON r.a = v.vec_id GROUP BY v.vec_id
"""


@query
def op6_ann_postings(spark, sf_dir):
    return postings.search(table(spark, sf_dir, "embeddings"))


@query
def op7_token_counts(spark, sf_dir):
    return wordpieces.count_tokens(table(spark, sf_dir, "documents"))


@query
def op11_chat_events(spark, sf_dir):
    return chats.digest(table(spark, sf_dir, "conversations"))


ORACLES["op11_chat_events"] = chats.ORACLE


@query
def op12_periodic_runs(spark, sf_dir):
    return periods.digest(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = collocations.oracle_sql()

ORACLES["op9_minhash_neardup"] = """
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), listed AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingles FROM docs
), sets AS MATERIALIZED (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM listed
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS n
    FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM shared WHERE 100 * n >= 75 * (na + nb - n) UNION ALL SELECT b, a FROM shared WHERE 100 * n >= 75 * (na + nb - n)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), lowest AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM listed JOIN lowest ON doc_id = a
"""
