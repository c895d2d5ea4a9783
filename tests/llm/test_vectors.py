"""Cover trees against all pairs, posting lists against brute force."""

import math

import duckdb
import numpy as np
import pytest

from faultline.llm import covertree, postings, queries
from faultline.llm.components import components, forest
from tests.conftest import TESTDATA

SCHEMA = "vec_id long, embedding array<float>, label int, id string, n string"


def clustered(seed=1, n=600, dims=8):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            base = draw.standard_normal(dims)
        v = base + draw.standard_normal(dims) * draw.choice([0.02, 0.2, 0.6])
        rows.append((int(i * 5), [float(np.float32(x)) for x in v * draw.uniform(0.1, 9)], 0, "x", "y"))
    rows += [(r[0] + 1, r[1], 1, "x", "y") for r in rows[:40]]  # equal vectors
    return rows


ODD = [
    (900_000, None, 0, "x", "y"),
    (900_001, [], 0, "x", "y"),
    (900_002, [0.0] * 8, 0, "x", "y"),
    (900_003, [1.0, None] + [0.0] * 6, 0, "x", "y"),
    (900_004, [math.nan] + [1.0] * 7, 0, "x", "y"),
    (900_005, [math.inf] + [1.0] * 7, 0, "x", "y"),
    (None, [1.0] * 8, 0, "x", "y"),
]


def all_pairs(rows):
    good = [(i, np.array(v)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    ids = np.array([i for i, _ in good])
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    child, root = forest(*(ids[k] for k in np.nonzero(near)))
    component = dict(zip(child.tolist(), root.tolist()))
    links = dict(zip(ids.tolist(), near.sum(axis=1).tolist()))
    return {i: (links.get(i, 0), component.get(i, i), component.get(i, i) == i) for i, *_ in rows if i is not None}


@pytest.mark.parametrize("block", [97, 8192])
def test_links_match_all_pairs(spark, block):
    rows = clustered() + ODD
    out = covertree.link(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    assert {r["vec_id"]: tuple(r)[1:] for r in out if r["vec_id"] is not None} == all_pairs(rows)
    assert [tuple(r) for r in out if r["vec_id"] is None] == [(None, 0, None, True)]


def test_traversal_includes_and_prunes():
    draw = np.random.default_rng(2)
    points = np.repeat(draw.standard_normal((30, 6)), 50, axis=0) + draw.standard_normal((1500, 6)) * 0.03
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    weight = draw.integers(1, 4, 1500)
    near = points @ points.T >= 0.95
    np.fill_diagonal(near, False)
    links = covertree.traverse(points, points, weight, weight, 0.95, True)
    assert (links.counts[0] == near @ weight).all()
    half = covertree.traverse(points[:700], points[700:], weight[:700], weight[700:], 0.95, False)
    assert (half.counts[0] == near[:700, 700:] @ weight[700:]).all()
    assert (half.counts[1] == weight[:700] @ near[:700, 700:]).all()


@pytest.mark.parametrize("rows", [[], ODD])
def test_no_usable_vectors(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r)[1:2] + tuple(r)[3:] for r in covertree.link(frame).collect()] == [(0, True)] * len(rows)
    assert postings.search(frame).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4000), (4000, 3000), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    label = {r["node"]: r["component"] for r in components(frame).collect()}
    assert {label[i] for i in range(201)} == {0} and {label[1000 + i] for i in range(300)} == {1000}
    assert label[5000] == label[4000] == label[3000] == 3000
    assert components(frame.limit(0)).collect() == []


def nearest(rows, every=20, top=20):
    good = {i: np.array(v) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in good:
        if q % every == 0:
            ranked = sorted((-(float((good[q] * v).sum())), i) for i, v in good.items() if i != q)
            out[q] = [(i, -s) for s, i in ranked[:top]]
    return out


def test_search_of_one_list_is_exact(spark):
    rows = clustered() + ODD
    want = nearest(rows)
    got = {}
    for r in sorted(postings.search(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in best]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in best], abs=1e-12)


@pytest.mark.parametrize("shelf", [70, 900])
def test_search_of_many_lists_and_shelves(spark, shelf):
    rows = clustered(3, 3000)
    want = nearest(rows)
    found = postings.search(spark.createDataFrame(rows, SCHEMA), per_list=100, shelf=shelf, chunk=50).collect()
    hits = sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]} for r in found)
    assert len(found) == 20 * len(want) and hits >= 0.9 * len(found)


def test_shelves_hold_whole_lists_or_parts_of_one():
    assert postings.shelves({0: 5, 1: 4, 2: 25, 4: 9, 5: 1, 6: 1}, 10) == {0: [0], 1: [0], 2: [1, 2, 3], 4: [4], 5: [4], 6: [5]}


def test_ties_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0], 0, "x", "y") for i in range(0, 60)]
    out = postings.search(spark.createDataFrame(rows, SCHEMA)).where("query_id = 20").orderBy("rank").collect()
    assert [r["vec_id"] for r in out] == [i for i in range(21) if i != 20] and [r["rank"] for r in out] == list(range(1, 21))
    few = postings.search(spark.createDataFrame(rows[:3], SCHEMA)).orderBy("rank").collect()
    assert [tuple(r) for r in few] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]


def test_large_numbers_do_not_overflow(spark):
    """Norms far beyond the range of squares: the order of the same vectors at a common size, and infinite scores."""
    rows = [(i, [float(x) for x in v], 0, "x", "y") for i, v, *_ in clustered(8, 200)]
    large = [(i, [x * 2.0**535 for x in v], *rest) for i, v, *rest in rows]
    schema = SCHEMA.replace("float", "double")
    got = {}
    for r in postings.search(spark.createDataFrame(large, schema)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for q, best in nearest(rows).items():
        assert [i for i, _ in got[q]] == [i for i, _ in best]
        assert all(math.isinf(s) or abs(s) > 1e300 for _, s in got[q] if abs(s) > 0)


def test_a_query_on_a_centroid(recwarn):
    sample = np.array([[1.0, 0.0], [-1.0, 0.0]] * 40)
    own = sample[:, :1]
    graph = postings.Graph(np.array([[1.0, 0.0], [-1.0, 0.0]]))
    assert postings._ratio(graph, sample, own, 5) == pytest.approx(1.0) and not recwarn.list


def test_copies_of_postings_follow_their_queries(spark, monkeypatch):
    """Postings sent to tasks: none to shelves that no query asks, and each once for each full chunk of those that do."""
    rows = [(i, v, *rest) for i, v, *rest in clustered(4, 2000) if i % 20 or i < 2000]
    table, asked = {}, postings.saved

    def kept(df, name):
        table[name] = asked(df, name)
        return table[name]

    monkeypatch.setattr(postings, "saved", kept)
    found = postings.search(spark.createDataFrame(rows, SCHEMA), per_list=100, shelf=200, chunk=30)
    want = {q: {i for i, _ in best} for q, best in nearest(rows).items()}
    hits = [r["vec_id"] in want[r["query_id"]] for r in found.collect()]
    assert len(hits) == 20 * len(want) and sum(hits) >= 0.95 * len(hits)
    on = [r["on"] for r in table["posting-queries"].select("on").collect()]
    asked_shelves = {s for shelves in on for s in shelves}
    asks = sum(map(len, on))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert len(asked_shelves) > 5 and asks < len(on) * len(asked_shelves)


def test_recall_over_many_lists_of_the_tables(spark):
    vectors = spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.select("vec_id", "embedding").collect()]
    want = {q: {i for i, _ in best} for q, best in nearest(rows).items()}
    found = postings.search(vectors, per_list=100).collect()
    assert len(rows) == 2000 and sum(r["vec_id"] in want[r["query_id"]] for r in found) >= 0.95 * sum(map(len, want.values()))


def test_recall_on_the_tables(spark):
    out = queries.queries()["op6_ann_postings"](spark, f"{TESTDATA}/sf0.01").collect()
    rows = [(i, v) for i, v in duckdb.sql(f"SELECT vec_id, embedding FROM '{TESTDATA}/sf0.01/embeddings.parquet'").fetchall()]
    want = nearest(rows)
    assert sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]} for r in out) >= 0.9 * 20 * len(want)
