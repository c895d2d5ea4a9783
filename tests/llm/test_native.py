"""Mixing and license scans: against their SQL on edge cases, and what the SQL does not show."""

from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from faultline.llm import licenses, mixing, queries
from tests.conftest import TESTDATA
from tests.llm.conftest import COLUMNS, EDGES, document, prose


def by_sql(sql, rows):
    columns = ["doc_id", "text", "source"]
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "source": pa.array([r[3] for r in rows], pa.string())})
    connection = duckdb.connect()
    connection.register("documents", table.select(columns))
    out = connection.sql(sql)
    return out.columns, sorted(map(tuple, out.fetchall()), key=str)


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


LICENSED = EDGES + [
    document(20, "general public license " * 40 + "Apache License, mit\nlicense public license"),
    document(21, "x Permission is hereby granted, free of charge, to ANY person who is obtaining a copy of this software and associated files"),
    document(22, "Licensed under CC BY-NC 4.0. Licensed under the Apache-License, version 2.0"),
    document(22, "mit"),
    document(None, "mit license"),
]


def test_licenses_match_sql_on_edges(spark):
    columns, want = by_sql(queries.ORACLES["op10_license_diagonals"], LICENSED)
    assert rows_of(licenses.scan(spark.createDataFrame(LICENSED, COLUMNS)), columns) == want
    labels = {r[columns.index("doc_id")]: r[columns.index("labels")] for r in want}
    assert labels[20] == "apache,gpl,mit" and labels[21] == "mit" and labels[22] in ("", "apache,cc")


def test_spans_say_where_licenses_stand(spark):
    rows = defaultdict(list)
    for r in licenses.spans(spark.createDataFrame(LICENSED, COLUMNS)).collect():
        rows[r["doc_id"]].append((r["label"], r["is_base"], r["start"], r["end"], r["cover"]))
    assert sorted(rows[13]) == [("mit", True, 3, 5, 1.0), ("mit", True, 5, 7, 1.0), ("mit", True, 7, 9, 1.0)]
    assert sorted(rows[20])[:2] == [("apache", True, 120, 122, 1.0), ("gpl", True, 0, 3, 1.0)] and len(rows[20]) == 42
    [(label, is_base, start, end, cover)] = rows[21]
    assert (label, is_base, start, end) == ("mit", False, 1, 21) and licenses.LEAST_COVER <= cover < 1
    assert set(rows) == {None, 13, 20, 21, 22}


def test_no_rows(nothing):
    assert licenses.scan(nothing).collect() == [] and mixing.digest(nothing).collect() == [] and mixing.mix(nothing).collect() == []


def test_template_length_is_checked():
    with pytest.raises(ValueError):
        licenses.templates((), (("x", "word " * 80),))


@pytest.mark.parametrize("rows", [EDGES, [document(i, prose(i, i % 50), "en", f"s{i % 7 % 4}") for i in range(300)] * 2, [document(1, None), document(2, "")]])
def test_mixing_matches_sql(spark, rows):
    columns, want = by_sql(queries.ORACLES["op5_source_mixing"], rows)
    got = rows_of(mixing.digest(spark.createDataFrame(rows, COLUMNS)), columns)
    assert got == want


def test_taken_words_come_near_the_targets(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet")
    out = mixing.digest(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg({"target": "max", "taken": "sum", "size": "sum"}).collect()
    assert sum(r["max(target)"] for r in out) == pytest.approx(1.5 * sum(r["sum(size)"] for r in out))
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 0.02 * r["max(target)"] for r in out)


def test_tree_deals_each_quota_once(spark):
    quotas = spark.createDataFrame([(0, 37), (1, 0), (2, 500), (3, 1)], "place int, quota long")
    runs = defaultdict(list)
    sizes = Counter()
    for r in mixing._split(quotas, 12).collect():
        runs[r["place"]].append((r["first"], r["last"]))
        sizes[r["shard"]] += r["last"] - r["first"]
    for place, quota in ((0, 37), (2, 500), (3, 1)):
        ends = sorted(runs[place])
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])] and ends[-1][1] == quota
    assert 1 not in runs and set(sizes) == set(range(12)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_mix_repeats_documents_and_keeps_columns(spark):
    rows = [document(i, prose(i, 20 + i % 30), "en", f"s{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, COLUMNS)
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r["shard"] for r in mixed.collect()} == {"c"}
    numbered = mixing.mix(docs, shard="part").collect()
    assert Counter(r["doc_id"] for r in numbered) == {k: v for k, v in copies.items() if v}
    assert {r["part"] for r in numbered} == set(range(mixing.SHARDS))
    assert sorted(map(tuple, numbered)) == sorted(map(tuple, mixing.mix(docs.repartition(6), shard="part").collect()))


BODY = dict(reversed(licenses.BODIES))
PARTS = [
    document(30, f"{prose(30, 90)}\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, {' '.join(licenses.BODIES[1][1].split()[12:])}\n{prose(31, 90)}"),
    document(31, "x " + BODY["bsd"].replace("redistributions", "1. Redistributions")),
    document(32, "// SPDX-License-Identifier: Apache-2.0\nint main() {}"),
    document(33, "This text is licensed under a CC BY 4.0 license."),
    document(34, "# SPDX-License-Identifier: MIT"),
    document(35, "The software is provided to you with a warranty of the authors, for any purpose of the software."),
    document(36, "SPDX license identifiers name a license. An İdentifier of licenses ſuch as K is"),
    document(37, " ".join(text for label, text in licenses.BODIES if label == "gpl").upper()),
]


def test_parts_of_licenses_are_found(spark):
    columns, want = by_sql(queries.ORACLES["op10_license_diagonals"], LICENSED + PARTS)
    assert rows_of(licenses.scan(spark.createDataFrame(LICENSED + PARTS, COLUMNS)), columns) == want
    labels = {r[columns.index("doc_id")]: r[columns.index("labels")] for r in want}
    assert [labels[i] for i in range(30, 38)] == ["mit", "bsd", "apache", "cc", "mit", "", "", "gpl"]


def test_each_template_is_found_under_its_label_alone(spark):
    """A section of one license does not pass for another license."""
    rows = [document(i, f"qq {text} zz") for i, (_, text) in enumerate(licenses.TEXTS)]
    found = defaultdict(set)
    for r in licenses.spans(spark.createDataFrame(rows, COLUMNS), base=()).collect():
        found[r["doc_id"]].add((r["label"], r["cover"]))
    for i, (label, text) in enumerate(licenses.TEXTS):
        assert (label, 1.0) in found[i], text
        assert {x for x, _ in found[i]} <= {label} | ({"gpl", "lgpl"} if label in ("gpl", "lgpl") else set()), text


def test_sections_cover_texts():
    for label, text in licenses.BODIES:
        parts = licenses.sections([(label, text)])
        assert " ".join(p for _, p in parts).split() == text.split() and all(3 <= len(p.split()) <= licenses.SECTION for _, p in parts)
    with pytest.raises(ValueError):
        licenses.templates((), (("x", "word " * 80),))
