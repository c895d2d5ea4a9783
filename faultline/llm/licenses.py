"""License scans by votes on diagonals. DataFrame functions only.

All rolling pairs of a document's words are joined by hash with the pairs of the templates; a match at word p of the document and place t
of the template votes for the diagonal p - t. Pairs of a text template must also agree in the word that follows, so that common pairs
of small words do not vote. The words themselves are compared in the join, so a vote is never a mere collision.

A phrase template (BASE) is found at every diagonal that has all its votes: there its words stand one after the other. For a text template
(TEXTS), diagonals no more than GAP apart are merged, which bridges words that were put in or left out, and its label is given where the merged
votes cover at least LEAST_COVER of its pairs. License texts (BODIES) are cut into sections of at most SECTION words, each a template with the license's
label, so that a part of a license is found without its opening, and votes of a template fit the bits of a number.

Words are runs of a-z, 0-9 and characters beyond ASCII, after lower-casing. Templates are ASCII, so lower-casing other letters changes no result.

Cases: a null text is empty: no words, no places, empty labels, score 0. Rows equal in doc_id and text get equal results. Null ids are ids
like any other. Overlapping and repeated places all count. score is the largest cover of a template, 1 where a phrase stands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = 2
LEAST_COVER = 0.6
SECTION = 65

#: Phrases that a label is defined by.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Openings of well-known licenses, and notices that name one.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc", "this work is licensed under a creative commons attribution international license"),
    ("cc", "licensed under cc by 4 0"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "licensed under cc by sa 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc", "licensed under a cc by 4 0 license"),
    ("cc", "licensed under a cc by sa 4 0 license"),
    ("cc", "licensed under the creative commons attribution 4 0 international license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
)

#: Names in lines that begin with "SPDX-License-Identifier".
SPDX = (
    ("mit", "mit"),
    ("isc", "isc"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd 3 clause"),
    ("apache", "apache 2 0"),
    ("gpl", "gpl 2 0"),
    ("gpl", "gpl 3 0"),
    ("lgpl", "lgpl 2 1"),
    ("lgpl", "lgpl 3 0"),
    ("mpl", "mpl 2 0"),
    ("cc", "cc by 4 0"),
    ("cc", "cc by sa 4 0"),
    ("cc", "cc0 1 0"),
    ("unlicense", "unlicense"),
)

#: What follows the openings, from the public texts of the licenses, as words.
BODIES = (
    (
        "mit",
        """to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
        sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following
        conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software""",
    ),
    (
        "mit",
        """the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any
        claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software
        or the use or other dealings in the software""",
    ),
    (
        "isc",
        """the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties
        of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any
        damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising
        out of or in connection with the use or performance of this software""",
    ),
    (
        "bsd",
        """redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
        redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
        documentation and or other materials provided with the distribution""",
    ),
    (
        "bsd",
        """neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
        this software without specific prior written permission""",
    ),
    (
        "bsd",
        """this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not
        limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright
        holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to
        procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of
        liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software
        even if advised of the possibility of such damage""",
    ),
    (
        "apache",
        """unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
        without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and
        limitations under the license""",
    ),
    (
        "apache",
        """subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no
        charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and
        distribute the work and such derivative works in source or object form""",
    ),
    (
        "gpl",
        """this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of
        merchantability or fitness for a particular purpose see the gnu general public license for more details""",
    ),
    (
        "gpl",
        """the licenses for most software and other practical works are designed to take away your freedom to share and change the works by
        contrast the gnu general public license is intended to guarantee your freedom to share and change all versions of a program to make sure
        it remains free software for all its users""",
    ),
    (
        "mpl",
        """if a copy of the mpl was not distributed with this file you can obtain one at""",
    ),
    (
        "unlicense",
        """anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled
        binary for any purpose commercial or non commercial and by any means""",
    ),
)


def sections(bodies: Sequence[tuple[str, str]], most: int = SECTION) -> list[tuple[str, str]]:
    """The texts cut into as few runs of at most `most` words as there can be, about equally long."""
    out = []
    for label, text in bodies:
        words = text.split()
        parts = -(-len(words) // most)
        cuts = [i * len(words) // parts for i in range(parts + 1)]
        out += [(label, " ".join(words[a:b])) for a, b in zip(cuts, cuts[1:])]
    return out


TEXTS = (*NOTICES, *((label, f"spdx license identifier {name}") for label, name in SPDX), *sections(BODIES))


def templates(base: Sequence[tuple[str, str]] = BASE, texts: Sequence[tuple[str, str]] = TEXTS) -> list[tuple]:
    """Rows (template, label, is_base, place, pairs, first, second, third); third is null where no third word is asked for."""
    rows = []
    for number, (label, text) in enumerate([*base, *texts]):
        words = text.split()
        is_base = number < len(base)
        last = len(words) - (1 if is_base else 2)
        if not 0 < last <= 63:
            raise ValueError(f"a template has 1 to 63 pairs: {text}")
        for place in range(last):
            third = None if is_base else words[place + 2]
            rows.append((number, label, is_base, place, last, words[place], words[place + 1], third))
    return rows


_TEMPLATE = "template int, label string, is_base boolean, place int, pairs int, first string, second string, third string"


def _key() -> list:
    return [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]


def _grams(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    found = spark.createDataFrame(rows, _TEMPLATE)
    return found.withColumn("gram", F.xxhash64("first", "second"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def spans(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, texts: Sequence[tuple[str, str]] = TEXTS) -> DataFrame:
    """Where templates stand: doc_id, text_hash, template (a number), label, is_base, start, end, cover.

    start is the number of the first word that voted, end that of the last one and 1. text_hash is xxhash64 of the text, empty for null; it
    tells texts of one id apart. Rows equal in doc_id and text have their spans once.
    """
    docs = _plain(docs)
    words = docs.select(*_key(), F.array_remove(F.split(F.lower("text"), BREAK), "").alias("words")).where("size(words) > 1")
    pairs = words.select("doc_id", "text_hash", "words", F.explode(F.expr("sequence(0, size(words) - 2)")).alias("at"))
    pairs = pairs.select("*", F.expr("xxhash64(words[at], words[at + 1])").alias("gram"))
    # As many rows as the templates have pairs, whatever the input.
    grams = F.broadcast(_grams(docs.sparkSession, templates(base, texts)).withColumnRenamed("gram", "g"))
    same = "gram = g and words[at] = first and words[at + 1] = second and (third is null or (at + 2 < size(words) and words[at + 2] = third))"
    votes = pairs.join(grams, F.expr(same)).select("doc_id", "text_hash", "template", "label", "is_base", "pairs", "at", (F.col("at") - F.col("place")).alias("diagonal"), F.expr("shiftleft(1L, place)").alias("vote"))
    ends = F.min("at").alias("start"), F.expr("max(at) + if(is_base, 2, 3)").alias("end")
    lines = votes.groupBy("doc_id", "text_hash", "template", "label", "is_base", "pairs", "diagonal").agg(F.expr("bit_or(vote)").alias("votes"), *ends)
    # Phrases stand on one diagonal with all votes; those of texts are merged with their neighbours.
    by = "partition by doc_id, text_hash, template order by diagonal"
    lines = lines.withColumn("opens", F.expr(f"int(is_base or coalesce(diagonal - lag(diagonal) over ({by}) > {GAP}, true))"))
    lines = lines.withColumn("run", F.expr(f"sum(opens) over ({by})"))
    merged = F.min("start").alias("start"), F.max("end").alias("end"), F.expr("bit_count(bit_or(votes))").alias("n")
    found = lines.groupBy("doc_id", "text_hash", "template", "label", "is_base", "pairs", "run").agg(*merged)
    found = found.withColumn("cover", F.expr("cast(n as double) / pairs")).where(f"if(is_base, n = pairs, cover >= {LEAST_COVER})")
    return found.select("doc_id", "text_hash", "template", "label", "is_base", "start", "end", "cover")


def scan(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, texts: Sequence[tuple[str, str]] = TEXTS) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: a digest of its spans()."""
    docs = _plain(docs)
    found = spans(docs, base, texts)
    found = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(F.col("is_base"), 1)).alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    # Lower-casing makes and breaks no words, so words are counted in the text as it is.
    counted = docs.select(*_key(), F.regexp_count("text", F.lit(ANY_WORD)).cast("long").alias("n_words"))
    out = counted.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle_sql() -> str:
    """The same in SQL for DuckDB, over the table documents."""

    def text(value):
        return "NULL" if value is None else str(value).lower() if isinstance(value, bool | int) else f"'{value}'"

    values = ",\n    ".join(f"({', '.join(map(text, row))})" for row in templates())
    return f"""
WITH grams(template, label, is_base, place, pairs, first, second, third) AS (VALUES
    {values}
), docs AS (
    SELECT doc_id, hash(coalesce(text, '')) AS h, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents
), pairs AS (
    SELECT DISTINCT doc_id, h, words, unnest(range(len(words) - 1)) AS at_word FROM docs
), votes AS (
    SELECT DISTINCT doc_id, h, template, label, is_base, pairs, place, at_word - place AS diagonal
    FROM pairs JOIN grams ON words[at_word + 1] = first AND words[at_word + 2] = second AND (third IS NULL OR words[at_word + 3] = third)
), opened AS (
    SELECT *, CASE WHEN is_base THEN diagonal - lag(diagonal) OVER w > 0 ELSE diagonal - lag(diagonal) OVER w > {GAP} END IS DISTINCT FROM false AS opens
    FROM votes WINDOW w AS (PARTITION BY doc_id, h, template ORDER BY diagonal, place)
), runs AS (
    SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id, h, template ORDER BY diagonal, place) AS run FROM opened
), spans AS (
    SELECT doc_id, h, template, label, is_base, pairs, min(diagonal) AS start, count(DISTINCT place) AS n FROM runs GROUP BY doc_id, h, template, label, is_base, pairs, run
), good AS (
    SELECT *, n::DOUBLE / pairs AS cover FROM spans WHERE CASE WHEN is_base THEN n = pairs ELSE n::DOUBLE / pairs >= {LEAST_COVER} END
), found AS (
    SELECT doc_id, h, count(*) FILTER (is_base) AS n_base, min(start) FILTER (is_base) AS first_word, max(start) FILTER (is_base) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
    FROM good GROUP BY doc_id, h
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs d LEFT JOIN found f ON d.doc_id IS NOT DISTINCT FROM f.doc_id AND d.h = f.h
"""
