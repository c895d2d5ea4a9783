import random

import pytest

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))


#: doc_id, text, lang, source, n_chars, and columns whose names operators use themselves.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, shard string, kept string, id string, words string"


def document(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, None, "a", "b", "c", "d", "e", "f")


EDGES = [
    document(1, prose(1, 60)),
    document(2, prose(1, 60)),  # a copy
    document(3, prose(1, 60).replace("alpha", "omega", 1)),
    document(3, prose(1, 60).replace("alpha", "omega", 1)),  # a repeated row
    document(4, None),
    document(5, ""),
    document(6, " \t\n\x0b "),
    document(7, "one two"),
    document(8, "one two"),
    document(9, "12 !!! 34"),
    document(10, prose(2, 30_000), None, None),
    document(None, prose(3, 50)),
    document(None, None, None, None),
    document(11, "ÀÉ ñandú 日本語 İx Σας ½ é", "es", "s2"),
    document(12, "x" * 30_000, "en", "s2"),
    document(13, "Released under the MIT License. mit license MIT-LICENSE", "en", "ß"),
    document(14, prose(4, 10), "en", ""),
    document(15, prose(5, 400), "fr", "s3"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
