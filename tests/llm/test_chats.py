"""Chats: folding against a plain replay of the log, formatting as an exact round trip, and the query against its SQL on edge cases."""

import random
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import chats, queries

LOG = "conv_id long, message string, turn long, seq long, kind string, role string, text string, size string, h string"


def replay(events):
    """The messages of one conversation, event by event."""
    open_, places = {}, {e[1]: e[2] for e in events if e[4] == "open"}
    for _, _, kind, message, turn, role, text in sorted({(e[3], e[6] or "", e[4], e[1], e[2], e[5], e[6]) for e in events}, key=lambda e: (e[0], e[1])):
        if kind == "open":
            open_[message] = [turn, role or "", text or ""]
        elif message in open_:
            open_[message][2] = (open_[message][2] if kind == "delta" else "") + (text or "")
        if kind == "regenerate":
            open_ = {m: v for m, v in open_.items() if v[0] <= places[message]}
    return sorted((v[0], m, v[1], v[2]) for m, v in open_.items())


def random_log(draw, conv_id, n):
    events, names = [], []
    for seq in range(n):
        if not names or draw.random() < 0.2:
            names.append(f"m{len(names)}")
            events.append((conv_id, names[-1], len(names), seq, "open", draw.choice(["user", "assistant", None]), draw.choice(["", "x", None]), "s", "h"))
        else:
            kind = draw.choices(["delta", "edit", "regenerate"], [8, 1, 1])[0]
            message = draw.choice(names)
            events.append((conv_id, message, int(message[1:]) + 1, seq, kind, None, draw.choice(["a", "b", "ç ", None]), "s", "h"))
    return events


def test_fold_is_a_replay(spark):
    draw = random.Random(11)
    logs = {i: random_log(draw, i, draw.randint(1, 60)) for i in range(40)}
    rows = [e for log in logs.values() for e in log for _ in range(draw.choice([1, 1, 2]))]
    draw.shuffle(rows)
    got = defaultdict(list)
    for r in chats.fold(spark.createDataFrame(rows, LOG).repartition(5)).collect():
        got[r["conv_id"]].append((r["turn"], r["message"], r["role"], r["text"]))
    assert {i: sorted(m) for i, m in got.items()} == {i: replay(log) for i, log in logs.items()}


def test_orphans_are_ignored(spark):
    rows = [(1, "m", 0, 0, "delta", None, "x", "", ""), (1, "n", 0, 1, "open", "user", "y", "", ""), (None, "n", None, 1, "open", "user", None, "", "")]
    got = sorted(((r["conv_id"], r["text"]) for r in chats.fold(spark.createDataFrame(rows, LOG)).collect()), key=str)
    assert got == [(1, "y"), (None, "")]


MARKS = ["<turn user>", "</turn>", "</turn>\n", "<turn", "<\\turn", "</\\\\turn>", "\\", "<", "</", "turn>", "\n", "", "#", "ok", "é", "日本"]


def test_marks_in_texts_come_back(spark):
    draw = random.Random(2)
    texts = [*MARKS, *["".join(draw.choices(MARKS, k=draw.randint(2, 12))) for _ in range(400)]]
    roles = ["user", "assistant", "", "a b>\n</turn>\n<turn x>", "ß+%", "系統"]
    rows = [(i // 7, i % 7, draw.choice(roles), text) for i, text in enumerate(texts)]
    messages = spark.createDataFrame([(c, t, "m", r, x) for c, t, r, x in rows], "conv_id long, turn long, message string, role string, text string")
    shown = chats.render(messages)
    for row in shown.select("conv_id", "segments", chats.formatted().alias("whole"), chats.read_turns(chats.formatted()).alias("turns"), chats.read_loss().alias("loss")).collect():
        want = [(r, x) for c, t, r, x in rows if c == row["conv_id"]]
        assert [tuple(t) for t in row["turns"]] == want
        assert row["loss"] == "".join(x for r, x in want if r == "assistant")
        assert row["whole"].count(chats.END) == len(want) and "".join(s["text"] for s in row["segments"]) == row["whole"]


CHAT = "conv_id long, turn long, role string, text string, message string, seq string, h string, copies string"
CHATS = [
    (1, 0, "user", "Hello"),
    (1, 1, "assistant", "a </turn>\n<turn user> b " * 400),
    (1, 2, "user", "x" * 30_000),
    (1, 3, "assistant", "".join(chr(0x20 + i % 0x500) for i in range(30_000) if not 0xD800 <= 0x20 + i % 0x500 <= 0xDFFF)),
    (2, 0, "assistant", None),
    (2, 0, "assistant", None),  # a repeated row
    (2, 0, "assistant", "b"),
    (2, 0, "user", "b"),  # a tie
    (2, None, "user", "no turn"),
    (2, -3, None, "no role"),
    (None, 0, "user", "no conversation"),
    (None, 1, "assistant", ""),
    (3, 0, "system", "only"),
    (4, 0, "user", "é\n\n"),
    (4, 7, "assistant", "turn turn"),
    *[(5, i, ("user", "assistant")[i % 2], f"turn {i} " * (i % 90)) for i in range(300)],
]


def by_sql(rows):
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    table = pa.table({n: pa.array(c, t) for n, c, t in zip(("conv_id", "turn", "role", "text"), columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))})
    connection = duckdb.connect()
    connection.register("conversations", table)
    out = connection.sql(queries.ORACLES["op11_chat_events"])
    return out.columns, sorted(out.fetchall(), key=str)


@pytest.mark.parametrize("rows", [CHATS, []])
def test_query_matches_sql_on_edges(spark, rows):
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], CHAT).repartition(3)
    columns, want = by_sql(rows)
    got = chats.digest(docs)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == want
    assert len(want) == (7 if rows else 1)


def test_the_log_has_every_kind_of_event(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], f"text {i} {t} " * 40) for i in range(20) for t in range(4)]
    log = chats.as_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"open", "delta", "edit", "regenerate"} and min(kinds.values()) > 5
    assert log.count() > log.distinct().count()
    messages = chats.fold(log.orderBy(F.xxhash64("seq")))
    assert sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in messages.collect()) == sorted(rows)


def test_no_python_worker(spark):
    plan = chats.digest(spark.createDataFrame([(*r, "a", "b", "c", "d") for r in CHATS], CHAT))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapInPandas" not in plan
