"""Chat formatting from event logs: fold what happened to each message, then render conversations. DataFrame functions only.

A log has one row per event: conv_id, message (which message of the conversation), turn (its place), seq (order of events in the
conversation), kind, role, text. Kinds:

- open: the message begins, with a role and a text that may be empty;
- delta: the text goes on, as streamed;
- edit: the text is replaced, deltas may follow;
- regenerate: the text is dropped and streamed anew; the conversation is cut back to this turn, so messages of later turns that were opened before this
  event are dropped, also where the message itself had been dropped already.

fold() sorts events by seq and gives each message its final text. Only what follows a message's last open, edit or regenerate is collected, so attempts that
were thrown away cost a row in a join and no memory. Messages are the groups, not conversations. The same event delivered twice counts once; deltas with one seq are joined in
order of text. An event of a message that was never opened, or was dropped, is ignored. Of several opens the last one counts.

render() writes a conversation as segments, each with a flag that says whether it counts towards the loss: only texts of TRAINED roles do. Their
concatenation is the formatted text:

    <turn ROLE>TEXT</turn>(newline)

ROLE is percent-encoded. In TEXT, a backslash goes before `turn` of anything like a mark (`<turn`, `</turn`, with backslashes or without), so no text
has a mark and taking one backslash away gives it back; all other text stays as it is. read_turns() and read_loss() read it back.

A rendered conversation is one value, so its messages meet in one task at the end. Before that, events are spread by message, and one row of numbers
for each message is ordered within its conversation.

Cases: null text or role is empty. A null conv_id is a conversation of its own. Turns are ordered with null first, then by role and text; repeated rows of a table
are repeated messages. Empty tables give no rows. Other columns are not read. Turn numbers from a table are between -2^42 and 2^42.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Roles whose texts are trained on.
TRAINED = ("assistant",)
#: Streamed texts come in pieces of this many characters, or in PIECES if that makes them longer.
PIECE = 200
PIECES = 64
#: Each turn of a table has this many sequence numbers to itself.
TURN_BITS = 20
#: A place before all others, for turns without a number.
FIRST = -(1 << 42)

LOG_COLUMNS = ["conv_id", "message", "turn", "seq", "kind", "role", "text"]
END = "</turn>\n"


def as_log(conversations: DataFrame) -> DataFrame:
    """The log that leaves the rows of a table (conv_id, turn, role, text) behind: what a chat service would have seen.

    By hash, a message comes whole, streamed, edited after a draft, or regenerated after an attempt that had already been answered. The hash also says
    which of its events were delivered twice.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    # Equal rows are told apart by a number, which needs no order.
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    named = counted.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.xxhash64("turn", "role", "text", "copy").alias("h"),
        F.expr("concat_ws('-', hex(xxhash64(turn, role, text)), sha2(concat(role, char(10), text), 256), copy)").alias("message"),
        F.expr(f"shiftleft(coalesce(turn, {FIRST}L), {TURN_BITS})").alias("start"),
        F.expr(f"greatest({PIECE}, ceil(length(text) / {PIECES}))").cast("int").alias("size"),
    )
    shown = named.select(
        "*",
        F.expr("if(text = '', array(), transform(sequence(0, cast((length(text) - 1) div size as int)), i -> substr(text, i * size + 1, size)))").alias("pieces"),
        F.expr("pmod(h, 4)").alias("how"),
    )

    def event(message: str, turn: str, place: str, kind: str, role: str, text: str) -> str:
        return f"struct({message} as message, {turn} as turn, start + {place} as seq, {kind} as kind, {role} as role, {text} as text)"

    def happens(place: str, kind: str, text: str) -> str:
        return event("message", "turn", place, f"'{kind}'", "if('" + kind + "' = 'open', role, null)", text)

    streamed = "transform(pieces, (piece, i) -> " + happens("(i + 8)", "delta", "piece") + ")"
    draft = "concat('(draft) ', reverse(left(text, 100)))"
    stray = event("concat(message, '-reply')", f"coalesce(turn, {FIRST}L) + 1", "3", "'open'", "'user'", "'Try again.'")
    log = f"""flatten(array(CASE how
        WHEN 0 THEN array({happens("0", "open", "text")})
        WHEN 1 THEN array({happens("0", "open", "''")})
        WHEN 2 THEN array({happens("0", "open", "''")}, {happens("1", "delta", draft)}, {happens("2", "edit", "''")})
        ELSE array({happens("0", "open", "''")}, {happens("1", "delta", draft)}, {happens("2", "delta", draft)}, {stray}, {happens("4", "regenerate", "''")})
      END, if(how = 0, array(), {streamed})))"""
    twice = "inline(flatten(transform(events, e -> if(pmod(h, 5) = 0, array(e, e), array(e)))))"
    return shown.selectExpr("conv_id", "h", f"{log} AS events").selectExpr("conv_id", twice).select(*LOG_COLUMNS)


def fold(log: DataFrame) -> DataFrame:
    """The final messages of a log: conv_id, turn, message, role, text."""
    log = log.select(*LOG_COLUMNS)
    is_open, place = F.col("kind") == "open", F.coalesce("turn", F.lit(FIRST))
    stated = log.groupBy("conv_id", "message").agg(
        F.max(F.when(F.col("kind").isin("open", "edit", "regenerate"), F.col("seq"))).alias("since"),
        F.max(F.when(is_open, F.col("seq"))).alias("opened"),
        F.max_by(F.when(is_open, place), F.when(is_open, F.col("seq"))).alias("place"),
        F.max_by(F.when(is_open, F.col("role")), F.when(is_open, F.col("seq"))).alias("role"),
        F.max_by(F.when(is_open, F.col("turn")), F.when(is_open, F.col("seq"))).alias("turn"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
    )
    # One row per message, whatever was said in it.
    stated = stated.where("opened is not null").withColumn(
        "dropped", F.expr("max(again) over (partition by conv_id order by place range between unbounded preceding and 1 preceding)")
    )
    alive = stated.where("dropped is null or opened > dropped").select(
        F.col("conv_id").alias("c"), F.col("message").alias("m"), "since", "turn", F.coalesce("role", F.lit("")).alias("role")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("message") == F.col("m")) & (F.col("seq") >= F.col("since"))
    said = log.select("conv_id", "message", "seq", F.coalesce("text", F.lit("")).alias("text")).join(alive, same)
    return (
        said.groupBy("conv_id", "message")
        .agg(F.first("turn").alias("turn"), F.first("role").alias("role"), F.sort_array(F.collect_set(F.struct("seq", "text"))).alias("parts"))
        .select("conv_id", "turn", "message", "role", F.array_join(F.col("parts.text"), "").alias("text"))
    )


def escaped(text: Column | str) -> Column:
    return F.regexp_replace(text, r"(</?\\*)(turn)", r"$1\\$2")


def unescaped(text: Column | str) -> Column:
    return F.regexp_replace(text, r"(</?\\*)\\(turn)", "$1$2")


def render(messages: DataFrame, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per conversation: conv_id and segments, an array of (text, loss); joined, the texts are the formatted conversation."""
    mark = F.concat(F.lit("<turn "), F.url_encode("role"), F.lit(">"))
    piece = F.struct(
        F.col("turn").isNotNull().alias("numbered"), "turn", "role", "text", "message",
        F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped("text").alias("text"), F.col("role").isin(*trained).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        ).alias("segments"),
    )
    gathered = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return gathered.select("conv_id", F.flatten(F.col("pieces.segments")).alias("segments"))


def formatted(segments: str = "segments") -> Column:
    return F.array_join(F.col(f"{segments}.text"), "")


def read_turns(text: Column | str) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    pieces = F.split(text, END)
    said = F.filter(pieces, lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, ">")
        role = F.url_decode(F.substr(piece, F.lit(7), cut - 7))
        return F.struct(role.alias("role"), unescaped(F.substr(piece, cut + 1)).alias("text"))

    return F.transform(said, turn)


def read_loss(segments: str = "segments") -> Column:
    """All text that counts towards the loss, as it was said."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


#: A conversation whose texts look like marks of many templates.
PLANTED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def with_planted(conversations: DataFrame) -> DataFrame:
    planted = conversations.sparkSession.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(planted)


def digest(conversations: DataFrame) -> DataFrame:
    """Conversations as their logs tell them, rendered, and what is read back from that."""
    shown = render(fold(as_log(with_planted(conversations))))
    read = shown.select("conv_id", formatted().alias("whole"), read_loss().alias("loss")).select(
        "conv_id", "loss", F.length("whole").cast("long").alias("formatted_chars"), read_turns("whole").alias("turns")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<turn ') + length(replace(url_encode(role), '%20', '+')) + length('>') + length(regexp_replace(text, '(</?\\*)(turn)', '\1\\\2', 'g')) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
