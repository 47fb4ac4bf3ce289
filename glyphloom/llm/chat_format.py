"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "### " role ": " text " </turn>\\n"

Roles and texts are written as they are first.  The result is parsed again by splitting at the turn end
and at the first ": ", undoing the escape (a backslash stands for the character behind it).  Where
the recovered turns differ from the source, the conversation is written with one more escape:
level 1 escapes backslashes, ``###`` and ``</turn>``; level 2 escapes every mark that the grammar uses.
The first level that gives the source back is kept; level 2 always does.  Everything a caller gets (turns, loss
mask, lengths, digests) is read back from the formatted text: the loss text is cut out of it at the mask's spans.

Defined cases: a null text or role counts as empty; rows of a conversation are ordered by turn (null first),
then role, then text, so ties and repeated rows keep their place; a null conv_id is a conversation of
its own; an empty table gives no rows; extra columns are ignored.  A conversation is one row of the result
and has one digest, so its turns meet in one task; all other work is row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_END = "</turn>\n"
#: What formats add around a role and a text.
HEAD, COLON, CLOSE = "### ", ": ", " " + TURN_END
LOSS_ROLE = "assistant"


def _escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    if level == 1:
        return F.replace(F.replace(text, F.lit("###"), F.lit("\\#\\#\\#")), F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.regexp_replace(text, "([#:</>\n ])", r"\\$1")


def _unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def rendered(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(HEAD), _escape(role, level), F.lit(COLON), _escape(text, level), F.lit(CLOSE))


def written_turns(formatted: Column) -> Column:
    """The turns as they are written, without their ends."""
    return F.filter(F.split(formatted, r"\Q" + TURN_END + r"\E"), lambda p, i: p != "")


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text, written, role_length).

    ``written`` is the text as it stands there, ``role_length`` the length of the role as it stands."""
    parts = written_turns(formatted)

    def turn(part: Column) -> Column:
        colon = F.locate(COLON, part)
        role = F.substring(part, F.lit(len(HEAD) + 1), F.greatest(F.lit(0), colon - len(HEAD) - 1))
        written = F.substring(part, colon + len(COLON), F.greatest(F.lit(0), F.length(part) - colon - len(COLON)))
        return F.struct(_unescape(role).alias("role"), _unescape(written).alias("text"), written.alias("written"), (colon - len(HEAD) - 1).alias("role_length"))

    return F.transform(parts, turn)


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, formatted, turns (read back), escape_level, round_trip (always true)."""
    clean = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    turns = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("turn"), "role", "text"))).alias("_source"))

    def written(level: int) -> Column:
        return F.array_join(F.transform("_source", lambda t: rendered(t["role"], t["text"], level)), "")

    def same(turns: Column) -> Column:
        pair = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        return F.transform(turns, pair) == F.transform("_source", pair)

    step = turns.withColumn("_formatted", written(0)).withColumn("_turns", parsed(F.col("_formatted"))).withColumn("_level", F.lit(0))
    for level in (1, 2):
        ok = same(F.col("_turns"))
        step = step.withColumn("_ok", ok)
        step = step.withColumn("_formatted", F.when(F.col("_ok"), F.col("_formatted")).otherwise(written(level)))
        step = step.withColumn("_level", F.when(F.col("_ok"), F.col("_level")).otherwise(F.lit(level)))
        step = step.withColumn("_turns", F.when(F.col("_ok"), F.col("_turns")).otherwise(parsed(F.col("_formatted"))))
    return step.select("conv_id", F.col("_formatted").alias("formatted"), F.col("_turns").alias("turns"), F.col("_level").alias("escape_level"), same(F.col("_turns")).alias("round_trip"))


def _place_in_turn(t: Column) -> tuple[Column, Column]:
    """Where a turn's text begins in the written turn, and how long it is there."""
    return t["role_length"] + len(HEAD) + len(COLON), F.length(t["written"])


def loss_spans(turns: Column) -> Column:
    """The loss mask: code-point spans [begin, end) of the assistant texts in the formatted conversation, still escaped."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<begin:bigint,end:bigint>>)").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin, size = _place_in_turn(t)
        begin = (acc["at"] + begin).cast("long")
        span = F.array(F.struct(begin.alias("begin"), (begin + size).cast("long").alias("end")))
        spans = F.when(t["role"] == LOSS_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((begin + size + len(CLOSE)).cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, empty, step, lambda acc: acc["spans"])


def masked_conversations(rows: DataFrame) -> DataFrame:
    """What training reads: conv_id, formatted, and loss_mask, the spans [begin, end) of ``formatted`` that bear loss."""
    formatted = format_conversations(rows)
    return formatted.select("conv_id", "formatted", loss_spans(F.col("turns")).alias("loss_mask"))


def under_mask(formatted: Column, turns: Column) -> Column:
    """The text that stands under the loss mask, unescaped, with nothing between the spans.

    Each span is cut out of its written turn: code points are counted from the start of a string, so cutting
    every span out of the whole would take the square of a long conversation.
    """

    def cut(part: Column, t: Column) -> Column:
        begin, size = _place_in_turn(t)
        return F.when(t["role"] == LOSS_ROLE, _unescape(F.substring(part, (begin + 1).cast("int"), size)))

    return F.array_join(F.zip_with(written_turns(formatted), turns, cut), "")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text gives back, as counts and digests; the loss text is what stands under the mask."""
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = formatted.withColumn("_loss", under_mask(F.col("formatted"), F.col("turns")))
    return masked.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escape_level",
        "round_trip",
    )
