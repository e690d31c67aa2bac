r"""Chat formatting in Spark expressions only: sorted turn structs, adjacent turns of one role merged, one template string.

    <s>[INST][ROLE]system[/ROLE]rules[/INST][INST]question[/INST]answer</s>

A block holds the adjacent turns of one role, their texts parted by [TURN]. A block of the learned role (assistant) is its texts and </s>; any
other block stands in [INST] ... [/INST], with its role in [ROLE] ... [/ROLE] unless that is user. Control strings inside texts and roles get a
backslash after their bracket (``<\s>``, ``[\INST]``), one more if they have some already, so that no text holds a control string and each text can
be had back. A formatted conversation is a list of segments (text, loss): their texts joined are the training string, and
those with loss are what is learned, each text of the learned role alone.

A conversation is one row of the result, so it meets in one task: memory goes with the longest conversation, not with the table.

Cases: a null text is empty and a null role is the empty role, which is read back as the empty string; turns are in order of their number, null
first, ties by role and text; repeated rows stay repeated turns; a null conversation id is a conversation of its own; an empty table gives an empty
result; texts may have any length, and other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
BEGIN, END = "<s>", "</s>"
ASK, ASKED = "[INST]", "[/INST]"
ROLE, ROLED = "[ROLE]", "[/ROLE]"
NEXT = "[TURN]"

LEARNED, PLAIN = "assistant", "user"
_REST = r"/?s>|/?INST\]|/?ROLE\]|TURN\]"


def escaped(text: Column) -> Column:
    """The text without control strings."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", "$1$2$3")


def blocks(turns: Column) -> Column:
    """Sorted turns as array<struct<role, texts>>: a block begins where the role differs from that of the turn before."""
    starts = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))

    def block(start, k):
        end = F.coalesce(F.get(starts, k + 1), F.size(turns))
        own = F.slice(turns, start + 1, end - start)
        return F.struct(F.get(turns, start)["role"].alias("role"), F.transform(own, lambda t: t["text"]).alias("texts"))

    return F.transform(starts, block)


def segments(block: Column) -> Column:
    """A block as array<struct<text, loss>>."""
    learned = block["role"] == LEARNED

    def one(text, k):
        mark = F.when(k > 0, F.lit(NEXT)).otherwise(F.lit(""))
        return F.array(F.struct(mark.alias("text"), F.lit(False).alias("loss")), F.struct(escaped(text).alias("text"), learned.alias("loss")))

    role = F.when(block["role"] == PLAIN, "").otherwise(F.concat(F.lit(ROLE), escaped(block["role"]), F.lit(ROLED)))
    head = F.struct(F.when(learned, "").otherwise(F.concat(F.lit(ASK), role)).alias("text"), F.lit(False).alias("loss"))
    tail = F.struct(F.when(learned, END).otherwise(ASKED).alias("text"), F.lit(False).alias("loss"))
    return F.concat(F.array(head), F.flatten(F.transform(block["texts"], one)), F.array(tail))


def formatted(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Row per conversation: conv_id, segments array<struct<text, loss>>, formatted (their texts joined)."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = rows.select("conv_id", blocks(F.col("turns")).alias("blocks"))
    begin = F.struct(F.lit(BEGIN).alias("text"), F.lit(False).alias("loss"))
    rows = rows.select("conv_id", F.concat(F.array(begin), F.flatten(F.transform("blocks", segments))).alias("segments"))
    rows = rows.withColumn("segments", F.filter("segments", lambda s: (s["text"] != "") | s["loss"]))
    return rows.withColumn("formatted", joined(F.col("segments")))


def joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def turns_read(text: Column) -> Column:
    """A formatted string read back as array<struct<role, text>>."""
    body = F.substring(text, F.lit(len(BEGIN) + 1), F.length(text))
    pieces = F.filter(F.split(body, r"(?<=</s>)|(?<=\[/INST\])"), lambda p: p != "")

    def parsed(piece):
        asked = piece.startswith(ASK)
        inner = F.substring(piece, F.when(asked, len(ASK) + 1).otherwise(1), F.length(piece) - F.when(asked, len(ASK) + len(ASKED)).otherwise(len(END)))
        named = asked & inner.startswith(ROLE)
        role_end = F.instr(inner, ROLED)
        role = F.when(~asked, LEARNED).when(named, unescaped(F.substring(inner, F.lit(len(ROLE) + 1), role_end - len(ROLE) - 1))).otherwise(PLAIN)
        texts = F.when(named, F.substring(inner, role_end + len(ROLED), F.length(inner))).otherwise(inner)
        return F.transform(F.split(texts, r"\[TURN\]"), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(pieces, parsed))


def learned_read(parts: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(parts, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def digests(rows: DataFrame) -> DataFrame:
    """What formatted() made, read back: n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars by conv_id."""
    rows = rows.select("conv_id", turns_read(F.col("formatted")).alias("turns"), learned_read(F.col("segments")).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
