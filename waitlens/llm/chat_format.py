"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes one training example: all preceding turns are context and only
that reply is trainable. A turn is written

    [TURN]role[/TURN]text</s>

and the loss span covers the (escaped) reply without its end mark. A conversation that does not
end with an assistant turn gets one more row, ``trainable = false`` with an empty span, so that
its trailing turns are not lost.

Escaping: inside roles and texts one backslash is put after the opening bracket of every control
string (those of this template and the well-known ones below), and of every control string that
already has backslashes there. Removing one backslash at the same places is the exact inverse, so
texts holding control strings, escaped ones included, come back unchanged.

Defined cases: null role or text is empty; rows of equal turn number are ordered by role, then
text, and repeated rows are repeated turns; a null turn number comes first; rows with a null
conv_id form one conversation; an empty table gives no rows. A conversation is one training
document, so its turns meet in one row; conversations are never joined with one another, hence
equal conversations or first turns cost nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, ROLE_END, END = "[TURN]", "[/TURN]", "</s>"
#: fixed values: what may follow the opening bracket of a control string
CONTROL = r"(?:/?s>|/?TURN\]|/?INST\]|/?SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)"
ESCAPE_PATTERN = r"([<\[])(\\*" + CONTROL + ")"
UNESCAPE_PATTERN = r"([<\[])\\(\\*" + CONTROL + ")"


def escape(col: Column) -> Column:
    return F.regexp_replace(col, ESCAPE_PATTERN, r"$1\\$2")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, UNESCAPE_PATTERN, "$1$2")


def expand(conversations: DataFrame, *, target_role: str = "assistant") -> DataFrame:
    """Examples of ``conversations`` (conv_id, turn, role, text): conv_id, example (1-based
    position of the last turn shown), formatted, loss_start, loss_end (code points, end
    exclusive), trainable."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = F.transform("turns", lambda t: F.struct(
        (t["role"] == target_role).alias("target"), escape(t["text"]).alias("text"),
        F.concat(F.lit(OPEN), escape(t["role"]), F.lit(ROLE_END), escape(t["text"]), F.lit(END)).alias("line")))
    whole = whole.select("conv_id", written.alias("written"))
    last = F.size("written")
    shown = F.filter(F.sequence(F.lit(1), last), lambda k: F.element_at("written", k)["target"] | (k == last))
    rows = whole.select("conv_id", "written", F.explode(shown).alias("example"))
    rows = rows.select(
        "conv_id", "example",
        F.array_join(F.transform(F.slice("written", F.lit(1), F.col("example")), lambda t: t["line"]), "").alias("formatted"),
        F.element_at("written", F.col("example"))["target"].alias("trainable"),
        F.char_length(F.element_at("written", F.col("example"))["text"]).alias("reply_chars"))
    end = F.char_length("formatted") - F.lit(len(END))
    stop = F.when(F.col("trainable"), end).otherwise(F.char_length("formatted"))
    start = F.when(F.col("trainable"), end - F.col("reply_chars")).otherwise(F.char_length("formatted"))
    return rows.select("conv_id", "example", "formatted", start.alias("loss_start"), stop.alias("loss_end"), "trainable")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the written examples alone: turns (array of role, text), loss_text
    (the trainable replies in order, unescaped) and formatted_chars (of all its examples)."""
    masked = F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    per_conv = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", unescape(masked).alias("text")))).alias("losses"),
        F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"))
    lines = F.split("whole", END)
    lines = F.slice(lines, F.lit(1), F.size(lines) - 1)  # a turn ends with the mark; nothing follows the last one
    turns = F.transform(lines, lambda line: F.struct(
        unescape(F.substring_index(F.substring(line, len(OPEN) + 1, 2_000_000_000), ROLE_END, 1)).alias("role"),
        unescape(F.substring_index(line, ROLE_END, -1)).alias("text")))
    return per_conv.select("conv_id", turns.alias("turns"), "formatted_chars",
                           F.array_join(F.transform("losses", lambda x: x["text"]), "").alias("loss_text"))
