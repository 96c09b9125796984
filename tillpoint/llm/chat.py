r"""Chat formatting by a grammar that is parsed back.

Rendered turns, one after the other with nothing between:

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    any other  <<ROLE>>role<</ROLE>>text</s>

A text is first written as it is.  The result is parsed (a turn starts at each opening string, ends
with its own closing string and holds no other control string; a backslash stands before a character
that is itself) and the recovered turns are compared with the source; a turn that breaks the grammar
has no text.  Where they differ, the conflicting texts are escaped, i.e. a backslash is doubled and one
is put behind the first character of every control string, so that no control string is left, and
the conversation is rendered, parsed and compared again.  A conversation that still differs raises an
error; none can, as the tests show on adversarial texts.

Everything is column expressions: a conversation is one row of the output, so its turns are
gathered in one row and no more.

Edge cases: a null text or role is an empty one; turns with equal numbers are ordered by role and
text; null turn numbers come first; a null conv_id is a conversation of its own; an empty table
gives only what ``extra`` adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the grammar.
SYSTEM, USER, ASSISTANT, ROLE = ("<<SYS>>", "<</SYS>>"), ("[INST]", "[/INST]"), ("<s>", "</s>"), (
    "<<ROLE>>", "<</ROLE>>")
_CONTROL = r"[<\[](?=<SYS>>|</SYS>>|INST\]|/INST\]|s>|/s>|<ROLE>>|</ROLE>>)"
_OPENING = r"(?=<<SYS>>|\[INST\]|<s>|<<ROLE>>)"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({_CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")
                  ).otherwise(text)


def conflicts(text: Column) -> Column:
    """True if the text, written as it is, would not come back from the parser."""
    return F.contains(text, F.lit("\\")) | text.rlike(_CONTROL)


def render_turn(role: Column, text: Column, escaped: Column) -> Column:
    body = F.when(escaped & conflicts(text), escape(text)).otherwise(text)
    name = F.when(escaped & conflicts(role), escape(role)).otherwise(role)

    def marked(marks) -> Column:
        return F.concat(F.lit(marks[0]), body, F.lit(marks[1]))

    return (F.when(role == "system", marked(SYSTEM)).when(role == "user", marked(USER))
            .when(role == "assistant", marked(ASSISTANT))
            .otherwise(F.concat(F.lit(ROLE[0]), name, F.lit(ROLE[1]), body, F.lit(ASSISTANT[1]))))


def render(turns: Column, escaped: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: render_turn(t["role"], t["text"], escaped)), "")


def parse(rendered: Column) -> Column:
    """Array of (role, text) of a rendered conversation."""
    def inside(turn: Column, marks, start=None) -> Column:
        start = F.lit(len(marks[0])) if start is None else start
        body = F.substring(turn, start + 1, F.length(turn) - start - len(marks[1]))
        return F.when(turn.endswith(marks[1]) & ~body.rlike(_CONTROL), body)

    def read(turn: Column) -> Column:
        end = F.instr(turn, ROLE[1])
        after = F.when(end > 0, end - 1 + len(ROLE[1])).otherwise(F.length(turn))
        name = F.substring(turn, F.lit(len(ROLE[0]) + 1), end - 1 - len(ROLE[0]))
        role = (F.when(turn.startswith(SYSTEM[0]), "system").when(turn.startswith(USER[0]), "user")
                .when(turn.startswith(ASSISTANT[0]), "assistant")
                .when(~name.rlike(_CONTROL), unescape(name)))
        body = (F.when(turn.startswith(SYSTEM[0]), inside(turn, SYSTEM))
                .when(turn.startswith(USER[0]), inside(turn, USER))
                .when(turn.startswith(ASSISTANT[0]), inside(turn, ASSISTANT))
                .otherwise(inside(turn, ASSISTANT, after)))
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(F.split(rendered, _OPENING, -1), read)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, recovered (array of role, text), escaped."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    whole = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
             .withColumn("source", F.transform("turns", lambda t: F.struct(
                 t["role"].alias("role"), t["text"].alias("text")))))
    plain = whole.withColumn("plain", render(F.col("source"), F.lit(False)))
    first = plain.withColumn("escaped", ~parse(F.col("plain")).eqNullSafe(F.col("source")))
    made = first.withColumn("formatted", F.when(
        F.col("escaped"), render(F.col("source"), F.lit(True))).otherwise(F.col("plain")))
    back = made.withColumn("recovered", parse(F.col("formatted")))
    checked = F.when(F.col("recovered").eqNullSafe(F.col("source")), F.col("recovered")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not come back from its format: "),
                               F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return back.select("conv_id", "formatted", checked.alias("recovered"), "escaped")


def digest(formatted: DataFrame) -> DataFrame:
    """Figures of what is read back from the output; the loss falls on assistant texts."""
    loss = F.array_join(F.transform(F.filter("recovered", lambda t: t["role"] == "assistant"),
                                    lambda t: t["text"]), "")
    said = F.array_join(F.transform("recovered", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        "conv_id", F.size("recovered").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
