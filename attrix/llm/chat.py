"""Operator 1: chat formatting with a checked grammar round trip.

A conversation is rendered as one text by the template

    turn := <|im_start|> role LF text <|im_end|> LF

and parsed again by a deterministic parser: split at the start marks, cut the
role at the first line end and the text at the end mark, undo the escapes. The
recovered turns are compared with the source. Conversations that do not come
back identical (their content holds marks, escapes or a line end in a role) are
rendered again with that content escaped:

* in texts and roles, ``<`` followed by backslashes and ``|`` gets one backslash
  more, so no mark can appear inside a turn; the parser takes one away;
* in roles a backslash becomes ``\\b`` and a line end ``\\n``.

After escaping, the round trip is checked again and a conversation that still
differs is an error. Everything is DataFrame functions.

The text under the loss mask is that of the assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_MARK_IN = r"<(\\*)\|"
_MARK_OUT = r"<\\(\\*)\|"


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, _MARK_IN, r"<\\$1|")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, _MARK_OUT, r"<$1|")


def escape_role(c: Column) -> Column:
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    return escape_text(plain)


def unescape_role(c: Column) -> Column:
    plain = F.replace(unescape_text(c), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def render(turns: Column, escaped: bool) -> Column:
    """The formatted text of an array of (role, text)."""
    def turn(t: Column) -> Column:
        role = escape_role(t["role"]) if escaped else t["role"]
        text = escape_text(t["text"]) if escaped else t["text"]
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))
    return F.array_join(F.transform(turns, turn), "")


def _parts(formatted: Column) -> Column:
    """What follows each start mark. A turn starts with one, so nothing comes before the first."""
    parts = F.split(formatted, r"<\|im_start\|>")
    return F.slice(parts, F.lit(2), F.size(parts) - 1)


def parse(formatted: Column) -> Column:
    """The array of (role, text) that a formatted text stands for."""
    parts = _parts(formatted)

    def turn(p: Column) -> Column:
        at = F.position(F.lit("\n"), p)
        body = F.substr(p, at + F.lit(1))
        return F.struct(unescape_role(F.substr(p, F.lit(1), at - F.lit(1))).alias("role"),
                        unescape_text(F.substring_index(body, END, 1)).alias("text"))
    return F.transform(parts, turn)


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(id, formatted, turns): per conversation the text and the turns parsed from it.

    Rows go by turn; rows of one turn by role, then text; a null turn comes
    first. Null text and null role are empty; repeated rows are turns of their
    own; rows with a null id are one conversation. An empty table gives an empty
    result; other columns are ignored. A conversation is one row of the result,
    so it has to fit into one string.
    """
    source = F.transform(F.array_sort(F.collect_list(F.struct("t", "role", "text"))),
                         lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    by_conv = (rows.select(F.col(id_col).alias("id"), F.struct(F.col(turn_col).isNotNull(), F.coalesce(
        F.col(turn_col).cast("long"), F.lit(0))).alias("t"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .groupBy("id").agg(source.alias("source")))
    plain = by_conv.withColumn("formatted", render(F.col("source"), False))
    first = plain.withColumn("same", parse(F.col("formatted")) == F.col("source"))
    again = first.withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(render(F.col("source"), True)))
    parsed = again.withColumn("turns", parse(F.col("formatted")))
    checked = F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not survive its round trip: "), F.col("id").cast("string"))))
    return parsed.select(F.col("id").alias(id_col), "formatted", checked.alias("turns"))


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant texts in order."""
    said = F.filter(turns, lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(said, lambda t: t["text"]), "")


def loss_spans(formatted: Column) -> Column:
    """The loss mask on the formatted text: (start, length) of each assistant text as rendered."""
    def add(acc: Column, p: Column) -> Column:
        at = F.position(F.lit("\n"), p)
        body = F.substring_index(F.substr(p, at + F.lit(1)), END, 1)
        start = acc["at"] + F.lit(len(START))
        here = F.array(F.struct((start + at).cast("long").alias("start"), F.length(body).cast("long").alias("length")))
        said = unescape_role(F.substr(p, F.lit(1), at - F.lit(1))) == "assistant"
        return F.struct((start + F.length(p)).alias("at"),
                        F.when(said, F.concat(acc["spans"], here)).otherwise(acc["spans"]).alias("spans"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return F.aggregate(_parts(formatted), empty, add)["spans"]


def conversation_digests(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the parsed output."""
    f = format_conversations(rows)
    whole = F.array_join(F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("turns"))
    return f.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                    F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))
