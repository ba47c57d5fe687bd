"""Chat formatting in Spark expressions.

A conversation's turns are collected as structs, sorted, merged where the
role repeats, and joined to one string:

    ### user: first text<and>second text</turn>
    ### assistant: text</turn>

Inside roles and texts the three signs of the control strings are escaped
(``\\`` as ``\\b``, ``<`` as ``\\l``, ``#`` as ``\\h``, and in roles ``:`` as
``\\c`` and a line feed as ``\\n``), so control strings occur in the output
only where the template puts them, and unescaping gives the input back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import let, running_sums

OPEN, COLON, AND, CLOSE = "### ", ": ", "<and>", "</turn>\n"
# Escapes, the escape sign first.
TEXT_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n"))


def escape(c: Column, escapes=TEXT_ESCAPES) -> Column:
    for raw, code in escapes:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column, escapes=TEXT_ESCAPES) -> Column:
    for raw, code in reversed(escapes):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conv_id: conv_id, formatted, loss_spans
    (array<struct<start, end, part>>, code points of ``formatted``, end
    exclusive, one span for each text of ``loss_role``, in order; ``part`` is
    the number of the text among all texts of the conversation).

    Rows are sorted by turn; equal turns by role, then text; a null turn
    comes last.  A null text or role is empty.  A null conv_id is a
    conversation of its own.  Repeated rows are turns of their own.  Extra
    columns are ignored; an empty table gives no rows.  Adjacent turns of
    one role become one block whose texts stay apart by a control string.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    sorted_turns = F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNull().alias("z"), F.col("turn").alias("t"), role.alias("role"), text.alias("text"))))
    chats = turns.groupBy("conv_id").agg(sorted_turns.alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        merged = (i > 0) & (F.get(F.col("turns"), i - 1)["role"] == t["role"])
        head = F.concat(F.when(i > 0, F.lit(CLOSE)).otherwise(F.lit("")), F.lit(OPEN),
                        escape(t["role"], ROLE_ESCAPES), F.lit(COLON))
        return F.struct(F.when(merged, F.lit(AND)).otherwise(head).alias("lead"),
                        escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))
    pieces = chats.withColumn("pieces", F.transform("turns", piece)).drop("turns")
    flat = F.concat(F.array_join(F.transform(
        "pieces", lambda p: F.concat(p["lead"], p["body"])), ""), F.lit(CLOSE))
    sizes = F.transform("pieces", lambda p: (F.length(p["lead"]) + F.length(p["body"])).cast("long"))
    placed = pieces.withColumn("sizes", sizes).withColumn("before", running_sums(F.col("sizes")))
    spans = F.transform("pieces", lambda p, i: F.struct(
        (F.get(F.col("before"), i) + F.length(p["lead"])).alias("start"),
        (F.get(F.col("before"), i) + F.get(F.col("sizes"), i)).alias("end"), i.alias("part"), p["loss"].alias("loss")))
    return placed.select("conv_id", flat.alias("formatted"), F.transform(
        F.filter(spans, lambda s: s["loss"]),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                           s["part"].alias("part"))).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted string holds."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = unescape(F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), COLON, 1), ROLE_ESCAPES)
        texts = F.split(F.substr(block, F.locate(COLON, block) + len(COLON)), AND)
        return let(F.struct(role.alias("role"), texts.alias("texts")), lambda b: F.transform(
            b["texts"], lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"))))
    return F.flatten(F.transform(blocks, turns))


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped.  The string is cut at its
    control strings once; a span is the end of its part, so the work is
    linear in the string's length."""
    return let(F.split(formatted, f"{CLOSE}|{AND}"), lambda parts: F.array_join(F.transform(
        spans, lambda s: unescape(F.right(F.get(parts, s["part"]), (s["end"] - s["start"]).cast("int")))), ""))
