"""Chat formatting (10): typed content parts flattened into a template, in DataFrame operations only.

A turn's content is text or an array of typed parts. Visiting the parts in order, text is escaped and put in
line, and an image, audio or document part leaves a placeholder; its reference goes to the conversation's
attachments with the place it stands at and the tokens it expands to. The template is

    <|role|> role <|text|> content <|end|> newline      (without the blanks)

In text and roles `&`, `<` and `[` are escaped, so no control string of this or other common templates can
appear in them, and unescaping gives back every character. The loss mask is kept as run lengths, a run for each
turn: characters to skip, to take, and to skip after; only what assistants say is taken.

A conversation is one output row, so its turns meet in one task and must fit there; rows of different conversations spread by id.

Defined cases: a null text is empty, a null role is empty and never under the loss; turns sort by turn (null
first), then role and content; repeated rows are turns of their own; a null conv_id is a conversation; an
unknown or null part type is skipped; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))


@dataclass(frozen=True)
class Params:
    loss_role: str = "assistant"
    #: Tokens that an attachment expands to: fixed, plus so many for each unit (tile, second, page) of the part.
    fixed: dict = field(default_factory=lambda: {"image": 85, "audio": 0, "document": 2})
    for_each: dict = field(default_factory=lambda: {"image": 170, "audio": 25, "document": 500})


def escaped(c: Column) -> Column:
    for plain, safe in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescaped(c: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(plain))
    return c


def text_part(text: Column) -> Column:
    """Content of one typed part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def _visit(parts: Column, p: Params) -> tuple[Column, Column]:
    """(content, attachments) of an array of struct<type, text, ref, units>."""
    known = F.filter(parts, lambda x: x["type"].isin("text", *p.fixed))
    content = F.array_join(F.transform(known, lambda x: F.when(x["type"] == "text", escaped(F.coalesce(x["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), x["type"], F.lit("|>")))), "")

    def tokens(x: Column) -> Column:
        out = F.lit(0)
        for kind, base in p.fixed.items():
            out = F.when(x["type"] == kind, F.lit(base) + F.lit(p.for_each[kind]) * F.coalesce(x["units"], F.lit(1))).otherwise(out)
        return out.cast("long")

    placed = F.filter(known, lambda x: x["type"] != "text")
    return content, F.transform(placed, lambda x, i: F.struct(i.alias("place"), x["type"].alias("type"), x["ref"].alias("ref"), tokens(x).alias("tokens")))


def format_chat(messages: DataFrame, p: Params = Params()) -> DataFrame:
    """(conv_id, formatted, loss_runs, attachments, expanded_tokens) of each conversation.

    messages has conv_id, turn, role and an array `parts` of struct<type, text, ref, units>, or text in its place, which
    is visited as one part of type text.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    content, found = _visit(F.col("parts") if "parts" in messages.columns else text_part(F.col("text")), p)
    content, found = F.coalesce(content, F.lit("")), F.coalesce(found, F.array())
    turns = messages.select("conv_id", F.struct("turn", role.alias("role"), content.alias("content"), found.alias("found")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    line = lambda t: F.concat(F.lit(ROLE), escaped(t["role"]), F.lit(TEXT), t["content"], F.lit(END))
    heard = lambda t: F.when(t["role"] == p.loss_role, F.length(t["content"])).otherwise(0)
    head = lambda t: F.length(escaped(t["role"])) + len(ROLE) + len(TEXT)
    runs = F.transform("turns", lambda t: F.struct(head(t).alias("skip"), heard(t).alias("take"), (F.length(t["content"]) - heard(t) + len(END)).alias("rest")))
    attachments = F.flatten(F.transform("turns", lambda t, i: F.transform(t["found"], lambda x: F.struct(i.alias("turn"), x["place"].alias("place"), x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens")))))
    out = grouped.select("conv_id", F.array_join(F.transform("turns", line), "").alias("formatted"), runs.alias("loss_runs"), attachments.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>, loss_text, formatted_chars) parsed from format_chat's output."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda x: x != "")
    d = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "loss_runs", pieces.alias("pieces"))
    body = lambda x: F.substring_index(x, TEXT, -1)  # noqa: E731  no text holds a control string
    name = lambda x: F.replace(F.substring_index(x, TEXT, 1), F.lit(ROLE), F.lit(""))
    turns = F.transform("pieces", lambda x: F.struct(unescaped(name(x)).alias("role"), unescaped(body(x)).alias("text")))
    heard = F.zip_with("pieces", "loss_runs", lambda x, r: unescaped(F.substr(x, r["skip"] + 1, r["take"])))
    return d.select("conv_id", turns.alias("turns"), F.array_join(heard, "").alias("loss_text"), "formatted_chars")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant who both say control strings."""
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))


def op10_chat(conversations: DataFrame, p: Params = Params()) -> DataFrame:
    """One row for each conversation and one for the probe, which stands apart even where the input has a conversation -7."""
    typed = lambda d: d.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", text_part(F.col("text")).alias("parts"))
    back = read_back(format_chat(typed(conversations), p).unionByName(format_chat(typed(probe(conversations.sparkSession)), p)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
with m as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, 0 as probe from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]', 1 union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]', 1),
e as (select *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') as safe, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') as safe_role from m)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, safe)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, safe) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(safe_role) + length(safe) + 24)::bigint as formatted_chars
from e group by conv_id, probe
"""
