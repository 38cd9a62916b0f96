r"""Chat formatting by a finite-state machine over roles and a declarative template; DataFrame functions only.

A template names, for each role, the marks before and after its text and whether the text counts for the loss, and which
roles may follow which. The machine's state is the role before (or the start); from the first turn that may not follow
on it is in error, and every segment from there on is marked so. Control
strings inside texts are broken by a backslash after their first character, and backslashes are doubled, so no text can
contain a mark and the original comes back exactly. `read_back` restores the turns from the formatted string alone and
the loss text from the segments' offsets.

Defined results: a null text is empty; a null role reads back as an empty role; a role the template does not name is
written with its name (URL-encoded) in the mark, without loss. Rows of a null conversation id form one conversation. Turns sort by
(turn, role, text), null turns first; repeated rows are repeated turns. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """marks: role -> (before, after, counts for the loss). turns: state -> roles that may follow."""

    start: str = "<s>"
    marks: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n", False),
        "user": ("[INST] ", " [/INST]\n", False),
        "assistant": ("[ANS] ", " </s>\n", True),
    })
    other: tuple = ("[ROLE ", "] ", " [/ROLE]\n")
    turns: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple = ("assistant",)
    controls: str = r"(<)(/?s>|</?SYS>>)|(\[)(/?INST\]|ANS\]|/?ROLE)"


LLAMA_LIKE = Template()


def escape(text: Column, template: Template = LLAMA_LIKE) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    # Twice: a mark can begin with the last character that the first pass has consumed ("<<s>" holds "<s>").
    once = F.regexp_replace(doubled, template.controls, r"$1$3\\$2$4")
    return F.regexp_replace(once, template.controls, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def segments(rows: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """One row per turn: the marks, the escaped text and whether it counts for the loss. No shuffle."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    before = F.concat(F.lit(template.other[0]), F.url_encode(role), F.lit(template.other[1]))
    after, loss = F.lit(template.other[2]), F.lit(False)
    for name, (left, right, counts) in template.marks.items():
        before = F.when(role == name, F.lit(left)).otherwise(before)
        after = F.when(role == name, F.lit(right)).otherwise(after)
        loss = F.when(role == name, F.lit(counts)).otherwise(loss)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), before.alias("before"),
                       escape(text, template).alias("body"), after.alias("after"), loss.alias("loss"))


def _may_follow(state: Column, role: Column, template: Template) -> Column:
    """Whether the machine has a move from a state by a role; a role's name is the state after it."""
    out = F.lit(False)
    for s, nexts in template.turns.items():
        out = out | ((state == s) & role.isin(*nexts))
    return out


def _first_wrong(turns: Column, template: Template) -> Column:
    """Number (from 0) of the first turn the machine has no move for; null if all may follow."""
    state = lambda i: F.when(i == 0, F.lit("")).otherwise(F.get(turns, i - 1).role)
    moves = F.transform(turns, lambda x, i: _may_follow(state(i), x.role, template))
    at = F.array_position(moves, False)
    return F.when(at > 0, at - 1).cast("long")


def format_chat(rows: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """One row per conversation: formatted, segments (text, loss, state) in order, first_wrong_turn, turns_valid.

    state: the role the machine is in, or `error` from the first wrong turn on. turns_valid: it ends in a final state.

    rows: conv_id, turn, role, text. A conversation is one string, so its turns meet in one row by definition.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "before", "body", "after", "loss")))
    grouped = segments(rows, template).groupBy("conv_id").agg(turns.alias("t"))
    told = grouped.withColumn("first_wrong_turn", _first_wrong(F.col("t"), template))

    def piece(text, loss, state):
        return F.struct(text.alias("text"), loss.alias("loss"), state.alias("state"))

    def three(x, i):
        state = F.when(i >= F.col("first_wrong_turn"), F.lit("error")).otherwise(x.role)
        return F.array(piece(x.before, F.lit(False), state), piece(x.body, x.loss, state), piece(x.after, F.lit(False), state))

    start = F.array(piece(F.lit(template.start), F.lit(False), F.lit("")))
    pieces = F.concat(start, F.flatten(F.transform("t", three)))
    return told.select("conv_id", pieces.alias("segments"), "first_wrong_turn").withColumn(
        "turns_valid", F.element_at("segments", -1).state.isin(*template.final)).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s.text), ""))


def read_back(formatted: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """Turns (role, text) parsed from the formatted string alone, and loss_texts cut from it by the segments' lengths."""
    quote = lambda s: "\\Q" + s + "\\E"
    named = [quote(a) + ".*?" + quote(b) for a, b, _ in template.marks.values()]
    any_turn = "(?s)" + "|".join([*named, quote(template.other[0]) + ".*?" + quote(template.other[2])])
    body = F.substr("formatted", F.lit(len(template.start) + 1))
    left, mid, right = template.other

    def turn(x: Column) -> Column:
        inner = F.substr(x, F.lit(len(left) + 1), F.length(x) - len(left) - len(right))
        at = F.instr(inner, mid)
        role, text = F.url_decode(F.substr(inner, F.lit(1), at - 1)), F.substr(inner, at + len(mid))
        for name, (a, b, _) in template.marks.items():
            hit = x.startswith(F.lit(a))
            role = F.when(hit, F.lit(name)).otherwise(role)
            text = F.when(hit, F.substr(x, F.lit(len(a) + 1), F.length(x) - len(a) - len(b))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    spans = F.aggregate(
        "segments", F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc.at + F.length(s.text)).alias("at"),
            F.when(s.loss, F.concat(acc.spans, F.array(F.struct(acc.at.alias("start"), F.length(s.text).alias("length")))))
            .otherwise(acc.spans).alias("spans")),
        lambda acc: acc.spans)
    return (
        formatted.withColumn("loss_spans", spans)
        .withColumn("turns", F.transform(F.regexp_extract_all(body, F.lit(any_turn), F.lit(0)), turn))
        .withColumn("loss_texts", F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s.start, s.length))))
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
    + (length(regexp_replace(text, '</?s>|<</?SYS>>|\[/?INST\]|\[ANS\]|\[/?ROLE', chr(1) || '\0', 'g')) - length(text))
    + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 12 END AS n FROM c),
f AS (
  SELECT *, row_number() OVER w - 1 AS place, (coalesce(lag(role) OVER w, '') || '>' || role) IN
    ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS fits
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(n))::BIGINT AS formatted_chars,
  min(place) FILTER (NOT fits) AS first_wrong_turn, bool_and(fits) AND arg_max(role, place) = 'assistant' AS turns_valid
FROM f GROUP BY conv_id
"""


def op8_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    back = read_back(format_chat(rows.unionByName(extra)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(told, "utf-8"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(F.encode(loss, "utf-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "first_wrong_turn", "turns_valid")
