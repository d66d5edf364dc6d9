"""Chat formatting from event logs, in native expressions only.

A log has one row per event of a message. Events are folded in the order of their sequence:
a delta appends to the message's text, an edit replaces it, a regeneration empties it for the
deltas that follow. Messages are then rendered by a template with control strings

    <s>[ROLE]user[/ROLE][INST] text [/INST]</s>[ROLE]assistant[/ROLE]text</s>

Control strings inside roles and texts get a backslash after their first character, and one
more for each that they have there already, which is undone exactly by taking one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<s>", "</s>"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
ASK, ASK_END = "[INST] ", " [/INST]"
USER, ASSISTANT = "user", "assistant"

DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"
# Code points of a delta, at most, of the logs made here.
PIECE = 256

_NAMES = r"/?(?:s>|ROLE\]|INST\])"
_ESCAPE = rf"([<\[])(\\*{_NAMES})"
_UNESCAPE = rf"([<\[])\\(\\*{_NAMES})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def messages(events: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: the final messages of a log conv_id, turn, seq, kind, role, text.

    Events of a message (conv_id, turn) are folded by seq, equal ones by kind, role and text.
    A null text counts as empty, a null or unknown kind as a delta; the role is that of the
    last event that has one, else empty. Null conv_ids and turns are messages of their own
    value. A message stays if its text is empty. A message's events meet in one row, as its
    text must. Other columns are ignored; an empty log gives an empty table.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    event = F.struct(F.col("seq"), F.col("kind"), F.col("role"), text.alias("text"))
    grouped = events.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(event)).alias("log"))
    folded = grouped.withColumn(
        "done",
        F.expr(
            f"""aggregate(log,
                named_struct('from', 0, 'at', 0, 'role', cast('' AS string)),
                (s, e) -> named_struct(
                    'from', if(e.kind IN ('{EDIT}', '{REGENERATE}'), s.at, s.from),
                    'at', s.at + 1,
                    'role', coalesce(e.role, s.role)))"""
        ),
    )
    last = F.expr(
        f"""array_join(transform(slice(log, done.from + 1, size(log)),
            e -> if(e.kind <=> '{REGENERATE}', '', e.text)), '')"""
    )
    return folded.select("conv_id", "turn", F.col("done.role").alias("role"), last.alias("text"))


def render(final: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: a conversation in one text, and the spans to learn from.

    `final` has conv_id, turn, role, text; turns are in order of turn, equal ones of role and
    text, nulls first. `loss` is an array of (start, length), in code points, of the assistant
    texts within `formatted`. A conversation is one text, so its messages meet in one row.
    """
    role = escape(F.coalesce("role", F.lit("")))
    user = F.coalesce(F.col("role") == USER, F.lit(False))
    parts = final.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(F.lit(ROLE), role, F.lit(ROLE_END), F.when(user, ASK).otherwise("")).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
        F.concat(F.when(user, ASK_END).otherwise(""), F.lit(END)).alias("tail"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, -1
    )
    size = F.length("head") + F.length("body") + F.length("tail")
    at = F.coalesce(F.sum(size).over(before), F.lit(0)) + len(BEGIN)
    placed = parts.select(
        "conv_id",
        F.struct(
            at.alias("at"),
            F.concat("head", "body", "tail").alias("whole"),
            (at + F.length("head")).alias("start"),
            F.length("body").cast("long").alias("length"),
            F.coalesce(F.col("role") == ASSISTANT, F.lit(False)).alias("learn"),
        ).alias("m"),
    )
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("turns"))
    return turns.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.col("turns")["whole"], "")).alias("formatted"),
        F.transform(
            F.filter("turns", lambda m: m["learn"]),
            lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length")),
        ).alias("loss"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation, array of (role, text), from the text alone."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    parts = F.split(body, END)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, ROLE_END, 1)
        role = F.substring(role, F.lit(len(ROLE) + 1), F.length(role))
        text = F.substring(
            part, F.length(role) + len(ROLE) + len(ROLE_END) + 1, F.length(part)
        )
        inner = F.substring(text, F.lit(len(ASK) + 1), F.length(text) - len(ASK) - len(ASK_END))
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.when(role == USER, inner).otherwise(text)).alias("text"),
        )

    return F.transform(parts, turn)


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    return F.array_join(
        F.transform(loss, lambda x: unescape(F.substring(formatted, x["start"] + 1, x["length"]))), ""
    )


def as_events(conversations: DataFrame) -> DataFrame:
    """A table of whole messages, conv_id, turn, role, text, as a log that leads to them.

    Rows that share a turn, repeated ones too, are told apart by their number in order of turn,
    role and text, nulls first, which becomes the turn. A text is streamed in deltas of up to
    `PIECE` code points, an empty or null one in an empty delta. Of three messages one is
    streamed right away, one starts with a delta that a regeneration then discards, and one with
    a delta that an edit replaces by the text's first piece. Only the first event of a message
    names its role, and a message's events come last first: `seq` alone gives their order.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)
    )

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    def deltas(texts: Column) -> Column:
        return F.transform(texts, lambda x: event(DELTA, x))

    stale = event(DELTA, F.element_at("pieces", -1))
    rest = F.slice("pieces", F.lit(2), F.size("pieces"))
    log = (
        F.when(F.col("turn") % 3 == 1, F.concat(F.array(stale, event(REGENERATE, F.lit(None).cast("string"))), deltas(F.col("pieces"))))
        .when(F.col("turn") % 3 == 2, F.concat(F.array(stale, event(EDIT, F.element_at("pieces", 1))), deltas(rest)))
        .otherwise(deltas(F.col("pieces")))
    )
    log = F.transform(log, lambda e, i: e.withField("seq", i))
    events = conversations.select(
        "conv_id",
        F.row_number().over(order).alias("turn"),
        "role",
        F.when(F.size(pieces) > 0, pieces).otherwise(F.array(F.lit(""))).alias("pieces"),
    ).select("conv_id", "turn", "role", F.explode(F.reverse(log)).alias("e"))
    return events.select(
        "conv_id",
        "turn",
        F.col("e.seq").alias("seq"),
        F.col("e.kind").alias("kind"),
        F.when(F.col("e.seq") == 0, F.col("role")).alias("role"),
        F.col("e.text").alias("text"),
    )
