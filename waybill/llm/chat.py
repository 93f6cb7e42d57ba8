"""Chat formatting with Spark expressions: sorted turns, merged roles, a template, a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template: BEGIN role (OPEN text CLOSE)+ END for each run of turns of one role.
BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (BEGIN, OPEN, CLOSE, END)
#: Roles whose text is learned.
LEARNED = ("assistant",)


def escape(text: Column) -> Column:
    """Doubled backslashes, and a backslash after the first letter of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescape(text: Column) -> Column:
    """What escape was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _merged(turns: Column) -> Column:
    """Adjacent turns of one role as one struct (role, texts)."""
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(runs: Column, turn: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        alone = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        longer = F.struct(
            turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts")
        )
        return F.when(
            last["role"] == turn["role"],
            F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer)),
        ).otherwise(F.concat(runs, F.array(alone)))

    return F.aggregate(turns, empty, add)


def _pieces(runs: Column) -> Column:
    """The output in pieces, each with whether the model learns it."""

    def piece(text: Column, learned: Column | bool) -> Column:
        return F.struct(text.alias("text"), F.lit(learned).alias("learned"))

    def run(r: Column) -> Column:
        learned = r["role"].isin(*LEARNED)
        texts = F.flatten(
            F.transform(
                r["texts"],
                lambda t: F.array(
                    piece(F.lit(OPEN), False), piece(escape(t), learned), piece(F.lit(CLOSE), False)
                ),
            )
        )
        head = F.array(piece(F.concat(F.lit(BEGIN), escape(r["role"])), False))
        return F.concat(head, texts, F.array(piece(F.lit(END), False)))

    return F.flatten(F.transform(runs, run))


def _spans(pieces: Column) -> Column:
    """(start, length) in characters, from 1, of the learned pieces."""
    begin = F.struct(
        F.lit(1).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def add(state: Column, piece: Column) -> Column:
        size = F.length(piece["text"]).cast("long")
        span = F.struct(state["at"].alias("start"), size.alias("length"))
        return F.struct(
            (state["at"] + size).alias("at"),
            F.when(piece["learned"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return F.aggregate(pieces, begin, add, lambda state: state["spans"])


def render(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation.

    Turns go by number (nulls first), ties by role, then text; rows that repeat are turns of
    their own. Null roles and texts are empty. Turns of one role in a row share one frame, each text in
    its own brackets, so rows can be read back. loss_spans are (start, length) in code points from 1 of each
    assistant text; an empty text has a span of length zero. Rows with a null conv_id are one conversation. An
    empty table gives no rows; other columns are not read. A conversation is one output row, so its turns
    meet in one task.
    """
    turn = F.struct(
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy(F.col(f"`{conv_col}`").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    pieces = sorted_turns.select("conv_id", _pieces(_merged(F.col("turns"))).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        _spans(F.col("pieces")).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    runs = F.filter(F.split(formatted, r"\Q</s>\E", -1), lambda r: r != "")

    def turns_of(run: Column) -> Column:
        body = F.substring(run, F.lit(len(BEGIN) + 1), F.length(run))
        role = unescape(F.substring_index(body, OPEN, 1))
        texts = F.filter(
            F.split(F.substring(body, F.instr(body, OPEN), F.length(body)), r"\Q[/INST]\E", -1),
            lambda t: t != "",
        )
        return F.transform(
            texts,
            lambda t: F.struct(
                role.alias("role"),
                unescape(F.substring(t, F.lit(len(OPEN) + 1), F.length(t))).alias("text"),
            ),
        )

    return F.flatten(F.transform(runs, turns_of))


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, without its escapes."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, s["start"].cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
