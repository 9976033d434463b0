"""Chat formatting: turns checked by a finite-state machine and written from a template.

A row per turn goes in and out. The machine's state before a turn is the role of the turn before, so
that its move is checked by a window over (conversation, turn), whose sort can spill; texts of a
conversation are never gathered. What is written of a turn is a list of segments, each with its
loss flag; one after the other, in the order of the turns, they are the formatted conversation.

DataFrame functions only. Inside texts a control string such as ``<|im_end|>`` is escaped by a
backslash before its bar; backslashes that already stand there get one more, so that unescaping
gives back the text as it was.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles whose text is trained on, and the machine's moves.

    ``moves`` are (state, role) pairs; the state is the role of the turn before, and "" at the
    start. A conversation is in order if every move is one of them and it ends in ``ends``.
    ``start`` and ``end`` must begin with ``<|``.
    """

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: tuple[tuple[str, str], ...] = field(
        default=(
            ("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"),
            ("assistant", "user"),
        )
    )
    ends: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def format_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", template: Template = CHATML,
) -> DataFrame:
    """A row per turn: conv_id, place (from 1), legal, ends, last and segments (text, loss).

    ``legal`` says whether the machine allows the turn after the one before, ``ends`` whether a
    conversation may end with it, and ``last`` marks where it does. Turns are ordered by ``turn``
    (nulls first), then role and text; repeated rows stay. A null role or text is empty; a role is
    written URL-encoded, so that it fits on its line; an empty or very long text is a segment like
    any other. Turns with a null conversation id make up one conversation. Turns that break the
    order are kept and marked. Other columns are ignored, whatever their names; an empty table
    gives no rows.

    A conversation's rows are sorted together, on disk where they are many: a task holds one row.
    """
    given = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    moves = _strings([f"{a}>{b}" for a, b in template.moves])
    move = F.concat(F.coalesce(F.lag("role").over(order), F.lit("")), F.lit(">"), F.col("role"))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    head = F.concat(F.lit(template.start), F.url_encode("role"), F.lit(template.after_role))
    segments = F.array(
        segment(head, F.lit(False)),
        segment(escaped(F.col("text")), F.array_contains(_strings(template.loss_roles), F.col("role"))),
        segment(F.lit(template.end + template.after_turn), F.lit(False)),
    )
    return given.select(
        "conv_id", F.row_number().over(order).alias("place"), F.array_contains(moves, move).alias("legal"),
        F.array_contains(_strings(template.ends), F.col("role")).alias("ends"),
        F.lead("role").over(order).isNull().alias("last"), segments.alias("segments"),
    )


def read_turns(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """What `format_turns` wrote, read back: role and text from the segments, unescaped.

    ``loss`` says whether the text is under the mask and ``chars`` counts what was written. A turn
    that isn't framed by the template's marks raises.
    """
    whole = F.array_join(F.transform("segments", lambda s: s.text), "")
    close = template.end + template.after_turn
    framed = F.startswith("whole", F.lit(template.start)) & F.endswith("whole", F.lit(close))
    head = F.substring_index("whole", template.after_role, 1)
    body = F.substr(
        "whole", F.length("head") + len(template.after_role) + 1,
        F.length("whole") - F.length("head") - len(template.after_role) - len(close),
    )
    masked = F.filter("segments", lambda s: s.loss)
    return (
        turns.withColumn("whole", whole)
        .withColumn("whole", F.when(framed, F.col("whole")).otherwise(F.raise_error(F.lit("not a formatted turn"))))
        .withColumn("head", head)
        .select(
            *[c for c in turns.columns if c != "segments"],
            F.url_decode(F.substr("head", F.lit(len(template.start) + 1))).alias("role"),
            unescaped(body).alias("text"), (F.size(masked) > 0).alias("loss"),
            unescaped(F.array_join(F.transform(masked, lambda s: s.text), "")).alias("loss_text"),
            F.length("whole").cast("long").alias("chars"),
        )
    )
