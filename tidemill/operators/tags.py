"""Keyword tags on call turns, and the running state of a call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.prefix import LEAST_HEAVY_ROWS, in_pieces, real_rows


@dataclass(frozen=True)
class AlertRule:
    """The alert is raised by a turn that contains any of the words."""

    words: tuple[str, ...]
    alert: str


@dataclass(frozen=True)
class SuggestionRule:
    """The first rule whose word occurs sets the suggestions, and next steps if it has any."""

    word: str
    suggestions: tuple[str, ...]
    next_steps: tuple[str, ...] = ()


def _texts(items: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(i) for i in items])


def tag_turns(
    df: DataFrame, text: str, alerts: list[AlertRule], suggestions: list[SuggestionRule]
) -> DataFrame:
    """Add ``alerts`` of the turn (empty if none), ``suggestions`` and ``next_steps`` (NULL if none)."""
    words = F.lower(F.coalesce(F.col(text), F.lit("")))
    raised = F.filter(
        F.array(
            *[
                F.when(_any(words, rule.words), F.lit(rule.alert))
                for rule in alerts
            ]
        ),
        lambda a: a.isNotNull(),
    )
    nothing = F.lit(None).cast("array<string>")
    suggested, steps = nothing, nothing
    for rule in reversed(suggestions):
        hit = F.contains(words, F.lit(rule.word.lower()))
        suggested = F.when(hit, _texts(rule.suggestions)).otherwise(suggested)
        steps = F.when(hit, _texts(rule.next_steps) if rule.next_steps else nothing).otherwise(steps)
    return df.withColumns({"alerts": raised, "suggestions": suggested, "next_steps": steps})


def _any(text: Column, words: tuple[str, ...]) -> Column:
    condition = F.lit(False)
    for word in words:
        condition = condition | F.contains(text, F.lit(word.lower()))
    return condition


def running_state(
    tagged: DataFrame, call: str, order: str, turns_per_piece: int | None = None,
    least_rows: int = LEAST_HEAVY_ROWS,
) -> DataFrame:
    """Add what holds after each turn: ``alerts_so_far``, latest suggestions and next steps.

    The list of alerts so far would grow with every turn, so it is kept as a
    count: `alert_log` lists the alerts with their numbers. A very long call is
    folded in pieces of consecutive turns, cut at its own quantiles unless ``turns_per_piece`` is given.
    """
    state = {"suggestions": "current_suggestions", "next_steps": "current_next_steps"}
    valued = tagged.withColumn("_n", F.size("alerts"))
    rows, along = in_pieces(
        valued, [call], [order],
        None if turns_per_piece is None else F.floor(F.col(order) / turns_per_piece),
        {"_n": "sum", **{c: "last_set" for c in state}}, least_rows,
    )
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    folded = rows.withColumn("alerts_so_far", F.sum("_n").over(so_far)).withColumns(
        {name: F.last(c, ignorenulls=True).over(so_far) for c, name in state.items()}
    )
    return real_rows(folded).drop("_n")


def alert_log(state: DataFrame, call: str, order: str) -> DataFrame:
    """One row per alert with its number in the call.

    The accumulated list after a turn is the alerts numbered up to its ``alerts_so_far``.
    """
    first = F.col("alerts_so_far") - F.size("alerts") + 1
    return state.select(call, order, first.alias("_first"), F.posexplode("alerts")).select(
        call, order, (F.col("_first") + F.col("pos")).alias("alert_no"), F.col("col").alias("alert")
    )
