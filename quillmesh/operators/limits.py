"""Limits of runs over their iteration logs: which turn, if any, ends a session, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _upto(session: str, turn: str) -> Window:
    return Window.partitionBy(session).orderBy(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def consecutive_errors(log: DataFrame, error: Column, session: str = "session_id", turn: str = "turn") -> DataFrame:
    """Adds errors_in_row: how many turns in a row up to this one had an error; a clean turn sets it to 0."""
    upto = _upto(session, turn)
    island = log.withColumn("error_", error).withColumn("clean_", F.sum(F.when(F.col("error_"), 0).otherwise(1)).over(upto))
    run = Window.partitionBy(session, "clean_").orderBy(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return island.withColumn("errors_in_row", F.sum(F.when(F.col("error_"), 1).otherwise(0)).over(run)).drop("error_", "clean_")


def running_total(log: DataFrame, value: Column, name: str, session: str = "session_id", turn: str = "turn") -> DataFrame:
    """Adds the sum of ``value`` up to and including each turn; null counts 0."""
    return log.withColumn(name, F.sum(F.coalesce(value, F.lit(0))).over(_upto(session, turn)))


def first_turn(log: DataFrame, over: Column, session: str = "session_id", turn: str = "turn") -> DataFrame:
    """The first turn of each session for which ``over`` holds."""
    return log.filter(over).groupBy(session).agg(F.min(turn).alias(turn))


def timeout_turn(log: DataFrame, seconds: Column, most: float, session: str = "session_id", turn: str = "turn") -> DataFrame:
    """The first turn that isn't begun, as the turns before it took more than ``most`` together."""
    before = Window.partitionBy(session).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    return first_turn(log.withColumn("elapsed_", F.coalesce(F.sum(seconds).over(before), F.lit(0.0))), F.col("elapsed_") > most, session, turn)


#: In the order in which a turn's limits are checked.
CAUSES = ("errors", "budget", "tokens")


def first_trip(
    log: DataFrame,
    error: Column,
    cost: Column,
    tokens: Column,
    max_errors: int,
    max_budget: float,
    max_tokens: int,
    session: str = "session_id",
    turn: str = "turn",
) -> DataFrame:
    """session, turn and cause of the first limit hit: errors in a row at the limit, cost or tokens over it."""
    log = consecutive_errors(log, error, session, turn)
    log = running_total(running_total(log, cost, "spent_", session, turn), tokens, "tokens_", session, turn)
    hit = F.when(F.col("errors_in_row") >= max_errors, 0).when(F.col("spent_") > max_budget, 1).when(F.col("tokens_") > max_tokens, 2)
    first = log.withColumn("cause_", hit).filter("cause_ is not null").groupBy(session).agg(F.min(F.struct(turn, "cause_")).alias("f"))
    return first.select(session, F.col(f"f.{turn}").alias(turn), F.element_at(F.array(*map(F.lit, CAUSES)), F.col("f.cause_") + 1).alias("cause"))


def best_partial(log: DataFrame, response: str, session: str = "session_id", turn: str = "turn") -> DataFrame:
    """The last response of each session that isn't blank."""
    kept = log.filter(F.trim(F.regexp_replace(response, r"\s", "")) != "")
    return kept.groupBy(session).agg(F.max_by(response, turn).alias("partial_answer"))


def child_limits(budget: Column, spent: Column, timeout: Column, elapsed: Column) -> dict[str, Column]:
    """What a sub-call may still use, and the error if it may not start; limits on errors, tokens and turns are passed whole."""
    left, time_left = budget - spent, timeout - elapsed
    return {
        "remaining_budget": left,
        "remaining_timeout": time_left,
        "refusal": F.when(left <= 0, F.lit("Error: no budget is left")).when(time_left <= 0, F.lit("Error: no time is left")),
    }
