"""Scoring of answers, gates and rewards, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The phrases of comparisons, the length of a short answer, what a unit of distance costs.
COMPARISONS = ("more common than", "less common than", "same frequency as")
SHORT = 20
DECAY = 0.75
NUMERIC, DATE = "ANSWER_TYPE.NUMERIC", "ANSWER_TYPE.DATE"
INTEGER = r"^\s*[+-]?\d+(?:_\d+)*\s*$"


def comparison_phrase(text: Column) -> Column:
    """The phrase that ends rightmost in the text by its last occurrence's start, null without any."""
    low = F.lower(text)

    def last(phrase: str) -> Column:
        back = F.locate(phrase[::-1], F.reverse(low))
        return F.when(back > 0, F.struct((F.length(low) - back - len(phrase) + 1).alias("at"), F.lit(phrase).alias("phrase")))

    return F.array_max(F.array(*[last(p) for p in COMPARISONS]))["phrase"]


def parsed_answer(text: Column) -> Column:
    """struct(answer, confidence): a comparison phrase; else, without a colon, a short text or its last word; else what
    follows the last colon, without marks."""
    phrase = comparison_phrase(text)
    stripped = F.regexp_replace(text, r"^\s+|\s+$", "")
    last_word = F.element_at(F.split(stripped, r"\s+"), -1)
    tail = F.translate(F.regexp_replace(F.substring_index(text, ":", -1), r"^\s+|\s+$", ""), "*[]", "")
    colon = F.contains(text, F.lit(":"))
    answer = F.coalesce(phrase, F.when(colon, tail).when(F.length(text) < SHORT, text).otherwise(last_word))
    sure = F.when(phrase.isNotNull(), "high").when(~colon, "low").when(F.length(tail) < SHORT, "vhigh").otherwise("med")
    return F.struct(answer.alias("answer"), sure.alias("confidence"))


def gold_answer(answer: Column) -> Column:
    """The first item of an answer written as a list; a date list as its date; else the text as it is."""
    date = F.regexp_extract(answer, r"datetime\.date\((\d+), (\d+), (\d+)\)", 0)
    part = lambda k: F.regexp_extract(answer, r"datetime\.date\((\d+), (\d+), (\d+)\)", k)
    as_date = F.concat(F.format_string("%s-%s-%s", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), F.lit(" 00:00:00"))
    quoted = F.regexp_extract(answer, r"""^\s*\[\s*(?:'([^']*)'|"([^"]*)")""", 0)
    text = F.concat(F.regexp_extract(answer, r"""^\s*\[\s*'([^']*)'""", 1), F.regexp_extract(answer, r"""^\s*\[\s*"([^"]*)\"""", 1))
    number = F.regexp_extract(answer, r"^\s*\[\s*([+-]?\d+(?:\.\d+)?)\s*[,\]]", 1)
    return F.when(date != "", as_date).when(quoted != "", text).when(number != "", number).otherwise(answer)


def score(answer: Column, answer_type: Column, output: Column) -> Column:
    """1 for the same answer (case apart); a power of the distance for numbers; 1 for the same date; 1 if the output holds
    the answer and that is no comparison phrase; else 0."""
    gold, got = gold_answer(answer), parsed_answer(output)["answer"]
    whole = lambda c: F.when(c.rlike(INTEGER), F.regexp_replace(F.trim(c), "_", "").cast("bigint"))
    distance = F.abs(whole(gold) - whole(got))
    held = (F.length(gold) > 0) & ~F.lower(gold).isin(*COMPARISONS) & F.contains(F.lower(output), F.lower(gold))
    dated = F.try_to_timestamp(got) == F.try_to_timestamp(gold)
    return (
        F.when((got == gold) | (F.lower(got) == F.lower(gold)), 1.0)
        .when(answer_type == NUMERIC, F.coalesce(F.pow(F.lit(DECAY), distance), F.lit(0.0)))
        .when(answer_type == DATE, F.when(F.coalesce(dated, F.lit(False)), 1.0).otherwise(0.0))
        .when(held, 1.0)
        .otherwise(0.0)
    )


def passes_gates(turns: Column, sub_calls: Column, min_turns: int, min_sub_calls: int) -> Column:
    return (F.coalesce(turns, F.lit(0)) >= min_turns) & (F.coalesce(sub_calls, F.lit(0)) >= min_sub_calls)


def gated_reward(value: Column, passed: Column, min_reward: float = 0.0, gated: bool = True) -> Column:
    """The value, or 0 if the gates or the least reward aren't met; a reward that isn't gated stays as it is."""
    return F.when(passed & (value >= min_reward), value).otherwise(0.0) if gated else value


def rubric_metrics(
    rollouts: DataFrame, min_turns: int, min_sub_calls: int, min_reward: float, turns: str = "turns", calls: str = "repl_calls",
    sub_calls: str = "sub_calls", answer: str = "final_answer", reward: str = "reward",
) -> DataFrame:
    """Adds the metrics of each rollout; the checks of sub-calls and reward count only where they are asked for."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    flag = lambda c: F.when(c, 1).otherwise(0)
    return rollouts.withColumns(
        {
            "m_turns": n(turns),
            "m_repl_calls": n(calls),
            "m_sub_calls": n(sub_calls),
            "m_has_answer": flag(F.coalesce(F.length(answer), F.lit(0)) > 0),
            "m_below_turns": flag(n(turns) < min_turns),
            "m_below_sub_calls": flag(F.lit(min_sub_calls > 0) & (n(sub_calls) < min_sub_calls)),
            "m_below_reward": flag(F.lit(min_reward > 0) & (n(reward) <= 0)),
        }
    )


def zero_advantage(rollouts: DataFrame, example: str, reward: str = "reward") -> DataFrame:
    """The examples whose rollouts all have the same reward, from which nothing can be learned."""
    return rollouts.groupBy(example).agg(F.min(reward).alias("lo"), F.max(reward).alias("hi")).filter("lo = hi").select(example)
