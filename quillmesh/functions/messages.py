"""Expressions over messages, prompts, code fences and outputs of code. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The fence that marks code to run, the cut of a block's output, lengths of previews.
FENCE = r"(?s)```repl\s*\n(.*?)\n```"
MAX_OUTPUT = 20_000
PREVIEW = 80
#: White space as Python's strip sees it, for the ASCII range.
EDGE_SPACE = r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: Escape sequences of terminals: control sequences, operating-system commands, two-byte escapes.
ANSI = r"\x1b\[[0-?]*[ -/]*[@-~]|\x1b\][^\x07\x1b]*(?:\x07|\x1b\\)|\x1b[@-Z\\-_]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def as_messages(prompt: Column, role: str = "user") -> Column:
    """One message with the prompt as content."""
    return F.array(F.struct(F.lit(role).alias("role"), prompt.alias("content")))


def last_user(messages: Column) -> Column:
    """Content of the last user message, null if there is none."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == "user"), F.lit(-1))["content"]


def last_system(messages: Column) -> Column:
    """Content of the last system message: of several it wins."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == "system"), F.lit(-1))["content"]


def without_system(messages: Column) -> Column:
    return F.filter(messages, lambda m: m["role"] != "system")


def service_roles(messages: Column) -> Column:
    """Roles of services that call the assistant ``model`` and know no others but the user."""
    return F.transform(
        without_system(messages),
        lambda m: F.struct(F.when(m["role"] == "assistant", "model").otherwise("user").alias("role"), m["content"].alias("content")),
    )


def filled_assistant(messages: Column) -> Column:
    """Empty assistant content is replaced by the reasoning text, or by nothing; messages have a ``reasoning`` field."""
    content = lambda m: F.when(
        (m["role"] == "assistant") & (F.coalesce(m["content"], F.lit("")) == ""), F.coalesce(m["reasoning"], F.lit(""))
    ).otherwise(m["content"])
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), content(m).alias("content")))


def code_blocks(response: Column) -> Column:
    """The code of every marked fence in order, stripped; an empty array without any."""
    return F.transform(F.regexp_extract_all(response, F.lit(FENCE), 1), strip)


def first_answer(answers: Column) -> Column:
    """Of the blocks' answers the first that isn't null."""
    return F.try_element_at(F.filter(answers, lambda x: x.isNotNull()), F.lit(1))


def cut(text: Column, most: int = MAX_OUTPUT) -> Column:
    """Text of over ``most`` characters ends in a note of how many are left out."""
    note = F.concat(F.lit("... + ["), (F.length(text) - most).cast("string"), F.lit(" chars...]"))
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), note)).otherwise(text)


def execution_result(stdout: Column, stderr: Column, names: Column) -> Column:
    """A block's output as the model sees it: stdout, stderr, names of the variables."""
    said = lambda c: F.when(F.length(c) > 0, F.concat(F.lit("\n"), c))
    shown = F.filter(names, lambda n: ~n.startswith("_"))
    listed = F.concat(F.lit("REPL variables: ['"), F.array_join(shown, "', '"), F.lit("']\n"))
    out = F.concat_ws("\n\n", said(stdout), said(stderr), F.when(F.size(shown) > 0, listed))
    return F.when(out == "", F.lit("No output")).otherwise(out)


def turn_messages(response: Column, results: Column, most: int = MAX_OUTPUT) -> Column:
    """A turn for the history: the response, then one user message with all blocks' results, numbered if several."""
    head = lambda i: F.when(
        F.size(results) > 1, F.concat(F.lit("REPL output (block "), (i + 1).cast("string"), F.lit("):"))
    ).otherwise(F.lit("REPL output:"))
    parts = F.transform(results, lambda r, i: F.concat(head(i), F.lit("\n"), cut(r, most)))
    answer = as_messages(response, "assistant")
    return F.when(F.size(results) > 0, F.concat(answer, as_messages(F.array_join(parts, "\n\n")))).otherwise(answer)


#: Our own wording.
FIRST_LOOK = "Nothing has been read so far. Look at the context before you answer.\n\n"


def turn_prompt(turn: Column, max_turns: int, contexts: Column, histories: Column) -> Column:
    """The user message that opens a turn (from 0 on), with notes on several contexts and earlier conversations."""
    several = F.concat(F.lit("\n\nContexts at hand: context_0 to context_"), (contexts - 1).cast("string"), F.lit("."))
    one_before = F.lit("\n\nAn earlier conversation is in `history`.")
    more_before = F.concat(F.lit("\n\nEarlier conversations: history_0 to history_"), (histories - 1).cast("string"), F.lit("."))
    return F.concat(
        F.when(turn == 0, F.lit(FIRST_LOOK)).otherwise(F.lit("")),
        F.format_string(f"Turn %d/{max_turns}:", turn + 1),
        F.when(contexts > 1, several).otherwise(F.lit("")),
        F.when(histories == 1, one_before).when(histories > 1, more_before).otherwise(F.lit("")),
    )


def opening(system: str, kind: Column, total: Column, question: Column | None = None, tools: str = "") -> Column:
    """The first two messages: the system prompt with the tools, and what the context is, after the question if any."""
    whole = system + (f"\n\nTools and data at hand:\n{tools}" if tools else "")
    about = F.concat(F.lit("The context is of type "), kind, F.lit(" with "), total.cast("string"), F.lit(" characters in all."))
    if question is not None:
        about = F.when(F.length(question) > 0, F.concat(F.lit("Question: "), question, F.lit("\n\n"), about)).otherwise(about)
    return F.concat(as_messages(F.lit(whole), "system"), as_messages(about))


def without_escapes(text: Column) -> Column:
    """Text without the escape sequences of terminals."""
    return F.regexp_replace(text, ANSI, "")


def snippet(text: Column, most: int = 60) -> Column:
    """A one-line preview."""
    return F.translate(F.substring(text, 1, most), "\n", " ")
