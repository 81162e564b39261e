"""Sessions: a model reads a context by writing code, turn by turn, until it has an answer.

A session is a row of state; a turn is a step over all rows that still run. Each turn's
states are written to the shared folder and reread, so a lost executor costs one
turn of its own sessions. Recursive queries inside a cell run in the same worker, down to
the depth allowed.
"""

from __future__ import annotations

import json
import re
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.functions import errors
from quillmesh.functions.messages import FENCE, FIRST_LOOK, MAX_OUTPUT
from quillmesh.functions.models import Model, Usage, get_model
from quillmesh.functions.sandbox import Result, Sandbox, plain_value
from quillmesh.functions.tools import describe, inherited, injected, parse_tools
from quillmesh.operators.compaction import GO_ON, SHARE, SUMMARISE
from quillmesh.operators.usage import CHARS_PER_TOKEN, CONTEXT_LIMITS, DEFAULT_LIMIT

_FENCE = re.compile(FENCE)
SYSTEM = (
    "You answer a question about a context too long to read at once. It is the variable `context` of a Python session. "
    "Write code in fences marked repl to look at it, to filter it, and to ask llm_query or rlm_query about parts of it. "
    "Set answer['content'] and then answer['ready'] = True when you are done."
)
LAST_CALL = "No turns are left. Give your answer now."


@dataclass(frozen=True)
class Limits:
    max_turns: int = 30
    max_depth: int = 1
    timeout: float | None = None
    budget: float | None = None
    tokens: int | None = None
    errors: int | None = None

    def for_child(self, spent: float, elapsed: float) -> Limits:
        """What is left of budget and time; the other limits in full."""
        return replace(
            self,
            budget=None if self.budget is None else self.budget - spent,
            timeout=None if self.timeout is None else self.timeout - elapsed,
        )


@dataclass(frozen=True)
class Config:
    """How sessions run. ``model`` and ``second`` are (kind, settings); ``second`` answers at depth one."""

    model: tuple[str, dict[str, Any]] = ("echo", {})
    second: tuple[str, dict[str, Any]] | None = None
    registered: dict[str, tuple[str, dict[str, Any]]] = field(default_factory=dict)
    limits: Limits = Limits()
    system: str = SYSTEM
    prologue: str | None = None
    tools: dict[str, Any] | None = None
    child_tools: dict[str, Any] | None = None
    compaction: bool = False
    compaction_share: float = SHARE
    cell_timeout: float | None = None
    setup: str | None = None
    on_event: Callable[[str, dict], None] | None = None

    def build(self, depth: int, asked: str | None = None) -> Model:
        if asked in self.registered:
            kind, settings = self.registered[asked]
        elif depth == 1 and self.second:
            kind, settings = self.second
        else:
            kind, settings = self.model
        return get_model(kind, **settings)


def find_code(text: str) -> list[str]:
    return [m.strip() for m in _FENCE.findall(text)]


def limit_of(model_name: str) -> int:
    held = [k for k in CONTEXT_LIMITS if k in model_name]
    return CONTEXT_LIMITS[max(held, key=len)] if held else DEFAULT_LIMIT


def result_text(r: Result) -> str:
    parts = [f"\n{x}" for x in (r.stdout, r.stderr) if x]
    shown = [n for n in r.names if not n.startswith("_")]
    if shown:
        parts.append(f"REPL variables: {shown}\n")
    return "\n\n".join(parts) or "No output"


def turn_history(response: str, results: list[Result]) -> list[dict[str, str]]:
    out = [{"role": "assistant", "content": response}]
    parts = []
    for k, r in enumerate(results):
        text = result_text(r)
        if len(text) > MAX_OUTPUT:
            text = f"{text[:MAX_OUTPUT]}... + [{len(text) - MAX_OUTPUT} chars...]"
        parts.append(f"REPL output (block {k + 1}):\n{text}" if len(results) > 1 else f"REPL output:\n{text}")
    return [*out, {"role": "user", "content": "\n\n".join(parts)}] if parts else out


class Session:
    """One session's state and its steps."""

    def __init__(self, config: Config, depth: int = 0, tools: dict[str, Any] | None = None) -> None:
        self.config, self.depth = config, depth
        self.model = config.build(depth)
        self.tools = parse_tools(config.tools if tools is None else tools)
        functions, values = injected(self.tools)
        self.sandbox = Sandbox(self._leaf, self._child, functions, values, config.cell_timeout)
        if config.setup:
            self.sandbox.run(config.setup)
        self.history: list[dict[str, str]] = []
        self.turn = self.errors_in_row = self.compactions = 0
        self.usage, self.elapsed = Usage(), 0.0
        self.partial: str | None = None
        self.answer: str | None = None
        self.status = "running"
        self.log: list[dict] = []
        self.segments = -1  # the history that this prompt's compactions go to
        self._spending = threading.Lock()  # sub-calls of a batch run side by side

    # queries from inside the code

    def _leaf(self, prompt: Any, model: str | None = None) -> str:
        got = self.config.build(self.depth + 1, model).complete(prompt)
        self._spent(got.usage)
        return got.text

    def _spent(self, usage: Usage) -> None:
        with self._spending:
            self.usage = self.usage.plus(usage)

    def _child(self, prompt: Any, model: str | None = None) -> str:
        """A session of its own one level down, or a plain call at the last level. Failures are error texts."""
        if self.depth + 1 >= self.config.limits.max_depth:
            return self._leaf(prompt, model)
        limits = self.config.limits.for_child(self.usage.cost or 0.0, self.elapsed)
        if limits.budget is not None and limits.budget <= 0:
            return "Error: no budget is left"
        if limits.timeout is not None and limits.timeout <= 0:
            return "Error: no time is left"
        self._tell("subcall_start", {"depth": self.depth + 1, "prompt": str(prompt)[:80]})
        given = inherited(self.config.tools, self.config.child_tools)
        child = Session(replace(self.config, limits=limits, tools=dict(given)), self.depth + 1, dict(given))
        child.open(prompt)
        child.run()
        self._spent(child.usage)
        self._tell("subcall_complete", {"depth": self.depth + 1, "status": child.status})
        return child.answer if child.answer is not None else f"Error: the sub-session ended by {child.status}"

    def _tell(self, event: str, about: dict) -> None:
        if self.config.on_event:
            try:
                self.config.on_event(event, about)
            except Exception:  # an observer must not stop the run
                return

    # steps

    def open(self, payload: Any, question: str | None = None) -> None:
        """A new prompt: the next context of the session, with its history kept from earlier ones."""
        index = self.sandbox.add_context(payload)
        size = len(payload) if isinstance(payload, str) else sum(len(str(x)) for x in payload)
        about = f"The context is of type {type(payload).__name__} with {size} characters in all."
        listed = describe(self.tools)
        system = self.config.system + (f"\n\nTools and data at hand:\n{listed}" if listed else "")
        first = f"Question: {question}\n\n{about}" if question else about
        self.history = [{"role": "system", "content": system}, {"role": "user", "content": first}]
        if self.config.prologue:
            self.history.append({"role": "user", "content": self.config.prologue})
        if index:
            self.sandbox.answer = type(self.sandbox.answer)()
        self.turn, self.answer, self.status, self.errors_in_row, self.segments = 0, None, "running", 0, -1

    def _prompt(self) -> list[dict[str, str]]:
        s = self.sandbox
        text = (FIRST_LOOK if self.turn == 0 else "") + f"Turn {self.turn + 1}/{self.config.limits.max_turns}:"
        if s.contexts > 1:
            text += f"\n\nContexts at hand: context_0 to context_{s.contexts - 1}."
        if s.histories == 1:
            text += "\n\nAn earlier conversation is in `history`."
        elif s.histories > 1:
            text += f"\n\nEarlier conversations: history_0 to history_{s.histories - 1}."
        return [*self.history, {"role": "user", "content": text}]

    def _compact(self) -> None:
        size = (sum(len(m["content"]) for m in self.history) + CHARS_PER_TOKEN - 1) // CHARS_PER_TOKEN
        if not self.config.compaction or size < int(self.config.compaction_share * limit_of(getattr(self.model, "name", ""))):
            return
        got = self.model.complete([*self.history, {"role": "user", "content": SUMMARISE}])
        self.usage = self.usage.plus(got.usage)
        self.compactions += 1
        if self.segments < 0:  # not into an earlier conversation
            self.segments = self.sandbox.add_history([])
        held = self.sandbox.locals.setdefault(f"history_{self.segments}", [])
        held += [list(self.history), {"type": "summary", "content": got.text}]
        note = {"role": "user", "content": GO_ON % self.compactions}
        self.history = [*self.history[:2], {"role": "assistant", "content": got.text}, note]

    def step(self) -> None:
        """One turn, unless a limit ends the session first."""
        limits = self.config.limits
        if self.turn >= limits.max_turns:
            self._last_call()
            return
        if limits.timeout is not None and self.elapsed > limits.timeout:
            self.status = errors.TimeExceeded.status
            return
        self._tell("iteration_start", {"turn": self.turn})
        began = time.monotonic()
        self._compact()
        prompt = self._prompt()
        try:
            got = self.model.complete(prompt)
            response, used = got.text, got.usage
        except Exception as e:
            response, used = f"Error: {e}", Usage(1)
        self.usage = self.usage.plus(used)
        results = [self.sandbox.run(code) for code in find_code(response)]
        seconds = time.monotonic() - began
        self.elapsed += seconds
        self.errors_in_row = self.errors_in_row + 1 if any(r.stderr for r in results) else 0
        spent, tokens = self.usage.cost or 0.0, self.usage.input_tokens + self.usage.output_tokens
        if limits.errors is not None and self.errors_in_row >= limits.errors:
            self.status = errors.TooManyErrors.status
        elif limits.budget is not None and spent > limits.budget:
            self.status = errors.BudgetExceeded.status
        elif limits.tokens is not None and tokens > limits.tokens:
            self.status = errors.TokensExceeded.status
        if self.status != "running":
            return
        if response.strip():
            self.partial = response
        self.history += [prompt[-1], *turn_history(response, results)]
        self.turn += 1
        self.answer = next((r.final_answer for r in results if r.final_answer is not None), None)
        blocks = [{"code": c, "result": vars(r)} for c, r in zip(find_code(response), results, strict=True)]
        self.log.append({"iteration": self.turn, "response": response, "code_blocks": blocks, "final_answer": self.answer, "iteration_time": seconds})
        self._tell("iteration_complete", {"turn": self.turn})
        if self.answer is not None:
            self._finish()

    def _last_call(self) -> None:
        got = self.model.complete([*self.history, {"role": "user", "content": LAST_CALL}])
        self.usage = self.usage.plus(got.usage)
        self.answer = got.text
        self.log.append({"iteration": self.turn + 1, "response": got.text, "code_blocks": [], "final_answer": got.text, "iteration_time": None})
        self._finish()

    def _finish(self) -> None:
        self.status = "done"
        self.sandbox.add_history(self.history)

    def run(self) -> Session:
        while self.status == "running":
            self.step()
        return self

    # state as a row

    FIELDS = ("history", "log", "turn", "errors_in_row", "compactions", "segments", "elapsed", "partial", "answer", "status")

    def dump(self, context: str | None = None) -> dict[str, Any]:
        """The state as a row; ``context`` is the first context's text, which isn't written again if it is as it was."""
        same = context is not None and self.sandbox.locals.get("context_0") == context
        row = {k: getattr(self, k) for k in self.FIELDS} | {"ns": self.sandbox.dump(frozenset({"context_0"}) if same else frozenset())}
        u = self.usage
        return row | {"history": json.dumps(self.history), "log": json.dumps(plain_value(self.log)), "calls": u.calls, "input_tokens": u.input_tokens, "output_tokens": u.output_tokens, "cost": u.cost}

    def load(self, row: dict[str, Any], context: str | None = None) -> None:
        for k in self.FIELDS:
            setattr(self, k, json.loads(row[k]) if k in ("history", "log") else row[k])
        if context is not None:
            self.sandbox.locals["context_0"] = context
        self.sandbox.load(row["ns"])
        cost = None if pd.isna(row["cost"]) else row["cost"]
        self.usage = Usage(int(row["calls"]), int(row["input_tokens"]), int(row["output_tokens"]), cost)
        for k in ("turn", "errors_in_row", "compactions", "segments"):
            setattr(self, k, int(row[k]))


def run_inline(payload: Any, config: Config = Config(), question: str | None = None) -> Session:
    """A session on the driver; raises what stopped it."""
    session = Session(config)
    session.open(payload, question)
    session.run()
    if session.status == "done":
        return session
    limits, u = config.limits, session.usage
    if session.status == "budget":
        raise errors.BudgetExceeded(u.cost or 0.0, limits.budget)
    if session.status == "timeout":
        raise errors.TimeExceeded(session.elapsed, limits.timeout, session.partial)
    if session.status == "tokens":
        raise errors.TokensExceeded(u.input_tokens + u.output_tokens, limits.tokens, session.partial)
    raise errors.TooManyErrors(session.errors_in_row, limits.errors, None, session.partial)


STATE = (
    "history string, log string, turn int, errors_in_row int, compactions int, segments int, elapsed double, partial string, answer string, status string, "
    "ns binary, calls bigint, input_tokens bigint, output_tokens bigint, cost double"
)


def run_sessions(sessions: DataFrame, config: Config = Config(), context: str = "context", question: str | None = None, turns_a_step: int = 1) -> DataFrame:
    """The sessions (one row each: their columns, with the context's text) with STATE's columns when none runs any more.

    ``log`` has the iterations as JSON (``iterations`` makes rows of it). The result doesn't depend on ``turns_a_step``."""
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sessions.schema.fields)
    names = [c.split()[0] for c in STATE.split(", ")]
    own = sessions.columns

    def advance(fresh: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for row in batch.to_dict("records"):
                    session = Session(config)
                    if fresh:
                        session.open(row[context] or "", row[question] if question else None)
                    else:
                        session.load(row, row[context] or "")
                    for _ in range(turns_a_step):
                        if session.status == "running":
                            session.step()
                    out.append({k: row[k] for k in own} | session.dump(row[context] or ""))
                yield pd.DataFrame(out, columns=[*own, *names])

        return run

    running = scratch.table(sessions.mapInPandas(advance(True), f"{given}, {STATE}"), "sessions")
    done = []
    while True:
        done.append(running.filter("status <> 'running'"))
        left = running.filter("status = 'running'")
        if not left.limit(1).count():
            break
        running = scratch.table(left.mapInPandas(advance(False), f"{given}, {STATE}"), "sessions")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumn("final_answer", F.col("answer")).drop("answer", "ns", "segments")


ITERATIONS = (
    "array<struct<iteration:int,response:string,code_blocks:array<struct<code:string,result:struct<stdout:string,stderr:string,seconds:double,"
    "final_answer:string>>>,final_answer:string,iteration_time:double>>"
)


def iterations(ended: DataFrame, *keys: str) -> DataFrame:
    """One row per turn of the sessions that ``run_sessions`` returns: the ``keys``, iteration, response, code_blocks,
    final_answer and iteration_time. Sessions without a turn have none."""
    each = ended.select(*keys, F.explode(F.from_json("log", ITERATIONS)).alias("turn_"))
    return each.select(*keys, "turn_.*")
