"""Language models as the engine sees them: built on the executor from a configuration that pickles.

The deterministic ones need no network and make every result checkable.
"""

from __future__ import annotations

import importlib.util
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, Protocol, runtime_checkable

#: Seconds before a call is given up, tokens that a deterministic model reports for a call.
DEFAULT_TIMEOUT = 300.0
MOCK_INPUT_TOKENS = MOCK_OUTPUT_TOKENS = 10


@dataclass(frozen=True)
class Usage:
    calls: int = 0
    input_tokens: int = 0
    output_tokens: int = 0
    cost: float | None = None

    def plus(self, other: Usage) -> Usage:
        """Sums; the cost is null only if neither side has one."""
        known = [c for c in (self.cost, other.cost) if c is not None]
        return Usage(
            self.calls + other.calls,
            self.input_tokens + other.input_tokens,
            self.output_tokens + other.output_tokens,
            sum(known) if known else None,
        )


@dataclass(frozen=True)
class Reply:
    text: str
    usage: Usage


@runtime_checkable
class Model(Protocol):
    """A completion for a prompt, which is text or a list of messages."""

    def complete(self, prompt: Any) -> Reply: ...


def prompt_text(prompt: Any) -> str:
    """A prompt as text; anything but text is written out and cut to 80 characters."""
    return prompt if isinstance(prompt, str) else str(prompt)[:80]


@dataclass
class EchoModel:
    """Answers with the prompt; prompts holding ``fail_on`` raise."""

    name: str = "echo"
    fail_on: str | None = None
    delay: float = 0.0
    cost: float | None = None

    def complete(self, prompt: Any) -> Reply:
        if self.delay:
            time.sleep(self.delay)
        text = prompt_text(prompt)
        if self.fail_on and self.fail_on in text:
            raise RuntimeError(f"refused: {self.fail_on}")
        return Reply(f"Mock response to: {text}", Usage(1, MOCK_INPUT_TOKENS, MOCK_OUTPUT_TOKENS, self.cost))


@dataclass
class ScriptedModel:
    """Answers with its responses in order; an IndexError when they are used up."""

    responses: list[str]
    name: str = "scripted"
    usage: Usage = Usage(1, MOCK_INPUT_TOKENS, MOCK_OUTPUT_TOKENS)
    _at: int = field(default=0, repr=False)

    def complete(self, prompt: Any) -> Reply:
        if self._at >= len(self.responses):
            raise IndexError("no scripted response is left")
        self._at += 1
        return Reply(self.responses[self._at - 1], self.usage)


@dataclass
class RuleModel:
    """Answers by a function of the prompt."""

    rule: Callable[[Any], str]
    name: str = "rule"

    def complete(self, prompt: Any) -> Reply:
        return Reply(self.rule(prompt), Usage(1, MOCK_INPUT_TOKENS, MOCK_OUTPUT_TOKENS))


def normalise_prompt(prompt: Any) -> list[dict[str, Any]]:
    """Text becomes one user message; a list of messages stays; anything else is an error."""
    if isinstance(prompt, str):
        return [{"role": "user", "content": prompt}]
    if isinstance(prompt, list) and all(isinstance(m, dict) for m in prompt):
        return prompt
    raise ValueError(f"a prompt is text or a list of messages, not {type(prompt).__name__}")


def sampling_arguments(given: dict[str, Any] | None, extra_body: dict[str, Any] | None = None) -> dict[str, Any]:
    """Arguments as chat services take them: the length limit under its newer name, nulls dropped, extra fields merged."""
    given = dict(given or {})
    extra = {**(given.pop("extra_body", None) or {}), **(extra_body or {})}
    out = {{"max_tokens": "max_completion_tokens"}.get(k, k): v for k, v in given.items() if v is not None}
    return out | ({"extra_body": extra} if extra else {})


@dataclass
class ServiceModel:
    """A chat service with the common completion interface, through its client library if that is installed."""

    name: str
    api_key: str | None = None
    base_url: str | None = None
    timeout: float = DEFAULT_TIMEOUT
    sampling: dict[str, Any] | None = None

    def complete(self, prompt: Any) -> Reply:
        if importlib.util.find_spec("openai") is None:
            raise RuntimeError("the client library of this service isn't installed")
        import openai

        client = openai.OpenAI(api_key=self.api_key, base_url=self.base_url, timeout=self.timeout)
        got = client.chat.completions.create(model=self.name, messages=normalise_prompt(prompt), **sampling_arguments(self.sampling))
        cost = reported_cost(got.usage.model_dump() if got.usage else {})
        used = Usage(1, got.usage.prompt_tokens, got.usage.completion_tokens, cost) if got.usage else Usage(1)
        return Reply(got.choices[0].message.content or "", used)


def reported_cost(usage: dict[str, Any]) -> float | None:
    """The first positive of a response's cost, its extra cost, and its upstream inference cost."""
    for found in (usage.get("cost"), (usage.get("extra") or {}).get("cost"), (usage.get("cost_details") or {}).get("upstream_inference_cost")):
        if found is not None and float(found) > 0:
            return float(found)
    return None


#: The addresses of services that are reached through the common interface.
SERVICE_URLS = {
    "openai": None,
    "portkey": "https://api.portkey.ai/v1",
    "openrouter": "https://openrouter.ai/api/v1",
    "vercel": "https://ai-gateway.vercel.sh/v1",
    "vllm": None,
    "gemini": "https://generativelanguage.googleapis.com/v1beta/openai/",
    "anthropic": "https://api.anthropic.com/v1/",
    "azure_openai": None,
}

_FACTORIES: dict[str, Callable[..., Model]] = {"echo": EchoModel, "scripted": ScriptedModel, "rule": RuleModel}


def register_model(kind: str, factory: Callable[..., Model]) -> None:
    _FACTORIES[kind] = factory


def get_model(kind: str, **settings: Any) -> Model:
    """A model by kind; the settings given are not changed."""
    if kind in _FACTORIES:
        return _FACTORIES[kind](**settings)
    if kind not in SERVICE_URLS:
        raise ValueError(f"unknown kind of model: {kind}; known: {sorted([*_FACTORIES, *SERVICE_URLS])}")
    settings = dict(settings)
    if kind in ("vllm", "azure_openai") and not settings.get("base_url"):
        raise ValueError(f"{kind} needs a base_url")
    return ServiceModel(**{"base_url": SERVICE_URLS[kind]} | settings)
