"""Why a run ended before it had an answer; the partial answer comes along where there is one."""

from __future__ import annotations


class RunStopped(Exception):
    """The base of all; ``status`` is what session tables hold."""

    status = "stopped"

    def __init__(self, message: str, partial_answer: str | None = None) -> None:
        super().__init__(message)
        self.partial_answer = partial_answer


class BudgetExceeded(RunStopped):
    status = "budget"

    def __init__(self, spent: float, budget: float) -> None:
        super().__init__(f"spent ${spent:.6f} of a budget of ${budget:.6f}")
        self.spent, self.budget = spent, budget


class TimeExceeded(RunStopped):
    status = "timeout"

    def __init__(self, elapsed: float, limit: float, partial_answer: str | None = None) -> None:
        super().__init__(f"ran {elapsed:.1f} s of at most {limit:.1f} s", partial_answer)
        self.elapsed, self.limit = elapsed, limit


class TokensExceeded(RunStopped):
    status = "tokens"

    def __init__(self, used: int, limit: int, partial_answer: str | None = None) -> None:
        super().__init__(f"used {used} of at most {limit} tokens", partial_answer)
        self.used, self.limit = used, limit


class TooManyErrors(RunStopped):
    status = "errors"

    def __init__(self, count: int, limit: int, last_error: str | None = None, partial_answer: str | None = None) -> None:
        super().__init__(f"{count} turns in a row with errors, at most {limit} are allowed", partial_answer)
        self.count, self.limit, self.last_error = count, limit, last_error


class Cancelled(RunStopped):
    status = "cancelled"


BY_STATUS = {c.status: c for c in (BudgetExceeded, TimeExceeded, TokensExceeded, TooManyErrors, Cancelled)}
