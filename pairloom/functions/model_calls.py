"""One core for all calls of plugged-in models: nulls, call sizes, retries, errors per row."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, Literal

OnError = Literal["null", "raise"]


@dataclass(frozen=True)
class Retry:
    """How often a refused call is tried again, and how long to wait before that.

    Only failures that may pass are tried again: status 429 or 5xx (an attribute ``status``,
    ``status_code`` or ``code`` of the error or of its ``response``), timeouts and lost
    connections. Waits grow by ``growth`` up to ``longest`` seconds, with up to ``jitter`` of
    each more, so that tasks do not call again all at once. A server's ``retry_after`` (seconds,
    on the error) is waited for at least.
    """

    attempts: int = 1
    wait: float = 1.0
    growth: float = 2.0
    longest: float = 60.0
    jitter: float = 0.25

    def pause(self, failure: Exception, tried: int) -> float | None:
        """Seconds to wait after ``tried`` attempts, or None to give up."""
        if tried >= self.attempts or not may_pass(failure):
            return None
        wait = min(self.longest, self.wait * self.growth ** (tried - 1))
        asked = getattr(failure, "retry_after", None)
        return max(wait * (1 + self.jitter * random.random()), float(asked or 0))


def may_pass(failure: Exception) -> bool:
    """Whether the same call may succeed later."""
    if isinstance(failure, (TimeoutError, ConnectionError)):
        return True
    for holder in (failure, getattr(failure, "response", None)):
        for name in ("status", "status_code", "code"):
            status = getattr(holder, name, None)
            if isinstance(status, int):
                return status == 429 or 500 <= status < 600
    return False


def call_model(
    model: Callable[..., Sequence[Any]],
    inputs: Sequence[Sequence[Any]],
    on_error: OnError = "null",
    call_size: int = 64,
    retry: Retry = Retry(),
    by_length: bool = False,
) -> list[tuple[Any, str | None, int]]:
    """``(value, error, attempts)`` for each row of the parallel lists ``inputs``.

    A row with a null in any input is not sent and gets ``(None, None, 0)``. At most
    ``call_size`` rows go into one call. With ``by_length`` rows are sent in the order of their
    length, so that a model which pads pads little; answers come back on their rows. A call
    that fails is tried again as ``retry`` says. If it fails for good and ``on_error`` is
    ``null``, its rows are tried one by one, and each failure is recorded with its row.
    ``attempts`` counts the calls that a row was part of.
    """
    rows = list(zip(*inputs))
    sent = [k for k, row in enumerate(rows) if all(value is not None for value in row)]
    if by_length:
        sent.sort(key=lambda k: sum(len(v) if isinstance(v, (str, list)) else 1 for v in rows[k]))
    out: list[tuple[Any, str | None, int]] = [(None, None, 0)] * len(rows)
    for at in range(0, len(sent), call_size):
        call = sent[at : at + call_size]
        for k, answer in zip(call, _answers(model, [rows[k] for k in call], on_error, retry)):
            out[k] = answer
    return out


def _answers(model, rows: list[tuple], on_error: OnError, retry: Retry, before: int = 0) -> list[tuple]:
    tried = 0
    while True:
        tried += 1
        try:
            values = list(model(*map(list, zip(*rows))))
            if len(values) != len(rows):
                raise ValueError(f"model gave {len(values)} texts for {len(rows)} prompts")
            return [(value, None, before + tried) for value in values]
        except Exception as failure:
            wait = retry.pause(failure, tried)
            if wait is not None:
                time.sleep(wait)
                continue
            if on_error == "raise":
                raise
            if len(rows) == 1:
                return [(None, str(failure) or type(failure).__name__, before + tried)]
            one = [_answers(model, [row], on_error, retry, before + tried) for row in rows]
            return [answer for answers in one for answer in answers]
