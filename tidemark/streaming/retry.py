"""Bounded retry around a write action on the driver (X8). Lost tasks are retried by Spark itself."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from tidemark.operators.failures import Rule, decide


@dataclass
class RetryPolicy:
    """Attempts and exponential waits; the last error is raised again.

    ``should_retry`` sees each error (G2); every ``Exception`` is retried by default.
    """

    attempts: int = 3
    min_wait: float = 1
    max_wait: float = 10
    should_retry: Callable[[BaseException], bool] = lambda error: True
    sleep: Callable[[float], None] = field(default=time.sleep)

    def __post_init__(self):
        if not 1 <= self.attempts <= 10:
            raise ValueError("attempts must be between 1 and 10")

    def wait_after(self, attempt: int) -> float:
        return max(self.min_wait, min(self.max_wait, 2.0 ** (attempt - 1)))

    def call(self, action: Callable[[], object], on_error: Callable[[int, Exception], None] | None = None):
        """Result of the action and the number of attempts it took."""
        attempt = 1
        while True:
            try:
                return action(), attempt
            except Exception as error:
                if on_error is not None:
                    on_error(attempt, error)
                if attempt >= self.attempts or not self.should_retry(error):
                    raise
                self.sleep(self.wait_after(attempt))
                attempt += 1


def triaged_retry(attempts: int = 3, rules: list[Rule] | None = None, **options) -> RetryPolicy:
    """Retry only what the triage rules call transient (X9), with longer waits."""
    return RetryPolicy(
        attempts, min_wait=2, max_wait=30, should_retry=lambda e: decide(e, rules).should_retry, **options
    )
