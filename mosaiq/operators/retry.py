"""Running again what failed for a reason that passes."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

T = TypeVar("T")
#: Parts of messages of failures that pass.
PASSING = ("Connection refused", "Connection reset", "connection timed out", "Read timed out", "SlowDown", "Too many requests", "temporarily unavailable")


def passing(error: Exception) -> bool:
    """Whether a failure is one of the network or of a store under load."""
    return isinstance(error, (ConnectionError, TimeoutError)) or any(p.lower() in str(error).lower() for p in PASSING)


@dataclass
class Strategy:
    """``run`` calls again after a passing failure, ``retries`` times at most,
    waiting twice as long each time. Work that is to be whole must be one call."""

    retries: int = 5
    delay: float = 0.5
    longest: float = 30.0
    transient: Callable[[Exception], bool] = passing
    sleep: Callable[[float], None] = time.sleep
    waits: list[float] = field(default_factory=list)

    def run(self, work: Callable[[], T]) -> T:
        for attempt in range(self.retries + 1):
            try:
                return work()
            except Exception as e:
                if attempt == self.retries or not self.transient(e):
                    raise
                self.waits.append(min(self.longest, self.delay * 2**attempt) * random.uniform(0.8, 1.2))
                self.sleep(self.waits[-1])
        raise AssertionError
