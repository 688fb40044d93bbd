"""A polite HTTP client for feeds: paced, retried, told to wait. Plain Python, used inside data source tasks."""

from __future__ import annotations

import email.utils
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable

ATTEMPTS, FIRST_DELAY = 6, 1.0


def retry_after(value: str | None, now: float) -> float | None:
    """Seconds that a Retry-After header asks to wait, given as seconds or as a date."""
    if not value:
        return None
    if value.strip().isdigit():
        return float(value)
    try:
        return max(0.0, email.utils.parsedate_to_datetime(value).timestamp() - now)
    except (TypeError, ValueError):
        return None


class Client:
    """get() gives the body, or None for what is not there. All threads share the pace and any wait that a server asks for."""

    def __init__(self, interval: float, opener: Callable = urllib.request.urlopen, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.opener, self.clock, self.sleep = interval, opener, clock, sleep
        self._lock, self._next = threading.Lock(), 0.0

    def _wait(self) -> None:
        with self._lock:
            now = self.clock()
            at = max(now, self._next)
            self._next = at + self.interval
        if at > now:
            self.sleep(at - now)

    def get(self, request: str | urllib.request.Request) -> bytes | None:
        delay = FIRST_DELAY
        for attempt in range(ATTEMPTS):
            self._wait()
            try:
                with self.opener(request) as answer:
                    return answer.read()
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return None
                if e.code != 429 and e.code < 500 or attempt == ATTEMPTS - 1:
                    raise
                asked = retry_after(e.headers.get("Retry-After") if e.headers else None, self.clock())
                if e.code == 429:
                    with self._lock:
                        self._next = max(self._next, self.clock() + (asked if asked is not None else delay))
                    delay *= 2
                    continue
            except (urllib.error.URLError, TimeoutError) as e:
                if isinstance(getattr(e, "reason", None), FileNotFoundError):
                    return None  # a stored answer that is not there
                if attempt == ATTEMPTS - 1:
                    raise
            self.sleep(delay)
            delay *= 2
        raise RuntimeError("unreachable")
