"""Fetching over HTTP with guard rails: a pace, retries with growing pauses, and a circuit that opens
after failures in a row. The transport is a function, so that tests and other clients can stand in."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

from tessera.errors import AuthenticationError, CircuitOpenError, HttpError, PayloadError, RateLimitedError

CHUNK = 1 << 16
#: What may pass when asked again.
AGAIN = (429, 500, 502, 503, 504)
DETAIL = 300


@dataclass
class Response:
    status: int
    headers: Mapping[str, str]
    chunks: Iterator[bytes]

    def text(self) -> str:
        return b"".join(self.chunks).decode("utf-8", "replace")


Transport = Callable[[str, float], Response]


def urllib_transport(headers: Mapping[str, str] | None = None) -> Transport:
    def fetch(url: str, timeout: float) -> Response:
        request = urllib.request.Request(url, headers=dict(headers or {}))
        try:
            got = urllib.request.urlopen(request, timeout=timeout)
        except urllib.error.HTTPError as e:
            got = e

        def chunks() -> Iterator[bytes]:
            with got:
                while block := got.read(CHUNK):
                    yield block

        return Response(got.status, dict(got.headers), chunks())

    return fetch


@dataclass
class Pace:
    """At least `gap` seconds between requests and at most `per_minute` in 60 seconds (0: any)."""

    per_minute: int = 600
    gap: float = 0.2
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _times: list[float] = field(default_factory=list)

    def wait(self) -> None:
        now = self.clock()
        due = self._times[-1] + self.gap if self._times else now
        if self.per_minute > 0:
            self._times = [t for t in self._times[-self.per_minute :] if t > now - 60]
            if len(self._times) >= self.per_minute:
                due = max(due, self._times[-self.per_minute] + 60)
        if due > now:
            self.sleep(due - now)
        self._times.append(max(now, due))


@dataclass
class Circuit:
    """Opens after `threshold` failures in a row; after `rest` seconds one trial may close it again."""

    threshold: int = 5
    rest: float = 60.0
    clock: Callable[[], float] = time.monotonic
    failures: int = 0
    until: float | None = None
    trying: bool = False

    def check(self) -> None:
        if self.until is None:
            return
        if self.trying or self.clock() < self.until:
            raise CircuitOpenError(f"{self.failures} failures in a row")
        self.trying = True

    def succeeded(self) -> None:
        self.failures, self.until, self.trying = 0, None, False

    def failed(self) -> None:
        self.failures += 1
        if self.trying or self.failures >= self.threshold:
            self.until, self.trying = self.clock() + self.rest, False


@dataclass
class Retries:
    most: int = 3
    factor: float = 0.5
    longest: float = 60.0
    jitter: float = 0.1

    def pause(self, attempt: int, asked: float | None = None) -> float:
        """Doubling from `factor`, `longest` at most, never below what the server asked for."""
        return max(min(self.longest, self.factor * 2**attempt), asked or 0.0) + random.uniform(0, self.jitter)


def retry_after(headers: Mapping[str, str], now: datetime | None = None) -> float | None:
    """Seconds that a server asks to wait, from a number or a date; else null."""
    value = next((v for k, v in headers.items() if k.lower() == "retry-after"), "").strip()
    if value.isdigit():
        return float(value)
    try:
        at = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    at = at if at.tzinfo else at.replace(tzinfo=UTC)
    return max(0.0, float(int((at - (now or datetime.now(UTC))).total_seconds())))


class Client:
    def __init__(self, transport: Transport, pace: Pace | None = None, circuit: Circuit | None = None, retries: Retries | None = None, cache=None, timeout: float = 30.0):
        self.transport, self.pace, self.circuit, self.retries = transport, pace or Pace(), circuit or Circuit(), retries or Retries()
        self.cache, self.timeout = cache, timeout

    def fetch(self, url: str) -> Response:
        """A response that isn't an error."""
        for attempt in range(self.retries.most + 1):
            self.circuit.check()
            self.pace.wait()
            last = attempt == self.retries.most
            try:
                got = self.transport(url, self.timeout)
            except OSError as e:  # timeouts and broken connections are such
                if last:
                    self.circuit.failed()
                    raise HttpError(0, str(e)) from e
                self.pace.sleep(self.retries.pause(attempt))
                continue
            if got.status < 400:
                self.circuit.succeeded()
                return got
            asked = retry_after(got.headers)
            if got.status in AGAIN and not last:
                self.pace.sleep(self.retries.pause(attempt, asked))
                continue
            self.circuit.failed()
            if got.status in (401, 403):
                raise AuthenticationError(got.status, " ".join(got.text().split())[:DETAIL])
            if got.status == 429:
                raise RateLimitedError(asked or 60)
            raise HttpError(got.status, " ".join(got.text().split())[:DETAIL])
        raise AssertionError("unreachable")

    def get_json(self, url: str, key: str | None = None) -> dict:
        """A JSON object, from the cache where it holds the key."""
        if key and self.cache is not None and (known := self.cache.get(key)) is not None:
            return known
        try:
            got = json.loads(self.fetch(url).text())
        except json.JSONDecodeError as e:
            raise PayloadError(f"{url}: {e}") from e
        if not isinstance(got, dict):
            raise PayloadError(f"{url}: not an object")
        if key and self.cache is not None:
            self.cache.set(key, got)
        return got

    def chunks(self, url: str) -> Iterator[bytes]:
        """A body in blocks of at most CHUNK bytes."""
        for block in self.fetch(url).chunks:
            for at in range(0, len(block), CHUNK):
                yield block[at : at + CHUNK]
