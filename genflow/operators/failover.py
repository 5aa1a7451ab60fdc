"""Endpoints of one worker process: weighted draws by live health, keys in turn, one event per try.

The pool is a small helper inside a task. What it records leaves the task as
rows and feeds the attempt-log analytics.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from random import Random

from pyspark.sql import DataFrame

from ..functions.attempts import MAX_WEIGHT_HALVINGS

#: Bits of an event id that count a process's tries; those above tell processes apart.
EVENT_BITS = 32


@dataclass(frozen=True)
class Endpoint:
    """One address with its keys; ``name`` is what the attempt log says."""

    name: str
    base_url: str | None = None
    keys: tuple[str, ...] = field(default=(), repr=False)
    weight: int = 1
    version: str | None = None


@dataclass(frozen=True)
class Target:
    """Where a try goes: an endpoint and the key whose turn it is (``key_id`` is its number)."""

    endpoint: Endpoint
    key: str | None = field(repr=False)
    key_id: int | None


def endpoints_of(table: DataFrame, keys: Iterable[str] = ()) -> list[Endpoint]:
    """Endpoints from a settings table (``endpoint``, ``base_url``, ``weight``); each may use all ``keys``.

    The table is configuration, one row per address, and does not grow with the data.
    """
    shared = tuple(keys)
    rows = table.select("endpoint", "base_url", "weight").orderBy("endpoint").collect()
    return [Endpoint(str(r["endpoint"]), r["base_url"], shared, int(r["weight"] or 1)) for r in rows]


class EndpointPool:
    """Draws an endpoint for every try by the weights that are left.

    Each outstanding error halves a weight, at most :data:`MAX_WEIGHT_HALVINGS`
    times and never below 1; a success takes one error off. Sums over blocks of
    weights (a binary indexed tree) keep a draw and an outcome at the logarithm
    of the number of endpoints, so thousands of them cost little.
    """

    def __init__(self, endpoints: list[Endpoint], process: int = 0, seed: int = 0, clock: Callable[[], float] = time.time):
        if not endpoints:
            raise ValueError("no endpoints configured")
        if any(e.weight < 1 for e in endpoints):
            raise ValueError("an endpoint's weight must be at least 1")
        self._endpoints, self._clock = endpoints, clock
        self._errors, self._turn = [0] * len(endpoints), [0] * len(endpoints)
        self._weights, self._sums = [0] * len(endpoints), [0] * (len(endpoints) + 1)
        for i, endpoint in enumerate(endpoints):
            self._weigh(i, endpoint.weight)
        self._random, self._lock = Random(f"{seed}/{process}"), threading.Lock()
        self._event, self._last = process << EVENT_BITS, 0

    def _weigh(self, i: int, weight: int) -> None:
        step, self._weights[i] = weight - self._weights[i], weight
        at = i + 1
        while at < len(self._sums):
            self._sums[at] += step
            at += at & -at

    def _at(self, draw: int) -> int:
        """The endpoint whose share of the weights holds ``draw``."""
        at, width = 0, 1 << (len(self._endpoints).bit_length() - 1)
        while width:
            if at + width < len(self._sums) and self._sums[at + width] <= draw:
                at += width
                draw -= self._sums[at]
            width >>= 1
        return at

    def weights(self) -> list[int]:
        return list(self._weights)

    def pick(self) -> tuple[int, Target]:
        """The next try's endpoint (its number, to report back) and key."""
        with self._lock:
            i = self._at(self._random.randrange(self._total()))
            endpoint, turn = self._endpoints[i], self._turn[i]
            self._turn[i] += 1
        if not endpoint.keys:
            return i, Target(endpoint, None, None)
        key_id = turn % len(endpoint.keys)
        return i, Target(endpoint, endpoint.keys[key_id], key_id)

    def _total(self) -> int:
        at, total = len(self._endpoints), 0
        while at:
            total += self._sums[at]
            at -= at & -at
        return total

    def record(self, i: int, ok: bool) -> dict:
        """Take note of an outcome: the endpoint's name, time (microseconds, never falling), event id and errors left."""
        with self._lock:
            self._errors[i] = max(0, self._errors[i] - 1) if ok else self._errors[i] + 1
            errors = self._errors[i]
            weight = self._endpoints[i].weight
            self._weigh(i, max(1, weight >> min(errors, MAX_WEIGHT_HALVINGS)) if errors else weight)
            self._last = max(self._last, int(self._clock() * 1_000_000))
            event, self._event = self._event, self._event + 1
            return {"endpoint": self._endpoints[i].name, "ts": self._last, "event_id": event, "errors": errors}
