"""Circuit breaker and adaptive rate as folds over ordered calls (T07, T08), one short array per key."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class BreakerParams:
    failures: int = 5
    timeout_sec: float = 30.0
    successes: int = 3
    half_open_calls: int = 3


@dataclass(frozen=True)
class RateParams:
    start: float = 10.0
    low: float = 1.0
    high: float = 50.0
    up: float = 1.2
    down: float = 0.5
    min_latencies: int = 10
    good_ms: float = 1000.0
    #: Latencies that the mean is of, the last ones; None for all of a key.
    keep: int | None = 100


class Breaker:
    """Failures add up while closed (a success does not clear them); any failure while half open opens again."""

    def __init__(self, p: BreakerParams):
        self.p, self.state, self.failed, self.good, self.tried, self.opened = p, "closed", 0, 0, 0, 0.0

    def admits(self, at: float) -> bool:
        """Whether a call at a time would be let through; an open breaker past its timeout is half open from then on."""
        if self.state == "open" and at - self.opened >= self.p.timeout_sec:
            self.state, self.good, self.tried = "half_open", 0, 0
        return self.state == "closed" or self.state == "half_open" and self.tried < self.p.half_open_calls

    def call(self, at: float, ok: bool) -> tuple[str, bool]:
        """State after a call at a time, and whether it was let through."""
        if not self.admits(at):
            return self.state, False
        if self.state == "half_open":
            self.tried += 1
        if ok:
            if self.state == "half_open":
                self.good += 1
                if self.good >= self.p.successes:
                    self.state, self.failed = "closed", 0
        else:
            self.failed += 1
            if self.state == "half_open" or self.failed >= self.p.failures:
                self.state, self.opened = "open", at
        return self.state, True


class Throttle:
    def __init__(self, p: RateParams):
        self.p, self.rate, self.seen, self.n, self.total = p, p.start, deque(maxlen=p.keep), 0, 0.0

    def call(self, latency_ms: float, ok: bool) -> float:
        if not ok:
            self.rate = max(self.p.low, self.rate * self.p.down)
            return self.rate
        if self.p.keep is None:  # of all of them, a sum in order is enough
            self.n, self.total = self.n + 1, self.total + latency_ms
        else:
            self.seen.append(latency_ms)
            self.n, self.total = len(self.seen), sum(self.seen)
        if self.n >= self.p.min_latencies:
            fast = self.total / self.n < self.p.good_ms
            self.rate = min(self.p.high, self.rate * self.p.up) if fast else max(self.p.low, self.rate * self.p.down)
        return self.rate


def replay_calls(calls: DataFrame, breaker: BreakerParams = BreakerParams(), rate: RateParams = RateParams()) -> DataFrame:
    """(key, seq, state, let_through, rate) of calls (key, seq, at_sec, latency_ms, ok) in order of (at_sec, seq).

    Keys are dealt out and sorted, then streamed: a key's calls are never held together.
    """
    n = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, b, t = None, Breaker(breaker), Throttle(rate)
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                if r.key != key:
                    key, b, t = r.key, Breaker(breaker), Throttle(rate)
                state, through = b.call(r.at_sec, bool(r.ok))
                out.append((r.key, r.seq, state, through, t.call(r.latency_ms, bool(r.ok)) if through else t.rate))
            yield pd.DataFrame(out, columns=["key", "seq", "state", "let_through", "rate"])

    dealt = calls.repartition(n, "key").sortWithinPartitions("key", "at_sec", "seq")
    key_type = calls.schema["key"].dataType.simpleString()
    return dealt.mapInPandas(run, f"key {key_type}, seq bigint, state string, let_through boolean, rate double")
