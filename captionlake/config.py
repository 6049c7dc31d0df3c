"""Parameters with their defaults and ranges (V06), and where they come from."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    """A parameter is out of its range."""


def _check(ok: bool, what: str) -> None:
    if not ok:
        raise ConfigError(what)


@dataclass(frozen=True)
class ChunkParams:
    """Smart merge: ``low_pct`` selects absolute breaks, the band up to ``high_pct`` candidates."""

    window_size: int = 5
    min_sentences: int = 8
    high_pct: float = 0.05
    low_pct: float = 0.02
    noise_drop_len: int = 2
    noise_weak_len: int = 3

    def __post_init__(self) -> None:
        _check(1 <= self.window_size <= 20, "window_size must be 1 to 20")
        _check(0 <= self.low_pct <= 1 and 0 <= self.high_pct <= 1, "percentages must be 0 to 1")
        _check(self.min_sentences >= 1, "min_sentences must be at least 1")
        _check(self.noise_drop_len >= 0 and self.noise_weak_len >= 0, "noise lengths must not be negative")

    def overlay(self, changes: dict) -> ChunkParams:
        """Inline keys replace fields one by one; others are ignored."""
        known = {f.name for f in fields(self)}
        return replace(self, **{k: v for k, v in changes.items() if k in known})


@dataclass(frozen=True)
class QualityParams:
    window: int = 10
    stride: int = 5
    clean_below: float = 0.2
    questionable_below: float = 0.6


@dataclass(frozen=True)
class AuditParams:
    stuck_sec: int = 600
    warn_sec: int = 420
    stale_sec: int = 1200
    max_failure_rate: float = 0.2
    min_model_total: int = 5
    min_model_success: float = 0.5
    max_retries: int = 3
    #: Dimensions D and F are scored 100 whatever they find, unless this is set.
    fix_clamp: bool = False


@dataclass(frozen=True)
class WatchParams:
    poll_sec: int = 30
    stuck_sec: int = 600
    report_sec: int = 300
    max_retries: int = 3
    slots: int = 1


#: Ranges of configured numbers, both ends included, by their path; None is no bound.
RANGES: dict[str, tuple[float | None, float | None]] = {
    "api.api_timeout": (1, 300),
    "chunking.smart_merge_window_size": (1, 20),
    "chunking.smart_merge_strong_pct": (0, 1),
    "chunking.smart_merge_weak_pct": (0, 1),
    "chunking.smart_merge_min_sentences": (1, None),
    "chunking.smart_merge_noise_drop_len": (0, None),
    "chunking.smart_merge_noise_weak_len": (0, None),
    "chunking.min_chunks": (1, None),
    "chunking.max_chunks": (1, None),
    "chunking.max_chunk_duration_sec": (30, None),
    "embedding.expected_dim": (1, None),
    "embedding.batch_max_size": (1, 256),
    "embedding.timeout": (1, None),
    "summarization.participant_chunks": (1, None),
    "summarization.max_retries": (0, None),
    "summarization.concurrency": (1, 50),
    "summarization.timeout_sec": (1, None),
}


def coerce(text: str, default: Any) -> Any:
    """A variable's text as the kind of value that the default is; the default where it is no such value."""
    if isinstance(default, bool):
        return text.lower() in ("true", "1", "yes", "on")
    if isinstance(default, (int, float)):
        try:
            return type(default)(text)
        except ValueError:
            return default
    if isinstance(default, list):
        try:
            found = json.loads(text)
        except json.JSONDecodeError:
            return default
        return found if isinstance(found, list) else default
    return text


@dataclass(frozen=True)
class Settings:
    """Configured values: environment variables go before the document."""

    document: dict = field(default_factory=dict)
    env: Mapping[str, str] = field(default_factory=lambda: os.environ)

    @classmethod
    def load(cls, folder: str, env: Mapping[str, str] | None = None) -> Settings:
        """``config.json`` in a folder, or ``config.example.json`` where there is none; neither is an error."""
        for name in ("config.json", "config.example.json"):
            path = Path(folder) / name
            if path.exists():
                return cls(json.loads(path.read_text(encoding="utf-8")), os.environ if env is None else env)
        raise ConfigError(f"no configuration in {folder}")

    def value(self, path: str, default: Any = None) -> Any:
        """The document's value at ``a.b.c``; the default where it is absent or null."""
        found: Any = self.document
        for part in path.split("."):
            if not isinstance(found, dict) or part not in found:
                return default
            found = found[part]
        return default if found is None else found

    def get(self, variable: str, path: str, default: Any = None) -> Any:
        told = self.env.get(variable)
        return self.value(path, default) if told is None else coerce(told, default)

    def problems(self) -> list[str]:
        """What is out of range, in order of path; empty if all is well."""
        out = []
        if not isinstance(self.document.get("api"), dict):
            out.append("api is missing")
        for path, (low, high) in RANGES.items():
            found = self.value(path)
            if found is None:
                continue
            if isinstance(found, bool) or not isinstance(found, (int, float)):
                out.append(f"{path} must be a number")
            elif (low is not None and found < low) or (high is not None and found > high):
                out.append(f"{path}={found} is not within {low} and {high}")
        least, most = (self.value(f"chunking.{k}", d) for k, d in (("min_chunks", 2), ("max_chunks", 200)))
        if isinstance(least, int) and isinstance(most, int) and most < least:
            out.append(f"chunking.max_chunks={most} is less than chunking.min_chunks={least}")
        return sorted(out)
