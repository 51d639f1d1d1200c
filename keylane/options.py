"""Typed, validated options of a keyed event consumer and producer."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import timedelta
from math import isfinite
from typing import Any

ENV_PREFIX = "KEYLANE_"

# The three operating modes and the two span relations.
MODES = ("pipeline", "low_latency", "best_effort")
SPAN_RELATIONS = ("child", "follows_from")

_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0, "y": 31_557_600.0}


def _texts(value: Any) -> tuple[str, ...]:
    if isinstance(value, str):
        return (value,)
    if isinstance(value, Iterable) and not isinstance(value, (bytes, Mapping)):
        return tuple(str(v) for v in value)
    raise ValueError(f"expected a text or a list of texts: {value!r}")


def _seconds(value: Any) -> float:
    if isinstance(value, timedelta):
        return value.total_seconds()
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ValueError(f"expected seconds as a number: {value!r}")
    return float(value)


def _mode(value: Any) -> str:
    mode = str(value).lower()
    if mode not in MODES:
        raise ValueError(f"invalid mode: {value!r}")
    return mode


def _span_relation(value: Any) -> str:
    if str(value) not in SPAN_RELATIONS:
        raise ValueError(f"span relation must be one of {SPAN_RELATIONS}: {value!r}")
    return str(value)


_PARSERS = {"list": _texts, "text": str, "int": int, "float": float, "bool": bool,
            "seconds": _seconds, "mode": _mode, "span": _span_relation}

# Option name, kind, default. A default of None means "unset".
OPTIONS: dict[str, tuple[str, Any]] = {
    "bootstrap_servers": ("list", None),
    "group_id": ("text", None),
    "subscribed_topics": ("list", None),
    "allowed_events": ("list", None),
    "source_system": ("text", None),
    "mock": ("bool", False),
    "mode": ("mode", "pipeline"),
    "max_concurrency": ("int", 32),
    "max_uncommitted": ("int", 64),
    "timeout": ("seconds", None),
    "commit_interval": ("seconds", 1.0),
    "poll_interval": ("seconds", 0.1),
    "shutdown_timeout": ("seconds", 30.0),
    "stall_threshold": ("seconds", 300.0),
    "failure_topic": ("text", None),
    "idempotence_cache_size": ("int", 8192),
    "idempotence_version": ("text", "1"),
    "idempotence_ttl": ("seconds", 604_800.0),
    "slab_size": ("seconds", 3600.0),
    "message_spans": ("span", "child"),
    "timer_spans": ("span", "follows_from"),
    "send_timeout": ("seconds", 1.0),
    "max_retries": ("int", 3),
    "retry_base": ("seconds", 0.02),
    "max_retry_delay": ("seconds", 300.0),
    "defer_enabled": ("bool", True),
    "defer_base": ("seconds", 1.0),
    "defer_max_delay": ("seconds", 86_400.0),
    "defer_failure_threshold": ("float", 0.9),
    "defer_failure_window": ("seconds", 300.0),
    "monopolization_enabled": ("bool", True),
    "monopolization_threshold": ("float", 0.9),
    "monopolization_window": ("seconds", 300.0),
    "scheduler_failure_weight": ("float", 0.3),
    "scheduler_max_wait": ("seconds", 120.0),
    "scheduler_wait_weight": ("float", 200.0),
    "retention": ("seconds", 31_557_600.0),
    "telemetry_topic": ("text", "telemetry-events"),
    "telemetry_enabled": ("bool", True),
    # Spark's own: how late event time may run, and how many records, or bytes of files, a micro-batch takes.
    "watermark_delay": ("seconds", 600.0),
    "max_offsets_per_trigger": ("int", 10_000_000),
    "max_bytes_per_trigger": ("int", 1 << 30),
}


@dataclass(frozen=True, init=False)
class PipelineOptions:
    """Options by keyword, then environment, then default. ``None`` clears one."""

    values: tuple[tuple[str, Any], ...]

    def __init__(self, **given: Any):
        parsed = {}
        for name, value in given.items():
            if name not in OPTIONS:
                raise TypeError(f"unknown option: {name}")
            if value is not None:
                parsed[name] = _PARSERS[OPTIONS[name][0]](value)
        ttl = parsed.get("idempotence_ttl")
        if ttl is not None and not (isfinite(ttl) and ttl >= 0):
            del parsed["idempotence_ttl"]
        object.__setattr__(self, "values", tuple(sorted(parsed.items())))

    def __getattr__(self, name: str) -> Any:
        if name.startswith("_") or name not in OPTIONS:
            raise AttributeError(name)
        set_ = dict(self.values)
        if name in set_:
            return set_[name]
        text = os.environ.get(ENV_PREFIX + name.upper())
        return OPTIONS[name][1] if text is None else _from_text(OPTIONS[name][0], text)

    def replace(self, **changes: Any) -> PipelineOptions:
        return PipelineOptions(**{**dict(self.values), **changes})

    def to_dict(self) -> dict[str, Any]:
        """Only the options that were set."""
        return dict(self.values)

    @property
    def origin(self) -> str | None:
        """What outgoing messages are tagged with: the source system, else the group."""
        return self.source_system or self.group_id

    @property
    def handler_timeout(self) -> float:
        """Deadline of one execution: given, else 80 % of the stall threshold."""
        return 0.8 * self.stall_threshold if self.timeout is None else self.timeout

    @property
    def dedup_enabled(self) -> bool:
        return self.idempotence_cache_size != 0


def _from_text(kind: str, text: str) -> Any:
    if kind == "list":
        return tuple(part for part in text.split(",") if part)
    if kind == "bool":
        return text.strip().lower() in ("1", "true", "yes", "on")
    if kind == "seconds":
        found = re.fullmatch(r"\s*([0-9.]+)\s*(ms|s|m|h|d|y)?\s*", text)
        if not found:
            raise ValueError(f"not a duration: {text!r}")
        return float(found.group(1)) * _UNITS[found.group(2) or "s"]
    return _PARSERS[kind](text)

