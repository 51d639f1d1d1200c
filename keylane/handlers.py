"""The user's handler: callbacks, error classes and the outcome of a call."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any, NamedTuple

MAX_TIMER_SECOND = 2**32 - 1


class HandlerError(Exception):
    """An error that says itself whether a retry can help."""

    permanent = False


class TransientError(HandlerError):
    """Temporary; the message may be retried."""


class PermanentError(HandlerError):
    """Retrying cannot help."""

    permanent = True


class Cancelled(Exception):
    """The execution was cancelled: by its deadline or by a shutdown."""


def permanent(method: str, *types: type[BaseException]) -> Callable[[type], type]:
    """Class decorator: these errors of ``method`` become permanent."""
    return _wrapped(method, types, PermanentError)


def transient(method: str, *types: type[BaseException]) -> Callable[[type], type]:
    """Class decorator: these errors of ``method`` become transient."""
    return _wrapped(method, types, TransientError)


def _wrapped(method: str, types: tuple, error: type[HandlerError]) -> Callable[[type], type]:
    if not types:
        raise ValueError("name at least one exception type")

    def decorate(cls: type) -> type:
        inner = getattr(cls, method, None)
        if inner is None:
            raise NameError(f"{cls.__name__} has no method {method!r}")

        def outer(self, *args, **kwargs):
            try:
                return inner(self, *args, **kwargs)
            except types as caught:
                raise error(str(caught)) from caught

        setattr(cls, method, outer)
        return cls

    return decorate


class Message:
    """One message as the handler sees it.

    The payload is decoded when it is first read, so a text that is not JSON
    fails in the handler, where errors are classified.
    """

    __slots__ = ("topic", "partition", "offset", "key", "_ts_us", "_text", "_payload")

    def __init__(self, topic: str, partition: int, offset: int, key: str, ts_us: int, text: str | None):
        self.topic, self.partition, self.offset, self.key = topic, partition, offset, key
        self._ts_us, self._text, self._payload = ts_us, text, None

    @property
    def payload(self) -> Any:
        if self._payload is None and self._text is not None:
            self._payload = json.loads(self._text)
        return self._payload

    @property
    def timestamp(self) -> datetime:
        return instant(self._ts_us)


class Timer(NamedTuple):
    """A timer that fired."""

    key: str
    time: datetime


class EventHandler:
    """Base of user handlers."""

    def on_message(self, context, message: Message) -> None:
        raise NotImplementedError("a handler must implement on_message")

    def on_timer(self, context, timer: Timer) -> None:
        raise NotImplementedError("a handler that schedules timers must implement on_timer")


class UsageError(BaseException):
    """A call that the context cannot serve: a fault of the program, never an outcome of a message."""


class ReplayContext:
    """Context of a batch replay: the message's time, and the timers of its key, if they are kept."""

    __slots__ = ("key", "_now_us", "_timers")

    def __init__(self, key: str, now_us: int, timers: set[int] | None = None):
        self.key, self._now_us, self._timers = key, now_us, timers

    @property
    def now(self) -> datetime:
        return instant(self._now_us)

    def should_cancel(self) -> bool:
        """A replay has no deadline."""
        return False

    def _kept(self) -> set[int]:
        if self._timers is None:
            raise UsageError("rows that are handled where they are have no timers of their key; replay them in order")
        return self._timers

    def schedule(self, at: datetime | float) -> None:
        """Add an instant; scheduling it twice keeps one."""
        self._kept().add(timer_second(at))

    def clear_and_schedule(self, at: datetime | float) -> None:
        """Replace all instants by one; an invalid instant changes nothing."""
        second = timer_second(at)
        self._kept().clear()
        self._kept().add(second)

    def unschedule(self, at: datetime | float) -> None:
        """Remove an instant; no effect when it is not scheduled."""
        self._kept().discard(timer_second(at))

    def clear_scheduled(self) -> None:
        self._kept().clear()

    def scheduled(self) -> list[datetime]:
        """The pending instants in order."""
        return [instant(s * 1_000_000) for s in sorted(self._kept())]


class Outcome(NamedTuple):
    outcome: str
    error_class: str | None = None
    message: str | None = None
    cause: str | None = None


def attempt(callback: Callable, context, event) -> Outcome:
    """Call the handler once and name the outcome; unlisted errors are transient."""
    try:
        callback(context, event)
    except Exception as error:
        kind = "permanent" if getattr(error, "permanent", False) is True else "transient"
        cause = error.__cause__
        named = cause if isinstance(error, HandlerError) and cause is not None else error
        return Outcome(kind, type(named).__name__, str(error), None if cause is None else repr(cause))
    return Outcome("success")


def instant(micros: int) -> datetime:
    whole, part = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(whole, timezone.utc).replace(microsecond=part)


def timer_second(at: datetime | int | float) -> int:
    """Nearest whole second of an instant, halves up; an error outside 1970-2106."""
    if isinstance(at, datetime):
        whole = int((at.replace(microsecond=0) - datetime(1970, 1, 1, tzinfo=at.tzinfo or None)).total_seconds()) \
            if at.tzinfo is None else int(at.replace(microsecond=0).timestamp())
        half = at.microsecond >= 500_000
    else:
        micros = round(at * 1_000_000)
        whole, half = micros // 1_000_000, micros % 1_000_000 >= 500_000
    second = whole + 1 if half else whole
    if whole < 0 or second > MAX_TIMER_SECOND:
        raise ValueError(f"time outside 1970-2106: {at!r}")
    return second
