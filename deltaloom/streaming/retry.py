"""Which failures are worth another try, and when."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TypeVar

from ..config import RetryConfig

R = TypeVar("R")

#: SQL states of failures that pass.
RETRYABLE_STATES = frozenset({"40001", "40P01", "57P01", "08006"})
INTERNAL_STATE, INTERNAL_MESSAGE = "XX000", "schema version mismatch"
RETRYABLE_MESSAGES = frozenset({"connection is closed", "connection reset by peer"})


class SqlError(Exception):
    """A failure that a database reported, with its SQL state."""

    def __init__(self, message: str = "", sqlstate: str | None = None) -> None:
        super().__init__(message)
        self.sqlstate = sqlstate


class RecoverableError(Exception):
    """The operation can be tried again on the same resource."""


class TransientConnectionError(ConnectionError):
    """A connection that failed for now."""


class TransientDataAccessError(Exception):
    """Access that may work next time."""


class TransactionError(Exception):
    """A transaction that could not be begun or ended."""


RETRYABLE_KINDS = (RecoverableError, TransientConnectionError, TransientDataAccessError, TransactionError)
#: What the JVM calls the same kinds; a driver's own classes extend them.
JVM_KINDS = ("java.sql.SQLRecoverableException", "java.sql.SQLTransientConnectionException")


def chain(error: BaseException) -> Iterator[BaseException]:
    """The error and its causes, each once. An error that merely was on the way when another one came up is no cause."""
    seen: set[int] = set()
    at: BaseException | None = error
    while at is not None and id(at) not in seen:
        seen.add(id(at))
        yield at
        at = at.__cause__


def is_sql(error: BaseException) -> bool:
    """Whether a database reported it: it is an SqlError, or has a place for an SQL state."""
    return isinstance(error, SqlError) or any(hasattr(error, n) for n in ("sqlstate", "pgcode", "getSqlState"))


def sql_state(error: BaseException) -> str | None:
    for name in ("sqlstate", "pgcode"):
        if isinstance(v := getattr(error, name, None), str):
            return v
    get = getattr(error, "getSqlState", None)
    return get() if callable(get) else None


def retryable_link(state: str | None, message: str | None) -> bool:
    """Whether an SQL error passes: by its state; under the internal state, by words of its message as they stand; or by its whole message in any case."""
    text = message or ""
    return state in RETRYABLE_STATES or (state == INTERNAL_STATE and INTERNAL_MESSAGE in text) or text.lower() in RETRYABLE_MESSAGES


def _jvm_links(error: BaseException) -> Iterator[tuple[object, str | None, str | None]]:
    """(throwable, SQL state, message) of the JVM's causes behind an error; the state only of SQL exceptions."""
    at = getattr(error, "java_exception", None)
    for _ in range(64):
        if at is None:
            return
        get = getattr(at, "getSQLState", None)
        yield at, get() if callable(get) and _kind_of(at, "java.sql.SQLException") else None, at.getMessage()
        at = at.getCause()


def _kind_of(throwable, name: str) -> bool:
    kind = throwable.getClass()
    for _ in range(32):
        if kind is None:
            return False
        if kind.getName() == name:
            return True
        kind = kind.getSuperclass()
    return False


def is_retryable(error: BaseException) -> bool:
    for e in chain(error):
        if isinstance(e, RETRYABLE_KINDS) or (is_sql(e) and retryable_link(sql_state(e), str(e))):
            return True
        for throwable, state, message in _jvm_links(e):
            if any(_kind_of(throwable, k) for k in JVM_KINDS) or (_kind_of(throwable, "java.sql.SQLException") and retryable_link(state, message)):
                return True
    return False


def backoff_schedule(cfg: RetryConfig) -> list[int]:
    """Waits in ms between the tries."""
    return [int(min(cfg.max_ms, cfg.initial_ms * cfg.multiplier**i)) for i in range(cfg.max_attempts - 1)]


def with_retry(run: Callable[[], R], cfg: RetryConfig, sleep: Callable[[float], None] = time.sleep) -> R:
    waits = backoff_schedule(cfg)
    for wait in [*waits, None]:
        try:
            return run()
        except Exception as e:
            if wait is None or not is_retryable(e):
                raise
            sleep(wait / 1000)
    raise AssertionError("unreachable")
