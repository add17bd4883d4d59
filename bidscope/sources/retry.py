"""SRC2: retries on a lost connection while a read is planned.

Tasks that lose their connection are retried by Spark (``spark.task.maxFailures``). The driver
reads a JDBC table's schema itself, while the query is built, where nothing retries;
``with_retry`` does. Any other error, a wrong password or table name for example, is raised at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TypeVar

R = TypeVar("R")
# Attempts and waits of the reference's warehouse queries, and its error codes of a lost connection.
ATTEMPTS = 3
LONGEST_WAIT = 8
LOST_CODES = (2006, 2013)
# SQLSTATE class of connection exceptions.
LOST_STATE = "08"


def _causes(error) -> Iterator:
    """A Java exception and its causes."""
    for _ in range(20):
        if error is None:
            return
        yield error
        error = error.getCause()


def lost_connection(error: BaseException) -> bool:
    """Is this the loss of a database connection (by error code or SQLSTATE), or of a socket in Python?"""
    if isinstance(error, ConnectionError):
        return True
    from py4j.protocol import Py4JJavaError
    if not isinstance(error, Py4JJavaError):
        return False
    for e in _causes(error.java_exception):
        # only SQL exceptions have a code and a state
        if "SQLException" in _kinds(e) and (e.getErrorCode() in LOST_CODES or (e.getSQLState() or "").startswith(LOST_STATE)):
            return True
    return False


def _kinds(error) -> set[str]:
    """Simple names of a Java object's class and its superclasses."""
    out, kind = set(), error.getClass()
    while kind is not None:
        out.add(kind.getSimpleName())
        kind = kind.getSuperclass()
    return out


def with_retry(read: Callable[[], R], attempts: int = ATTEMPTS, lost: Callable[[BaseException], bool] = lost_connection,
               sleep: Callable[[float], None] = time.sleep) -> R:
    """``read()``, tried ``attempts`` times while the connection is lost, after 2, 4, 8, 8, ... seconds."""
    for attempt in range(1, attempts + 1):
        try:
            return read()
        except Exception as e:
            if attempt >= attempts or not lost(e):
                raise
        sleep(min(2 ** attempt, LONGEST_WAIT))
    raise ValueError("attempts must be at least 1")
