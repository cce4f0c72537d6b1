"""Logging in UTC, and progress of steps."""

from __future__ import annotations

import logging
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager

FORMAT = "%(asctime)sZ %(levelname)s %(name)s: %(message)s"


def logger(name: str = "tessera", level: int = logging.INFO) -> logging.Logger:
    """A logger that writes UTC times to standard error; asking again adds nothing."""
    out = logging.getLogger(name)
    if not out.handlers:
        handler = logging.StreamHandler(sys.stderr)
        handler.setFormatter(logging.Formatter(FORMAT, "%Y-%m-%dT%H:%M:%S"))
        handler.formatter.converter = time.gmtime
        out.addHandler(handler)
        out.propagate = False
    out.setLevel(level)
    return out


@contextmanager
def progress(step: str) -> Iterator[None]:
    """Says when a step starts and how long it took, also when it failed."""
    log, start = logger(), time.monotonic()
    log.info("%s started", step)
    try:
        yield
    except BaseException:
        log.error("%s failed after %.1f s", step, time.monotonic() - start)
        raise
    log.info("%s took %.1f s", step, time.monotonic() - start)
