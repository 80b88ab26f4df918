"""Spans with an allow-list of metadata, and row counts by Spark observations."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ALLOWED = frozenset({"operation", "resource", "kinds", "row_count", "destination_count", "depth", "aggregate_count", "duration_s", "outcome", "reason", "changes"})
_handlers: list[Callable[[str, dict[str, Any]], None]] = []


def attach(handler: Callable[[str, dict[str, Any]], None]) -> None:
    _handlers.append(handler)


def detach(handler: Callable[[str, dict[str, Any]], None]) -> None:
    _handlers.remove(handler)


def emit(event: str, **metadata: Any) -> None:
    kept = {k: v for k, v in metadata.items() if k in ALLOWED}
    for handler in list(_handlers):
        handler(event, kept)


@contextmanager
def span(event: str, **metadata: Any) -> Iterator[dict[str, Any]]:
    began, more = time.monotonic(), dict(metadata)
    try:
        yield more
    except Exception as e:
        emit(event, **more, outcome="error", reason=getattr(e, "reason", type(e).__name__), duration_s=time.monotonic() - began)
        raise
    emit(event, **more, outcome="ok", duration_s=time.monotonic() - began)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and an observation that has row_count once an action has run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
