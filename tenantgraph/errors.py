"""Errors name a class, an operator and a field, never a value."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class GraphError(Exception):
    """Base. ``reason`` is a static word; no data of the query or the table ever enters the message."""

    def __init__(self, reason: str, *, operator: str | None = None, field: str | None = None):
        self.reason, self.operator, self.field = reason, operator, field
        super().__init__(" ".join(x for x in (reason, operator and f"operator={operator}", field and f"field={field}") if x))


class QueryFailed(GraphError): ...


class UnsupportedFilter(GraphError): ...


class UnsortableField(GraphError): ...


class UnsupportedAggregate(GraphError): ...


class NotFilterable(GraphError): ...


class TenantRequired(GraphError): ...


class CreateFailed(GraphError): ...


class UpdateFailed(GraphError): ...


class StaleRecord(GraphError): ...


class InvalidRelationship(GraphError): ...


class ConcurrentModification(GraphError): ...


class InvalidResource(GraphError): ...


class CdcError(GraphError): ...


def redacted[T](action: Callable[[], T], kind: type[GraphError] = QueryFailed) -> T:
    """Runs an action; engine errors, whose text holds literals and data, come out as a bare reason."""
    try:
        return action()
    except GraphError:
        raise
    except Exception as e:  # noqa: BLE001
        condition: Any = getattr(e, "getCondition", lambda: None)() or type(e).__name__
        raise kind(f"failed: {condition}") from None
