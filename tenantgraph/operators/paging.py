"""Keyset pagination: a cursor is a row's sort values and key; null sort values have their place like any other."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantgraph.errors import QueryFailed
from tenantgraph.plans.query import Query
from tenantgraph.types import literal


def _after(c: Column, value: Any, direction: str, storage: str, field: str, backwards: bool) -> tuple[Column, Column]:
    """(strictly beyond the value, equal to it), in the sort's order."""
    descending = direction.startswith("desc")
    nulls_first = direction in ("desc", "asc_nils_first", "desc_nils_first")
    up, nulls_after = descending == backwards, nulls_first == backwards
    if value is None:
        return (F.lit(False) if nulls_after else c.isNotNull()), c.isNull()
    bound = literal(value, storage, field)
    beyond = F.coalesce(c > bound if up else c < bound, F.lit(False))
    return (beyond | c.isNull() if nulls_after else beyond), F.coalesce(c == bound, F.lit(False))


def page(q: Query, size: int, *, after: dict[str, Any] | None = None, before: dict[str, Any] | None = None) -> DataFrame:
    """The rows that follow (or come before) the cursor row, size at most, in the query's order."""
    if after is not None and before is not None or size < 1:
        raise QueryFailed("invalid_page")
    r = q.resource
    sorts = [*q.sorts, *((k, "asc") for k in r.pk if k not in dict(q.sorts))]
    cursor, backwards = (before, True) if before is not None else (after, False)
    if cursor is not None:
        condition, equal = F.lit(False), F.lit(True)
        for name, direction in sorts:
            if name not in r.by_name:
                raise QueryFailed("cursor_over_calculation", field=name)
            q.sort_column(name, direction)
            beyond, same = _after(F.col(f"`{name}`"), cursor[name], direction, r.by_name[name].storage, name, backwards)
            condition, equal = condition | (equal & beyond), equal & same
        q = replace(q, extra=(*q.extra, condition))
    if not backwards:
        return replace(q, sorts=tuple(sorts), limit_=size).to_df()
    turned = {"asc": "desc_nils_first", "asc_nils_last": "desc_nils_first", "asc_nils_first": "desc_nils_last", "desc": "asc_nils_last", "desc_nils_first": "asc_nils_last", "desc_nils_last": "asc_nils_first"}
    last = replace(q, sorts=tuple((n, turned[d]) for n, d in sorts), limit_=size).to_df()
    return last.orderBy(*[q.sort_column(*s) for s in sorts])


def stream(q: Query, size: int = 500) -> Iterator[Any]:
    """All rows, page by page, in bounded memory."""
    cursor = None
    while rows := page(q, size, after=cursor).collect():
        yield from rows
        if len(rows) < size:
            return
        cursor = rows[-1].asDict()
