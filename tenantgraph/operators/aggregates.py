"""Ungrouped aggregates of a query: any number of them in one scan."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tenantgraph import telemetry
from tenantgraph.errors import UnsupportedAggregate, redacted
from tenantgraph.functions.expr import Compiler, Expr
from tenantgraph.plans.query import Query
from tenantgraph.resource import Resource
from tenantgraph.types import is_orderable, is_summable, literal

KINDS = ("count", "exists", "sum", "avg", "min", "max", "first", "list")


@dataclass(frozen=True)
class Aggregate:
    name: str
    kind: str
    field: str | None = None
    uniq: bool = False
    default: Any = None
    where: Expr | None = None
    sort: tuple[tuple[str, str], ...] = ()
    include_nil: bool = False


def check(a: Aggregate, resource: Resource, strict: bool, per_parent: bool = False) -> None:
    def refuse(reason: str) -> None:
        raise UnsupportedAggregate(reason, operator=a.kind, field=a.field)

    if a.kind not in KINDS:
        refuse("unsupported_kind")
    if a.field is None:
        if a.kind not in ("count", "exists"):
            refuse("field_required")
        return
    if "." in a.field:
        refuse("relationship_path")
    if a.field in resource.calculations:
        refuse("calculated_field")
    attribute = resource.by_name.get(a.field)
    if attribute is None or attribute.skip or attribute.sensitive:
        refuse("field_not_stored")
    storage = attribute.storage
    loose = not strict and storage == "decimal"
    if a.kind in ("sum", "avg") and not is_summable(storage) and not loose:
        refuse("field_not_summable")
    if a.kind in ("min", "max", "first") and not is_orderable(storage) and not loose:
        refuse("field_not_orderable")
    if a.kind == "list" and storage == "binary":
        refuse("binary_list")
    if a.include_nil and strict and not per_parent:
        refuse("include_nil")


def column(a: Aggregate, q: Query, present: Column | None = None) -> Column:
    """present: that a row is there at all, for rows from an outer join."""
    conditions = [c for c in (present, a.where is not None and Compiler(q.resource, q.strict).column(a.where)) if c is not None and c is not False]
    held = None
    for c in conditions:
        held = c if held is None else held & c
    pick = lambda c: c if held is None else F.when(held, c)
    if a.kind in ("count", "exists") and a.field is None or a.kind == "exists":
        n = F.count(pick(F.lit(1)))
        return (n > 0 if a.kind == "exists" else n).alias(a.name)
    c = F.col(f"`{a.field}`")
    storage = q.resource.by_name[a.field].storage
    keys = [F.col(f"`{k}`") for k in q.resource.pk]
    if a.kind == "count":
        return (F.count_distinct(pick(c)) if a.uniq else F.count(pick(c))).alias(a.name)
    if a.kind in ("sum", "avg", "min", "max"):
        out = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[a.kind](pick(c))
    elif a.uniq and a.kind == "list":
        out = F.sort_array(F.collect_set(pick(c)))
    else:
        order = [q.sort_column(*s) for s in a.sort]  # guards; the order itself is built from places that compare
        del order
        rank = F.struct(*[x for s in a.sort for x in _place(F.col(f"`{s[0]}`"), s[1], q.resource.by_name[s[0]].storage)], *keys, c.alias("__tg_value"))
        there = F.lit(True) if a.include_nil else c.isNotNull()
        ranked = F.when(there if held is None else held & there, rank)
        out = F.min(ranked)["__tg_value"] if a.kind == "first" else F.transform(F.sort_array(F.collect_list(ranked)), lambda x: x["__tg_value"])
    if a.default is not None:
        if a.kind == "list":
            out = F.when(F.size(out) == 0, F.lit(list(a.default))).otherwise(out)
        else:
            out = F.coalesce(out, literal(a.default, "float" if a.kind == "avg" else storage, a.field))
    return out.alias(a.name)


def _place(c: Column, direction: str, storage: str) -> list[Column]:
    """Columns that ascend as the direction goes, nulls in their place."""
    descending = direction.startswith("desc")
    nulls_first = direction in ("desc", "asc_nils_first", "desc_nils_first")
    null = F.when(c.isNull(), F.lit(0 if nulls_first else 2)).otherwise(F.lit(1))
    if not descending:
        return [null, c]
    if storage in ("integer", "float"):
        return [null, -c]
    if storage == "boolean":
        return [null, ~c]
    if storage == "date":
        return [null, -F.unix_date(c)]
    if storage in ("utc_datetime", "naive_datetime", "time"):
        return [null, -(c if storage == "time" else F.unix_micros(c.cast("timestamp")))]
    if storage in ("string", "ci_string", "uuid"):  # complement of the bytes, closed by a byte above all
        return [null, F.concat(F.translate(F.hex(c.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    raise UnsupportedAggregate("field_not_orderable")


def aggregate(q: Query, *aggregates: Aggregate) -> DataFrame:
    """One row with a column per aggregate, all from one scan. Over a distinct query they see its representatives."""
    for a in aggregates:
        check(a, q.resource, q.strict)
    if q.branches and q.strict:
        raise UnsupportedAggregate("aggregate_over_combination")
    df = q.rows() if q.distincts or q.branches else q.filtered()
    return df.agg(*[column(a, q) for a in aggregates])


def fold(q: Query, *aggregates: Aggregate) -> Row:
    """The row of aggregate, under a span."""
    with telemetry.span("aggregate", resource=q.resource.label, kinds=[a.kind for a in aggregates], aggregate_count=len(aggregates)):
        return redacted(lambda: aggregate(q, *aggregates).first())
